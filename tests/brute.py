"""Plain Python counterparts of operators, written apart from the engine, for comparison on small tables."""

from __future__ import annotations

import re
from datetime import UTC, date, datetime, timedelta, timezone
from zoneinfo import ZoneInfo

NAMES = {"Z": 0, "GMT": 0, "UTC": 0, "EST": -5, "EDT": -4, "PST": -8, "PDT": -7, "NST": -3.5, "NDT": -2.5, "CET": 1, "CEST": 2, "EET": 2, "EEST": 3, "JST": 9, "IST": 5.5}
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]


def micros(d: datetime) -> int:
    return (d - datetime(1970, 1, 1, tzinfo=UTC)) // timedelta(microseconds=1)


def instants(text: str | None, zone: str) -> set[int]:
    """All instants (epoch microseconds) a text may mean."""
    if text is None:
        return set()
    t = text.strip().lower()
    t = t.translate(str.maketrans("０１２３４５６７８９：", "0123456789:"))
    t = re.sub(r"\[.*\]$", "", t).replace("年", "-").replace("月", "-").replace("日", " ").replace("時", ":").replace("分", "").strip()
    if re.fullmatch(r"\d{13}", t):
        return {int(t) * 1000}
    if m := re.fullmatch(r"(\d{10})(?:\.(\d+))?", t):
        return {int(m[1]) * 1_000_000 + int((m[2] or "0")[:6].ljust(6, "0"))}
    days = []
    if m := re.match(r"(\d{4})[-/](\d{1,2})[-/](\d{1,2})(.*)", t) or re.match(r"(\d{4})(\d\d)(\d\d)(t.*)", t):
        days, rest = [(m[1], m[2], m[3])], m[4]
    elif m := re.match(r"(\d{1,2})\.(\d{1,2})\.(\d{4})(.*)", t):
        days, rest = [(m[3], m[2], m[1])], m[4]
    elif m := re.match(r"(\d{1,2})/(\d{1,2})/(\d{4})(.*)", t):
        days, rest = [(m[3], m[2], m[1]), (m[3], m[1], m[2])], m[4]
    elif m := re.match(r"[a-z]{3}, (\d\d) ([a-z]{3}) (\d{4})(.*)", t):
        days, rest = [(m[3], MONTHS.index(m[2]) + 1, m[1])], m[4]
    else:
        return set()
    m = re.fullmatch(r"[t\s]*(\d{1,2}):?(\d\d)(?::?(\d\d)(?:\.(\d+))?)?\s*([ap]m)?\s*([a-z]+|[+-]\d\d:?\d\d)?", rest)
    if not m:
        return set()
    h, us = int(m[1]), int((m[4] or "0")[:6].ljust(6, "0"))
    if m[5]:
        h = h % 12 + 12 * (m[5] == "pm")
    found = set()
    for y, mo, d in days:
        try:
            wall = datetime(int(y), int(mo), int(d), h, int(m[2]), int(m[3] or 0), us)
        except ValueError:
            continue
        if m[6] and m[6][0] in "+-":
            sign, digits = (-1 if m[6][0] == "-" else 1), m[6][1:].replace(":", "")
            found.add(micros(wall.replace(tzinfo=timezone(sign * timedelta(hours=int(digits[:2]), minutes=int(digits[2:]))))))
        elif m[6] and m[6].upper() in NAMES:
            found.add(micros(wall.replace(tzinfo=UTC)) - int(NAMES[m[6].upper()] * 3600e6))
        else:
            for fold in (0, 1):
                found.add(micros(wall.replace(tzinfo=ZoneInfo(zone), fold=fold).astimezone(UTC)))
    return found


def read(text: str | None, zone: str, feed_ts: int | None) -> int | None:
    found = instants(text, zone)
    if not found:
        return None
    return min(found, key=lambda x: abs(x - feed_ts * 1_000_000)) if feed_ts is not None else min(found)


def timetable(dc_date: str | None, clocks: list[str | None]) -> list[tuple[int, int]]:
    """(item, micros) of the date (item 0) and of each readable departure."""
    at = read(dc_date, "Asia/Tokyo", None)
    if at is None:
        return []
    day = datetime.fromtimestamp(at / 1e6, ZoneInfo("Asia/Tokyo")).date()
    out, shift, last = [(0, at)], 0, None
    for i, x in enumerate(clocks or [], 1):
        if x is None:
            continue
        digits = re.sub(r"\D", ":", x.translate(str.maketrans("０１２３４５６７８９：", "0123456789:"))).strip(":")
        parts = [int(v) for v in (digits.split(":") if ":" in digits else [digits[:-2], digits[-2:]])] + [0]
        s = parts[0] * 3600 + parts[1] * 60 + parts[2]
        if last is not None and s < last:
            shift += 1
        last = s
        midnight = datetime(day.year, day.month, day.day, tzinfo=ZoneInfo("Asia/Tokyo"))
        out.append((i, micros(midnight.astimezone(UTC)) + (shift * 86400 + s) * 1_000_000))
    return out


def day_number(d: date) -> int:
    return (d - date(1970, 1, 1)).days

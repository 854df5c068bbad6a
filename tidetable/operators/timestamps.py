"""Mixed timestamp spellings and zones to one UTC instant, by expectation-maximisation over format mixtures per source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY = 86_400_000_000

#: Zone abbreviations of the IANA zones they belong to, as seconds east of UTC.
ABBREVIATIONS = {
    "America/Los_Angeles": {"PST": -28800, "PDT": -25200},
    "America/New_York": {"EST": -18000, "EDT": -14400},
    "America/St_Johns": {"NST": -12600, "NDT": -9000},
    "Asia/Kolkata": {"IST": 19800},
    "Asia/Tokyo": {"JST": 32400},
    "Australia/Lord_Howe": {"LHST": 37800, "LHDT": 39600},
    "Europe/Helsinki": {"EET": 7200, "EEST": 10800},
    "Europe/Zurich": {"CET": 3600, "CEST": 7200},
}
#: Interpretations a value may have, by position: written order, day first or month first, each as the earlier or the later of
#: two instants with the same wall clock.
KINDS = ("plain", "plain_later", "day_first", "day_first_later", "month_first", "month_first_later")

#: Every readable form at once: an epoch; or a date (year first, year last, named month) with an optional clock, half of the day and zone.
_FORM = (r"^(?:(\d{10}|\d{13}|\d{16}|\d{19})(?:[.,](\d+))?"
         r"|(?:(\d{4})([-/.]?)(\d{1,2})\4(\d{1,2})|(\d{1,2})([-/.])(\d{1,2})\8(\d{4})|(?:[A-Z]{3,9},?\s+)?(\d{1,2})[\s-]([A-Z]{3,9})[\s-](\d{4}))"
         r"(?:[T\s,]\s*(\d{1,2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d+))?)?)?\s*([AP]M)?\s*(Z|[+-]\d{2}(?::?\d{2})?|[A-Z]{3,5})?\s*(?:\[[^\]]*\])?)?)$")
#: Its parts in one text: epoch, its fraction, year, month or second number, day or first number, month name, separator of a date
#: with the year last, hour, minute, second, fraction, half, zone. Of the three dates one matches, so parts of one meaning are written together.
_PARTS = "$1|$2|$3$10$13|$5$9|$6$7$11|$12|$8|$14|$15|$16|$17|$18|$19"
#: Dates with the year last whose first two numbers may be day and month or month and day; the only spellings that need a mixture.
_TWO_ORDERS = r"^\d{1,2}([-/])\d{1,2}\1\d{4}(?:\D|$)"
#: What every such date begins with before it is made plain; it spares other texts the closer look.
_MAYBE_TWO_ORDERS = r"^[\s　]*[0-9０-９]{1,2}[-/－／年月]"
_MONTHS = "JANFEBMARAPRMAYJUNJULAUGSEPOCTNOVDEC"
#: Likelihood ratios and weights stay within these, so that no value alone makes the other order impossible.
_MOST_ODDS, _LEAST_WEIGHT = 1e18, 1e-6


def plain_text(text: Column) -> Column:
    """Upper case without outer space; full-width digits and colons and the date marks of Japanese as ASCII."""
    t = F.translate(text, "０１２３４５６７８９：／－．　", "0123456789:/-. ")
    t = F.when(F.contains(t, F.lit("分")), F.regexp_replace(t, r"分(?=\d)", ":")).otherwise(t)
    t = F.translate(t, "年月日時分秒", "-- :")
    # a text of as many bytes as characters is ASCII and holds nothing to translate
    return F.upper(F.btrim(F.when(F.octet_length(text) == F.length(text), text).otherwise(t), F.lit(" \t\n\r\f\x0b")))


def _micros(digits: Column) -> Column:
    """Digits after the point as microseconds; further digits are cut."""
    return F.rpad(F.substring(digits, 1, 6), 6, "0").try_cast("bigint")


def _offset(at: Column, zone: Column) -> Column:
    return F.unix_micros(F.from_utc_timestamp(F.timestamp_micros(at), zone)) - at


def _instants(local: Column, zone: Column, before: Column, after: Column) -> tuple[Column, Column]:
    """:func:`local_instants`, given the offsets a day before and a day after; only where these differ are more looked up."""
    one, two = local - before, local - after
    one_ok, two_ok = one + _offset(one, zone) == local, two + _offset(two, zone) == local
    early = F.when(before == after, one).otherwise(F.when(one_ok & two_ok, F.least(one, two)).when(two_ok & ~one_ok, two).otherwise(one))
    return early, F.when(before != after, F.when(one_ok & two_ok, F.greatest(one, two)))


def local_instants(local: Column, zone: Column) -> tuple[Column, Column]:
    """The earlier and the later UTC instant (micros) with wall clock ``local`` (micros as if UTC) in ``zone``.

    The later one is null unless the clock was put back over that time. A wall clock that was skipped is read with the
    offset in force before the change. Null without a zone.
    """
    return _instants(local, zone, _offset(local - DAY, zone), _offset(local + DAY, zone))


def _shift(mark: Column, zone: Column) -> Column:
    """Seconds east of UTC of a stated zone; null for names that are not the zone's own."""
    sign = F.when(F.substring(mark, 1, 1) == "-", -1).otherwise(1)
    numeric = sign * (F.substring(mark, 2, 2).try_cast("int") * 3600 + F.when(F.length(mark) > 3, F.substring(mark, -2, 2).try_cast("int") * 60).otherwise(0))
    named = F.create_map(*[F.lit(x) for z, names in ABBREVIATIONS.items() for a, s in names.items() for x in (f"{z} {a}", s)])
    return F.when(mark.isin("Z", "GMT", "UTC"), 0).when(F.substring(mark, 1, 1).isin("+", "-"), numeric).otherwise(F.try_element_at(named, F.concat_ws(" ", zone, mark)))


def _apart(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with ``columns`` behind a one-row generator, which the optimizer neither merges with other projections nor pushes
    filters through; without it a filter on a column would repeat its whole expression."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def _stages() -> list[dict[str, Column]]:
    """The columns that lead from ``__t``, a plain text, and ``__zone`` to its readings ``__q0`` to ``__q3``, stage by stage."""
    c = F.col
    stages = [{"__form": F.regexp_replace("__t", _FORM, _PARTS)}, {"__p": F.when(c("__form") != c("__t"), F.split("__form", r"\|"))}]
    epoch, fraction, year, month, day, name, last, h, mi, s, f, half, mark = (c("__p")[i] for i in range(13))
    number = lambda t: F.coalesce(t.try_cast("int"), F.lit(0))
    hours, minutes, seconds = number(h), number(mi), number(s)
    named = F.position(F.substring(name, 1, 3), F.lit(_MONTHS))
    written = F.when(name == "", month).otherwise(F.when(named % 3 == 1, ((named + 2) / 3).cast("int").cast("string")))
    hour = F.when(half == "", F.when(hours < 24, hours)).when(hours.between(1, 12), hours % 12 + F.when(half == "PM", 12).otherwise(0))
    clock = F.when((minutes < 60) & (seconds < 60), (hour * 3600 + minutes * 60 + seconds).cast("bigint") * 1_000_000 + F.when(f == "", 0).otherwise(_micros(f)))
    date = lambda m, d: F.unix_date(F.concat_ws("-", year, m, d).try_cast("date")).cast("bigint") * DAY
    n, digits, part = epoch.try_cast("bigint"), F.length(epoch), F.when(fraction == "", 0).otherwise(_micros(fraction))
    instant = F.when(digits == 10, n * 1_000_000 + part).when(digits == 13, n * 1000).when(digits == 16, n).when(digits == 19, F.floor(n.cast("decimal(20,0)") / 1000).cast("bigint"))
    stages.append({"__epoch": F.when(epoch != "", instant), "__clock": F.when(epoch == "", clock), "__shift": F.when(mark != "", _shift(mark, c("__zone"))).cast("bigint") * 1_000_000,
                   "__one": F.when(epoch == "", date(written, day)), "__two": F.when(last.isin("-", "/"), date(day, month)), "__last": F.coalesce(last != "", F.lit(False))})
    stages.append({"__one": c("__one") + c("__clock"), "__two": c("__two") + c("__clock")})
    local = c("__shift").isNull()
    stages.append({f"{k}_{w}": F.when(local, _offset(c(k) + d, c("__zone"))) for k in ("__one", "__two") for w, d in (("before", -DAY), ("after", DAY))})
    one, two = (_instants(c(k), c("__zone"), c(f"{k}_before"), c(f"{k}_after")) for k in ("__one", "__two"))
    stages.append({"__q0": F.coalesce("__epoch", c("__one") - c("__shift"), one[0]), "__q1": one[1], "__q2": F.coalesce(c("__two") - c("__shift"), two[0]), "__q3": two[1]})
    return stages


def with_readings(df: DataFrame, text: Column, zone: Column, stages: list[dict[str, Column]] | None = None) -> DataFrame:
    """``df`` with every valid reading of ``text`` in micros: ``__r0`` and ``__r1`` in the written order (day first where the year is
    last), ``__r2`` and ``__r3`` month first; the second of each pair is the later instant of a wall clock that came twice. Null
    where there is no such reading or it is the same instant (``__same``). ``__last`` tells whether the year is last.

    Read are ISO 8601 in extended and compact form, year-first and day- or month-first dates with ``-``, ``/`` or ``.``, HTTP
    dates, epoch seconds (also with a fraction), milliseconds, microseconds and nanoseconds, 24- and 12-hour clocks,
    numeric offsets, ``Z``, and the zone's own abbreviations. A text without zone is local time of ``zone``; a stated
    offset outranks a bracketed region. One regular expression takes a text apart.
    """
    out = df.withColumns({"__zone": zone, "__t": plain_text(text)})
    for columns in stages or _stages():
        out = out.withColumns(columns)
    # without the day-first reading the month-first one stands alone; of equal dates the first
    q = [F.col(f"__q{i}") for i in range(4)]
    same = F.coalesce(q[0] == q[2], F.lit(False))
    return _apart(out.select(*df.columns, "__last", *q), __same=same, __r0=q[0], __r1=q[1], __r2=F.when(~same, q[2]), __r3=F.when(~same, q[3])).drop(*[f"__q{i}" for i in range(4)])


def _likelihoods(near: Column, spread: float) -> list[Column]:
    """How well each reading agrees with the evidence, 1 for the nearest, falling by e with every ``spread`` seconds of further distance; a
    wall clock that came twice counts half for each of its instants. 0 for absent readings; all agree where there is no evidence."""
    r = [F.col(f"__r{i}") for i in range(4)]
    far = [F.abs(x - near) for x in r]
    least = F.least(*far)
    half = [F.when(r[1].isNotNull(), 0.5).otherwise(1.0)] * 2 + [F.when(r[3].isNotNull(), 0.5).otherwise(1.0)] * 2
    return [F.when(x.isNull(), 0.0).when(near.isNull(), h).otherwise(h * F.exp((least - d) / F.lit(spread * 1e6))) for x, d, h in zip(r, far, half, strict=True)]


def format_mixtures(values: DataFrame, rounds: int = 25, prior: float = 1.0) -> DataFrame:
    """``day_first``, the weight of day-first among the dates of a (``source``, ``surface``), by EM with a Dirichlet prior.

    ``values`` holds ``source``, ``surface`` and ``odds``, the likelihood of a value's day-first reading over that of its
    month-first one. Values are first counted by the logarithm of their odds, of which there are at most some eighty, so
    the iteration runs over that many counts per source, inside one JVM expression and without a job per round. The
    E-step shares each count over both orders in proportion to weight times likelihood; the M-step adds the shares.
    The prior is the mixture of the surface over all sources, of ``prior`` pseudo-values, so a source without clear
    values follows the others. Null sources are one source.
    """
    step_of = F.round(F.log(F.greatest(F.lit(1 / _MOST_ODDS), F.least(F.lit(_MOST_ODDS), F.col("odds"))))).cast("int")
    counts = values.groupBy("source", "surface", step_of.alias("step")).agg(F.count(F.lit(1)).cast("double").alias("n"))

    def em(rows: Column, start: Column, weight: float) -> Column:
        total = F.aggregate(rows, F.lit(float(weight)), lambda a, r: a + r["n"])

        def step(w: Column, _: Column) -> Column:
            share = F.aggregate(rows, start * weight, lambda a, r: a + r["n"] * w * r["odds"] / (w * r["odds"] + 1 - w))
            return F.greatest(F.lit(_LEAST_WEIGHT), F.least(F.lit(1 - _LEAST_WEIGHT), share / total))
        return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, step)

    row = F.collect_list(F.struct("n", F.exp(F.col("step").cast("double")).alias("odds"))).alias("rows")
    overall = counts.groupBy("surface", "step").agg(F.sum("n").alias("n")).groupBy("surface").agg(row).select("surface", em(F.col("rows"), F.lit(0.5), 1e-3).alias("prior"))
    return counts.groupBy("source", "surface").agg(row).join(overall, "surface").select("source", "surface", em(F.col("rows"), F.col("prior"), prior).alias("day_first"))


def normalise(df: DataFrame, text: str, zone: str, source: str, evidence: str | None = None, sure: float = 0.9, spread: float = 60.0) -> DataFrame:
    """``df`` with ``utc_micros``, ``reading``, ``posterior`` and ``status`` of each ``text``.

    ``zone`` names the column of the IANA zone for texts without one, ``evidence`` a column of epoch microseconds near which
    the value should lie. A reading's likelihood falls with its distance from the evidence, by e every ``spread`` seconds; it is
    weighed by the share that its order of day and month has in the mixture of its source and spelling, and the
    reading of the highest posterior is taken, on a tie the smaller kind. ``status`` is ``certain`` (one instant only), ``by evidence``
    (the likelihoods alone reach ``sure``), ``by mixture`` (the posterior does) or ``ambiguous``. Null, empty and unreadable
    texts give null and ``unreadable``. No row is lost. Columns that carry an added name are replaced; names that begin
    with two underscores are kept for the operator.

    Only dates in two possible orders need a mixture. They are told by their spelling, so every other row is parsed once
    and joined with nothing; they are parsed a second time to be counted.
    """
    df = df.drop(*[c for c in ("utc_micros", "reading", "posterior", "status") if c not in (text, zone, source, evidence)])
    near = F.col(evidence) if evidence else F.lit(None).cast("bigint")
    two_orders = F.coalesce(F.col(text).rlike(_MAYBE_TWO_ORDERS) & plain_text(F.col(text)).rlike(_TWO_ORDERS), F.lit(False))
    surface = F.regexp_replace(F.regexp_replace(plain_text(F.col(text)), r"\d+", "9"), r"[A-Z]{3,}", "A")
    u, stages = _likelihoods(near, spread), _stages()

    weighed_by = [F.col(f"__u{i}") * (F.col("__w") if i < 2 else 1 - F.col("__w")) for i in range(4)]
    at = F.when(F.col("__top") <= 0, F.lit(None).cast("int"))
    for i in range(4):
        at = at.when(F.col(f"__e{i}") == F.col("__top"), i)
    pick = lambda stem: F.when(F.col("__at") == 0, F.col(f"{stem}0")).when(F.col("__at") == 1, F.col(f"{stem}1")).when(F.col("__at") == 2, F.col(f"{stem}2")).when(F.col("__at") == 3, F.col(f"{stem}3"))
    share = lambda stem: pick(stem) / (F.col(f"{stem}0") + F.col(f"{stem}1") + F.col(f"{stem}2") + F.col(f"{stem}3"))
    several = sum((F.col(f"__r{i}").isNotNull().cast("int") for i in range(4)), F.lit(0)) > 1
    kind = F.col("__at") + F.when(F.col("__last") | (F.col("__at") >= 2), 2).otherwise(0)
    posterior = F.when(F.col("__at").isNotNull(), share("__e"))
    status = F.when(F.col("__at").isNull(), "unreadable").when(~several, "certain").when(share("__u") >= sure, "by evidence").when(posterior >= sure, "by mixture").otherwise("ambiguous")
    added = {"utc_micros": pick("__r"), "reading": F.try_element_at(F.array(*[F.lit(k) for k in KINDS]), kind + 1), "posterior": posterior, "status": status}
    choice = [{f"__u{i}": x for i, x in enumerate(u)}, {f"__e{i}": x for i, x in enumerate(weighed_by)}, {"__top": F.greatest(*[f"__e{i}" for i in range(4)])}, {"__at": at}]

    def chosen(read: DataFrame, weight: Column) -> DataFrame:
        staged = read.withColumn("__w", weight)
        for columns in choice:
            staged = staged.withColumns(columns)
        return _apart(staged, **added).select(*df.columns, *added)

    plain = chosen(with_readings(df.where(~two_orders), F.col(text), F.col(zone), stages), F.lit(0.5))
    open_ = df.where(two_orders)
    counted = open_.select(F.col(source).cast("string").alias("source"), surface.alias("surface"), F.col(text).alias("__text"), F.col(zone).alias("__of"), near.alias("__near"))
    v = _likelihoods(F.col("__near"), spread)
    counted = with_readings(counted, F.col("__text"), F.col("__of"), stages).where("NOT __same").select("source", "surface", F.greatest(v[0], v[1]).alias("day"), F.greatest(v[2], v[3]).alias("month"))
    counted = counted.where("day > 0 OR month > 0").select("source", "surface", (F.col("day") / F.greatest("month", F.lit(1 / _MOST_ODDS))).alias("odds"))
    weights = format_mixtures(counted).select(F.col("source").alias("__s"), F.col("surface").alias("__f"), F.col("day_first").alias("__v"))
    weighed = open_.withColumn("__surface", surface).join(weights, F.col(source).cast("string").eqNullSafe(F.col("__s")) & (F.col("__surface") == F.col("__f")), "left")
    return plain.unionByName(chosen(with_readings(weighed.drop("__s", "__f", "__surface"), F.col(text), F.col(zone), stages), F.coalesce("__v", F.lit(0.5))))


def clock_seconds(text: Column) -> Column:
    """A clock as seconds from 00:00, hours past 24 kept; ``H:MM``, ``HHMM``, ``HH:MM:SS``, full-width and Japanese marks. Null if unreadable."""
    part = F.split(F.regexp_replace(plain_text(text), r"^(\d{1,2}):?(\d{2})(?::?(\d{2}))?$", "$1|$2|$3"), r"\|")
    h, m, s = (F.try_element_at(part, F.lit(i)).try_cast("int") for i in (1, 2, 3))
    return F.when((F.size(part) == 3) & (m < 60) & (F.coalesce(s, F.lit(0)) < 60), h * 3600 + m * 60 + F.coalesce(s, F.lit(0)))


def running_clock(clocks: Column) -> Column:
    """``array<struct<item, seconds>>``: the readable clocks of a list (position from 1), a day later each time they run backwards."""
    numbered = F.filter(F.transform(clocks, lambda x, i: F.struct((i + 1).alias("item"), clock_seconds(x).cast("bigint").alias("clock"))), lambda x: x["clock"].isNotNull())
    start = F.struct(F.lit(None).cast("bigint").alias("last"), F.lit(0).cast("bigint").alias("days"), F.expr("cast(array() as array<struct<item int, seconds bigint>>)").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        days = acc["days"] + F.when(x["clock"] < acc["last"], 1).otherwise(0)
        return F.struct(x["clock"].alias("last"), days.alias("days"), F.concat(acc["out"], F.array(F.struct(x["item"].alias("item"), (days * 86400 + x["clock"]).alias("seconds")))).alias("out"))

    return F.aggregate(numbered, start, step, lambda acc: acc["out"])


"""Column functions of scheduled public service: clocks, service days, identities, bands. All stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Largest plausible delay either way, in seconds.
DELAY_LIMIT = 43_200
#: Severity of alert effects, worst first.
ALERT_EFFECTS = ["NO_SERVICE", "REDUCED_SERVICE", "SIGNIFICANT_DELAYS", "DETOUR", "MODIFIED_SERVICE", "ADDITIONAL_SERVICE", "STOP_MOVED", "ACCESSIBILITY_ISSUE", "OTHER_EFFECT", "NO_EFFECT", "UNKNOWN_EFFECT"]
#: Fixed values: (first hour, last hour, part of the day); all other hours are overnight.
DAYPARTS = [(5, 9, "am_peak"), (10, 15, "midday"), (16, 19, "pm_peak"), (20, 23, "evening")]
#: Fixed values: (greatest delay in whole seconds, band), in order.
BANDS = [(-61, "early"), (299, "on_time"), (899, "late")]
#: Fixed values: (first route type, last route type, mode), basic and extended.
MODES = [(0, 0, "tram"), (1, 1, "metro"), (2, 2, "rail"), (3, 3, "bus"), (4, 4, "ferry"), (100, 199, "rail"), (200, 299, "bus"), (400, 499, "metro"), (700, 799, "bus"), (900, 999, "tram"), (1000, 1299, "ferry")]


def gtfs_seconds(clock: Column) -> Column:
    """``H:MM:SS`` as seconds from 00:00:00, hours past 24 kept; null if null or not such a clock."""
    part = F.split(F.trim(clock), ":")
    h, m, s = (F.try_element_at(part, F.lit(i)).try_cast("int") for i in (1, 2, 3))
    return F.when(F.size(part) == 3, h * 3600 + m * 60 + s)


def gtfs_mode(route_type: Column) -> Column:
    """Mode of a basic or extended route type; ``other`` for the rest and null."""
    out = F.lit("other")
    for low, high, mode in reversed(MODES):
        out = F.when(route_type.between(low, high), mode).otherwise(out)
    return out


def daypart(hour: Column) -> Column:
    """Part of the day of a local hour; null stays null."""
    out = F.when(hour.isNull(), F.lit(None))
    for first, last, name in DAYPARTS:
        out = out.when(hour.between(first, last), name)
    return out.otherwise("overnight")


def otp_band(delay: Column) -> Column:
    """Band of a delay in seconds, by its greatest value; ``very_late`` beyond all; null stays null."""
    out = F.when(delay.isNull(), F.lit(None))
    for most, name in BANDS:
        out = out.when(delay <= most, name)
    return out.otherwise("very_late")


def alert_effect_rank(effect: Column) -> Column:
    """Severity rank, 1 the worst; unlisted effects and null after all others."""
    at = F.array_position(F.array(*[F.lit(e) for e in ALERT_EFFECTS]), effect)
    return F.coalesce(F.nullif(at, F.lit(0)), F.lit(len(ALERT_EFFECTS) + 1)).cast("int")


def local_time(utc: Column, zone: Column | str) -> Column:
    """Wall clock of an instant in a zone, as a timestamp read as UTC."""
    return F.from_utc_timestamp(utc, zone)


def service_date(start_date: Column, fetched_at: Column, zone: Column, cutover_hours: Column) -> Column:
    """The stated date (yyyyMMdd), else the local date of the fetch less the cutover; an unknown zone counts as UTC."""
    local = F.from_utc_timestamp(fetched_at, F.coalesce(zone, F.lit("UTC")))
    return F.coalesce(F.try_to_date(start_date, "yyyyMMdd"), F.to_date(local - F.make_dt_interval(hours=F.coalesce(cutover_hours, F.lit(12)))))


def trip_uid(city: Column, day: Column, trip_id: Column, route_id: Column, direction_id: Column, start_time: Column) -> Column:
    """sha-256 of city, day and identity; null without a trip id or route. The identity is the trip id, else route, direction and start."""
    other = F.when(F.nullif(route_id, F.lit("")).isNotNull(), F.concat_ws("-", route_id, F.coalesce(direction_id.cast("string"), F.lit("")), F.coalesce(start_time, F.lit(""))))
    identity = F.coalesce(F.nullif(trip_id, F.lit("")), other)
    return F.when(identity.isNotNull() & city.isNotNull() & day.isNotNull(), F.sha2(F.concat_ws("|", city, day.cast("string"), identity), 256))


def scheduled_instant(day: Column, seconds: Column, zone: Column | str) -> Column:
    """UTC instant of a schedule clock: local noon of the service day less 12 h plus the seconds, so it holds on days the clock changes."""
    noon = F.to_utc_timestamp(F.timestamp_seconds(F.unix_date(day).cast("bigint") * 86_400 + 43_200), zone)
    return F.timestamp_micros(F.unix_micros(noon) + (seconds.cast("bigint") - 43_200) * 1_000_000)


def effective_delay(stated: Column, actual: Column, scheduled: Column) -> Column:
    """The stated delay if plausible, else actual less scheduled if plausible, else null."""
    computed = F.unix_seconds(actual) - F.unix_seconds(scheduled)
    first = F.when(F.abs(stated) <= DELAY_LIMIT, stated.cast("bigint")).otherwise(computed)
    return F.when(F.abs(first) <= DELAY_LIMIT, first)


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as double; null where the whole is 0 or null."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def clamp(x: Column, low: float, high: float) -> Column:
    """``x`` within bounds; null stays null (``greatest`` alone would skip it)."""
    return F.when(x.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), x)))


def route_prefix(trip_id: Column) -> Column:
    """The part of a compound trip token from the origin clock on (``..._123450_N..S``), else null."""
    return F.nullif(F.regexp_extract(trip_id, r"(\d{6}_.+)$", 1), F.lit(""))


def geo_cell(lat: Column, lon: Column, resolution: int = 8) -> Column:
    """A cell of a fixed latitude-longitude grid with 2^resolution rows per 180 degrees. Not an H3 cell; null outside the globe."""
    n = 1 << resolution
    row = F.least(F.floor((lat + 90) / 180 * n), F.lit(n - 1))
    column = F.least(F.floor((lon + 180) / 360 * 2 * n), F.lit(2 * n - 1))
    return F.when(lat.between(-90, 90) & lon.between(-180, 180), F.concat_ws("-", F.lit(str(resolution)), row.cast("string"), column.cast("string")))


def delay_colour(delay: Column, worst: int = 600) -> Column:
    """``[r, g, b, a]`` from green at 0 to red at ``worst`` seconds; grey for null."""
    x = clamp(delay.cast("double") / worst, 0.0, 1.0)
    return F.when(delay.isNull(), F.array(*[F.lit(v) for v in (128, 128, 128, 90)])).otherwise(F.array((x * 220 + 30).cast("int"), ((1 - x) * 170 + 40).cast("int"), F.lit(60), F.lit(190)))


def folded_direction(direction_id: Column) -> Column:
    """Null directions as -1, so that they group and join."""
    return F.coalesce(direction_id, F.lit(-1))


def folded_route(route_id: Column) -> Column:
    """Null routes as ``__unrouted__``."""
    return F.coalesce(route_id, F.lit("__unrouted__"))

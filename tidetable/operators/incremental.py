"""What an incremental build recomputes: lookback and repair windows, rotation freeze, the closed day and misdated events."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidetable.operators.joins import null_safe_anti

#: Hours of local time after midnight until which a service day may still run.
CUTOVER_HOURS = 3
#: Local hour from which an event of the day before cannot be overnight service any more.
MORNING = 6


def lookback(df: DataFrame, day: str, as_of: Column, hours: int = 72) -> DataFrame:
    """Rows of the days that ``hours`` before ``as_of`` (a date) still touch. The instant is given, so a replay gives the same rows."""
    return df.where(F.col(day) >= F.date_sub(as_of, math.ceil(hours / 24)))


def repair(df: DataFrame, scope: str, value: str, day: str, first: str, last: str) -> DataFrame:
    """Rows of one scope and a closed range of days, in place of the lookback."""
    return df.where((F.col(scope) == value) & F.col(day).between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def recomputable(days: DataFrame, covered: DataFrame, computed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Days that may be computed anew: those the newest schedule covers, and those never computed before.

    A day that is computed and no longer covered keeps what it has. Null keys match each other.
    """
    known = covered.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
    same = F.lit(True)
    for k in keys:
        same = same & days[k].eqNullSafe(known[f"__{k}"])
    fresh = null_safe_anti(null_safe_anti(days, covered, keys), computed, keys)
    return days.join(known, same, "left_semi").unionByName(fresh)


def day_closed(day: Column, as_of: Column, zone: Column) -> Column:
    """Whether a service day is over in its zone at ``as_of`` (UTC), its night hours included."""
    local = F.from_utc_timestamp(as_of, zone) - F.make_dt_interval(hours=F.lit(CUTOVER_HOURS))
    return F.to_date(local) > day


def well_dated(df: DataFrame, day: str, at: str, zone: Column) -> DataFrame:
    """Rows without those that happened on a later local day than ``day`` in the morning or after, which belong to that later day.

    Rows of unknown day, time or zone stay.
    """
    local = F.from_utc_timestamp(F.col(at).cast("timestamp"), zone)
    late = (F.to_date(local) > F.col(day)) & (F.hour(local) >= MORNING)
    return df.where(~F.coalesce(late, F.lit(False)))

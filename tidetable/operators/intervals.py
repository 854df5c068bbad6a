"""Heartbeats, gaps, islands and day clamping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def heartbeat(df: DataFrame, keys: Sequence[str], at: str, unit: str = "minute") -> DataFrame:
    """Distinct ``keys`` and ``beat``, the truncated time; null times give none."""
    return df.where(f"`{at}` IS NOT NULL").select(*keys, F.date_trunc(unit, F.col(at).cast("timestamp")).alias("beat")).distinct()


def gaps(beats: DataFrame, keys: Sequence[str], longer_than: int = 600, unit: int = 60) -> DataFrame:
    """Holes between consecutive beats longer than ``longer_than`` seconds, from one ``unit`` after the last beat to the next."""
    w = Window.partitionBy(*keys).orderBy("beat")
    nxt = beats.withColumn("gap_end", F.lead("beat").over(w)).withColumn("gap_seconds", F.unix_seconds("gap_end") - F.unix_seconds("beat"))
    return nxt.where(F.col("gap_seconds") > longer_than).select(*keys, F.timestamp_seconds(F.unix_seconds("beat") + unit).alias("gap_start"), "gap_end", "gap_seconds")


def _united(df: DataFrame, keys: Sequence[str], start: str, end: str, touching: bool) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(start, end)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    opens = reach.isNull() | (reach < F.col(start) if touching else reach <= F.col(start))
    marked = df.withColumn("__new", F.when(opens, 1).otherwise(0))
    marked = marked.withColumn("__island", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return marked.groupBy(*keys, "__island").agg(F.min(start).alias(start), F.max(end).alias(end), F.sum("parts").alias("parts")).drop("__island")


def merge_islands(df: DataFrame, keys: Sequence[str], start: str, end: str, touching: bool = True) -> DataFrame:
    """Overlapping or (``touching``) touching intervals of each key united: ``keys``, ``start``, ``end``, ``parts``.

    A running maximum of the ends before each row decides whether it opens an island. Intervals with a null or an
    end before their start are ignored; equal ones merge. They are united first among those of a key that start on the
    same day (numbers: in the same 86,400), then across days, so a key's window over all time holds islands and not intervals.
    """
    ok = df.where(F.col(start).isNotNull() & F.col(end).isNotNull() & (F.col(end) >= F.col(start))).select(*keys, start, end, F.lit(1).cast("bigint").alias("parts"))
    day = F.to_date(start) if dict(df.dtypes)[start].startswith(("timestamp", "date")) else F.floor(F.col(start) / 86_400)
    return _united(_united(ok.withColumn("__day", day), [*keys, "__day"], start, end, touching).drop("__day"), keys, start, end, touching)


def by_day(df: DataFrame, start: str, end: str) -> DataFrame:
    """Each interval cut at midnight: one row per day it touches with ``day`` and its clamped ends; zero-length parts stay."""
    days = df.where(F.col(end) >= F.col(start)).withColumn("day", F.explode(F.sequence(F.to_date(start), F.to_date(end))))
    low, high = F.col("day").cast("timestamp"), F.date_add("day", 1).cast("timestamp")
    return days.withColumn(start, F.greatest(F.col(start).cast("timestamp"), low)).withColumn(end, F.least(F.col(end).cast("timestamp"), high))


def sessions(df: DataFrame, keys: Sequence[str], at: str, gap_seconds: int) -> DataFrame:
    """Rows of each key grouped while no pause exceeds the gap: ``session_start``, ``session_end``, ``events``.

    A pause of exactly the gap keeps the session. Null times are ignored.
    """
    w = Window.partitionBy(*keys).orderBy(at)
    pause = F.unix_micros(F.col(at).cast("timestamp")) - F.unix_micros(F.lag(at).over(w).cast("timestamp"))
    marked = df.where(f"`{at}` IS NOT NULL").withColumn("__new", F.when(pause <= gap_seconds * 1_000_000, 0).otherwise(1))
    marked = marked.withColumn("__s", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return marked.groupBy(*keys, "__s").agg(F.min(at).alias("session_start"), F.max(at).alias("session_end"), F.count(F.lit(1)).alias("events")).drop("__s")

"""Data contracts: each returns the violating rows, none on healthy data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def tally(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Violations of many row-wise checks in one pass: ``check_name``, ``violations``. A check that is null for a row is no violation."""
    one = df.agg(*[F.count_if(bad).alias(name) for name, bad in checks.items()])
    return one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(n).alias("violations")) for n in checks])).alias("x")).select("x.*")


def out_of_range(df: DataFrame, column: str, low: float | None = None, high: float | None = None, strict_low: bool = False) -> DataFrame:
    """Rows whose non-null value lies beyond the bounds (``strict_low``: or equals the lower)."""
    bad = F.lit(False)
    if low is not None:
        bad = bad | (F.col(column) < low) | (F.lit(strict_low) & (F.col(column) == low))
    if high is not None:
        bad = bad | (F.col(column) > high)
    return df.where(F.col(column).isNotNull() & bad)


def nulls(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Non-null keys that occur more than once, with their count ``n``."""
    return df.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def unaccepted(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))


def orphans(df: DataFrame, keys: Sequence[str], parent: DataFrame, parent_keys: Sequence[str]) -> DataFrame:
    """Rows with non-null keys that no parent row has."""
    p = parent.select(*[F.col(k).alias(f"__p{i}") for i, k in enumerate(parent_keys)]).distinct()
    on = [df[k] == p[f"__p{i}"] for i, k in enumerate(keys)]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return df.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)).join(p, cond, "left_anti")


def disagreeing(df: DataFrame, a: Column, b: Column) -> DataFrame:
    """Rows in which two ways of deriving a value differ; null equals null."""
    return df.where(~a.eqNullSafe(b))


def overlapping_versions(df: DataFrame, entity: Sequence[str], start: str, end: str) -> DataFrame:
    """Versions that begin before their predecessor ends, by one window instead of a self join."""
    w = Window.partitionBy(*entity).orderBy(start, F.col(end).asc_nulls_last())
    reach = F.max(F.coalesce(F.col(end), F.lit("9999-12-31").cast("date"))).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn("__reach", reach).where(F.col("__reach") > F.col(start)).drop("__reach")


def ghost_versions(df: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """Versions all of whose attributes are null."""
    return df.where(" AND ".join(f"`{a}` IS NULL" for a in attributes))


def shared_identity(df: DataFrame, identity: str, owner: str) -> DataFrame:
    """Identities that more than one owner carries."""
    return df.where(F.col(identity).isNotNull()).groupBy(identity).agg(F.countDistinct(owner).alias("owners")).where("owners > 1")


def under_covered(whole: DataFrame, part: DataFrame, keys: Sequence[str], item: str, least: float, floor: int) -> DataFrame:
    """Keys with at least ``floor`` distinct items in ``whole`` of which ``part`` holds a smaller share than ``least``."""
    w = whole.groupBy(*keys).agg(F.countDistinct(item).alias("expected"))
    p = part.groupBy(*keys).agg(F.countDistinct(item).alias("present"))
    return w.join(p, list(keys), "left").withColumn("present", F.coalesce("present", F.lit(0))).where((F.col("expected") >= floor) & (F.col("present") < F.col("expected") * least))


def null_rates(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Share of nulls per column, long: ``keys``, ``column``, ``null_share``, ``n``."""
    agg = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"__{c}") for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), (F.col(f"__{c}") / F.col("n")).alias("null_share")) for c in columns])
    return agg.select(*keys, "n", F.explode(pairs).alias("x")).select(*keys, "x.column", "x.null_share", "n")


def freshness(df: DataFrame, keys: Sequence[str], at: str, as_of: Column, warn_sec: int, error_sec: int) -> DataFrame:
    """Age of each key's newest row at ``as_of`` with ``status`` ok, warn or error."""
    newest = df.groupBy(*keys).agg(F.max(F.col(at).cast("timestamp")).alias("__at"))
    age = F.unix_seconds(as_of) - F.unix_seconds("__at")
    return newest.select(*keys, age.alias("age_sec")).withColumn("status", F.when(F.col("age_sec") > error_sec, "error").when(F.col("age_sec") > warn_sec, "warn").otherwise("ok"))


def audit(df: DataFrame, hop: str, keys: Sequence[str], identity: str, grain: Sequence[str], scheduled: str | None) -> DataFrame:
    """One hop of a pipeline per ``keys``: rows, rows without identity, repeated rows of the grain, rows with a schedule (null where a hop has none)."""
    per = df.groupBy(*keys, *[F.col(c).alias(f"__g{i}") for i, c in enumerate(grain)]).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(identity).isNull()).alias("w"), (F.count(scheduled) if scheduled else F.lit(None).cast("bigint")).alias("s"))
    return per.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("w").alias("without_trip"), (F.sum("n") - F.count(F.lit(1))).alias("repeated"), F.sum("s").alias("with_schedule")).withColumn("hop", F.lit(hop))


def growing(df: DataFrame, keys: Sequence[str], day: str, days: int) -> DataFrame:
    """Rows that each key gained over its newest ``days`` days: ``seen``."""
    per = df.groupBy(*keys, day).agg(F.count(F.lit(1)).alias("n")).withColumn("__k", F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(day).desc())))
    return per.groupBy(*keys).agg(F.sum(F.when(F.col("__k") <= days, F.col("n")).otherwise(0)).alias("seen"))


def judged(checks: DataFrame, severity: str) -> DataFrame:
    """Checks with a boolean ``failed`` as ``severity`` and ``outcome``: pass, or the severity itself."""
    return checks.withColumn("severity", F.lit(severity)).withColumn("outcome", F.when(F.col("failed"), severity).otherwise("pass")).drop("failed")


def store_failures(bad: DataFrame, path: str, check: str) -> int:
    """Keep the violating rows of a check beside those of others, replacing its earlier ones; their number."""
    bad.write.mode("overwrite").parquet(f"{path}/check={check}")
    return bad.sparkSession.read.parquet(f"{path}/check={check}").count()

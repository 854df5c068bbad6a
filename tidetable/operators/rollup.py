"""Roll-ups that divide by evidence: weighted means, wait times, quantiles, standardisation, scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidetable.functions.domain import clamp, ratio


def weighted_mean(x: Column, weight: Column) -> Column:
    """Aggregate: sum of x times weight over the weights of non-null x; null without evidence."""
    return ratio(F.sum(x.cast("double") * weight), F.sum(F.when(x.isNotNull(), weight)))


def wait_time(gap: Column) -> Column:
    """Aggregate: mean wait of passengers who arrive at random, sum of squared gaps over twice their sum."""
    g = gap.cast("double")
    return F.sum(g * g) / F.nullif(2 * F.sum(g), F.lit(0.0))


def excess_wait(df: DataFrame, keys: Sequence[str], slices: Sequence[str], gap: str, scheduled: str, paired: bool = True) -> DataFrame:
    """``ewt_sec`` per ``keys``: actual less scheduled wait of each slice, weighted by its gaps. Signed.

    Rows lacking either gap do not count if ``paired``; otherwise each gap counts for its own wait, and ``gaps`` are those of slices
    with both waits.
    """
    both = df.where(F.col(gap).isNotNull() & (F.col(scheduled).isNotNull() | F.lit(not paired)))
    per = both.groupBy(*keys, *slices).agg((wait_time(F.col(gap)) - wait_time(F.col(scheduled))).alias("__e"), F.count(F.lit(1)).alias("__n"))
    counted = F.col("__n") if paired else F.when(F.col("__e").isNotNull(), F.col("__n"))
    return per.groupBy(*keys).agg(weighted_mean(F.col("__e"), F.col("__n")).alias("ewt_sec"), F.sum(counted).alias("gaps"))


def nearest_rank(df: DataFrame, keys: Sequence[str], value: str, shares: dict[str, float]) -> DataFrame:
    """Per key the value at position ``floor(share * n)`` (at most the last) of the sorted non-null values.

    Values are counted first, so the window runs over distinct values and not over rows.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(*keys)
    ranked = counts.withColumn("__all", F.sum("__n").over(w)).withColumn("__upto", F.sum("__n").over(w.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return ranked.groupBy(*keys).agg(F.max("__all").alias("n"), *[F.min(F.when(F.col("__upto") > F.least(F.col("__all") - 1, F.floor(F.col("__all") * s)), F.col(value))).alias(name) for name, s in shares.items()])


def histogram(df: DataFrame, keys: Sequence[str], value: str, low: float, high: float, width: float) -> DataFrame:
    """Counts per bucket of ``width``; values beyond the bounds fall into the outermost buckets, nulls into none."""
    at = (F.floor(clamp(F.col(value).cast("double"), low, high) / width) * width).cast("bigint")
    return df.where(F.col(value).isNotNull()).groupBy(*keys, at.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def standardised(df: DataFrame, keys: Sequence[str], stratum: str, exposed: str, outcome: str, least: int = 0) -> DataFrame:
    """Direct standardisation: the outcome rate of exposed rows beside that of unexposed ones reweighted to the exposed rows' strata.

    Strata without unexposed rows are left out of both rates. Groups with fewer than ``least`` exposed rows are left out.
    """
    per = df.where(F.col(outcome).isNotNull() & F.col(exposed).isNotNull()).groupBy(*keys, stratum).agg(
        F.count_if(F.col(exposed)).alias("n1"), F.count_if(~F.col(exposed)).alias("n0"), F.count_if(F.col(exposed) & F.col(outcome)).alias("y1"), F.count_if(~F.col(exposed) & F.col(outcome)).alias("y0"))
    both = per.where("n0 > 0 AND n1 > 0")
    out = both.groupBy(*keys).agg(F.sum("n1").alias("exposed_n"), ratio(F.sum("y1"), F.sum("n1")).alias("exposed_rate"), ratio(F.sum(F.col("n1") * F.col("y0") / F.col("n0")), F.sum("n1")).alias("baseline_rate"))
    return out.where(F.col("exposed_n") >= least)


def composite(parts: Sequence[tuple[Column, float]], least_parts: int = 1) -> Column:
    """Weighted mean of the parts that are present, their weights renormalised; each is clamped to 0..100. Null with fewer than ``least_parts``."""
    total = sum((F.when(p.isNotNull(), F.lit(w)).otherwise(0.0) for p, w in parts), F.lit(0.0))
    value = sum((F.coalesce(clamp(p.cast("double"), 0.0, 100.0) * w, F.lit(0.0)) for p, w in parts), F.lit(0.0))
    present = sum((p.isNotNull().cast("int") for p, _ in parts), F.lit(0))
    return F.when(present >= least_parts, value / F.nullif(total, F.lit(0.0)))


def summed_streams(streams: dict[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Several counts per key side by side, 0 where a stream has none: union then sum, in place of a chain of full outer joins.

    Each stream holds ``keys`` and ``n``.
    """
    both = None
    for name, df in streams.items():
        part = df.select(*keys, *[(F.col("n") if s == name else F.lit(0)).cast("bigint").alias(s) for s in streams])
        both = part if both is None else both.unionByName(part)
    return both.groupBy(*keys).agg(*[F.sum(s).alias(s) for s in streams])


def summed_counts(relations: Sequence[DataFrame], keys: Sequence[str], counts: Sequence[str]) -> DataFrame:
    """Relations that each hold ``keys`` and some of the ``counts`` put together, 0 where none has a count: union then sum."""
    both = None
    for df in relations:
        part = df.select(*keys, *[(F.col(c) if c in df.columns else F.lit(0)).cast("bigint").alias(c) for c in counts])
        both = part if both is None else both.unionByName(part)
    return both.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counts])


def decimate(df: DataFrame, keys: Sequence[str], order: Sequence[str], most: int) -> DataFrame:
    """Every k-th row of each key so that about ``most`` stay, and always the first and last. Rows are kept in place, not sampled."""
    w = Window.partitionBy(*keys)
    numbered = df.withColumn("__i", F.row_number().over(w.orderBy(*order))).withColumn("__n", F.count(F.lit(1)).over(w))
    step = F.ceil(F.col("__n") / most)
    return numbered.where((F.pmod(F.col("__i") - 1, step) == 0) | (F.col("__i") == F.col("__n"))).drop("__i", "__n")

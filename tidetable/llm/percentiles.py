"""Percentiles of very large columns from signed logarithmic buckets, which add up across partitions and days."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Relative error of a value read from a bucket.
ACCURACY = 0.005
#: The least and the greatest magnitude of a double other than zero.
LEAST, GREATEST = 5e-324, 1.7976931348623157e308


def _scale(accuracy: float) -> float:
    return math.log((1 + accuracy) / (1 - accuracy))


def _first(accuracy: float) -> int:
    """The exponent before that of the least magnitude."""
    return math.floor(math.log(LEAST) / _scale(accuracy)) - 1


def _end(accuracy: float) -> int:
    """The bucket of infinity, after that of the greatest magnitude."""
    return math.ceil(math.log(GREATEST) / _scale(accuracy)) - _first(accuracy) + 1


def bucket(value: Column, accuracy: float = ACCURACY) -> Column:
    """The signed bucket of a number: 0 for zero, else sign times a position that rises with the magnitude's logarithm.

    Bucket k > 0 holds (gamma^(k + f - 1), gamma^(k + f)] with gamma = (1 + a) / (1 - a) and an offset f below the exponent of the
    least double, so every position is positive and the order of buckets is the order of values. Infinities have an end
    bucket each; null and NaN have none.
    """
    x = value.cast("double")
    size = F.abs(x)
    place = F.when(size > GREATEST, _end(accuracy)).otherwise(F.ceil(F.log(size) / _scale(accuracy)) - _first(accuracy))
    return F.when(F.isnan(x), F.lit(None)).when(size == 0, 0).otherwise(F.signum(x) * place).cast("int")


def bucket_value(position: Column, accuracy: float = ACCURACY) -> Column:
    """The value that stands for a bucket: within ``accuracy`` of every value in it; infinity for the end buckets."""
    gamma = (1 + accuracy) / (1 - accuracy)
    exponent = F.abs(position) + _first(accuracy)
    size = F.when(F.abs(position) >= _end(accuracy), float("inf")).otherwise(F.least(F.lit(GREATEST), F.exp(exponent * _scale(accuracy) + math.log(2 / (1 + gamma)))))
    return F.when(position == 0, 0.0).otherwise(F.signum(position.cast("double")) * size)


def sketch(df: DataFrame, keys: Sequence[str], value: str, accuracy: float = ACCURACY) -> DataFrame:
    """``keys``, ``bucket``, ``n``, ``low``, ``high``: how many non-null values of each group lie in each bucket, and the least and greatest of them.

    One aggregation with map-side combining; a group has a bounded number of buckets whatever its rows, so no
    key is too hot. Null keys form groups of their own; NaN counts for none.
    """
    x = F.col(value)
    return df.where(x.isNotNull() & ~F.isnan(x.cast("double"))).groupBy(*keys, bucket(x, accuracy).alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.min(x).alias("low"), F.max(x).alias("high"))


def merge(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sketches of partitions, days or other parts put together under ``keys``, a subset of their keys."""
    return sketches.groupBy(*keys, "bucket").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))


def percentiles(sketches: DataFrame, keys: Sequence[str], shares: dict[str, float], accuracy: float = ACCURACY) -> DataFrame:
    """One row per group: ``n`` and, under each name, the value at rank ``ceil(share * n)`` within the relative error.

    Windows run over one group's buckets, whose number is bounded.
    """
    w = Window.partitionBy(*keys)
    ranked = sketches.withColumn("__n", F.sum("n").over(w)).withColumn("__upto", F.sum("n").over(w.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    out = ranked.groupBy(*keys).agg(F.max("__n").alias("n"), *[F.min(F.when(F.col("__upto") >= F.greatest(F.lit(1), F.ceil(F.col("__n") * s)), F.col("bucket"))).alias(name) for name, s in shares.items()])
    return out.select(*keys, "n", *[bucket_value(F.col(name), accuracy).alias(name) for name in shares])


def rank_bounds(sketches: DataFrame, stated: DataFrame, keys: Sequence[str], value: str, accuracy: float = ACCURACY) -> DataFrame:
    """``stated`` with bounds of how many of its group's values lie below and at most at ``value``, and ``at``, its bucket.

    ``below_least <= count(x < v) <= below_most`` and ``upto_least <= count(x <= v) <= upto_most``: buckets other than v's
    own are decided by order, v's own by its least and greatest value, and only where v lies between these do the
    bounds differ. Rows without values get n = 0.
    """
    s = sketches.select(*[F.col(k).alias(f"__{k}") for k in keys], "bucket", F.col("n").alias("__n"), F.col("low").alias("__low"), F.col("high").alias("__high"))
    v = stated.withColumn("at", bucket(F.col(value), accuracy))
    cond = F.lit(True)
    for k in keys:
        cond = cond & v[k].eqNullSafe(s[f"__{k}"])
    own = F.col("bucket") == F.col("at")

    def counted(of_own: Column) -> Column:
        return F.coalesce(F.sum(F.when((F.col("bucket") < F.col("at")) | own & of_own, F.col("__n"))), F.lit(0))

    x = F.col(value)
    return v.join(s, cond, "left").groupBy(*v.columns).agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("n"), counted(x > F.col("__high")).alias("below_least"), counted(x > F.col("__low")).alias("below_most"),
        counted(x >= F.col("__high")).alias("upto_least"), counted(x >= F.col("__low")).alias("upto_most"))


def key_marks(df: DataFrame, keys: Sequence[str], bits: int = 1 << 18) -> Column:
    """Whether a row's ``keys`` may be among those of ``df``: one bit per hash, true for all that are there and few others.

    A scalar subquery of ``bits / 8`` bytes, whatever the number of keys, so that rows without a partner need not be
    shuffled to a join. It only leaves rows out that have none.
    """
    def place(d: DataFrame | None) -> tuple[Column, Column]:
        h = F.pmod(F.xxhash64(*[F.coalesce((d[k] if d is not None else F.col(k)).cast("string"), F.lit("\0")) for k in keys]), F.lit(bits))
        return F.shiftright(h, 6).cast("int"), F.pmod(h, F.lit(64)).cast("int")

    word, bit = place(df)
    words = df.groupBy(word.alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)).alias("w"))
    words = words.agg(F.map_from_entries(F.collect_list(F.struct("word", "w"))).alias("m")).select(F.transform(F.sequence(F.lit(0), F.lit(bits // 64 - 1)), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0).cast("bigint"))).alias("words"))
    word, bit = place(None)
    return F.getbit(F.element_at(words.scalar(), word + 1), bit) == 1

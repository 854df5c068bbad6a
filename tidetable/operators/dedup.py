"""Messages delivered more than once: keep one copy of each by hash aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 2 * 10^19 exceeds the span of 64-bit tie-breaks, so delivery time and tie-break share one decimal(38, 0) without overlap.
_SHIFT = "20000000000000000000"


def delivery_order(micros: Column, tie_break: Column) -> Column:
    """The struct (delivery time, tie-break) as one ordered decimal(38, 0).

    A struct held by ``min_by`` would turn the hash aggregation into a sort aggregation, because only fixed-width values can
    be updated in place in a hash map; the packed decimal compares exactly like the struct. Null times sort after all
    others, null tie-breaks after all of the same time.
    """
    time = F.when(micros.isNull(), F.lit(4_000_000_000_000_000_000)).otherwise(micros).cast("decimal(38,0)")
    tie = F.coalesce(tie_break, F.lit(9_223_372_036_854_775_807)).cast("decimal(38,0)")
    return (time * F.lit(_SHIFT).cast("decimal(20,0)") + tie).cast("decimal(38,0)")


def keepers(df: DataFrame, identifier: Sequence[str], delivered: str, tie_break: str) -> DataFrame:
    """``identifier`` columns, the kept row's ``tie_break`` and the number of copies ``copies`` of every message.

    Null equals null in the identifier. The earliest ``delivered`` (timestamp) is kept, then the smallest ``tie_break``
    (an integer naming a row); null deliveries lose against any other. Map-side partial aggregation leaves one row
    per message and task, so a message with a third of all copies costs no task more than others.
    """
    micros = F.unix_micros(F.col(delivered).cast("timestamp"))
    order = delivery_order(micros, F.col(tie_break))
    return df.groupBy(*identifier).agg(F.min_by(F.col(tie_break), order).alias(tie_break), F.count(F.lit(1)).alias("copies"))


def digest(identifier: Sequence[str]) -> tuple[Column, Column]:
    """The identifier as 128 bits: two hashes over all its values and which of them are null, so that a value and a null cannot change places.

    Rows that differ in one number alone never agree; of 10^12 messages any two agree with a probability of about 10^-15.
    """
    parts = [*[F.col(c).isNull() for c in identifier], *[F.col(c) for c in identifier]]
    return F.xxhash64(F.lit(0), *parts), F.xxhash64(F.lit(1), *parts)


def redundant(df: DataFrame, identifier: Sequence[str], delivered: str, tie_break: str) -> DataFrame:
    """The rows that :func:`keepers` does not keep, whole and with their own columns.

    Only the kept rows' names are needed, so messages are told apart by :func:`digest` and their columns stay out of the shuffle. The
    comparison back to the rows is on ``tie_break`` alone, which is evenly spread whatever the identifiers' skew.
    Rows with a null ``tie_break`` cannot be named; all of them stay, unless a named copy of their message is kept, which makes them redundant.
    """
    one, two = digest(identifier)
    order = delivery_order(F.unix_micros(F.col(delivered).cast("timestamp")), F.col(tie_break))
    copies = df.select(one.alias("__one"), two.alias("__two"), F.col(tie_break).alias("__tie"), order.alias("__order"))
    kept = copies.groupBy("__one", "__two").agg(F.min_by("__tie", "__order").alias("__kept")).where(F.col("__kept").isNotNull())
    named = df.where(F.col(tie_break).isNotNull()).join(kept.select("__kept"), F.col(tie_break) == F.col("__kept"), "left_anti")
    nameless = df.where(F.col(tie_break).isNull()).withColumns({"__first": one, "__second": two})
    lost = nameless.join(kept.select("__one", "__two"), (F.col("__first") == F.col("__one")) & (F.col("__second") == F.col("__two")), "left_semi")
    return named.unionByName(lost.select(*df.columns))


def keep_first(df: DataFrame, identifier: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One whole row of each identifier, the first by ``order`` (nulls last), in one shuffle.

    The ordering struct holds a null flag before each value, then all other columns as text, so equal deliveries give
    the same row on every run. Exact repeats collapse to one row. An empty table gives an empty table.
    """
    if not identifier:
        raise ValueError("identifier needs at least one column")
    row = F.struct(*[F.col(c) for c in df.columns])
    rest = [F.col(c).cast("string") for c, t in df.dtypes if c not in order and not t.startswith(("map", "array", "struct"))]
    first = F.struct(*[x for c in order for x in (F.col(c).isNull(), F.col(c))], *[F.coalesce(x, F.lit("")) for x in rest])
    return df.groupBy(*[F.col(c).alias(f"__id{i}") for i, c in enumerate(identifier)]).agg(F.min_by(row, first).alias("__row")).select("__row.*")

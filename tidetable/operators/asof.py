"""Attributes as known at event time, from independent change histories per attribute."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def change_histories(dim: DataFrame, entity: Sequence[str], start: str, end: str | None, attributes: Sequence[str]) -> DataFrame:
    """One row per change of one attribute: ``entity``, ``attribute``, ``since``, ``value`` (text), ``present``.

    ``dim`` holds versions valid in [start, end), end null or absent for open. Consecutive versions that agree in an
    attribute leave one change; a version that ends without a successor leaves a change to ``present = false``. Rows
    with a null entity column or start are ignored; repeated rows change nothing.
    """
    long = dim.select(*entity, F.col(start).alias("since"), (F.col(end) if end else F.lit(None).cast(dict(dim.dtypes)[start])).alias("until"),
                      F.explode(F.array(*[F.struct(F.lit(a).alias("attribute"), F.col(a).cast("string").alias("value")) for a in attributes])).alias("x"))
    long = long.select(*entity, "since", "until", "x.attribute", "x.value").where(" AND ".join(f"`{c}` IS NOT NULL" for c in [*entity, "since"]))
    w = Window.partitionBy(*entity, "attribute").orderBy("since", F.col("until").asc_nulls_last(), "value")
    seen = long.select("*", F.lag("value").over(w).alias("__was"), F.lag("until").over(w).alias("__ended"), F.lag("since").over(w).alias("__began"),
                       F.lead("since").over(w).alias("__next"))
    goes_on = F.col("__began").isNotNull() & (F.col("__ended").isNull() | (F.col("__ended") >= F.col("since"))) & F.col("value").eqNullSafe(F.col("__was"))
    starts = F.when(~goes_on, F.struct(F.col("since"), F.col("value"), F.lit(True).alias("present")))
    stops = F.when(F.col("until").isNotNull() & (F.col("__next").isNull() | (F.col("__next") > F.col("until"))),
                   F.struct(F.col("until").alias("since"), F.lit(None).cast("string").alias("value"), F.lit(False).alias("present")))
    return seen.select(*entity, "attribute", F.explode(F.filter(F.array(starts, stops), lambda x: x.isNotNull())).alias("x")).select(*entity, "attribute", "x.*")


def last_known(probes: DataFrame, histories: DataFrame, entity: Sequence[str], time: str, attributes: dict[str, str]) -> DataFrame:
    """For each distinct (entity, time) the value of each attribute last changed at or before that time.

    ``attributes`` maps names to Spark types. Each attribute is matched on its own; all matches share one exchange and one
    sort of probes and changes together, and the values land in one row per probe. Probes are made distinct first,
    with map-side combining, so an entity's group holds its distinct times and changes, not its events. ``known_<a>`` is
    false where the attribute is absent at that time or not yet known.
    """
    kind = dict(probes.dtypes)[time]
    asked = probes.select(*entity, F.col(time).alias("since")).where(" AND ".join(f"`{c}` IS NOT NULL" for c in [*entity, "since"])).distinct()
    both = asked.select(*entity, "since", F.lit(1).alias("__probe"), F.lit(None).cast("string").alias("attribute"), F.lit(None).cast("string").alias("value"),
                        F.lit(None).cast("boolean").alias("present")).unionByName(
        histories.select(*entity, F.col("since").cast(kind).alias("since"), F.lit(0).alias("__probe"), "attribute", "value", "present"))
    w = Window.partitionBy(*entity).orderBy("since", "__probe").rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def last(a: str) -> Column:
        return F.last(F.when(F.col("attribute") == a, F.struct("value", "present")), ignorenulls=True).over(w).alias(f"__{a}")

    found = both.select(*entity, "since", "__probe", *[last(a) for a in attributes]).where("__probe = 1")
    return found.select(*entity, F.col("since").alias(time), *[F.col(f"__{a}.value").cast(t).alias(a) for a, t in attributes.items()],
                        *[F.coalesce(F.col(f"__{a}.present"), F.lit(False)).alias(f"known_{a}") for a in attributes])


def attributes_as_known(events: DataFrame, dim: DataFrame, entity: Sequence[str], time: str, start: str, end: str | None, attributes: Sequence[str],
                        prefix: str = "known_") -> DataFrame:
    """``events`` whole, with ``<prefix><a>`` of each attribute valid at the event's time and ``<prefix>present``.

    Never uses a value that became valid later. Events with a null entity or time, or without a valid version, carry nulls
    and ``present = false``. Every event stays exactly once. The match is many-to-one, so AQE can split a hot key.
    Columns of ``events`` that clash with the added names are replaced.
    """
    types = dict(dim.dtypes)
    found = last_known(events, change_histories(dim, entity, start, end, attributes), entity, time, {a: types[a] for a in attributes})
    keys = [F.col(c).alias(f"__k{i}") for i, c in enumerate([*entity, time])]
    present = F.lit(False)
    for a in attributes:
        present = present | F.col(f"known_{a}")
    found = found.select(*keys, *[F.col(a).alias(f"__v_{a}") for a in attributes], present.alias("__v_present"))
    on = None
    for i, c in enumerate([*entity, time]):
        on = (events[c] == found[f"__k{i}"]) if on is None else on & (events[c] == found[f"__k{i}"])
    joined = events.join(found, on, "left").drop(*[f"__k{i}" for i in range(len(keys))])
    for a in attributes:
        joined = joined.withColumn(f"{prefix}{a}", F.col(f"__v_{a}")).drop(f"__v_{a}")
    return joined.withColumn(f"{prefix}present", F.coalesce("__v_present", F.lit(False))).drop("__v_present")

"""History of changing entity attributes, from full snapshots, by gaps and islands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidetable.session import broadcast_if_small


def state_hash(attributes: Sequence[str]) -> F.Column:
    """md5 over the attributes; null equals empty text. Each value carries its length, so values cannot run together."""
    parts = []
    for a in attributes:
        v = F.coalesce(F.col(a).cast("string"), F.lit(""))
        parts += [F.length(v).cast("string"), v]
    return F.md5(F.concat_ws(":", *parts))


def snapshot_history(snapshots: DataFrame, scope: Sequence[str], entity: Sequence[str], version: str, version_date: str, attributes: Sequence[str]) -> DataFrame:
    """One row per period in which an entity was listed unchanged: ``valid_from``, ``valid_to`` (exclusive, null = open),
    ``is_current``, the starting version and its attributes.

    A period starts where the entity appears, reappears or differs from the scope's previous version, and ends at the
    scope's next version in which it differs or is absent. Null equals empty text in the comparison. Rows with a
    null scope, entity, version or date are ignored (they belong to no period); repeated rows collapse, and where rows
    of one entity and version disagree, the one with the smallest hash counts. Windows run over one scope's versions
    and one entity's versions, both as long as the number of versions. An empty table gives an empty table.
    """
    keys = [*scope, *entity, version, version_date]
    listed = snapshots.where(" AND ".join(f"`{c}` IS NOT NULL" for c in keys)).select(*keys, *attributes, state_hash(attributes).alias("__state"))
    listed = listed.groupBy(*keys).agg(F.min(F.struct("__state", *attributes)).alias("__row"))
    order = Window.partitionBy(*scope).orderBy(version_date, version)
    versions = snapshots.where(" AND ".join(f"`{c}` IS NOT NULL" for c in [*scope, version, version_date])).select(*scope, version, version_date).distinct()
    versions = versions.select(*scope, version, F.row_number().over(order).alias("__seq"), F.lead(version_date).over(order).alias("__next"))
    listed = listed.join(broadcast_if_small(versions), [*scope, version])
    one = Window.partitionBy(*scope, *entity).orderBy("__seq")
    changed = F.lag("__seq").over(one).isNull() | (F.lag("__seq").over(one) < F.col("__seq") - 1) | (F.lag("__row.__state").over(one) != F.col("__row.__state"))
    marked = listed.withColumn("__new", changed.cast("int"))
    marked = marked.withColumn("__island", F.sum("__new").over(one.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    first = F.min(F.struct("__seq", F.col(version_date).alias("valid_from"), F.col(version).alias(version), "__row")).alias("__first")
    periods = marked.groupBy(*scope, *entity, "__island").agg(first, F.max(F.struct("__seq", F.col("__next").alias("valid_to"))).alias("__last"))
    return periods.select(*scope, *entity, "__first.valid_from", "__last.valid_to", F.col("__last.valid_to").isNull().alias("is_current"), F.col(f"__first.{version}").alias(version),
                          *[F.col(f"__first.__row.{a}").alias(a) for a in attributes])

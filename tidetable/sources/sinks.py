"""Sinks and table maintenance on plain parquet: versions, overwrites, upserts, rollback, export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def overwrite_partitions(df: DataFrame, path: str, partitions: Sequence[str]) -> None:
    """Replace only the partitions that ``df`` holds; running it again leaves the same table."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def ensure_table(spark: SparkSession, name: str, ddl: str, partitions: Sequence[str] = (), location: str | None = None) -> None:
    """Create a parquet table if there is none, at ``location`` if one is given."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet" + (f" PARTITIONED BY ({', '.join(partitions)})" if partitions else "") + (f" LOCATION '{location}'" if location else ""))


def evolve_table(df: DataFrame, name: str) -> list[str]:
    """Append ``df`` to a table whose columns it may lack or exceed: columns that the table lacks are added to it first, those that ``df`` lacks
    are null. Earlier rows stay. The names added; a column whose type changed is refused."""
    table = df.sparkSession.table(name)
    _, changed = evolved(df, table)
    if changed and any(dict(df.dtypes).get(c, t) != t for c, t in table.dtypes):
        raise ValueError(f"{name}: a column changed its type")
    added = [(c, t) for c, t in df.dtypes if c not in table.columns]
    if added:
        df.sparkSession.sql(f"ALTER TABLE {name} ADD COLUMNS (" + ", ".join(f"`{c}` {t}" for c, t in added) + ")")
    now = df.sparkSession.table(name)
    df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in now.dtypes]).write.insertInto(name)
    return [c for c, _ in added]


def full_refresh(df: DataFrame, name: str, location: str) -> DataFrame:
    """Write ``df`` anew as a table's whole content, and give the table."""
    df.write.mode("overwrite").option("path", location).saveAsTable(name)
    return df.sparkSession.table(name)


def catalog(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """``table``, ``rows`` and ``columns`` of tables and views by name; a missing one is left out."""
    out = None
    for n in names:
        if spark.catalog.tableExists(n):
            t = spark.table(n)
            one = t.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table"), "rows", F.lit(len(t.columns)).alias("columns"))
            out = one if out is None else out.unionByName(one)
    return out if out is not None else spark.createDataFrame([], "`table` string, rows bigint, columns int")


def rolled_back(spark: SparkSession, root: str, before: str, least: int = 1) -> DataFrame:
    """The version a table had at ``before``; refused if there is none or it holds fewer than ``least`` rows."""
    path = version_as_of(spark, root, before)
    if path is None:
        raise ValueError(f"{root}: no version at {before}")
    df = spark.read.parquet(path)
    if len(df.take(least)) < least:
        raise ValueError(f"{path}: fewer than {least} rows")
    return df


def zipped(rows: DataFrame, path: str, member: str, lines: str) -> DataFrame:
    """``path`` and ``content``: one archive per row with the member ``member`` of the row's ``lines`` (an array of text)."""
    import io
    import zipfile
    from collections.abc import Iterable, Iterator

    import pyarrow as pa

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for ls in batch.column(1).to_pylist():
                held = io.BytesIO()
                with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
                    z.writestr(member, "\n".join(ls or []))
                out.append(held.getvalue())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["path", "content"])

    return rows.select(F.col(path), F.col(lines)).mapInArrow(run, "path string, content binary")


def evolved(df: DataFrame, existing: DataFrame) -> tuple[DataFrame, bool]:
    """``df`` with the existing table's columns first, typed nulls for those it lacks, then its new ones; and whether the table must be recreated, because a type changed."""
    have = dict(df.dtypes)
    changed = any(have.get(c, t) != t for c, t in existing.dtypes)
    first = [F.col(c) if c in have else F.lit(None).cast(t).alias(c) for c, t in existing.dtypes]
    return df.select(*first, *[c for c in df.columns if c not in existing.columns]), changed


def append_missing(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``new`` to append: those whose keys are not there yet; null equals null. Appending twice adds nothing."""
    from tidetable.operators.joins import null_safe_anti

    return null_safe_anti(new, existing, keys)


def upsert(existing: DataFrame, new: DataFrame, keys: Sequence[str], newest: str) -> DataFrame:
    """Rows of both, one per key: the newest by ``newest``, of equal age the new one."""
    both = existing.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)), allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy(F.col(newest).desc_nulls_last(), F.col("__new").desc())
    return both.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn", "__new")


def delete_insert(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``existing`` without the keys that ``new`` holds, plus ``new``."""
    from tidetable.operators.joins import null_safe_anti

    return null_safe_anti(existing, new, keys).unionByName(new, allowMissingColumns=True)


def write_version(df: DataFrame, root: str, version: str) -> str:
    """Write a full version beside the others; readers choose one by :func:`version_as_of`."""
    path = f"{root}/version={version}"
    df.write.mode("overwrite").parquet(path)
    return path


def version_as_of(spark: SparkSession, root: str, before: str | None = None) -> str | None:
    """Path of the newest version named at or before ``before`` (names sort in time), as a rollback target; null if there is none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []
    fit = [n for n in names if n.startswith("version=") and (before is None or n[8:] <= before)]
    return f"{root}/{fit[-1]}" if fit else None


def archive(df: DataFrame, path: str, at: str, keys: Sequence[str]) -> None:
    """Raw rows under keys, day and hour."""
    t = F.col(at).cast("timestamp")
    df.withColumn("day", F.to_date(t)).withColumn("hour", F.hour(t)).write.mode("append").partitionBy(*keys, "day", "hour").parquet(path)


def export_json(df: DataFrame, path: str) -> None:
    """A small result as one JSON lines file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def size_bounded(envelopes: DataFrame, most: int = 900_000) -> DataFrame:
    """Messages as JSON text ``value`` with key ``key``, payloads cut so that none exceeds ``most`` bytes; order is kept and a lone larger record stays whole.

    Each record's length is summed along the payload, and records of one budget multiple go together. All inside the JVM.
    """
    sized = envelopes.withColumn("__len", F.transform("payload", lambda r: F.octet_length(F.to_json(r)) + 1))
    head = F.octet_length(F.to_json(F.struct(*[c for c in envelopes.columns if c != "payload"]))) + 14
    start = F.struct(F.lit(0).alias("chunk"), F.lit(0).alias("size"), F.expr("cast(array() as array<int>)").alias("at"))

    def step(acc, n):
        full = (acc["size"] > 0) & (acc["size"] + n > F.lit(most) - head)
        chunk = acc["chunk"] + F.when(full, 1).otherwise(0)
        return F.struct(chunk.alias("chunk"), F.when(full, n).otherwise(acc["size"] + n).alias("size"), F.concat(acc["at"], F.array(chunk)).alias("at"))

    cut = sized.withColumn("__at", F.aggregate("__len", start, step, lambda a: a["at"])).withColumn("__chunk", F.explode(F.array_distinct("__at")))
    part = F.filter("payload", lambda r, i: F.element_at("__at", i + 1) == F.col("__chunk"))
    rest = [c for c in envelopes.columns if c != "payload"]
    return cut.select(F.col("city").alias("key"), F.col("__chunk").alias("chunk"), F.to_json(F.struct(*rest, part.alias("payload"))).alias("value"))

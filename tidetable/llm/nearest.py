"""Matching records by nearest time: DuckDB as-of joins over Arrow groups."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Seconds of one time bucket; a key's probes and candidates are split by it, so a hot key spreads over many groups.
BUCKET = 3600
#: Rows that DuckDB joins at once; groups are cut only between keys.
GROUP_ROWS = 200_000


def clock_seconds(text: Column) -> Column:
    """``H:MM[:SS]`` as seconds from 00:00:00, hours past 24 kept; null if unreadable or null."""
    pattern = r"^\s*(\d{1,3}):([0-5]\d)(?::([0-5]\d))?\s*$"
    part = [F.regexp_extract(text, pattern, i).try_cast("int") for i in (1, 2, 3)]
    return part[0] * 3600 + part[1] * 60 + F.coalesce(part[2], F.lit(0))


_NEAREST = """
WITH p AS (SELECT k, bucket, sec FROM grp WHERE side = 0), c AS (SELECT k, bucket, sec, id FROM grp WHERE side = 1),
earlier AS (SELECT p.k, p.sec, p.sec - c.sec AS distance, c.id FROM p ASOF JOIN c ON p.k = c.k AND p.bucket = c.bucket AND p.sec >= c.sec),
later AS (SELECT p.k, p.sec, c.sec - p.sec AS distance, c.id FROM p ASOF JOIN c ON p.k = c.k AND p.bucket = c.bucket AND p.sec <= c.sec),
near AS (SELECT * FROM earlier UNION ALL SELECT * FROM later)
SELECT k, sec, arg_min(id, struct_pack(d := distance, i := id)) AS id, min(distance) AS distance FROM near WHERE distance <= $tolerance GROUP BY k, sec
"""


def _joined(batches: Iterable[pa.RecordBatch], tolerance: int) -> Iterator[pa.RecordBatch]:
    """Both joins over rows sorted by ``g``, in groups of about GROUP_ROWS cut between values of ``g``."""
    import duckdb

    con = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "1GB", "temp_directory": ""})

    def join(table: pa.Table) -> Iterator[pa.RecordBatch]:
        con.register("grp", table)
        found = con.sql(_NEAREST, params={"tolerance": tolerance}).to_arrow_table()
        con.unregister("grp")
        for b in found.to_batches():
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1).cast(pa.int64()), b.column(2), b.column(3).cast(pa.int64())], ["k", "sec", "id", "distance"])

    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n < GROUP_ROWS:
            continue
        table = pa.Table.from_batches(held)
        last = table.column("g")[n - 1]
        same = pc.sum(pc.equal(table.column("g"), last)).as_py()
        if same < n:
            yield from join(table.slice(0, n - same))
            held = table.slice(n - same).combine_chunks().to_batches()
            n = same
    if n:
        yield from join(pa.Table.from_batches(held))
    con.close()


def _key(keys: Sequence[str], last: Column) -> Column:
    """The key columns and a last part as one text; lengths keep the parts apart."""
    parts = [x for c in keys for x in (F.length(F.col(c).cast("string")).cast("string"), F.col(c).cast("string"))]
    return F.concat_ws(":", *parts, last)


def _looks(keys: Sequence[str], loose: str) -> Column:
    """Where a probe looks: one of its value among candidates of that value and of none, one without value among all."""
    value = F.concat(F.lit("="), F.col(loose).cast("string"))
    return F.explode(F.when(F.col(loose).isNull(), F.array(_key(keys, F.lit("*")))).otherwise(F.array(_key(keys, value), _key(keys, F.lit("-"))))).alias("k")


def nearest(probes: DataFrame, candidates: DataFrame, keys: Sequence[str], loose: str, at: str, candidate_at: str, candidate_id: str, tolerance: int) -> DataFrame:
    """For every distinct look (key text ``k``, time ``sec``) the nearest candidate's ``id`` and ``distance``, if within ``tolerance``.

    Keys must be equal and non-null; ``loose`` must be equal or null on either side; ``at`` are integer seconds. On equal
    distance the smallest id wins. Rows with a null key or time match nothing. Columns besides the named ones are ignored.

    Probes and candidates are made distinct by time first, with map-side combining, so that a key holds at most one
    row per second and value of ``loose``; time buckets split each key further. Buckets overlap by the tolerance on the
    candidate side only. Rows are hash-partitioned by key and bucket and sorted within partitions, and each Arrow
    group is joined by DuckDB, backward and forward, and the nearer candidate is kept.
    """
    full = " AND ".join(f"`{c}` IS NOT NULL" for c in keys)
    value = F.coalesce(F.concat(F.lit("="), F.col(loose).cast("string")), F.lit("-"))
    left = probes.where(f"{full} AND `{at}` IS NOT NULL").select(_looks(keys, loose), F.col(at).cast("bigint").alias("sec")).distinct()
    left = left.select("k", F.floor(F.col("sec") / BUCKET).cast("bigint").alias("bucket"), "sec", F.lit(None).cast("string").alias("id"), F.lit(0).alias("side"))
    offered = candidates.where(f"{full} AND `{candidate_at}` IS NOT NULL AND `{candidate_id}` IS NOT NULL")
    offered = offered.select(F.explode(F.array(_key(keys, value), _key(keys, F.lit("*")))).alias("k"), F.col(candidate_at).cast("bigint").alias("sec"), F.col(candidate_id).cast("string").alias("id"))
    first, last = (F.floor((F.col("sec") + d) / BUCKET).cast("bigint") for d in (-tolerance, tolerance))
    right = offered.groupBy("k", "sec").agg(F.min("id").alias("id")).select("k", F.explode(F.sequence(first, last)).alias("bucket"), "sec", "id", F.lit(1).alias("side"))
    rows = left.unionByName(right).withColumn("g", F.xxhash64("k", "bucket")).repartition("g").sortWithinPartitions("g")
    found = rows.mapInArrow(lambda b: _joined(b, tolerance), "k string, sec bigint, id string, distance bigint")
    return found


def match(probes: DataFrame, candidates: DataFrame, entity: str, keys: Sequence[str], loose: str, at: str, candidate_at: str, candidate_id: str, tolerance: int) -> DataFrame:
    """``entity``, the candidate's id as ``match_id``, ``distance`` and ``match_confidence`` of every entity with a match.

    The confidence falls from 1 at equal times to 0.5 at the tolerance. Probes choose independently; an entity with
    several probes takes the nearest match, then the smallest id. See :func:`nearest`.
    """
    found = nearest(probes, candidates, keys, loose, at, candidate_at, candidate_id, tolerance)
    full = " AND ".join(f"`{c}` IS NOT NULL" for c in [entity, *keys, at])
    looks = probes.where(full).select(F.col(entity), F.col(at).cast("bigint").alias("sec"), _looks(keys, loose))
    best = looks.join(found, ["k", "sec"]).groupBy(entity).agg(F.min(F.struct("distance", "id")).alias("b"))
    return best.select(entity, F.col("b.id").alias("match_id"), F.col("b.distance").alias("distance"), F.round(1 - F.col("b.distance") / (2 * max(1, tolerance)), 4).alias("match_confidence"))

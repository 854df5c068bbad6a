"""Temporal and tolerant joins composed of built-in operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidetable.operators.intervals import merge_islands
from tidetable.session import broadcast_if_small


def _all(conditions: Sequence[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def asof_backward(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str, values: Sequence[str], allow_equal: bool = True) -> DataFrame:
    """``left`` with the ``values`` of the latest ``right`` row at or before its time, for equal keys, and that row's time as ``asof_time``.

    Union and ordered window: one shuffle, no expansion, whatever the number of candidates. Null keys match
    each other within a window, so rows with a null key are kept with nulls. Among ``right`` rows of one time the one
    with the smallest values wins. Every left row stays exactly once.
    """
    ordered = F.struct(*values)
    r = right.where(" AND ".join(f"`{c}` IS NOT NULL" for c in [*keys, right_time])).groupBy(*keys, right_time).agg(F.min(ordered).alias("__v")).select(*keys, F.col(right_time).alias("__t"), F.struct(F.col(right_time).alias("t"), *[F.col(f"__v.{v}").alias(v) for v in values]).alias("__r"))
    lrow = left.select(*[F.col(k) for k in keys], F.col(left_time).alias("__t"), F.struct(*left.columns).alias("__l"))
    both = lrow.withColumn("__r", F.lit(None).cast(r.schema["__r"].dataType)).withColumn("__side", F.lit(1 if allow_equal else 0)).unionByName(
        r.withColumn("__l", F.lit(None).cast(lrow.schema["__l"].dataType)).withColumn("__side", F.lit(0 if allow_equal else 1)))
    w = Window.partitionBy(*keys).orderBy(F.col("__t").asc_nulls_first(), "__side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = both.withColumn("__m", F.last("__r", ignorenulls=True).over(w)).where("__l IS NOT NULL")
    return out.select("__l.*", F.col("__m.t").alias("asof_time"), *[F.col(f"__m.{v}").alias(v) for v in values])


def nearest_within(left: DataFrame, right: DataFrame, left_id: str, right_id: str, keys: Sequence[str], left_at: str, right_at: str, tolerance: int, loose: str | None = None) -> DataFrame:
    """``left_id``, ``right_id`` and ``distance`` of each left row's nearest right row with equal keys, at most ``tolerance`` apart.

    The distance is bucketed: a row meets candidates of its own and the neighbouring bucket only, so the join stays an
    equi-join whose fan-out is the density within the tolerance. Ties go to the smallest right id. ``loose`` must be equal or
    null on either side.
    """
    width = 2 * max(1, tolerance)
    l = left.where(" AND ".join(f"`{c}` IS NOT NULL" for c in [*keys, left_at])).select(*keys, left_id, (F.col(loose) if loose else F.lit(None)).alias("__m"), F.col(left_at).alias("__a"), F.floor(F.col(left_at) / width).alias("__b"))
    ends = [F.floor((F.col(right_at) + d) / width) for d in (-tolerance, tolerance)]
    r = right.where(" AND ".join(f"`{c}` IS NOT NULL" for c in [*keys, right_at])).select(*keys, right_id, (F.col(loose) if loose else F.lit(None)).alias("__n"), F.col(right_at).alias("__c"), F.explode(F.array_distinct(F.array(*ends))).alias("__b"))
    met = l.join(r, [*keys, "__b"]).withColumn("distance", F.abs(F.col("__a") - F.col("__c"))).where(F.col("distance") <= tolerance)
    if loose:
        met = met.where("__m IS NULL OR __n IS NULL OR __m = __n")
    return met.groupBy(left_id).agg(F.min(F.struct("distance", right_id)).alias("m")).select(left_id, f"m.{right_id}", "m.distance")


def resolve_priority(matches: Sequence[DataFrame], entity: str) -> DataFrame:
    """Matches of several matchers in order of precedence: an entity keeps the first matcher's row, then the smallest values."""
    tagged = [m.withColumn("__rank", F.lit(i)) for i, m in enumerate(matches)]
    both = tagged[0]
    for m in tagged[1:]:
        both = both.unionByName(m)
    rest = [c for c in both.columns if c not in (entity, "__rank")]
    return both.groupBy(entity).agg(F.min(F.struct("__rank", *rest)).alias("m")).select(entity, *[f"m.{c}" for c in rest])


def version_for_date(days: DataFrame, versions: DataFrame, scope: Sequence[str], day: str, version: str, version_date: str) -> DataFrame:
    """``scope``, ``day`` and the newest version dated at or before the day, else the earliest one after it.

    The versions of a scope become one sorted array, looked up by each distinct day: one small equi-join.
    """
    lists = versions.where(f"`{version_date}` IS NOT NULL").groupBy(*scope).agg(F.array_sort(F.collect_set(F.struct(F.col(version_date).alias("d"), F.col(version).alias("v")))).alias("__vs"))
    asked = days.select(*scope, day).where(f"`{day}` IS NOT NULL").distinct()
    past = F.filter("__vs", lambda x: x["d"] <= F.col(day))
    return asked.join(broadcast_if_small(lists), list(scope)).select(*scope, day, F.when(F.size(past) > 0, F.element_at(past, -1)["v"]).otherwise(F.element_at("__vs", 1)["v"]).alias(version))


#: Seconds of the narrowest time bucket, and how often it is doubled for longer spans.
_BUCKET, _LEVELS = 86_400, 24


def _seconds(df: DataFrame, c: str) -> Column:
    """A time or a number as seconds, with fractions."""
    return F.unix_micros(F.col(c).cast("timestamp")) / 1e6 if dict(df.dtypes)[c].startswith(("timestamp", "date")) else F.col(c).cast("double")


def inside_interval(points: DataFrame, intervals: DataFrame, keys: Sequence[str], at: str, start: str, end: str, strict: bool = True) -> DataFrame:
    """``points`` with ``inside``: whether some interval of equal keys holds the point (strictly, or with its ends).

    Intervals are united (where strict, only those that overlap) and listed under each day they touch, so that a point
    meets those of its own key and day in an equi-join, at most one of which holds it; no point is repeated, and a hot key is
    spread over its days. Points with a null key or time are outside.
    """
    whole = intervals.where(" AND ".join(f"`{c}` IS NOT NULL" for c in [*keys, start, end]))
    one = merge_islands(whole, keys, start, end, touching=not strict)
    first, last = (F.floor(_seconds(one, c) / _BUCKET) for c in (start, end))
    listed = one.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col(start).alias("__s"), F.col(end).alias("__e"), F.explode(F.sequence(first, last)).alias("__b"))
    held = (F.col(at) > F.col("__s")) & (F.col(at) < F.col("__e")) if strict else (F.col(at) >= F.col("__s")) & (F.col(at) <= F.col("__e"))
    asked = points.withColumn("__pb", F.floor(_seconds(points, at) / _BUCKET))
    joined = asked.join(broadcast_if_small(listed), _all([asked[k] == F.col(f"__{k}") for k in keys] + [F.col("__pb") == F.col("__b"), held]), "left")
    return joined.select(*[asked[c] for c in points.columns], F.col("__b").isNotNull().alias("inside"))


def without_overlap(spans: DataFrame, intervals: DataFrame, keys: Sequence[str], first: str, last: str, start: str, end: str) -> DataFrame:
    """``spans`` (first..last) that no interval of equal keys overlaps; spans with a null end or key are kept.

    A span looks in one bucket: that of its last instant, in buckets at least as wide as the span is long. Intervals
    are listed at every width under the buckets they touch and the next one, so an anti-join on key, width and
    bucket sees every interval that may overlap. A hot key is spread over its buckets.
    """
    length = _seconds(spans, last) - _seconds(spans, first)
    level = F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(length, F.lit(1.0)) / _BUCKET))).cast("int")
    asked = spans.withColumn("__level", level).withColumn("__at", F.floor(_seconds(spans, last) / (_BUCKET * F.pow(F.lit(2.0), F.col("__level")))))
    whole = intervals.where(" AND ".join(f"`{c}` IS NOT NULL" for c in [*keys, start, end]))
    listed = whole.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col(start).alias("__s"), F.col(end).alias("__e"), _seconds(whole, start).alias("__a"), _seconds(whole, end).alias("__z"), F.explode(F.sequence(F.lit(0), F.lit(_LEVELS))).alias("__l"))
    width = _BUCKET * F.pow(F.lit(2.0), F.col("__l"))
    listed = listed.where("__z >= __a").select(*[f"__{k}" for k in keys], "__s", "__e", "__l", F.explode(F.sequence(F.floor(F.col("__a") / width), F.floor(F.col("__z") / width) + 1)).alias("__b"))
    met = _all([asked[k] == F.col(f"__{k}") for k in keys] + [F.col("__level") == F.col("__l"), F.col("__at") == F.col("__b"), F.col(first) < F.col("__e"), F.col(last) > F.col("__s")])
    return asked.join(broadcast_if_small(listed), met, "left_anti").select(*spans.columns)


def null_safe_anti(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose keys do not occur in ``right``; null equals null. Stays an equi-join."""
    r = right.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
    return left.join(r, _all([left[k].eqNullSafe(r[f"__{k}"]) for k in keys]), "left_anti")


def allow_listed(df: DataFrame, allowed: DataFrame, restricted: Sequence[str], scope: str, key: str) -> DataFrame:
    """Rows of scopes that are not restricted, and those of restricted ones whose key is listed; a missing list drops the scope.

    A semi-join of the restricted part beside the rest, instead of a nested loop under OR.
    """
    limited = F.coalesce(F.col(scope).isin(list(restricted)), F.lit(False))
    listed = allowed.select(F.col(scope), F.col(key)).distinct()
    return df.where(~limited).unionByName(df.where(limited).join(broadcast_if_small(listed), [scope, key], "left_semi").select(*df.columns))


def unmatched_then(left: DataFrame, exact: DataFrame, second: DataFrame, entity: str, keys: Sequence[str], at: str, exact_at: str, tolerance: int) -> DataFrame:
    """Recovery of re-keyed rows: left rows without an exact partner within the tolerance, joined with ``second`` on keys and time."""
    e = exact.select(F.col(entity).alias("__e"), F.col(exact_at).alias("__x"))
    lost = left.join(e, (left[entity] == e["__e"]) & (F.abs(left[at] - e["__x"]) <= tolerance), "left_anti")
    return lost.join(second, [*keys, at])


def rekeyed(left: DataFrame, exact: DataFrame, second: DataFrame, entity: str, keys: Sequence[str], at: str, exact_at: str, second_id: str, tolerance: int, confidence: float = 0.9) -> DataFrame:
    """One match of each row that :func:`unmatched_then` recovers: ``entity``, the smallest ``second_id``, ``candidates`` and ``match_confidence``."""
    met = unmatched_then(left, exact, second, entity, keys, at, exact_at, tolerance)
    return met.groupBy(entity).agg(F.min(second_id).alias(second_id), F.countDistinct(second_id).alias("candidates")).withColumn("match_confidence", F.lit(confidence))


def exact_matches(left: DataFrame, right: DataFrame, keys: Sequence[str], inherited: Sequence[str], confidence: float = 1.0) -> DataFrame:
    """``left`` rows whose keys ``right`` has, with the ``inherited`` columns taken from ``right`` where they are null, and ``match_confidence``.

    Of several right rows of one key the one with the smallest inherited values counts, nulls last, so no left row is repeated.
    Rows with a null key match nothing.
    """
    one = right.groupBy(*keys).agg(F.min(F.struct(*[F.struct(F.col(c).isNull().alias("n"), F.col(c)).alias(c) for c in inherited])).alias("__r"))
    joined = left.join(one, list(keys))
    return joined.select(*[F.coalesce(F.col(c), F.col(f"__r.{c}.{c}")).alias(c) if c in inherited else F.col(c) for c in left.columns], F.lit(confidence).alias("match_confidence"))


def not_in(left: DataFrame, right: DataFrame, key: str, right_key: str) -> DataFrame:
    """``left`` rows whose ``key`` is NOT IN ``right``, by SQL's rule for null: a null on the right leaves nothing, a null key is kept only if
    the right side is empty. An anti-join and two scalar subqueries, so nothing must be broadcast."""
    r = right.select(F.col(right_key).alias("__k"))
    nulls, rows = r.agg(F.count_if(F.col("__k").isNull()).alias("n")).scalar(), r.agg(F.count(F.lit(1)).alias("n")).scalar()
    kept = left.join(r.where("__k IS NOT NULL").distinct(), left[key] == F.col("__k"), "left_anti")
    return kept.where((rows == 0) | ((nulls == 0) & F.col(key).isNotNull()))


def by_day_type(days: DataFrame, items: DataFrame, day: str, kind: str, types: dict[str, Sequence[int]]) -> DataFrame:
    """``items`` of each day of ``days`` whose day type (``kind``) covers its weekday (Monday = 1).

    The OR over day types is spelled out as a small table of (type, weekday), which makes two equi-joins of it.
    """
    spark = days.sparkSession
    seed = spark.createDataFrame([(k, d) for k, ds in types.items() for d in ds], f"`{kind}` string, __dow int")
    running = items.join(F.broadcast(seed), kind)
    return days.withColumn("__dow", F.weekday(day) + 1).join(running, "__dow").drop("__dow")

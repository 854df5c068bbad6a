"""Queries of the training-data problems 1, 5, 8, 9 and 10 with their production parameters, and their SQL oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidetable.llm import bpe, nearest, packing, percentiles, stuffed
from tidetable.session import load

#: Tokens a container holds.
CAPACITY = 2048
SHARES = {"p50": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99}


def matched_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = load(spark, sf_dir, "stop_time_predictions").where("trip_uid IS NOT NULL AND route_id IS NOT NULL AND start_time IS NOT NULL")
    # a trip's rows agree in these, so this leaves one row per trip; as keys of a hash aggregation they are combined before the shuffle
    trips = trips.select("trip_uid", "city", "route_id", "direction_id", "start_time").distinct().withColumn("at", nearest.clock_seconds(F.col("start_time")))
    static = load(spark, sf_dir, "gtfs_static_trips").withColumn("origin", nearest.clock_seconds(F.col("origin_time")))
    return nearest.match(trips, static, "trip_uid", ["city", "route_id"], "direction_id", "at", "origin", "trip_id", 300)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matched_trips(spark, sf_dir).select("trip_uid", F.col("match_id").alias("static_trip_id"))


def p1_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches with distance and confidence."""
    return matched_trips(spark, sf_dir).withColumnRenamed("match_id", "static_trip_id")


ROUTE_DAY = ["city_key", "service_date", "route_id", "direction_id"]


def _delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "fct_stop_events").select(*ROUTE_DAY, "delay_arr_sec")
    return events.withColumn("direction_id", F.coalesce("direction_id", F.lit(-1)))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    stated = load(spark, sf_dir, "fct_route_reliability_daily").where("p90_delay_sec IS NOT NULL").select("route_day_key", *ROUTE_DAY, "p90_delay_sec")
    delays = _delays(spark, sf_dir)
    b = percentiles.rank_bounds(percentiles.sketch(delays, ROUTE_DAY, "delay_arr_sec"), stated, ROUTE_DAY, "p90_delay_sec").where("n > 0")
    b = b.withColumn("wrong", (F.col("below_least") > 0.95 * F.col("n")) | (F.col("upto_most") < 0.85 * F.col("n")))
    b = b.withColumn("open", ~F.col("wrong") & ((F.col("below_most") > 0.95 * F.col("n")) | (F.col("upto_least") < 0.85 * F.col("n"))))
    # route-days whose own bucket straddles a line are counted exactly: their own bucket's values alone, equal ones combined before the shuffle
    same = [*ROUTE_DAY, "at"]
    both = b.where("wrong OR open").select("route_day_key", *same, "p90_delay_sec", "n", F.col("below_least").alias("below"), F.col("upto_least").alias("upto"), "wrong")
    own = delays.where("delay_arr_sec IS NOT NULL").withColumn("at", percentiles.bucket(F.col("delay_arr_sec")))
    own = own.where(percentiles.key_marks(both.where("NOT wrong"), same)).groupBy(*same, "delay_arr_sec").agg(F.count(F.lit(1)).alias("c"))
    on = ~both["wrong"]
    for c in same:
        on = on & own[c].eqNullSafe(both[c])
    x, v = F.col("delay_arr_sec"), F.col("p90_delay_sec")
    exact = both.join(own, on, "left").groupBy("route_day_key", "n", "below", "upto", "wrong").agg(F.sum(F.when(x < v, F.col("c")).otherwise(0)).alias("b"), F.sum(F.when(x <= v, F.col("c")).otherwise(0)).alias("u"))
    return exact.where("wrong OR below + b > 0.95 * n OR upto + u < 0.85 * n").select("route_day_key")


def p5_city_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles of each city over all days, from the route-days' sketches put together."""
    days = percentiles.sketch(_delays(spark, sf_dir), ROUTE_DAY, "delay_arr_sec")
    return percentiles.percentiles(percentiles.merge(days, ["city_key"]), ["city_key"], SHARES).select("city_key", "n", *[F.round(p, 6).alias(p) for p in SHARES])


def p5_route_day_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles of each route-day."""
    return percentiles.percentiles(percentiles.sketch(_delays(spark, sf_dir), ROUTE_DAY, "delay_arr_sec"), ROUTE_DAY, SHARES).select(*ROUTE_DAY, "n", *[F.round(p, 6).alias(p) for p in SHARES])


def p5_within_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City medians and 90th percentiles that stay within the relative error of the exact value of the same rank."""
    delays = load(spark, sf_dir, "fct_stop_events").where("delay_arr_sec IS NOT NULL")
    counts = delays.groupBy("city_key", "delay_arr_sec").agg(F.count(F.lit(1)).alias("n"))
    from pyspark.sql import Window

    w = Window.partitionBy("city_key")
    upto = F.sum("n").over(w.orderBy("delay_arr_sec").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = counts.withColumn("all", F.sum("n").over(w)).withColumn("upto", upto)
    exact = ranked.groupBy("city_key").agg(*[F.min(F.when(F.col("upto") >= F.ceil(F.col("all") * s), F.col("delay_arr_sec"))).alias(f"exact_{p}") for p, s in SHARES.items()])
    near = p5_city_percentiles(spark, sf_dir).join(exact, "city_key")
    ok = [F.abs(F.col(p) - F.col(f"exact_{p}")) <= percentiles.ACCURACY * F.abs(F.col(f"exact_{p}")) + 1e-9 for p in SHARES]
    return near.select("city_key", (ok[0] & ok[1] & ok[2] & ok[3]).alias("within_bound"), *[F.col(f"exact_{p}") for p in SHARES])


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(load(spark, sf_dir, "documents"), "doc_id", "text")


def p8_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, those with text, those whose ids decode to their very text, and those without ids."""
    r = bpe.round_trip(load(spark, sf_dir, "documents"), "doc_id", "text")
    return r.agg(F.count(F.lit(1)).alias("documents"), F.count("same").alias("with_text"), F.count_if("same").alias("same"), F.count_if(F.col("n_tokens") == 0).alias("without_ids"))


def p9_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = load(spark, sf_dir, "documents")
    return packing.pack_documents(bpe.count_tokens(documents, "doc_id", "text"), "doc_id", "n_tokens", CAPACITY, packing.chunk_count(documents))


def p9_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the containers hold every document's tokens, none more than its capacity, and parts only of documents above it."""
    packed = p9_packed(spark, sf_dir)
    fullest = packed.groupBy("container_id").agg(F.sum("n_tokens").alias("fill")).agg(F.max("fill")).scalar()
    held = packed.groupBy("doc_id").agg(F.sum("n_tokens").alias("held"), F.count(F.lit(1)).alias("parts"))
    both = bpe.count_tokens(load(spark, sf_dir, "documents"), "doc_id", "text").join(held, "doc_id", "left")
    whole, unsplit = F.col("held") == F.col("n_tokens"), F.col("parts") == F.greatest(F.lit(1), F.ceil(F.col("n_tokens") / CAPACITY))
    return both.agg(F.count(F.lit(1)).alias("documents"), F.bool_and(F.coalesce(whole, F.lit(False))).alias("whole"), F.bool_and(F.coalesce(unsplit, F.lit(False))).alias("split_only_above"),
                    (F.first(fullest) <= CAPACITY).alias("within_capacity"))


def p9_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of 500 to 800 in containers of 2,048, where the start is far from optimal: whether the search needs fewer containers and loses nothing."""
    documents = load(spark, sf_dir, "documents").select("doc_id", (F.lit(500) + F.pmod(F.col("doc_id") * 7919, F.lit(301))).alias("size"))
    n = packing.chunk_count(documents)
    both = [packing.pack_documents(documents, "doc_id", "size", CAPACITY, n, search=s).agg(F.countDistinct("container_id").alias("c"), F.sum("n_tokens").alias("t"), F.count(F.lit(1)).alias("i")).withColumn("searched", F.lit(s)) for s in (False, True)]
    pick = lambda c, s: F.max(F.when(F.col("searched") == s, F.col(c)))
    return both[0].unionByName(both[1]).agg(pick("i", True).alias("items"), pick("t", True).alias("tokens"), (pick("c", True) < pick("c", False)).alias("fewer_containers"))


def p9_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How full the containers are: their number, the fewest possible, and the share of room used."""
    c = p9_packed(spark, sf_dir).groupBy("container_id").agg(F.sum("n_tokens").alias("fill"), F.count(F.lit(1)).alias("items"))
    return c.agg(F.count(F.lit(1)).alias("containers"), F.ceil(F.sum("fill") / CAPACITY).alias("fewest"), F.sum("fill").alias("tokens"), F.max("fill").alias("fullest"),
                 F.sum("items").alias("items"), (F.sum("fill") / (F.count(F.lit(1)) * CAPACITY)).alias("used"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stuffed.stuffed_pages(load(spark, sf_dir, "documents"), "doc_id", "text")


def p10_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits, false alarms and misses on the labelled rows by language, on those the limits were fitted on and on the others."""
    return stuffed.calibration(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"), "doc_id", "text", "stuffed")


def p10_on_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled rows with text by label, and whether at least 98 % of the cases and at most 1 % of the others are found."""
    found = stuffed.judged(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"), "doc_id", "text", "stuffed").groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_if("case").alias("f"))
    return found.select(F.col("label").alias("stuffed"), "n", F.when(F.col("label") == 1, F.col("f") >= 0.98 * F.col("n")).otherwise(F.col("f") <= 0.01 * F.col("n")).alias("within_bound"))


QUERIES = {f.__name__: f for f in (p1_found, p1_matches, p5_found, p5_city_percentiles, p5_route_day_percentiles, p5_within_bound, p8_ids, p8_round_trip, p9_packed, p9_whole, p9_search, p9_fill, p10_found, p10_calibration, p10_on_labels)}

_SECONDS = "CAST(split_part({0}, ':', 1) AS INT) * 3600 + CAST(split_part({0}, ':', 2) AS INT) * 60 + CAST(split_part({0}, ':', 3) AS INT)"
_MATCHES = f"""
WITH rt AS (SELECT DISTINCT trip_uid, city, route_id, direction_id, {_SECONDS.format("start_time")} AS sec FROM stop_time_predictions
            WHERE trip_uid IS NOT NULL AND route_id IS NOT NULL AND start_time IS NOT NULL),
st AS (SELECT city, route_id, direction_id, trip_id, {_SECONDS.format("origin_time")} AS origin FROM gtfs_static_trips WHERE origin_time IS NOT NULL),
m AS (SELECT trip_uid, trip_id, abs(sec - origin) AS d, row_number() OVER (PARTITION BY trip_uid ORDER BY abs(sec - origin), trip_id) AS rn
      FROM rt JOIN st ON rt.city = st.city AND rt.route_id = st.route_id AND (rt.direction_id = st.direction_id OR rt.direction_id IS NULL OR st.direction_id IS NULL)
      WHERE abs(sec - origin) <= 300)
"""
#: The value that stands for the bucket of the exact percentile.
_STANDS = "round(CASE WHEN {0} = 0 THEN 0 ELSE sign({0}) * exp(ceil(ln(abs({0})) / ln(1.005 / 0.995)) * ln(1.005 / 0.995)) * 2 / (1 + 1.005 / 0.995) END, 6)"
_SKETCHED = ", ".join(f"{_STANDS.format(f'quantile_disc(CAST(delay_arr_sec AS DOUBLE), {s})')} AS {p}" for p, s in SHARES.items())
_EXACT = "CAST(quantile_disc(delay_arr_sec, {}) AS INT)"
ORACLES = {
    "p8_round_trip": "SELECT count(*) AS documents, count(text) AS with_text, count(text) AS same, count(*) FILTER (WHERE coalesce(text, '') = '') AS without_ids FROM documents",
    "p9_whole": "SELECT count(*) AS documents, true AS whole, true AS split_only_above, true AS within_capacity FROM documents",
    "p9_search": "SELECT count(*) AS items, CAST(sum(500 + doc_id * 7919 % 301) AS BIGINT) AS tokens, true AS fewer_containers FROM documents",
    "p10_on_labels": "SELECT stuffed, count(*) AS n, true AS within_bound FROM labels JOIN documents USING (doc_id) WHERE regexp_matches(text, '\\S') GROUP BY 1",
    "p1_found": f"{_MATCHES} SELECT trip_uid, trip_id AS static_trip_id FROM m WHERE rn = 1",
    "p1_matches": f"{_MATCHES} SELECT trip_uid, trip_id AS static_trip_id, CAST(d AS BIGINT) AS distance, round(1 - d / 600.0, 4) AS match_confidence FROM m WHERE rn = 1",
    "p5_found": """SELECT route_day_key FROM fct_route_reliability_daily f JOIN fct_stop_events e ON e.city_key = f.city_key AND e.service_date = f.service_date AND e.route_id IS NOT DISTINCT FROM f.route_id
AND coalesce(e.direction_id, -1) = f.direction_id WHERE f.p90_delay_sec IS NOT NULL AND e.delay_arr_sec IS NOT NULL GROUP BY route_day_key
HAVING count(*) FILTER (WHERE e.delay_arr_sec < f.p90_delay_sec) > 0.95 * count(*) OR count(*) FILTER (WHERE e.delay_arr_sec <= f.p90_delay_sec) < 0.85 * count(*)""",
    "p5_city_percentiles": f"SELECT city_key, count(*) AS n, {_SKETCHED} FROM fct_stop_events WHERE delay_arr_sec IS NOT NULL GROUP BY 1",
    "p5_route_day_percentiles": f"SELECT city_key, service_date, route_id, coalesce(direction_id, -1) AS direction_id, count(*) AS n, {_SKETCHED} FROM fct_stop_events WHERE delay_arr_sec IS NOT NULL GROUP BY ALL",
    "p5_within_bound": f"""SELECT city_key, true AS within_bound, {_EXACT.format(0.5)} AS exact_p50, {_EXACT.format(0.9)} AS exact_p90, {_EXACT.format(0.95)} AS exact_p95, {_EXACT.format(0.99)} AS exact_p99
FROM fct_stop_events WHERE delay_arr_sec IS NOT NULL GROUP BY city_key""",
}

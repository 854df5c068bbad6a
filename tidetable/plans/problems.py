"""Queries of the general training-data problems (2, 3, 4, 6 and 7) with their production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidetable.operators import asof, dedup, history, late, timestamps
from tidetable.session import broadcast_if_small, load

MESSAGE = ["city", "trip_uid", "stop_id", "stop_sequence", "arr_pred_ts_utc", "dep_pred_ts_utc", "arr_delay_sec", "dep_delay_sec", "schedule_relationship", "stu_schedule_relationship"]
ROUTE_STATE = ["agency_id", "route_short_name", "route_long_name", "route_type", "route_color"]
#: Seconds of further distance from the feed's time that cost a reading a factor of e. So short, the nearest reading always wins, as the problem
#: asks, and the mixture only settles what the feed's time leaves open.
SPREAD = 0.001
ROUTE_KNOWN = ["route_key", "agency_id", "route_short_name", "route_long_name", "route_type", "mode", "route_color"]


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "stop_time_predictions").select("row_no", "fetched_at", *MESSAGE)
    return dedup.redundant(rows, MESSAGE, "fetched_at", "row_no").select("row_no")


def p2_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages and their copies per city and schedule relationship, after deduplication."""
    rows = load(spark, sf_dir, "stop_time_predictions").select("row_no", "fetched_at", *MESSAGE)
    kept = dedup.keepers(rows, MESSAGE, "fetched_at", "row_no")
    return kept.groupBy("city", "schedule_relationship").agg(F.count(F.lit(1)).alias("messages"), F.sum("copies").alias("deliveries"), F.max("copies").alias("most_copies"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "fct_stop_events").where("route_id IS NOT NULL").select("event_no", "city_key", "route_id", "service_date", "route_key")
    known = asof.attributes_as_known(events, load(spark, sf_dir, "dim_route"), ["city_key", "route_id"], "service_date", "valid_from", "valid_to", ["route_key"])
    return known.where(~F.col("route_key").eqNullSafe(F.col("known_route_key"))).select("event_no", F.coalesce("known_route_key", F.lit("")).alias("route_key"))


def p3_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stop visits by mode and route type as known on their service date."""
    events = load(spark, sf_dir, "fct_stop_events").select("event_no", "city_key", "route_id", "service_date", "delay_arr_sec")
    known = asof.attributes_as_known(events, load(spark, sf_dir, "dim_route"), ["city_key", "route_id"], "service_date", "valid_from", "valid_to", ROUTE_KNOWN)
    return known.groupBy("city_key", F.col("known_mode").alias("mode"), F.col("known_route_type").alias("route_type")).agg(
        F.count(F.lit(1)).alias("visits"), F.count("known_route_key").alias("with_route"), F.sum("delay_arr_sec").alias("delay_sum"), F.count("known_route_color").alias("with_color"))


def read_envelopes(spark: SparkSession, sf_dir: str, columns: list[str]) -> DataFrame:
    """Envelopes with the city's zone and feed time as evidence in microseconds. The city table is fixed and small."""
    zones = load(spark, sf_dir, "dim_city").select(F.col("city_key").alias("city"), F.col("iana_tz").alias("zone"))
    return load(spark, sf_dir, "envelope").select("city", "endpoint", "fetched_at", "feed_ts", *columns).join(broadcast_if_small(zones), "city", "left").withColumn("near", F.col("feed_ts") * 1_000_000)


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per delivered vehicle record: endpoint, vehicle as ``record``, own time, arrival."""
    read = read_envelopes(spark, sf_dir, ["payload"]).withColumn("payload", F.transform(F.col("payload"), lambda x: F.struct(x["vehicle_id"].alias("vehicle_id"), x["timestamp"].alias("timestamp"))))
    read = timestamps.normalise(read, "fetched_at", "zone", "endpoint", "near", spread=SPREAD).where("utc_micros IS NOT NULL")
    return read.select("endpoint", "feed_ts", "utc_micros", F.explode("payload").alias("x")).select(
        "endpoint", F.col("x.vehicle_id").alias("record"), F.coalesce("x.timestamp", "feed_ts").alias("event_s"), F.col("utc_micros").alias("arrival_us"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    revisions = p4_revisions(spark, sf_dir)
    # the count that stood ten minutes after the hour's end was put right later
    return late.corrected(revisions, "endpoint", after=1).select("endpoint", F.col("period_start").alias("hour_start"))


def p4_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every corrected hourly count per endpoint within the cut-off."""
    return late.revisions(p4_cells(spark, sf_dir), "endpoint")


def p4_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The triangle itself: arrivals per endpoint, hour and ten minutes of lateness."""
    return late.triangle(arrivals(spark, sf_dir), "endpoint", length=3600, step=600, cutoff=7200)


def listed_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    routes = load(spark, sf_dir, "gtfs_static_routes").withColumnRenamed("city", "city_key")
    return routes.withColumn("version_date", F.try_to_date(F.regexp_extract("gtfs_version_id", r"-(\d{8})-[^-]*$", 1), "yyyyMMdd"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = history.snapshot_history(listed_routes(spark, sf_dir), ["city_key"], ["route_id"], "gtfs_version_id", "version_date", ROUTE_STATE)
    return h.select("city_key", "route_id", F.date_format("valid_from", "yyyy-MM-dd").alias("valid_from"), F.coalesce(F.date_format("valid_to", "yyyy-MM-dd"), F.lit("")).alias("valid_to"), "gtfs_version_id")


def p6_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rebuilt route dimension with its surrogate key."""
    h = history.snapshot_history(listed_routes(spark, sf_dir), ["city_key"], ["route_id"], "gtfs_version_id", "version_date", ROUTE_STATE)
    key = F.md5(F.concat_ws("|", "city_key", "route_id", F.date_format("valid_from", "yyyy-MM-dd")))
    return h.select(key.alias("route_key"), "city_key", "route_id", *ROUTE_STATE, "valid_from", "valid_to", "is_current", "gtfs_version_id")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = read_envelopes(spark, sf_dir, ["envelope_id"]).where(~F.col("fetched_at").rlike(r"\A\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ\z"))
    table = load(spark, sf_dir, "tokyo_odpt_train_timetable")
    # both tables in one pass of the operator, as sources of their own
    texts = sent.select(F.lit("envelope").alias("src"), F.col("envelope_id").alias("record_id"), F.col("fetched_at").alias("text"), "zone", F.col("endpoint").alias("source"), "near", F.lit(None).cast("array<string>").alias("clocks")).unionByName(
        table.select(F.lit("timetable").alias("src"), F.col("timetable_id").alias("record_id"), F.col("dc_date").alias("text"), F.lit("Asia/Tokyo").alias("zone"), F.lit("timetable").alias("source"), F.lit(None).cast("bigint").alias("near"),
                     F.col("odpt_train_timetable_object.departure_time").alias("clocks")))
    read = timestamps.normalise(texts, "text", "zone", "source", "near", spread=SPREAD).where("utc_micros IS NOT NULL")
    day = F.unix_date(F.to_date(F.from_utc_timestamp(F.timestamp_micros("utc_micros"), "Asia/Tokyo"))).cast("bigint") * timestamps.DAY
    # the value itself as item 0, then the list's clocks on the local day
    own = F.array(F.struct(F.lit(0).alias("item"), F.lit(None).cast("bigint").alias("seconds")))
    stops = F.coalesce(timestamps.running_clock(F.col("clocks")), F.expr("cast(array() as array<struct<item int, seconds bigint>>)"))
    items = read.select("src", "record_id", "utc_micros", day.alias("day"), F.inline(F.concat(own, stops)))
    local = F.col("day") + F.col("seconds") * 1_000_000
    micros = F.when(F.col("item") == 0, F.col("utc_micros")).otherwise(timestamps.local_instants(local, F.lit("Asia/Tokyo"))[0])
    return items.select("src", "record_id", F.col("item").alias("item_no"), micros.alias("utc_micros"))


def p7_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the fetch times were read, by status and reading."""
    sent = timestamps.normalise(read_envelopes(spark, sf_dir, ["envelope_id"]), "fetched_at", "zone", "endpoint", "near", spread=SPREAD)
    return sent.groupBy("status", "reading").agg(F.count(F.lit(1)).alias("n"))


def p7_by_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetch times whose day and month the mixture of their city decides, without the feed's time, and how many of them the feed's time reads alike."""
    sent = timestamps.normalise(read_envelopes(spark, sf_dir, ["envelope_id"]), "fetched_at", "zone", "city")
    # dates that both orders can read, apart
    sent = sent.where(F.col("fetched_at").rlike(r"^\s*(0?[1-9]|1[0-2])/(?!\1/)(0?[1-9]|1[0-2])/") & F.col("status").isin("by mixture", "ambiguous")).withColumnsRenamed({"utc_micros": "alone", "reading": "reading_alone", "status": "status_alone"})
    both = timestamps.normalise(sent, "fetched_at", "zone", "endpoint", "near", spread=SPREAD)
    return both.groupBy("city", F.col("reading_alone").alias("reading"), F.col("status_alone").alias("status")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("alone") == F.col("utc_micros")).alias("as_by_evidence"))


QUERIES = {f.__name__: f for f in (p2_found, p2_kept, p3_found, p3_attributes, p4_found, p4_revisions, p4_cells, p6_found, p6_history, p7_found, p7_status, p7_by_mixture)}

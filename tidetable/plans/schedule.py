"""Queries of service calendars, exploded schedules, passages, empty relations and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidetable.operators import service
from tidetable.plans import delivery, relational
from tidetable.plans.base import query
from tidetable.session import load
from tidetable.sources import readers

# The static trips state a service and no calendar: A runs on weekdays, B on weekends, others every day, in the first half of October 2025; one
# Saturday is added to A and one day is taken from the daily service.
_CALENDAR = """svc AS (SELECT DISTINCT city, service_id FROM gtfs_static_trips WHERE service_id IS NOT NULL),
regular AS (SELECT city, service_id, CAST(d AS DATE) AS service_date FROM svc, generate_series(TIMESTAMP '2025-10-01', TIMESTAMP '2025-10-15', INTERVAL 1 DAY) t(d) WHERE CASE WHEN service_id LIKE '%A' THEN isodow(d) <= 5 WHEN service_id LIKE '%B' THEN isodow(d) >= 6 ELSE true END),
dates AS (SELECT * FROM regular WHERE NOT (service_id = 'daily' AND service_date = DATE '2025-10-08') UNION SELECT city, service_id, DATE '2025-10-04' FROM svc WHERE service_id LIKE '%A')"""


def _dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    svc = load(spark, sf_dir, "gtfs_static_trips").where("service_id IS NOT NULL").select("city", "service_id").distinct()
    a, b = F.col("service_id").like("%A"), F.col("service_id").like("%B")
    flags = [F.when(~b if i < 5 else ~a, 1).otherwise(0).alias(d) for i, d in enumerate(service.WEEKDAYS)]
    calendar = svc.select("*", *flags, F.lit("20251001").alias("start_date"), F.lit("20251015").alias("end_date"))
    extra = svc.where(a).select("*", F.lit("20251004").alias("date"), F.lit(1).alias("exception_type"))
    gone = svc.where("service_id = 'daily'").select("*", F.lit("20251008").alias("date"), F.lit(2).alias("exception_type"))
    days = readers.date_spine(spark, "2025-09-01", "2025-11-30").select(F.col("date").alias("service_date"))
    return service.service_dates(calendar, extra.unionByName(gone), days, ["city"])


@query(f"WITH {_CALENDAR} SELECT city, service_date, count(*) AS services FROM dates GROUP BY 1, 2")
def active_services(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Services of each day: the calendar's weekdays, less removals, plus additions."""
    return _dates(spark, sf_dir).groupBy("city", "service_date").agg(F.count(F.lit(1)).alias("services"))


@query(f"""WITH {_CALENDAR}, {delivery._SCHED}, trips AS (SELECT DISTINCT city, trip_id, service_id FROM gtfs_static_trips)
SELECT city, service_date, count(*) AS calls, count(DISTINCT trip_id) AS trips, CAST(min(t) AS BIGINT) AS first_call, CAST(max(t) AS BIGINT) AS last_call FROM (SELECT trips.city, service_date, trip_id, {delivery._MIDNIGHT.format("service_date")} // 1000000 + sched_sec AS t
FROM trips JOIN dates USING (city, service_id) JOIN sched USING (city, trip_id) JOIN dim_city ON city_key = trips.city) GROUP BY 1, 2""")
def exploded_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every scheduled call of every active trip and day as an instant."""
    zones = load(spark, sf_dir, "dim_city").select(F.col("city_key").alias("city"), F.col("iana_tz").alias("zone"))
    clock = lambda s: F.concat_ws(":", *[F.lpad(x.cast("string"), 2, "0") for x in (F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60)])
    stops = delivery._schedule(spark, sf_dir).select("city", "trip_id", "stop_id", "stop_sequence", clock(F.col("sched_sec")).alias("arrival_time"))
    trips = load(spark, sf_dir, "gtfs_static_trips").select("city", "trip_id", "service_id").distinct()
    s = service.scheduled_stop_times(trips, _dates(spark, sf_dir), stops, zones, ["city"])
    t = F.unix_seconds("sched_arr_ts_utc")
    return s.groupBy("city", "service_date").agg(F.count(F.lit(1)).alias("calls"), F.countDistinct("trip_id").alias("trips"), F.min(t).alias("first_call"), F.max(t).alias("last_call"))


@query("""WITH x AS (SELECT city, r.trip_id AS trip, r.current_stop_sequence AS s, r.timestamp AS t FROM (SELECT city, unnest(payload) AS r FROM envelope) WHERE r.trip_id IS NOT NULL AND r.current_stop_sequence IS NOT NULL AND r.timestamp > 0)
SELECT a.city, a.trip, CAST(a.s AS INT) AS stop, CAST(min(b.t) AS BIGINT) AS passed_at FROM (SELECT DISTINCT city, trip, s FROM x) a JOIN x b ON b.city = a.city AND b.trip = a.trip AND b.s >= a.s GROUP BY 1, 2, 3""")
def stop_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When each trip's vehicle was first seen at or past each of its stops."""
    x = load(spark, sf_dir, "envelope").select("city", F.explode("payload").alias("r")).select("city", F.col("r.trip_id").alias("trip"), F.col("r.current_stop_sequence").alias("s"), F.col("r.timestamp").alias("t"), F.lit(None).cast("int").alias("delay"))
    x = x.where("trip IS NOT NULL AND s IS NOT NULL AND t > 0")
    stops = x.select("city", "trip", F.col("s").alias("stop"), F.lit(1).alias("sign")).distinct()
    return service.passages(x, stops, ["city", "trip"], "s", "t", "sign", "stop", "delay").select("city", "trip", "stop", "passed_at")


@query("SELECT city_key, CAST(0 AS BIGINT) AS hours, CAST(NULL AS DOUBLE) AS warmest FROM dim_city")
def absent_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cities beside a source that is not there: a typed relation without rows stands in for it."""
    w = readers.empty(spark, "city_key string, temp_c double")
    return load(spark, sf_dir, "dim_city").select("city_key").join(w, "city_key", "left").groupBy("city_key").agg(F.count("temp_c").alias("hours"), F.max("temp_c").alias("warmest"))


@query("SELECT least(10, count(*)) AS rows, least(10, count(*)) AS of_the_table, true AS distinct_rows FROM events")
def sample_holds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample has the asked size, and each of its rows is one of the table's."""
    s = relational.sampled_events(spark, sf_dir)
    found = s.join(load(spark, sf_dir, "events").select("event_id").distinct(), "event_id", "left_semi")
    sizes = s.agg(F.count(F.lit(1)).alias("rows"), (F.countDistinct("event_id") == F.count(F.lit(1))).alias("distinct_rows"))
    return sizes.withColumn("of_the_table", found.agg(F.count(F.lit(1)).alias("n")).scalar())

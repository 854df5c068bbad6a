"""Queries of finalization with the schedule, matching, service delivery, weather and the read side's named questions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidetable.functions import domain
from tidetable.operators import incremental, joins, quality, rollup, service, timestamps
from tidetable.plans import relational, temporal
from tidetable.plans.base import query
from tidetable.session import broadcast_if_small, load
from tidetable.sources import readers

UNROUTED = "__unrouted__"
_MIDNIGHT = "(epoch_us(CAST(timezone(iana_tz, CAST({0} AS TIMESTAMP) + INTERVAL 12 HOUR) AS TIMESTAMPTZ)) - 43200000000)"
_SCHED = f"""sched AS (SELECT city_key AS city, static_trip_id AS trip_id, stop_id, stop_sequence, min(epoch_us(sched_arr_ts_utc) // 1000000 - {_MIDNIGHT.format("service_date")} // 1000000) AS sched_sec
FROM fct_stop_events JOIN dim_city USING (city_key) WHERE static_trip_id IS NOT NULL AND sched_arr_ts_utc IS NOT NULL GROUP BY 1, 2, 3, 4)"""
_NEAR = relational._NEAR_ORIGIN
_FINAL = f"""{_NEAR}, {_SCHED},
fresh AS (SELECT *, coalesce(a, d) AS pred FROM (SELECT *, epoch_us(arr_pred_ts_utc) AS a, epoch_us(dep_pred_ts_utc) AS d, epoch_us(fetched_at) AS f FROM stop_time_predictions
  WHERE arr_pred_ts_utc IS NOT NULL OR dep_pred_ts_utc IS NOT NULL OR arr_delay_sec IS NOT NULL OR dep_delay_sec IS NOT NULL) WHERE f IS NOT NULL AND (coalesce(a, d) IS NULL OR f <= coalesce(a, d) + 1800000000)),
newest AS (SELECT max(f) AS n FROM fresh),
called AS (SELECT * FROM (SELECT row_no, seq, due, row_number() OVER (PARTITION BY row_no ORDER BY abs(coalesce(pred, f) - due), seq, due) AS rn FROM (SELECT row_no, pred, f, s.stop_sequence AS seq, {_MIDNIGHT.format("service_date")} + sched_sec * 1000000 AS due
  FROM fresh JOIN near USING (trip_uid) JOIN sched s ON s.city = fresh.city AND s.trip_id = near.trip_id AND s.stop_id = fresh.stop_id JOIN dim_city ON city_key = fresh.city)) WHERE rn = 1),
placed AS (SELECT fresh.*, near.trip_id AS static_trip_id, c.due, coalesce(stop_sequence, c.seq) AS seq, coalesce(a, c.due + arr_delay_sec * 1000000::BIGINT) AS arr_eff, coalesce(pred, c.due + arr_delay_sec * 1000000::BIGINT, c.due + dep_delay_sec * 1000000::BIGINT) AS eff
  FROM fresh LEFT JOIN near USING (trip_uid) LEFT JOIN called c USING (row_no)),
visit_rows AS (SELECT *, row_number() OVER v AS rn, count(*) OVER g AS n_predictions, min(f) OVER g AS first_seen FROM placed, newest WHERE f <= eff + 1800000000 AND eff <= n - 1200000000 AND trip_uid IS NOT NULL AND seq IS NOT NULL AND stop_id IS NOT NULL
  WINDOW g AS (PARTITION BY city, service_date, trip_uid, seq), v AS (PARTITION BY city, service_date, trip_uid, seq ORDER BY f DESC, eff DESC, row_no DESC)),
visits AS (SELECT *, CASE WHEN abs(stated) <= 43200 THEN stated END AS delay FROM (SELECT *, CASE WHEN abs(arr_delay_sec) <= 43200 THEN arr_delay_sec ELSE CAST(pred // 1000000 - due // 1000000 AS BIGINT) END AS stated FROM visit_rows WHERE rn = 1))"""
_REL = "CASE WHEN schedule_relationship IN ('NEW', 'UNSCHEDULED') THEN 'ADDED' ELSE coalesce(schedule_relationship, 'SCHEDULED') END"


def _matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rt, st = relational._origins(spark, sf_dir)
    return joins.nearest_within(rt, st, "trip_uid", "trip_id", ["city", "route_id"], "s", "o", 300, "direction_id")


def _zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "dim_city").select(F.col("city_key").alias("city"), F.col("iana_tz").alias("zone"))


def _schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clocks of the scheduled stops of each static trip, as the visits state them."""
    e = load(spark, sf_dir, "fct_stop_events").where("static_trip_id IS NOT NULL AND sched_arr_ts_utc IS NOT NULL").withColumnRenamed("city_key", "city").join(broadcast_if_small(_zones(spark, sf_dir)), "city")
    sec = F.unix_seconds(F.col("sched_arr_ts_utc").cast("timestamp")) - F.unix_seconds(domain.scheduled_instant(F.col("service_date"), F.lit(0), F.col("zone")))
    return e.groupBy("city", F.col("static_trip_id").alias("trip_id"), "stop_id", "stop_sequence").agg(F.min(sec).alias("sched_sec"))


def _visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return service.finalize_with_schedule(load(spark, sf_dir, "stop_time_predictions"), _matches(spark, sf_dir), _schedule(spark, sf_dir), _zones(spark, sf_dir))


@query(f"""WITH {_FINAL} SELECT city, service_date, trip_uid, CAST(seq AS INT) AS stop_sequence, row_no, static_trip_id, due // 1000000 AS scheduled, arr_eff // 1000000 AS actual, CAST(delay AS INT) AS delay_arr_sec,
coalesce(stu_schedule_relationship = 'SKIPPED', false) AS skipped, CASE WHEN pred IS NOT NULL THEN 'last_prediction' ELSE 'delay_plus_schedule' END AS method, n_predictions FROM visits""")
def finalized_with_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stop visits of predictions by time or by delay alone, with the nearest scheduled call."""
    seconds = lambda c: F.floor(F.unix_micros(F.col(c)) / 1_000_000)
    return _visits(spark, sf_dir).select("city", "service_date", "trip_uid", "stop_sequence", "row_no", "static_trip_id", seconds("sched_arr_ts_utc").alias("scheduled"), seconds("actual_arr_ts_utc").alias("actual"), "delay_arr_sec",
                                         F.coalesce("skipped", F.lit(False)).alias("skipped"), "method", "n_predictions")


_DELIVERY = f"""{_FINAL}, every AS (SELECT DISTINCT city, service_date FROM stop_time_predictions),
streams AS (
SELECT t.city, route_id, service_date, n AS scheduled, 0 AS observed, 0 AS added, 0 AS observed_scheduled, 0 AS cancelled, 0 AS cancelled_unmatched, 0 AS published FROM (SELECT city, route_id, count(DISTINCT trip_id) AS n FROM gtfs_static_trips WHERE route_id IS NOT NULL GROUP BY 1, 2) t JOIN every ON every.city = t.city
UNION ALL SELECT city, coalesce(route_id, '{UNROUTED}'), service_date, 0, count(DISTINCT trip_uid), count(DISTINCT CASE WHEN {_REL} = 'ADDED' THEN trip_uid END), count(DISTINCT CASE WHEN {_REL} <> 'ADDED' THEN trip_uid END), 0, 0, 0 FROM visits GROUP BY 1, 2, 3
UNION ALL SELECT city, coalesce(route_id, '{UNROUTED}'), service_date, 0, 0, 0, 0, count(DISTINCT near.trip_id), count(DISTINCT CASE WHEN near.trip_id IS NULL THEN p.trip_uid END), 0 FROM stop_time_predictions p LEFT JOIN near ON near.trip_uid = p.trip_uid WHERE schedule_relationship = 'CANCELED' GROUP BY 1, 2, 3
UNION ALL SELECT city, coalesce(route_id, '{UNROUTED}'), service_date, 0, 0, 0, 0, 0, 0, count(DISTINCT p.trip_uid) FROM stop_time_predictions p JOIN near ON near.trip_uid = p.trip_uid WHERE (arr_pred_ts_utc IS NOT NULL OR dep_pred_ts_utc IS NOT NULL OR arr_delay_sec IS NOT NULL OR dep_delay_sec IS NOT NULL)
  AND EXISTS (SELECT 1 FROM sched s WHERE s.city = p.city AND s.trip_id = near.trip_id) GROUP BY 1, 2, 3),
rolled AS (SELECT city, route_id, service_date, {", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in ("scheduled", "observed", "added", "observed_scheduled", "cancelled", "cancelled_unmatched", "published"))} FROM streams GROUP BY 1, 2, 3),
delivery AS (SELECT r.*, observed_scheduled / CAST(nullif(scheduled, 0) AS DOUBLE) AS completeness_pct, observed / CAST(nullif(published, 0) AS DOUBLE) AS capture_rate,
  CAST(timezone(iana_tz, timezone('UTC', (SELECT max(fetched_at) FROM stop_time_predictions))) - INTERVAL 3 HOUR AS DATE) > service_date AS day_closed, coalesce(service_date >= retired_from, false) AS retired_day FROM rolled r LEFT JOIN dim_city ON city_key = r.city)"""
COUNTS = ["scheduled", "observed", "added", "observed_scheduled", "cancelled", "cancelled_unmatched", "published"]


def _delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, match = load(spark, sf_dir, "stop_time_predictions"), _matches(spark, sf_dir)
    keys = ["city", "route_id", "service_date"]
    routed = lambda df: df.withColumn("route_id", domain.folded_route(F.col("route_id")))
    trips = load(spark, sf_dir, "gtfs_static_trips").where("route_id IS NOT NULL").groupBy("city", "route_id").agg(F.countDistinct("trip_id").alias("scheduled"))
    scheduled = trips.join(p.select("city", "service_date").distinct(), "city")
    added = F.coalesce(F.col("schedule_relationship").isin("NEW", "UNSCHEDULED", "ADDED"), F.lit(False))
    observed = routed(_visits(spark, sf_dir)).groupBy(*keys).agg(F.countDistinct("trip_uid").alias("observed"), F.countDistinct(F.when(added, F.col("trip_uid"))).alias("added"), F.countDistinct(F.when(~added, F.col("trip_uid"))).alias("observed_scheduled"))
    dropped = routed(p.where("schedule_relationship = 'CANCELED'")).select(*keys, "trip_uid").join(match.select("trip_uid", F.col("trip_id").alias("match")), "trip_uid", "left")
    cancelled = dropped.groupBy(*keys).agg(F.countDistinct("match").alias("cancelled"), F.countDistinct(F.when(F.col("match").isNull(), F.col("trip_uid"))).alias("cancelled_unmatched"))
    stated = routed(p.where("arr_pred_ts_utc IS NOT NULL OR dep_pred_ts_utc IS NOT NULL OR arr_delay_sec IS NOT NULL OR dep_delay_sec IS NOT NULL")).select(*keys, "trip_uid").distinct()
    known = stated.join(match.select("trip_uid", "trip_id"), "trip_uid").join(_schedule(spark, sf_dir).select("city", "trip_id"), ["city", "trip_id"], "left_semi")
    published = known.groupBy(*keys).agg(F.countDistinct("trip_uid").alias("published"))
    rolled = rollup.summed_counts([scheduled, observed, cancelled, published], keys, COUNTS)
    city = load(spark, sf_dir, "dim_city").select(F.col("city_key").alias("city"), "iana_tz", "retired_from")
    as_of = p.agg(F.max(F.col("fetched_at").cast("timestamp")).alias("t")).scalar()
    out = rolled.join(broadcast_if_small(city), "city", "left")
    return out.select(*keys, *COUNTS, domain.ratio(F.col("observed_scheduled"), F.col("scheduled")).alias("completeness_pct"), domain.ratio(F.col("observed"), F.col("published")).alias("capture_rate"),
                      incremental.day_closed(F.col("service_date"), as_of, F.col("iana_tz")).alias("day_closed"), F.coalesce(F.col("service_date") >= F.col("retired_from"), F.lit(False)).alias("retired_day"))


@query(f"WITH {_DELIVERY} SELECT * FROM delivery")
def delivery_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips scheduled, observed, added, cancelled and published per route and day, completeness, capture, and whether the local day is over."""
    return _delivery(spark, sf_dir)


@query(f"""WITH {_DELIVERY} SELECT city, count(*) AS route_days, round(100 * avg(completeness_pct), 4) AS mean_completeness_pct, CAST(sum(scheduled) AS BIGINT) AS scheduled, CAST(sum(observed) AS BIGINT) AS observed, CAST(sum(added) AS BIGINT) AS added, CAST(sum(cancelled) AS BIGINT) AS cancelled
FROM delivery WHERE day_closed AND NOT retired_day GROUP BY 1""")
def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _delivery(spark, sf_dir).where("day_closed AND NOT retired_day")
    return d.groupBy("city").agg(F.count(F.lit(1)).alias("route_days"), F.round(100 * F.avg("completeness_pct"), 4).alias("mean_completeness_pct"), *[F.sum(c).alias(c) for c in ("scheduled", "observed", "added", "cancelled")])


@query(f"""WITH {_DELIVERY}, s AS (SELECT city, route_id, sum(scheduled) AS sched, sum(observed) AS obs FROM delivery WHERE NOT retired_day GROUP BY 1, 2), m AS (SELECT city, max(gtfs_version_id) AS v FROM gtfs_static_routes GROUP BY 1), r AS (SELECT DISTINCT g.city, route_id, route_type FROM gtfs_static_routes g JOIN m ON m.city = g.city AND m.v = g.gtfs_version_id)
SELECT r.city, r.route_type, count(*) AS static_routes, count(*) FILTER (WHERE coalesce(sched, 0) = 0) AS never_scheduled, count(*) FILTER (WHERE sched > 0 AND coalesce(obs, 0) = 0) AS scheduled_not_observed, count(*) FILTER (WHERE obs > 0) AS observed FROM r LEFT JOIN s ON s.city = r.city AND s.route_id = r.route_id GROUP BY 1, 2""")
def never_scheduled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routes of the newest version by type: never scheduled, scheduled and not observed, observed."""
    s = _delivery(spark, sf_dir).where("NOT retired_day").groupBy("city", "route_id").agg(F.sum("scheduled").alias("sched"), F.sum("observed").alias("obs"))
    r = relational.latest_version_routes(spark, sf_dir).select("city", "route_id", "route_type").distinct().join(s, ["city", "route_id"], "left")
    return r.groupBy("city", "route_type").agg(F.count(F.lit(1)).alias("static_routes"), F.count_if(F.coalesce("sched", F.lit(0)) == 0).alias("never_scheduled"),
                                               F.count_if((F.col("sched") > 0) & (F.coalesce("obs", F.lit(0)) == 0)).alias("scheduled_not_observed"), F.count_if(F.col("obs") > 0).alias("observed"))


@query(f"""WITH {_DELIVERY} SELECT split_part(route_id, '-', 1) AS prefix, count(DISTINCT route_id) AS routes, count(DISTINCT CASE WHEN scheduled > 0 THEN route_id END) AS scheduled, count(DISTINCT CASE WHEN observed > 0 THEN route_id END) AS observed FROM delivery WHERE city = 'palmlow' GROUP BY 1""")
def routes_by_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One city's routes by the prefix of their id that names the operator."""
    d = _delivery(spark, sf_dir).where("city = 'palmlow'")
    return d.groupBy(F.split_part("route_id", F.lit("-"), F.lit(1)).alias("prefix")).agg(F.countDistinct("route_id").alias("routes"), F.countDistinct(F.when(F.col("scheduled") > 0, F.col("route_id"))).alias("scheduled"), F.countDistinct(F.when(F.col("observed") > 0, F.col("route_id"))).alias("observed"))


# what an incremental build recomputes


@query("""SELECT city_key, count(*) AS kept FROM fct_stop_events JOIN dim_city USING (city_key) WHERE NOT coalesce(CAST(timezone(iana_tz, timezone('UTC', actual_arr_ts_utc)) AS DATE) > service_date AND hour(timezone(iana_tz, timezone('UTC', actual_arr_ts_utc))) >= 6, false) GROUP BY 1""")
def misdated_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "fct_stop_events").select("city_key", "service_date", "actual_arr_ts_utc").join(broadcast_if_small(load(spark, sf_dir, "dim_city").select("city_key", "iana_tz")), "city_key")
    return incremental.well_dated(e, "service_date", "actual_arr_ts_utc", F.col("iana_tz")).groupBy("city_key").agg(F.count(F.lit(1)).alias("kept"))


@query("""SELECT city_key, service_date, count(*) AS visits FROM fct_stop_events WHERE service_date >= (SELECT max(service_date) FROM fct_stop_events) - 3 GROUP BY 1, 2""")
def lookback_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "fct_stop_events").select("city_key", "service_date")
    return incremental.lookback(e, "service_date", e.agg(F.max("service_date").alias("d")).scalar()).groupBy("city_key", "service_date").agg(F.count(F.lit(1)).alias("visits"))


@query("""SELECT city_key, service_date, count(*) AS visits FROM fct_stop_events WHERE city_key = 'norvale' AND service_date BETWEEN DATE '2024-10-01' AND DATE '2025-12-31' GROUP BY 1, 2""")
def repair_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.repair(load(spark, sf_dir, "fct_stop_events"), "city_key", "norvale", "service_date", "2024-10-01", "2025-12-31").groupBy("city_key", "service_date").agg(F.count(F.lit(1)).alias("visits"))


@query("""WITH d AS (SELECT DISTINCT city_key, service_date FROM fct_stop_events), c AS (SELECT DISTINCT city_key, CAST(strptime(v, '%Y%m%d') AS DATE) AS since FROM (SELECT city AS city_key, split_part(max(gtfs_version_id), '-', 2) AS v FROM gtfs_static_routes GROUP BY 1)),
p AS (SELECT DISTINCT city_key, service_date FROM fct_route_reliability_daily WHERE banded_events >= 150)
SELECT d.city_key, d.service_date FROM d WHERE EXISTS (SELECT 1 FROM c WHERE c.city_key = d.city_key AND d.service_date >= c.since) OR NOT EXISTS (SELECT 1 FROM p WHERE p.city_key = d.city_key AND p.service_date = d.service_date)""")
def rotation_freeze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of visits that the newest version covers, or that were never published with many events."""
    keys = ["city_key", "service_date"]
    days = load(spark, sf_dir, "fct_stop_events").select(*keys).distinct()
    newest = load(spark, sf_dir, "gtfs_static_routes").groupBy(F.col("city").alias("city_key")).agg(F.try_to_date(F.split_part(F.max("gtfs_version_id"), F.lit("-"), F.lit(2)), "yyyyMMdd").alias("since"))
    covered = days.join(broadcast_if_small(newest), "city_key").where("service_date >= since").select(*keys)
    return incremental.recomputable(days, covered, load(spark, sf_dir, "fct_route_reliability_daily").where("banded_events >= 150"), keys)


# matching


@query("""SELECT city_key, coalesce(e.route_id, s.route_id) AS route_id, count(*) AS visits, count(*) FILTER (WHERE e.route_id IS NULL) AS inherited FROM fct_stop_events e JOIN (SELECT city, trip_id, min(route_id) AS route_id FROM gtfs_static_trips GROUP BY 1, 2) s ON s.city = e.city_key AND s.trip_id = e.static_trip_id GROUP BY 1, 2""")
def route_inheritance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits matched by the exact trip id, which take the schedule's route where they state none."""
    e = load(spark, sf_dir, "fct_stop_events").select(F.col("city_key").alias("city"), F.col("static_trip_id").alias("trip_id"), "route_id", F.col("route_id").isNull().alias("without"))
    m = joins.exact_matches(e, load(spark, sf_dir, "gtfs_static_trips"), ["city", "trip_id"], ["route_id"])
    return m.groupBy(F.col("city").alias("city_key"), "route_id").agg(F.count(F.lit(1)).alias("visits"), F.count_if("without").alias("inherited"))


@query(r"""WITH l AS (SELECT DISTINCT city_key AS city, static_trip_id AS id, nullif(regexp_extract(static_trip_id, '\.T(\d+)$', 1), '') AS token FROM fct_stop_events WHERE static_trip_id IS NOT NULL), r AS (SELECT DISTINCT city, trip_id, nullif(regexp_extract(trip_id, '\.T(\d+)$', 1), '') AS token FROM gtfs_static_trips)
SELECT l.city, l.id, min(r.trip_id) AS trip_id, CAST(1.0 AS DOUBLE) AS match_confidence FROM l JOIN r ON l.city = r.city AND l.token = r.token GROUP BY 1, 2""")
def token_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips whose ids share a token, whatever stands before it."""
    token = lambda c: F.nullif(F.regexp_extract(c, r"\.T(\d+)$", 1), F.lit("")).alias("token")
    left = load(spark, sf_dir, "fct_stop_events").where("static_trip_id IS NOT NULL").select(F.col("city_key").alias("city"), F.col("static_trip_id").alias("id"), token("static_trip_id"), F.lit(None).cast("string").alias("trip_id")).distinct()
    right = load(spark, sf_dir, "gtfs_static_trips").select("city", "trip_id", token("trip_id"))
    return joins.exact_matches(left, right, ["city", "token"], ["trip_id"]).select("city", "id", "trip_id", "match_confidence")


@query("""SELECT 'with_null' AS list, count(*) AS n FROM gtfs_static_trips WHERE trip_id NOT IN (SELECT static_trip_id FROM fct_stop_events) UNION ALL SELECT 'without_null', count(*) FROM gtfs_static_trips WHERE trip_id NOT IN (SELECT static_trip_id FROM fct_stop_events WHERE static_trip_id IS NOT NULL)
UNION ALL SELECT 'empty', count(*) FROM gtfs_static_trips""")
def null_aware_not_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NOT IN against a list with nulls, one without and an empty one."""
    t, e = load(spark, sf_dir, "gtfs_static_trips").select("trip_id"), load(spark, sf_dir, "fct_stop_events").select("static_trip_id")
    out = None
    for name, listed in (("with_null", e), ("without_null", e.where("static_trip_id IS NOT NULL")), ("empty", e.where("false"))):
        n = joins.not_in(t, listed, "trip_id", "static_trip_id").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("list"), "n")
        out = n if out is None else out.unionByName(n)
    return out


@query(f"""WITH {relational._ORIGINS} SELECT trip_uid, min(trip_id) AS trip_id, count(DISTINCT trip_id) AS candidates, CAST(0.9 AS DOUBLE) AS match_confidence FROM (SELECT trip_uid, rt.city, rt.route_id, s // 60 AS m FROM rt WHERE NOT EXISTS (SELECT 1 FROM fct_stop_events e JOIN dim_city USING (city_key)
WHERE e.trip_uid = rt.trip_uid)) l JOIN st ON st.city = l.city AND st.route_id = l.route_id AND st.o // 60 = l.m GROUP BY 1""")
def rekey_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips without a visit of their own id near their start, matched by route and minute of origin."""
    rt, st = relational._origins(spark, sf_dir)
    minute = lambda c: F.floor(F.col(c) / 60).cast("int")
    left = rt.select("trip_uid", "city", "route_id", minute("s").alias("at"))
    active = load(spark, sf_dir, "fct_stop_events").select("trip_uid", F.lit(0).alias("seen"))
    return joins.rekeyed(left, active, st.select("city", "route_id", minute("o").alias("at"), "trip_id"), "trip_uid", ["city", "route_id"], "at", "seen", "trip_id", 1 << 30)


DAY_TYPES = {"Weekday": [1, 2, 3, 4, 5], "Saturday": [6], "Holiday": [7], "SaturdayHoliday": [6, 7]}


@query("""WITH d AS (SELECT DISTINCT service_date FROM fct_stop_events WHERE city_key = 'minasato'), t AS (SELECT timetable_id, split_part(odpt_calendar, ':', 2) AS kind FROM tokyo_odpt_train_timetable)
SELECT service_date, kind, count(*) AS trains FROM d JOIN t ON (kind = 'Weekday' AND isodow(service_date) <= 5) OR (kind = 'Saturday' AND isodow(service_date) = 6) OR (kind = 'Holiday' AND isodow(service_date) = 7) OR (kind = 'SaturdayHoliday' AND isodow(service_date) >= 6) GROUP BY 1, 2""")
def trains_by_day_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timetables that run on each service day by their calendar's day type."""
    days = load(spark, sf_dir, "fct_stop_events").where("city_key = 'minasato'").select("service_date").distinct()
    t = load(spark, sf_dir, "tokyo_odpt_train_timetable").select("timetable_id", F.split_part("odpt_calendar", F.lit(":"), F.lit(2)).alias("kind"))
    return joins.by_day_type(days, t, "service_date", "kind", DAY_TYPES).groupBy("service_date", "kind").agg(F.count(F.lit(1)).alias("trains"))


@query("""SELECT t.timetable_id, count(DISTINCT r.route_id) AS routes FROM (SELECT timetable_id, list_extract(string_split(odpt_railway, '.'), -1) AS title FROM tokyo_odpt_train_timetable) t LEFT JOIN (SELECT route_id, replace(route_long_name, ' ', '') AS title FROM dim_route) r ON r.title = t.title GROUP BY 1""")
def title_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timetables joined with routes by the title of their line."""
    t = load(spark, sf_dir, "tokyo_odpt_train_timetable").select("timetable_id", readers.urn_tail(F.col("odpt_railway")).alias("title"))
    r = load(spark, sf_dir, "dim_route").select("route_id", F.replace("route_long_name", F.lit(" "), F.lit("")).alias("title")).where("title IS NOT NULL").distinct()
    return t.join(r, "title", "left").groupBy("timetable_id").agg(F.countDistinct("route_id").alias("routes"))


@query("""SELECT e.city_key, count(*) AS visits, CAST(sum(last_sequence) AS BIGINT) AS sequences FROM fct_stop_events e JOIN (SELECT city_key, service_date, trip_uid, max(stop_sequence) AS last_sequence FROM fct_stop_events GROUP BY 1, 2, 3) m ON m.city_key = e.city_key AND m.service_date = e.service_date AND m.trip_uid = e.trip_uid GROUP BY 1""")
def grain_join_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An attribute of the trip joined back to its visits on the trip's grain."""
    keys = ["city_key", "service_date", "trip_uid"]
    e = load(spark, sf_dir, "fct_stop_events").select(*keys, "stop_sequence")
    return e.join(e.groupBy(*keys).agg(F.max("stop_sequence").alias("last_sequence")), keys).groupBy("city_key").agg(F.count(F.lit(1)).alias("visits"), F.sum("last_sequence").alias("sequences"))


@query("SELECT city_key, service_date, count(*) AS visits, max(delay_arr_sec) AS worst FROM fct_stop_events GROUP BY ALL")
def group_by_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql("SELECT city_key, service_date, count(*) AS visits, max(delay_arr_sec) AS worst FROM {e} GROUP BY ALL", e=load(spark, sf_dir, "fct_stop_events"))


@query("SELECT * EXCLUDE (route_key, is_current), valid_to IS NULL AS is_current FROM dim_route")
def star_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns but a surrogate key, one of them derived anew."""
    return spark.sql("SELECT * EXCEPT (route_key, is_current), valid_to IS NULL AS is_current FROM {d}", d=load(spark, sf_dir, "dim_route"))


# weather

_WEATHER = """hours AS (SELECT city_key, iana_tz, k FROM (SELECT DISTINCT city_key, iana_tz, CAST(epoch_us(actual_arr_ts_utc) // 86400000000 AS BIGINT) AS d FROM fct_stop_events JOIN dim_city USING (city_key) WHERE actual_arr_ts_utc IS NOT NULL), LATERAL (SELECT unnest(generate_series((d - 1) * 24, (d + 2) * 24 - 1)) AS k)),
local_hours AS (SELECT city_key, CAST(l AS DATE) AS local_date, hour(l) AS local_hour, max(k) AS k FROM (SELECT city_key, k, timezone(iana_tz, make_timestamptz(k * 3600000000)) AS l FROM hours) GROUP BY 1, 2, 3),
weather AS (SELECT city_key, local_date, local_hour, (k * 7919 % 10) / 4.0 AS precip_mm FROM local_hours),
seen AS (SELECT e.*, CAST(l AS DATE) AS local_date, hour(l) AS local_hour FROM (SELECT fct_stop_events.*, timezone(iana_tz, timezone('UTC', actual_arr_ts_utc)) AS l FROM fct_stop_events JOIN dim_city USING (city_key) WHERE actual_arr_ts_utc IS NOT NULL AND delay_arr_sec IS NOT NULL) e),
rained AS (SELECT seen.*, precip_mm, delay_arr_sec BETWEEN -60 AND 299 AS on_time FROM seen JOIN weather USING (city_key, local_date, local_hour))"""


def _rained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits with the weather of their local hour. The weather is made up: hourly arrays of every city and day in the form the service sends."""
    zone = broadcast_if_small(load(spark, sf_dir, "dim_city").select("city_key", "iana_tz"))
    e = load(spark, sf_dir, "fct_stop_events").where("actual_arr_ts_utc IS NOT NULL AND delay_arr_sec IS NOT NULL").join(zone, "city_key").withColumn("__l", domain.local_time(F.col("actual_arr_ts_utc").cast("timestamp"), F.col("iana_tz")))
    d = F.unix_date(F.to_date("actual_arr_ts_utc")).cast("bigint")
    days = load(spark, sf_dir, "fct_stop_events").where("actual_arr_ts_utc IS NOT NULL").join(zone, "city_key").select(F.col("city_key").alias("city"), F.col("iana_tz").alias("zone"), F.explode(F.sequence(d - 1, d + 1)).alias("d")).distinct()
    hours = F.transform(F.sequence(F.lit(0), F.lit(23)), lambda h: F.col("d") * 24 + h)
    none = F.transform(F.col("k"), lambda k: F.lit(None).cast("double"))
    raw = days.withColumn("k", hours).select("city", "zone", F.transform("k", lambda k: F.date_format(F.timestamp_seconds(k * 3600), "yyyy-MM-dd'T'HH:mm")).alias("time"), none.alias("temp_c"), F.transform("k", lambda k: (k * 7919 % 10) / 4.0).alias("precip_mm"),
                                             none.alias("snowfall_cm"), none.alias("wind_kph"), F.transform("k", lambda k: F.lit(None).cast("int")).alias("weather_code"))
    w = readers.weather_hours(raw).withColumnRenamed("city", "city_key").select("city_key", "local_date", "local_hour", "precip_mm")
    e = e.withColumn("local_date", F.to_date("__l")).withColumn("local_hour", F.hour("__l"))
    return e.join(w, ["city_key", "local_date", "local_hour"]).withColumn("on_time", domain.otp_band(F.col("delay_arr_sec")) == "on_time")


@query(f"""WITH {_WEATHER} SELECT city_key, CASE WHEN precip_mm >= 1 THEN 'wet' ELSE 'dry' END AS sky, count(*) AS n, round(100.0 * count(*) FILTER (WHERE on_time) / count(*), 4) AS otp_pct, round(avg(delay_arr_sec), 4) AS mean_delay_sec FROM rained GROUP BY 1, 2 HAVING count(*) >= 20""")
def weather_otp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Punctuality of wet and dry hours, by city, local date and local hour."""
    r = _rained(spark, sf_dir).groupBy("city_key", F.when(F.col("precip_mm") >= 1, "wet").otherwise("dry").alias("sky"))
    return r.agg(F.count(F.lit(1)).alias("n"), F.round(100.0 * F.count_if("on_time") / F.count(F.lit(1)), 4).alias("otp_pct"), F.round(F.avg("delay_arr_sec"), 4).alias("mean_delay_sec")).where("n >= 20")


@query(f"""WITH {_WEATHER}, s AS (SELECT city_key, local_hour, count(*) FILTER (WHERE precip_mm >= 0.5) AS n1, count(*) FILTER (WHERE precip_mm < 0.5) AS n0, count(*) FILTER (WHERE precip_mm >= 0.5 AND on_time) AS y1, count(*) FILTER (WHERE precip_mm < 0.5 AND on_time) AS y0 FROM rained GROUP BY 1, 2)
SELECT city_key, CAST(sum(n1) AS BIGINT) AS wet_n, round(sum(y1) / CAST(sum(n1) AS DOUBLE), 6) AS wet_otp, round(sum(n1 * y0 / CAST(n0 AS DOUBLE)) / sum(n1), 6) AS dry_otp_reweighted FROM s WHERE n0 > 0 AND n1 > 0 GROUP BY 1 HAVING sum(n1) >= 50""")
def rain_standardised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Punctuality in rain beside that of dry hours reweighted to the same hours of the day."""
    r = rollup.standardised(_rained(spark, sf_dir).withColumn("wet", F.col("precip_mm") >= 0.5), ["city_key"], "local_hour", "wet", "on_time", 50)
    return r.select("city_key", F.col("exposed_n").alias("wet_n"), F.round("exposed_rate", 6).alias("wet_otp"), F.round("baseline_rate", 6).alias("dry_otp_reweighted"))


# named questions

_BAND = "CASE WHEN delay_arr_sec < -60 THEN 'early' WHEN delay_arr_sec <= 299 THEN 'on_time' WHEN delay_arr_sec <= 899 THEN 'late' ELSE 'very_late' END"


@query(f"""SELECT city_name, count(*) AS scored, {", ".join(f"round(100.0 * count(*) FILTER (WHERE band = '{b}') / count(*), 4) AS {b}_pct" for b in ("on_time", "early", "late", "very_late"))} FROM (SELECT city_name, {_BAND} AS band FROM fct_stop_events JOIN dim_city USING (city_key) WHERE delay_arr_sec IS NOT NULL) GROUP BY 1""")
def otp_by_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "fct_stop_events").where("delay_arr_sec IS NOT NULL").join(broadcast_if_small(load(spark, sf_dir, "dim_city").select("city_key", "city_name")), "city_key").withColumn("band", domain.otp_band(F.col("delay_arr_sec")))
    return e.groupBy("city_name").agg(F.count(F.lit(1)).alias("scored"), *[F.round(100.0 * F.count_if(F.col("band") == b) / F.count(F.lit(1)), 4).alias(f"{b}_pct") for b in ("on_time", "early", "late", "very_late")])


@query(f"""SELECT city_name, CAST(h AS INT) AS local_hour, count(*) AS events, round(100.0 * count(*) FILTER (WHERE band = 'on_time') / count(*), 4) AS otp_pct FROM (SELECT city_name, hour(timezone(iana_tz, timezone('UTC', actual_arr_ts_utc))) AS h, {_BAND} AS band FROM fct_stop_events JOIN dim_city USING (city_key)
WHERE delay_arr_sec IS NOT NULL AND actual_arr_ts_utc IS NOT NULL) GROUP BY 1, 2 HAVING count(*) >= 20""")
def otp_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Punctuality by city and local hour, thin hours left out."""
    e = load(spark, sf_dir, "fct_stop_events").where("delay_arr_sec IS NOT NULL AND actual_arr_ts_utc IS NOT NULL").join(broadcast_if_small(load(spark, sf_dir, "dim_city").select("city_key", "city_name", "iana_tz")), "city_key")
    hour = F.hour(domain.local_time(F.col("actual_arr_ts_utc").cast("timestamp"), F.col("iana_tz")))
    return e.groupBy("city_name", hour.alias("local_hour")).agg(F.count(F.lit(1)).alias("events"), F.round(100.0 * F.count_if(domain.otp_band(F.col("delay_arr_sec")) == "on_time") / F.count(F.lit(1)), 4).alias("otp_pct")).where("events >= 20")


@query("""SELECT city_key, count(*) AS events, round(quantile_cont(delay_arr_sec, 0.5), 4) AS p50_s, round(quantile_cont(delay_arr_sec, 0.75), 4) AS p75_s, round(quantile_cont(delay_arr_sec, 0.9), 4) AS p90_s, round(quantile_cont(delay_arr_sec, 0.95), 4) AS p95_s, round(avg(delay_arr_sec), 4) AS mean_s FROM fct_stop_events WHERE delay_arr_sec IS NOT NULL GROUP BY 1""")
def delay_reach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far delays reach: upper percentiles by city, exact over counted values."""
    e = load(spark, sf_dir, "fct_stop_events").where("delay_arr_sec IS NOT NULL")
    return e.groupBy("city_key").agg(F.count(F.lit(1)).alias("events"), *[F.round(F.percentile("delay_arr_sec", s), 4).alias(f"{p}_s") for p, s in (("p50", 0.5), ("p75", 0.75), ("p90", 0.9), ("p95", 0.95))], F.round(F.avg("delay_arr_sec"), 4).alias("mean_s"))


@query("""WITH r AS (SELECT city_key, route_id, any_value(mode) AS mode FROM dim_route WHERE is_current GROUP BY 1, 2), h AS (SELECT city, coalesce(mode, 'unknown') AS mode, date_trunc('hour', fetched_at) AS hour, count(DISTINCT coalesce(vehicle_id, trip_uid)) AS vehicles, count(DISTINCT trip_uid) AS trips, count(DISTINCT p.route_id) AS routes, bool_and(vehicle_id IS NOT NULL) AS reliable
FROM stop_time_predictions p LEFT JOIN r ON r.city_key = p.city AND r.route_id = p.route_id WHERE fetched_at IS NOT NULL GROUP BY 1, 2, 3) SELECT city, mode, max(vehicles) AS peak_vehicles, max(trips) AS peak_trips, max(routes) AS peak_routes, bool_or(reliable) AS vehicle_id_reliable FROM h GROUP BY 1, 2""")
def peak_vehicles_by_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most distinct vehicles, trips and routes of one hour, by city and mode of the current route."""
    r = load(spark, sf_dir, "dim_route").where("is_current").groupBy(F.col("city_key").alias("city"), "route_id").agg(F.first("mode").alias("mode"))
    p = load(spark, sf_dir, "stop_time_predictions").where("fetched_at IS NOT NULL").select("city", "route_id", "fetched_at", "vehicle_id", "trip_uid").join(broadcast_if_small(r), ["city", "route_id"], "left")
    h = p.groupBy("city", F.coalesce("mode", F.lit("unknown")).alias("mode"), F.date_trunc("hour", "fetched_at").alias("hour")).agg(F.countDistinct(F.coalesce("vehicle_id", "trip_uid")).alias("v"), F.countDistinct("trip_uid").alias("t"), F.countDistinct("route_id").alias("r"), F.bool_and(F.col("vehicle_id").isNotNull()).alias("ok"))
    return h.groupBy("city", "mode").agg(F.max("v").alias("peak_vehicles"), F.max("t").alias("peak_trips"), F.max("r").alias("peak_routes"), F.bool_or("ok").alias("vehicle_id_reliable"))


@query(f"""WITH {temporal._SEEN}, r AS (SELECT city_key, gap_sec, gap_sec / CAST(sched_gap_sec AS DOUBLE) AS ratio, measurable FROM seen WHERE sched_gap_sec > 0)
SELECT city_key, count(*) AS gaps, round(avg(gap_sec), 4) AS mean_gap_s, round(quantile_cont(gap_sec, 0.5), 4) AS median_gap_s, round(100.0 * avg(CASE WHEN measurable AND ratio < 0.5 THEN 1 ELSE 0 END), 4) AS bunched_pct, round(100.0 * avg(CASE WHEN measurable AND ratio > 2 THEN 1 ELSE 0 END), 4) AS big_gap_pct FROM r GROUP BY 1""")
def headway_regularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = temporal.headways_outside_gaps(spark, sf_dir).where("sched_gap_sec > 0").join(load(spark, sf_dir, "fct_stop_events").select("event_no", "city_key"), "event_no")
    share = lambda c: F.round(100.0 * F.avg(F.coalesce(F.col(c).cast("int"), F.lit(0))), 4).alias(f"{c}_pct")
    return h.groupBy("city_key").agg(F.count(F.lit(1)).alias("gaps"), F.round(F.avg("gap_sec"), 4).alias("mean_gap_s"), F.round(F.percentile("gap_sec", 0.5), 4).alias("median_gap_s"), share("bunched"), share("big_gap"))


@query(f"""WITH {_DELIVERY} SELECT city, CAST(sum(scheduled) AS BIGINT) AS scheduled_trips, round(100 * avg(cancelled / CAST(nullif(scheduled, 0) AS DOUBLE)), 6) AS mean_cancel_pct FROM delivery GROUP BY 1""")
def cancellations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _delivery(spark, sf_dir).groupBy("city").agg(F.sum("scheduled").alias("scheduled_trips"), F.round(100 * F.avg(domain.ratio(F.col("cancelled"), F.col("scheduled"))), 6).alias("mean_cancel_pct"))


@query("""WITH r AS (SELECT city_key, round(100 * sum(otp_pct * banded_events) / nullif(sum(CASE WHEN otp_pct IS NOT NULL THEN banded_events END), 0), 1) AS otp FROM fct_route_reliability_daily GROUP BY city_key, route_id HAVING sum(banded_events) >= 20),
l AS (SELECT city_key, list(otp ORDER BY otp) AS os FROM r WHERE otp IS NOT NULL GROUP BY 1)
SELECT city_key, len(os) AS routes, os[1 + CAST(least(floor(0.1 * len(os)), len(os) - 1) AS INT)] AS p10_otp, os[1 + CAST(least(floor(0.5 * len(os)), len(os) - 1) AS INT)] AS p50_otp, os[1 + CAST(least(floor(0.9 * len(os)), len(os) - 1) AS INT)] AS p90_otp,
round(100.0 * len(list_filter(os, lambda o: o >= 80)) / len(os), 4) AS ge_80_pct FROM l""")
def route_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How a city's routes spread: nearest-rank quantiles over routes of their weighted punctuality."""
    d = load(spark, sf_dir, "fct_route_reliability_daily").groupBy("city_key", "route_id").agg(F.round(100 * rollup.weighted_mean(F.col("otp_pct"), F.col("banded_events")), 1).alias("otp"), F.sum("banded_events").alias("b")).where("b >= 20 AND otp IS NOT NULL")
    q = rollup.nearest_rank(d, ["city_key"], "otp", {"p10_otp": 0.1, "p50_otp": 0.5, "p90_otp": 0.9})
    share = d.groupBy("city_key").agg(F.round(100.0 * F.count_if(F.col("otp") >= 80) / F.count(F.lit(1)), 4).alias("ge_80_pct"))
    return q.join(share, "city_key").select("city_key", F.col("n").alias("routes"), "p10_otp", "p50_otp", "p90_otp", "ge_80_pct")


@query(f"""SELECT route_id, CAST(h AS INT) AS local_hour, count(*) AS events, count(*) FILTER (WHERE band = 'on_time') AS on_time, round(quantile_cont(delay_arr_sec, 0.5), 4) AS median_s, round(quantile_cont(delay_arr_sec, 0.9), 4) AS p90_s FROM (SELECT route_id, delay_arr_sec, hour(timezone(iana_tz, timezone('UTC', actual_arr_ts_utc))) AS h, {_BAND} AS band
FROM fct_stop_events JOIN dim_city USING (city_key) WHERE city_key = 'norvale' AND delay_arr_sec IS NOT NULL AND actual_arr_ts_utc IS NOT NULL AND route_id IS NOT NULL) GROUP BY 1, 2""")
def route_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One city's proof table by route and local hour."""
    e = load(spark, sf_dir, "fct_stop_events").where("city_key = 'norvale' AND delay_arr_sec IS NOT NULL AND actual_arr_ts_utc IS NOT NULL AND route_id IS NOT NULL").join(broadcast_if_small(load(spark, sf_dir, "dim_city").select("city_key", "iana_tz")), "city_key")
    hour = F.hour(domain.local_time(F.col("actual_arr_ts_utc").cast("timestamp"), F.col("iana_tz")))
    return e.groupBy("route_id", hour.alias("local_hour")).agg(F.count(F.lit(1)).alias("events"), F.count_if(domain.otp_band(F.col("delay_arr_sec")) == "on_time").alias("on_time"), F.round(F.percentile("delay_arr_sec", 0.5), 4).alias("median_s"), F.round(F.percentile("delay_arr_sec", 0.9), 4).alias("p90_s"))


#: Weights of waiting, punctuality, cancellation and bunching in the score, and the excess wait in seconds that scores nothing.
WEIGHTS = {"wait": 0.35, "otp": 0.3, "cancel": 0.2, "bunch": 0.15}
WORST_WAIT = 600.0


@query(f"""WITH {_DELIVERY}, ewt AS (SELECT city_key, sum(ewt_sec * gaps) / sum(gaps) AS ewt FROM ({temporal.ROUTE_DAY_WAIT_SQL}) GROUP BY 1), o AS (SELECT city_key, sum(otp_pct * banded_events) / nullif(sum(CASE WHEN otp_pct IS NOT NULL THEN banded_events END), 0) AS otp FROM fct_route_reliability_daily GROUP BY 1),
c AS (SELECT city AS city_key, sum(cancelled) / CAST(nullif(sum(scheduled), 0) AS DOUBLE) AS cancel FROM delivery GROUP BY 1), b AS (SELECT city_key, avg(CASE WHEN bunched THEN 1.0 ELSE 0 END) AS bunch FROM ({temporal.HEADWAY_SQL}) JOIN fct_stop_events USING (event_no) WHERE bunched IS NOT NULL GROUP BY 1),
s AS (SELECT city_key, CASE WHEN ewt IS NOT NULL THEN 100 * least(1, greatest(0, 1 - ewt / 600)) END AS w, CASE WHEN otp IS NOT NULL THEN 100 * least(1, greatest(0, otp)) END AS o, CASE WHEN cancel IS NOT NULL THEN 100 * least(1, greatest(0, 1 - cancel)) END AS c, CASE WHEN bunch IS NOT NULL THEN 100 * least(1, greatest(0, 1 - bunch)) END AS b
FROM dim_city LEFT JOIN ewt USING (city_key) LEFT JOIN o USING (city_key) LEFT JOIN c USING (city_key) LEFT JOIN b USING (city_key))
SELECT city_key, round(w, 4) AS s_wait, round(o, 4) AS s_otp, round(c, 4) AS s_cancel, round(b, 4) AS s_bunch, round((coalesce(0.35 * w, 0) + coalesce(0.3 * o, 0) + coalesce(0.2 * c, 0) + coalesce(0.15 * b, 0)) / nullif(CASE WHEN w IS NULL THEN 0 ELSE 0.35 END + CASE WHEN o IS NULL THEN 0 ELSE 0.3 END + CASE WHEN c IS NULL THEN 0 ELSE 0.2 END + CASE WHEN b IS NULL THEN 0 ELSE 0.15 END, 0), 4) AS score FROM s""")
def city_scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four sub-scores and their weighted mean, the weights renormalised over those a city has."""
    wait = temporal.route_day_excess_wait(spark, sf_dir).groupBy("city_key").agg((1 - rollup.weighted_mean(F.col("ewt_sec"), F.col("gaps")) / WORST_WAIT).alias("wait"))
    otp = load(spark, sf_dir, "fct_route_reliability_daily").groupBy("city_key").agg(rollup.weighted_mean(F.col("otp_pct"), F.col("banded_events")).alias("otp"))
    cancel = _delivery(spark, sf_dir).groupBy(F.col("city").alias("city_key")).agg((1 - domain.ratio(F.sum("cancelled"), F.sum("scheduled"))).alias("cancel"))
    bunch = temporal.headways_outside_gaps(spark, sf_dir).where("bunched IS NOT NULL").join(load(spark, sf_dir, "fct_stop_events").select("event_no", "city_key"), "event_no").groupBy("city_key").agg((1 - F.avg(F.col("bunched").cast("int"))).alias("bunch"))
    s = load(spark, sf_dir, "dim_city").select("city_key")
    for part in (wait, otp, cancel, bunch):
        s = s.join(part, "city_key", "left")
    score = rollup.composite([(100 * F.col(c), w) for c, w in WEIGHTS.items()])
    return s.select("city_key", *[F.round(domain.clamp(100 * F.col(c), 0.0, 100.0), 4).alias(f"s_{c}") for c in WEIGHTS], F.round(score, 4).alias("score"))


@query("""SELECT city_key, strftime(service_date, '%Y-%m') AS month, round(quantile_cont(delay_arr_sec, 0.5), 4) AS median_delay_sec, o.n_orders AS benchmark FROM fct_stop_events LEFT JOIN (SELECT strftime(o_orderdate, '%m') AS m, count(*) AS n_orders FROM orders GROUP BY 1) o ON o.m = strftime(service_date, '%m') WHERE delay_arr_sec IS NOT NULL GROUP BY 1, 2, 4""")
def benchmark_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly medians beside a monthly figure from elsewhere, which a month may lack."""
    e = load(spark, sf_dir, "fct_stop_events").where("delay_arr_sec IS NOT NULL").groupBy("city_key", F.date_format("service_date", "yyyy-MM").alias("month")).agg(F.round(F.percentile("delay_arr_sec", 0.5), 4).alias("median_delay_sec"))
    other = load(spark, sf_dir, "orders").groupBy(F.date_format("o_orderdate", "MM").alias("__m")).agg(F.count(F.lit(1)).alias("benchmark"))
    return e.join(broadcast_if_small(other), F.substring("month", 6, 2) == F.col("__m"), "left").drop("__m")


@query("""WITH x AS (SELECT city, feed_ts, unnest(payload) AS r FROM envelope WHERE feed_ts IS NOT NULL), f AS (SELECT city, feed_ts, r.vehicle_id AS v, r.trip_id AS t FROM x WHERE r.vehicle_id IS NOT NULL AND coalesce(r.timestamp, feed_ts) BETWEEN feed_ts - 120 AND feed_ts + 120)
SELECT city, CAST(feed_ts // 3600 * 3600 AS BIGINT) AS hour, count(DISTINCT CASE WHEN t IS NOT NULL THEN v END) AS on_trip, count(DISTINCT CASE WHEN t IS NULL THEN v END) AS without_trip FROM f GROUP BY 1, 2""")
def positions_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicles with a fix at most two minutes old, on a trip and without one, per city and hour."""
    x = load(spark, sf_dir, "envelope").where("feed_ts IS NOT NULL").select("city", "feed_ts", F.explode("payload").alias("r")).select("city", "feed_ts", F.col("r.vehicle_id").alias("v"), F.col("r.trip_id").alias("t"), F.coalesce("r.timestamp", "feed_ts").alias("at"))
    fresh = x.where("v IS NOT NULL AND at BETWEEN feed_ts - 120 AND feed_ts + 120")
    return fresh.groupBy("city", (F.floor(F.col("feed_ts") / 3600) * 3600).alias("hour")).agg(F.countDistinct(F.when(F.col("t").isNotNull(), F.col("v"))).alias("on_trip"), F.countDistinct(F.when(F.col("t").isNull(), F.col("v"))).alias("without_trip"))


# audits


@query(f"""WITH {_FINAL} SELECT 'feed' AS hop, city, count(*) AS n, count(*) FILTER (WHERE trip_uid IS NULL) AS without_trip, count(*) - count(DISTINCT (coalesce(trip_uid, ''), coalesce(stop_sequence, -1), fetched_at)) AS repeated, CAST(NULL AS BIGINT) AS with_schedule FROM stop_time_predictions GROUP BY 2
UNION ALL SELECT 'visits', city, count(*), 0, 0, count(due) FROM visits GROUP BY 2 UNION ALL SELECT 'facts', city_key, count(*), count(*) FILTER (WHERE trip_uid IS NULL), count(*) - count(DISTINCT (coalesce(trip_uid, ''), coalesce(stop_sequence, -1), last_seen_utc)), count(sched_arr_ts_utc) FROM fct_stop_events GROUP BY 2""")
def hop_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, missing identities, repeated grains and schedule coverage at each hop from the feed to the facts."""
    p, v, e = load(spark, sf_dir, "stop_time_predictions"), _visits(spark, sf_dir), load(spark, sf_dir, "fct_stop_events").withColumnRenamed("city_key", "city")
    hops = [quality.audit(p, "feed", ["city"], "trip_uid", ["trip_uid", "stop_sequence", "fetched_at"], None), quality.audit(v, "visits", ["city"], "trip_uid", ["service_date", "trip_uid", "stop_sequence"], "sched_arr_ts_utc"),
            quality.audit(e, "facts", ["city"], "trip_uid", ["trip_uid", "stop_sequence", "last_seen_utc"], "sched_arr_ts_utc")]
    return hops[0].unionByName(hops[1]).unionByName(hops[2])


@query("""WITH d AS (SELECT city_key, service_date, count(*) AS n FROM fct_stop_events GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY city_key ORDER BY service_date DESC) AS k FROM d)
SELECT 'growing' AS check_name, 'warn' AS severity, city_key AS subject, CAST(sum(CASE WHEN k = 1 THEN n ELSE 0 END) AS BIGINT) AS seen, CASE WHEN sum(CASE WHEN k = 1 THEN n ELSE 0 END) >= 1 THEN 'pass' ELSE 'warn' END AS outcome FROM r GROUP BY city_key
UNION ALL SELECT 'range', 'error', city_key, count(*) FILTER (WHERE delay_arr_sec NOT BETWEEN -1800 AND 21600), CASE WHEN count(*) FILTER (WHERE delay_arr_sec NOT BETWEEN -1800 AND 21600) > 0 THEN 'error' ELSE 'pass' END FROM fct_stop_events WHERE service_date >= DATE '2024-01-01' GROUP BY city_key""")
def judged_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks with a severity and a condition: facts still growing, delays in range since a date."""
    e = load(spark, sf_dir, "fct_stop_events")
    growing = quality.growing(e, ["city_key"], "service_date", 1).select(F.lit("growing").alias("check_name"), F.col("city_key").alias("subject"), "seen", F.col("seen") < 1)
    since = e.where("service_date >= DATE '2024-01-01'").groupBy("city_key").agg(F.count_if(~F.col("delay_arr_sec").between(-1800, 21600)).alias("seen")).select(F.lit("range").alias("check_name"), F.col("city_key").alias("subject"), "seen", F.col("seen") > 0)
    return quality.judged(growing.toDF("check_name", "subject", "seen", "failed"), "warn").unionByName(quality.judged(since.toDF("check_name", "subject", "seen", "failed"), "error")).select("check_name", "severity", "subject", "seen", "outcome")

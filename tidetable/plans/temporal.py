"""Queries of the composite temporal operators, contracts and table maintenance."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidetable.functions import domain
from tidetable.operators import intervals, joins, quality, rollup, service, timestamps
from tidetable.plans.base import query
from tidetable.plans.relational import epoch
from tidetable.session import broadcast_if_small, load
from tidetable.sources import sinks
from tidetable.streaming import silver

_BEATS = "b AS (SELECT DISTINCT city, epoch_us(date_trunc('minute', fetched_at)) // 1000000 AS s FROM stop_time_predictions WHERE fetched_at IS NOT NULL)"
_GAPS = f"{_BEATS}, g AS (SELECT city, s + 60 AS a, lead(s) OVER (PARTITION BY city ORDER BY s) AS z, lead(s) OVER (PARTITION BY city ORDER BY s) - s AS gap FROM b), gaps AS (SELECT city, a, z, gap FROM g WHERE gap > 600)"


def _feed_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.gaps(intervals.heartbeat(load(spark, sf_dir, "stop_time_predictions"), ["city"], "fetched_at"), ["city"])


@query(f"WITH {_BEATS} SELECT city, CAST(s AS BIGINT) AS beat FROM b")
def feed_heartbeat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.heartbeat(load(spark, sf_dir, "stop_time_predictions"), ["city"], "fetched_at").select("city", epoch("beat").alias("beat"))


@query(f"WITH {_GAPS} SELECT city, CAST(a AS BIGINT) AS gap_start, CAST(z AS BIGINT) AS gap_end, CAST(gap AS BIGINT) AS gap_seconds FROM gaps")
def feed_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _feed_gaps(spark, sf_dir).select("city", epoch("gap_start").alias("gap_start"), epoch("gap_end").alias("gap_end"), "gap_seconds")


@query(f"""WITH {_GAPS}, p AS (SELECT row_no, city, epoch_us(arr_pred_ts_utc) / 1000000 AS t FROM stop_time_predictions WHERE arr_pred_ts_utc IS NOT NULL)
SELECT city, count(*) AS inside FROM p WHERE EXISTS (SELECT 1 FROM gaps WHERE gaps.city = p.city AND p.t > a AND p.t < z) GROUP BY 1""")
def predictions_in_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "stop_time_predictions").where("arr_pred_ts_utc IS NOT NULL").select("city", F.col("arr_pred_ts_utc").cast("timestamp").alias("t"))
    return joins.inside_interval(p, _feed_gaps(spark, sf_dir), ["city"], "t", "gap_start", "gap_end").where("inside").groupBy("city").agg(F.count(F.lit(1)).alias("inside"))


@query("""WITH s AS (SELECT trip_uid, city_key, min(actual_arr_ts_utc) AS a, max(actual_arr_ts_utc) AS z FROM fct_stop_events WHERE trip_uid IS NOT NULL AND actual_arr_ts_utc IS NOT NULL GROUP BY 1, 2),
m AS (SELECT *, max(z) OVER (PARTITION BY city_key ORDER BY a, z ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM s),
i AS (SELECT *, sum(CASE WHEN reach IS NULL OR reach < a THEN 1 ELSE 0 END) OVER (PARTITION BY city_key ORDER BY a, z ROWS UNBOUNDED PRECEDING) AS k FROM m)
SELECT city_key, CAST(epoch_us(min(a)) // 1000000 AS BIGINT) AS a, CAST(epoch_us(max(z)) // 1000000 AS BIGINT) AS z, count(*) AS parts FROM i GROUP BY city_key, k""")
def service_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times with at least one running trip, trips' spans united."""
    spans = load(spark, sf_dir, "fct_stop_events").where("trip_uid IS NOT NULL AND actual_arr_ts_utc IS NOT NULL").groupBy("trip_uid", "city_key").agg(F.min("actual_arr_ts_utc").alias("a"), F.max("actual_arr_ts_utc").alias("z"))
    return intervals.merge_islands(spans, ["city_key"], "a", "z").select("city_key", epoch("a").alias("a"), epoch("z").alias("z"), "parts")


@query("""WITH s AS (SELECT trip_uid, city_key, min(actual_arr_ts_utc) AS a, max(actual_arr_ts_utc) AS z FROM fct_stop_events WHERE trip_uid IS NOT NULL AND actual_arr_ts_utc IS NOT NULL GROUP BY 1, 2),
d AS (SELECT city_key, a, z, CAST(unnest(generate_series(CAST(CAST(a AS DATE) AS TIMESTAMP), CAST(CAST(z AS DATE) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day FROM s)
SELECT city_key, day, CAST(sum((epoch_us(least(z, CAST(day + 1 AS TIMESTAMP))) - epoch_us(greatest(a, CAST(day AS TIMESTAMP)))) // 1000000) AS BIGINT) AS seconds, count(*) AS parts FROM d GROUP BY 1, 2""")
def spans_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = load(spark, sf_dir, "fct_stop_events").where("trip_uid IS NOT NULL AND actual_arr_ts_utc IS NOT NULL").groupBy("trip_uid", "city_key").agg(F.min("actual_arr_ts_utc").alias("a"), F.max("actual_arr_ts_utc").alias("z"))
    d = intervals.by_day(spans, "a", "z")
    return d.groupBy("city_key", "day").agg(F.sum(F.floor((F.unix_micros("z") - F.unix_micros("a")) / 1_000_000)).cast("bigint").alias("seconds"), F.count(F.lit(1)).alias("parts"))


@query("""WITH e AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS was FROM events), s AS (SELECT *, sum(CASE WHEN epoch_us(ts) - epoch_us(was) <= 1800000000 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM e)
SELECT user_id, CAST(epoch_us(min(ts)) // 1000000 AS BIGINT) AS session_start, CAST(epoch_us(max(ts)) // 1000000 AS BIGINT) AS session_end, count(*) AS events FROM s GROUP BY user_id, k""")
def user_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = intervals.sessions(load(spark, sf_dir, "events"), ["user_id"], "ts", 1800)
    return s.select("user_id", epoch("session_start").alias("session_start"), epoch("session_end").alias("session_end"), "events")


@query("SELECT CAST(epoch_us(time_bucket(INTERVAL 6 HOUR, ts)) // 1000000 AS BIGINT) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def tumbling_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    return silver.windowed_counts(e, "ts", ["event_type"], "6 hours").select(epoch("window_start").alias("window_start"), "event_type", "n")


@query("""SELECT s AS window_start, count(*) AS n FROM (SELECT CAST(epoch_us(ts) // 3600000000 * 3600 - 3600 * k AS BIGINT) AS s FROM events, range(3) r(k)) GROUP BY 1""")
def sliding_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"))
    return silver.windowed_counts(e, "ts", [], "3 hours", "1 hour").select(epoch("window_start").alias("window_start"), "n")


@query("""WITH p AS (SELECT *, epoch_us(fetched_at) AS f, epoch_us(arr_pred_ts_utc) AS a FROM stop_time_predictions), h AS (SELECT max(f) AS newest FROM p),
k AS (SELECT city, service_date, trip_uid, stop_sequence, arr_pred_ts_utc, fetched_at, a, f, row_no, count(*) OVER v AS n, row_number() OVER (PARTITION BY city, service_date, trip_uid, stop_sequence ORDER BY f DESC, a DESC, row_no DESC) AS rn FROM p
WHERE city IS NOT NULL AND service_date IS NOT NULL AND trip_uid IS NOT NULL AND stop_sequence IS NOT NULL AND a IS NOT NULL AND f IS NOT NULL AND f <= a + 1800000000 WINDOW v AS (PARTITION BY city, service_date, trip_uid, stop_sequence))
SELECT city, service_date, trip_uid, stop_sequence, a // 1000000 AS arrival, row_no, n AS n_predictions, f // 1000000 AS last_seen FROM k, h WHERE rn = 1 AND a <= newest - 1200000000""")
def finalized_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last valid prediction of each stop visit, as its arrival."""
    p = load(spark, sf_dir, "stop_time_predictions").select("city", "service_date", "trip_uid", "stop_sequence", "arr_pred_ts_utc", "fetched_at", "row_no")
    v = service.finalize(p, ["city", "service_date", "trip_uid", "stop_sequence"], "arr_pred_ts_utc", "fetched_at")
    micros = lambda c: F.floor(F.unix_micros(F.col(c).cast("timestamp")) / 1_000_000)
    return v.select("city", "service_date", "trip_uid", "stop_sequence", micros("arr_pred_ts_utc").alias("arrival"), "row_no", "n_predictions", micros("last_seen").alias("last_seen"))


_KEYS = "city_key, service_date, route_id, direction_id, stop_id"
_HEADWAYS = f"""e AS (SELECT *, epoch_us(actual_arr_ts_utc) // 1000000 AS a, epoch_us(sched_arr_ts_utc) // 1000000 AS s FROM fct_stop_events WHERE city_key IS NOT NULL AND service_date IS NOT NULL AND route_id IS NOT NULL AND direction_id IS NOT NULL AND stop_id IS NOT NULL),
own AS (SELECT {_KEYS}, event_no, a, a - lag(a) OVER (PARTITION BY {_KEYS} ORDER BY a, event_no) AS gap_sec FROM e WHERE a IS NOT NULL),
plan AS (SELECT {_KEYS}, s, s - lag(s) OVER (PARTITION BY {_KEYS} ORDER BY s) AS sched_gap_sec FROM (SELECT DISTINCT {_KEYS}, s FROM e WHERE s IS NOT NULL)),
h AS (SELECT own.*, plan.sched_gap_sec FROM own ASOF LEFT JOIN plan ON own.city_key = plan.city_key AND own.service_date = plan.service_date AND own.route_id = plan.route_id AND own.direction_id = plan.direction_id AND own.stop_id = plan.stop_id AND own.a >= plan.s WHERE own.gap_sec IS NOT NULL)"""


def _headways(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "fct_stop_events").select("city_key", "service_date", "route_id", "direction_id", "stop_id", "event_no", "actual_arr_ts_utc", "sched_arr_ts_utc")
    return service.headways(e, ["city_key", "service_date", "route_id", "direction_id", "stop_id"], "actual_arr_ts_utc", "sched_arr_ts_utc", "event_no")


@query(f"WITH {_HEADWAYS} SELECT event_no, gap_sec, sched_gap_sec, coalesce(gap_sec / nullif(CAST(sched_gap_sec AS DOUBLE), 0) < 0.5, false) AS bunched, coalesce(gap_sec / nullif(CAST(sched_gap_sec AS DOUBLE), 0) > 2.0, false) AS big_gap FROM h")
def headways(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _headways(spark, sf_dir).select("event_no", "gap_sec", "sched_gap_sec", F.coalesce("bunched", F.lit(False)).alias("bunched"), F.coalesce("big_gap", F.lit(False)).alias("big_gap"))


@query(f"""WITH {_HEADWAYS}, sl AS (SELECT city_key, stop_id, sum(CAST(gap_sec AS DOUBLE) * gap_sec) / nullif(2 * sum(CAST(gap_sec AS DOUBLE)), 0) - sum(CAST(sched_gap_sec AS DOUBLE) * sched_gap_sec) / nullif(2 * sum(CAST(sched_gap_sec AS DOUBLE)), 0) AS e, count(*) AS n
FROM h WHERE sched_gap_sec IS NOT NULL GROUP BY 1, 2) SELECT city_key, round(sum(e * n) / nullif(sum(CASE WHEN e IS NOT NULL THEN n END), 0), 4) AS ewt_sec, CAST(sum(n) AS BIGINT) AS gaps FROM sl GROUP BY 1""")
def excess_wait_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = rollup.excess_wait(_headways(spark, sf_dir), ["city_key"], ["stop_id"], "gap_sec", "sched_gap_sec")
    return x.select("city_key", F.round("ewt_sec", 4).alias("ewt_sec"), "gaps")


_SAME = " AND ".join(f"own.{c} = plan.{c}" for c in _KEYS.split(", "))
_SEEN = f"""{_GAPS}, ev AS (SELECT city_key, service_date, route_id, coalesce(direction_id, -1) AS direction_id, stop_id, event_no, actual_arr_ts_utc, sched_arr_ts_utc, epoch_us(actual_arr_ts_utc) AS t, epoch_us(sched_arr_ts_utc) AS s
FROM fct_stop_events WHERE city_key IS NOT NULL AND service_date IS NOT NULL AND route_id IS NOT NULL AND stop_id IS NOT NULL),
own AS (SELECT {_KEYS}, event_no, actual_arr_ts_utc, t, lag(t) OVER (PARTITION BY {_KEYS} ORDER BY t, event_no) AS p FROM ev WHERE t IS NOT NULL),
plan AS (SELECT {_KEYS}, s, s // 1000000 - lag(s) OVER (PARTITION BY {_KEYS} ORDER BY s) // 1000000 AS sched_gap_sec FROM (SELECT DISTINCT {_KEYS}, s FROM ev WHERE s IS NOT NULL)),
paired AS (SELECT own.*, t // 1000000 - p // 1000000 AS gap_sec, plan.sched_gap_sec FROM own ASOF LEFT JOIN plan ON {_SAME} AND own.t >= plan.s WHERE own.p IS NOT NULL),
seen AS (SELECT paired.* EXCLUDE (sched_gap_sec), CASE WHEN coalesce(schedule_matchable, true) THEN sched_gap_sec END AS sched_gap_sec, coalesce(gap_regularity_measurable, true) AS measurable, iana_tz FROM paired LEFT JOIN dim_city USING (city_key)
WHERE NOT EXISTS (SELECT 1 FROM gaps WHERE gaps.city = paired.city_key AND paired.p < gaps.z * 1000000 AND paired.t > gaps.a * 1000000))"""


def _folded_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "fct_stop_events").select("city_key", "service_date", "route_id", "direction_id", "stop_id", "event_no", "actual_arr_ts_utc", "sched_arr_ts_utc")
    return e.withColumn("direction_id", domain.folded_direction(F.col("direction_id")))


def _seen_headways(spark: SparkSession, sf_dir: str) -> DataFrame:
    dark = _feed_gaps(spark, sf_dir).withColumnRenamed("city", "city_key")
    h = service.headways(_folded_events(spark, sf_dir), _KEYS.split(", "), "actual_arr_ts_utc", "sched_arr_ts_utc", "event_no", dark, ["city_key"])
    city = load(spark, sf_dir, "dim_city").select("city_key", "iana_tz", F.coalesce("schedule_matchable", F.lit(True)).alias("matchable"), F.coalesce("gap_regularity_measurable", F.lit(True)).alias("measurable"))
    h = h.join(broadcast_if_small(city), "city_key", "left").withColumn("measurable", F.coalesce("measurable", F.lit(True)))
    return h.withColumn("sched_gap_sec", F.when(F.coalesce("matchable", F.lit(True)), F.col("sched_gap_sec")))


HEADWAY_SQL = f"""WITH {_SEEN} SELECT event_no, gap_sec, sched_gap_sec, CASE WHEN measurable THEN gap_sec / nullif(CAST(sched_gap_sec AS DOUBLE), 0) < 0.5 END AS bunched, CASE WHEN measurable THEN gap_sec / nullif(CAST(sched_gap_sec AS DOUBLE), 0) > 2.0 END AS big_gap FROM seen"""


@query(HEADWAY_SQL)
def headways_outside_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headways that no feed gap of the city overlaps, unknown directions as one; no flags where a city's gaps measure nothing."""
    h = _seen_headways(spark, sf_dir)
    flag = lambda c: F.when(F.col("measurable") & F.col("sched_gap_sec").isNotNull(), F.col(c)).alias(c)
    return h.select("event_no", "gap_sec", "sched_gap_sec", flag("bunched"), flag("big_gap"))


_DAYPART = "CASE WHEN {0} BETWEEN 5 AND 9 THEN 'am_peak' WHEN {0} BETWEEN 10 AND 15 THEN 'midday' WHEN {0} BETWEEN 16 AND 19 THEN 'pm_peak' WHEN {0} BETWEEN 20 AND 23 THEN 'evening' WHEN {0} IS NOT NULL THEN 'overnight' END"
_LOCAL_HOUR = "hour(timezone(iana_tz, timezone('UTC', {0})))"


ROUTE_DAY_WAIT_SQL = f"""WITH {_SEEN}, every AS (SELECT DISTINCT {_KEYS}, s, {_LOCAL_HOUR.format("sched_arr_ts_utc")} AS h FROM ev JOIN dim_city USING (city_key) WHERE s IS NOT NULL),
step AS (SELECT *, s // 1000000 - lag(s) OVER (PARTITION BY {_KEYS} ORDER BY s) // 1000000 AS step FROM every),
frequent AS (SELECT city_key, service_date, route_id, direction_id, {_DAYPART.format("h")} AS daypart FROM step WHERE step > 0 GROUP BY ALL HAVING quantile_cont(step, 0.5) <= 600),
parts AS (SELECT *, {_DAYPART.format("h")} AS daypart FROM (SELECT *, {_LOCAL_HOUR.format("actual_arr_ts_utc")} AS h FROM seen WHERE measurable AND gap_sec > 0)),
slices AS (SELECT city_key, service_date, route_id, direction_id, stop_id, daypart, sum(CAST(gap_sec AS DOUBLE) * gap_sec) / (2 * sum(CAST(gap_sec AS DOUBLE))) - sum(CAST(sched_gap_sec AS DOUBLE) * sched_gap_sec) / nullif(2 * sum(CAST(sched_gap_sec AS DOUBLE)), 0) AS e, count(*) AS n
FROM parts JOIN frequent USING (city_key, service_date, route_id, direction_id, daypart) GROUP BY ALL)
SELECT city_key, service_date, route_id, direction_id, round(sum(e * n) / sum(n), 4) AS ewt_sec, CAST(sum(n) AS BIGINT) AS gaps FROM slices WHERE e IS NOT NULL GROUP BY ALL"""


@query(ROUTE_DAY_WAIT_SQL)
def route_day_excess_wait(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Excess wait of each route-day and direction over its frequent slices of stop and part of the local day."""
    zone = broadcast_if_small(load(spark, sf_dir, "dim_city").select("city_key", "iana_tz"))
    part = lambda c: domain.daypart(F.hour(domain.local_time(F.col(c).cast("timestamp"), F.col("iana_tz")))).alias("daypart")
    keys = ["city_key", "service_date", "route_id", "direction_id"]
    frequency = service.service_frequency(_folded_events(spark, sf_dir).join(zone, "city_key"), [*keys, "stop_id"], "sched_arr_ts_utc", [part("sched_arr_ts_utc")], pooled=["stop_id"])
    h = _seen_headways(spark, sf_dir).where("measurable AND gap_sec > 0").select(*keys, "stop_id", part("actual_arr_ts_utc"), "gap_sec", "sched_gap_sec")
    frequent = h.join(frequency.where("is_frequent").select(*keys, "daypart"), [*keys, "daypart"])
    x = rollup.excess_wait(frequent, keys, ["stop_id", "daypart"], "gap_sec", "sched_gap_sec", paired=False)
    return x.where("ewt_sec IS NOT NULL").select(*keys, F.round("ewt_sec", 4).alias("ewt_sec"), "gaps")


@query(f"""WITH e AS (SELECT DISTINCT {_KEYS}, epoch_us(sched_arr_ts_utc) // 1000000 AS s, hour(sched_arr_ts_utc) AS h FROM fct_stop_events WHERE city_key IS NOT NULL AND service_date IS NOT NULL AND route_id IS NOT NULL AND direction_id IS NOT NULL AND stop_id IS NOT NULL AND sched_arr_ts_utc IS NOT NULL),
g AS (SELECT *, s - lag(s) OVER (PARTITION BY {_KEYS} ORDER BY s) AS gap FROM e) SELECT {_KEYS}, CAST(h AS INT) AS hour, quantile_cont(gap, 0.5) AS median_gap_sec, count(*) AS gaps, quantile_cont(gap, 0.5) <= 600 AS is_frequent FROM g WHERE gap > 0 GROUP BY {_KEYS}, h""")
def service_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "fct_stop_events").withColumn("sched", F.date_trunc("second", F.col("sched_arr_ts_utc").cast("timestamp")))
    return service.service_frequency(e, ["city_key", "service_date", "route_id", "direction_id", "stop_id"], "sched", [F.hour("sched").alias("hour")])


@query("""SELECT city, CAST(epoch_us(date_trunc('hour', fetched_at)) // 1000000 AS BIGINT) AS hour, count(DISTINCT coalesce(vehicle_id, trip_uid)) AS vehicles, count(*) AS records, coalesce(bool_and(vehicle_id IS NOT NULL), false) AS reliable FROM stop_time_predictions WHERE fetched_at IS NOT NULL GROUP BY 1, 2""")
def vehicle_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = service.vehicle_activity(load(spark, sf_dir, "stop_time_predictions"), ["city"], "fetched_at", "vehicle_id", "trip_uid")
    return v.select("city", epoch("hour").alias("hour"), "vehicles", "records", "reliable")


@query("""WITH s AS (SELECT trip_uid, city_key, date_trunc('minute', min(actual_arr_ts_utc)) AS a, date_trunc('minute', max(actual_arr_ts_utc)) AS z FROM fct_stop_events WHERE trip_uid IS NOT NULL AND actual_arr_ts_utc IS NOT NULL GROUP BY 1, 2),
m AS (SELECT city_key, unnest(generate_series(a, z, INTERVAL 1 MINUTE)) AS minute FROM s) SELECT city_key, CAST(max(n) AS BIGINT) AS peak FROM (SELECT city_key, minute, count(*) AS n FROM m GROUP BY 1, 2) GROUP BY 1""")
def in_motion_peak(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most trips in motion in one minute, per city."""
    spans = load(spark, sf_dir, "fct_stop_events").where("trip_uid IS NOT NULL AND actual_arr_ts_utc IS NOT NULL").groupBy("trip_uid", "city_key").agg(F.min("actual_arr_ts_utc").alias("a"), F.max("actual_arr_ts_utc").alias("z"))
    return service.minute_census(spans, ["city_key"], "a", "z").groupBy("city_key").agg(F.max("live").alias("peak"))


@query("""WITH n AS (SELECT max(fetched_at) AS t FROM stop_time_predictions) SELECT city, vehicle_id, row_no FROM (SELECT city, vehicle_id, row_no, row_number() OVER (PARTITION BY city, vehicle_id ORDER BY fetched_at DESC, row_no DESC) AS rn FROM stop_time_predictions, n
WHERE vehicle_id IS NOT NULL AND fetched_at > t - INTERVAL 7 DAY) WHERE rn = 1""")
def latest_fix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vehicle's last row in the week up to the newest fetch."""
    p = load(spark, sf_dir, "stop_time_predictions").where("vehicle_id IS NOT NULL").select("city", "vehicle_id", "fetched_at", "row_no")
    newest = load(spark, sf_dir, "stop_time_predictions").agg(F.max(F.col("fetched_at").cast("timestamp")).alias("now"))
    return service.latest_fix(p, ["city", "vehicle_id"], "fetched_at", newest.scalar(), 7 * 86_400).select("city", "vehicle_id", "row_no")


@query("""WITH m AS (SELECT timetable_id, unnest(odpt_train_timetable_object) AS x, generate_subscripts(odpt_train_timetable_object, 1) AS i FROM tokyo_odpt_train_timetable), p AS (SELECT timetable_id, i, regexp_replace(translate(x.departure_time, '０１２３４５６７８９：時分', '0123456789::'), ':$', '') AS t FROM m WHERE x.departure_time IS NOT NULL),
s AS (SELECT timetable_id, i, CASE WHEN t LIKE '%:%' THEN CAST(split_part(t, ':', 1) AS INT) * 3600 + CAST(split_part(t, ':', 2) AS INT) * 60 + coalesce(TRY_CAST(split_part(t, ':', 3) AS INT), 0) ELSE CAST(t[:-3] AS INT) * 3600 + CAST(t[-2:] AS INT) * 60 END AS c FROM p),
b AS (SELECT *, CASE WHEN c < lag(c) OVER (PARTITION BY timetable_id ORDER BY i) THEN 1 ELSE 0 END AS back FROM s)
SELECT timetable_id, CAST(i AS INT) AS item, CAST(c + 86400 * sum(back) OVER (PARTITION BY timetable_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS BIGINT) AS seconds FROM b""")
def midnight_unwrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Departure clocks of each timetable, running on past midnight."""
    t = load(spark, sf_dir, "tokyo_odpt_train_timetable").select("timetable_id", F.explode(timestamps.running_clock(F.col("odpt_train_timetable_object.departure_time"))).alias("x"))
    return t.select("timetable_id", "x.item", "x.seconds")


@query("""SELECT event_no, CAST(epoch_us(CAST(timezone(iana_tz, CAST(service_date AS TIMESTAMP) + INTERVAL 12 HOUR) AS TIMESTAMPTZ)) // 1000000 - 43200 + 91800 AS BIGINT) AS instant FROM fct_stop_events JOIN dim_city USING (city_key)""")
def scheduled_instants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The UTC instant of 25:30:00 on every event's service day, in the city's zone."""
    e = load(spark, sf_dir, "fct_stop_events").join(broadcast_if_small(load(spark, sf_dir, "dim_city")), "city_key")
    return e.select("event_no", F.unix_seconds(domain.scheduled_instant(F.col("service_date"), domain.gtfs_seconds(F.lit("25:30:00")), F.col("iana_tz"))).alias("instant"))


@query("""WITH l AS (SELECT city_key, hour(timezone(iana_tz, timezone('UTC', actual_arr_ts_utc))) AS h, delay_arr_sec FROM fct_stop_events JOIN dim_city USING (city_key) WHERE actual_arr_ts_utc IS NOT NULL)
SELECT city_key, CASE WHEN h BETWEEN 5 AND 9 THEN 'am_peak' WHEN h BETWEEN 10 AND 15 THEN 'midday' WHEN h BETWEEN 16 AND 19 THEN 'pm_peak' WHEN h BETWEEN 20 AND 23 THEN 'evening' ELSE 'overnight' END AS daypart, count(*) AS visits, avg(delay_arr_sec) AS mean_delay FROM l GROUP BY 1, 2""")
def delay_by_daypart(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "fct_stop_events").where("actual_arr_ts_utc IS NOT NULL").join(broadcast_if_small(load(spark, sf_dir, "dim_city").select("city_key", "iana_tz")), "city_key")
    part = domain.daypart(F.hour(domain.local_time(F.col("actual_arr_ts_utc").cast("timestamp"), F.col("iana_tz"))))
    return e.groupBy("city_key", part.alias("daypart")).agg(F.count(F.lit(1)).alias("visits"), F.avg("delay_arr_sec").alias("mean_delay"))


@query("""SELECT event_no, CASE WHEN abs(delay_arr_sec) <= 43200 THEN delay_arr_sec WHEN abs(c) <= 43200 THEN c END AS delay FROM (SELECT event_no, CAST(delay_arr_sec AS BIGINT) AS delay_arr_sec, CAST(epoch_us(actual_arr_ts_utc) // 1000000 - epoch_us(sched_arr_ts_utc) // 1000000 AS BIGINT) AS c FROM fct_stop_events)""")
def effective_delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stated delay where plausible, else actual less scheduled."""
    e = load(spark, sf_dir, "fct_stop_events")
    return e.select("event_no", domain.effective_delay(F.col("delay_arr_sec"), F.col("actual_arr_ts_utc").cast("timestamp"), F.col("sched_arr_ts_utc").cast("timestamp")).alias("delay"))


@query("""WITH d AS (SELECT city_key, 100 * sum(otp_pct * banded_events) / nullif(sum(CASE WHEN otp_pct IS NOT NULL THEN banded_events END), 0) AS otp, 100 - avg(median_delay_sec) / 6 AS punctual, CASE WHEN count(p90_delay_sec) >= 10 THEN 100 - avg(p90_delay_sec) / 12 END AS tail, count(*) AS days FROM fct_route_reliability_daily GROUP BY 1)
SELECT city_key, days, round((coalesce(greatest(0, least(100, otp)) * 0.5, 0) + coalesce(greatest(0, least(100, punctual)) * 0.3, 0) + CASE WHEN tail IS NOT NULL THEN greatest(0, least(100, tail)) * 0.2 ELSE 0 END)
/ nullif(CASE WHEN otp IS NOT NULL THEN 0.5 ELSE 0 END + CASE WHEN punctual IS NOT NULL THEN 0.3 ELSE 0 END + CASE WHEN tail IS NOT NULL THEN 0.2 ELSE 0 END, 0), 4) AS score FROM d""")
def composite_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score of three clamped parts whose weights are renormalised over the parts with evidence."""
    d = load(spark, sf_dir, "fct_route_reliability_daily").groupBy("city_key").agg(
        (100 * rollup.weighted_mean(F.col("otp_pct"), F.col("banded_events"))).alias("otp"), (100 - F.avg("median_delay_sec") / 6).alias("punctual"), F.when(F.count("p90_delay_sec") >= 10, 100 - F.avg("p90_delay_sec") / 12).alias("tail"), F.count(F.lit(1)).alias("days"))
    return d.select("city_key", "days", F.round(rollup.composite([(F.col("otp"), 0.5), (F.col("punctual"), 0.3), (F.col("tail"), 0.2)]), 4).alias("score"))


@query("""SELECT route_key, CASE WHEN route_type = 0 THEN 'tram' WHEN route_type = 1 THEN 'metro' WHEN route_type = 2 THEN 'rail' WHEN route_type = 3 THEN 'bus' WHEN route_type = 4 THEN 'ferry' WHEN route_type BETWEEN 100 AND 199 THEN 'rail' WHEN route_type BETWEEN 200 AND 299 THEN 'bus'
WHEN route_type BETWEEN 400 AND 499 THEN 'metro' WHEN route_type BETWEEN 700 AND 799 THEN 'bus' WHEN route_type BETWEEN 900 AND 999 THEN 'tram' WHEN route_type BETWEEN 1000 AND 1299 THEN 'ferry' ELSE 'other' END AS mode, md5(concat_ws('|', city_key, route_id, strftime(valid_from, '%Y-%m-%d'))) = route_key AS key_ok FROM dim_route""")
def route_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = load(spark, sf_dir, "dim_route")
    return d.select("route_key", domain.gtfs_mode(F.col("route_type")).alias("mode"), (F.md5(F.concat_ws("|", "city_key", "route_id", F.date_format("valid_from", "yyyy-MM-dd"))) == F.col("route_key")).alias("key_ok"))


@query("""SELECT row_no, CASE WHEN nullif(trip_id, '') IS NOT NULL THEN sha256(city || '|' || CAST(service_date AS VARCHAR) || '|' || trip_id) WHEN nullif(route_id, '') IS NOT NULL THEN sha256(city || '|' || CAST(service_date AS VARCHAR) || '|' || route_id || '-' || coalesce(CAST(direction_id AS VARCHAR), '') || '-' || coalesce(start_time, '')) END AS uid FROM stop_time_predictions""")
def trip_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "stop_time_predictions")
    return p.select("row_no", domain.trip_uid(F.col("city"), F.col("service_date"), F.col("trip_id"), F.col("route_id"), F.col("direction_id"), F.col("start_time")).alias("uid"))


@query("SELECT CAST(count(*) AS BIGINT) AS n, count(uid) AS identified FROM (SELECT CASE WHEN trip_id IS NULL AND route_id IS NULL THEN NULL ELSE trip_uid END AS uid FROM stop_time_predictions)")
def identity_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "stop_time_predictions")
    return p.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(~(F.col("trip_id").isNull() & F.col("route_id").isNull()), F.col("trip_uid"))).alias("identified"))


# contracts: violations per check


@query("""SELECT 'delay_range' AS check_name, count(*) AS violations FROM fct_stop_events WHERE delay_arr_sec < -1800 OR delay_arr_sec > 21600
UNION ALL SELECT 'route_null', count(*) FROM fct_stop_events WHERE route_id IS NULL
UNION ALL SELECT 'event_unique', count(*) FROM (SELECT event_no FROM fct_stop_events GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'relationship_accepted', count(*) FROM stop_time_predictions WHERE schedule_relationship IS NOT NULL AND schedule_relationship NOT IN ('SCHEDULED', 'CANCELED', 'ADDED')
UNION ALL SELECT 'route_exists', count(*) FROM fct_stop_events e WHERE route_key IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim_route r WHERE r.route_key = e.route_key)
UNION ALL SELECT 'versions_disjoint', count(*) FROM (SELECT valid_from, max(coalesce(valid_to, DATE '9999-12-31')) OVER (PARTITION BY city_key, route_id ORDER BY valid_from, valid_to NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM dim_route) WHERE reach > valid_from
UNION ALL SELECT 'ghost_versions', count(*) FROM dim_route WHERE route_short_name IS NULL AND route_long_name IS NULL AND agency_id IS NULL
UNION ALL SELECT 'identity_shared', count(*) FROM (SELECT trip_uid FROM stop_time_predictions WHERE trip_uid IS NOT NULL GROUP BY 1 HAVING count(DISTINCT vehicle_id) > 1)
UNION ALL SELECT 'matched_without_route', count(*) FROM fct_stop_events WHERE static_trip_id IS NOT NULL AND route_id IS NULL
UNION ALL SELECT 'flags_disagree', count(*) FROM dim_route WHERE is_current IS DISTINCT FROM (valid_to IS NULL)""")
def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, d, p = (load(spark, sf_dir, t) for t in ("fct_stop_events", "dim_route", "stop_time_predictions"))
    x = F.col
    # row-wise checks of a table in one pass, beside the uniqueness of its key where there is one
    events = e.groupBy("event_no").agg(F.count(F.lit(1)).alias("n"), F.count_if((x("delay_arr_sec") < -1800) | (x("delay_arr_sec") > 21600)).alias("delay"), F.count_if(x("route_id").isNull()).alias("unrouted"),
                                       F.count_if(x("static_trip_id").isNotNull() & x("route_id").isNull()).alias("matched"))
    events = events.agg(F.sum("delay").alias("delay_range"), F.sum("unrouted").alias("route_null"), F.count_if(x("n") > 1).alias("event_unique"), F.sum("matched").alias("matched_without_route"))
    events = events.select(F.explode(F.array(*[F.struct(F.lit(n).alias("check_name"), F.coalesce(x(n), F.lit(0)).alias("violations")) for n in events.columns])).alias("x")).select("x.*")
    routes = quality.tally(d, {"ghost_versions": x("route_short_name").isNull() & x("route_long_name").isNull() & x("agency_id").isNull(), "flags_disagree": ~x("is_current").eqNullSafe(x("valid_to").isNull())})
    accepted = quality.tally(p, {"relationship_accepted": ~x("schedule_relationship").isin("SCHEDULED", "CANCELED", "ADDED")})
    others = {"route_exists": quality.orphans(e, ["route_key"], d, ["route_key"]), "versions_disjoint": quality.overlapping_versions(d, ["city_key", "route_id"], "valid_from", "valid_to"),
              "identity_shared": quality.shared_identity(p, "trip_uid", "vehicle_id")}
    out = events.unionByName(routes).unionByName(accepted)
    for name, bad in others.items():
        out = out.unionByName(bad.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check_name"), "violations"))
    return out


@query("""SELECT e.city_key, e.service_date, expected, coalesce(present, 0) AS present FROM (SELECT city_key, service_date, count(DISTINCT trip_uid) AS expected FROM fct_stop_events GROUP BY 1, 2) e
LEFT JOIN (SELECT city_key, service_date, count(DISTINCT trip_uid) AS present FROM fct_stop_events WHERE delay_arr_sec IS NOT NULL AND static_trip_id IS NOT NULL GROUP BY 1, 2) p ON e.city_key = p.city_key AND e.service_date = p.service_date WHERE expected >= 5 AND coalesce(present, 0) < expected * 0.9""")
def coverage_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "fct_stop_events")
    return quality.under_covered(e, e.where("delay_arr_sec IS NOT NULL AND static_trip_id IS NOT NULL"), ["city_key", "service_date"], "trip_uid", 0.9, 5)


@query(" UNION ALL ".join(f"SELECT city, '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) / CAST(count(*) AS DOUBLE) AS null_share, count(*) AS n FROM stop_time_predictions GROUP BY 1" for c in ("trip_id", "route_id", "direction_id", "start_time", "stop_id", "arr_delay_sec")))
def null_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_rates(load(spark, sf_dir, "stop_time_predictions"), ["trip_id", "route_id", "direction_id", "start_time", "stop_id", "arr_delay_sec"], ["city"])


@query("""WITH n AS (SELECT max(epoch_us(fetched_at) // 1000000) AS t FROM stop_time_predictions), a AS (SELECT city, endpoint, any_value(t) - max(epoch_us(fetched_at) // 1000000) AS age_sec FROM stop_time_predictions, n GROUP BY 1, 2)
SELECT city, endpoint, CAST(age_sec AS BIGINT) AS age_sec, CASE WHEN age_sec > 7200 THEN 'error' WHEN age_sec > 1800 THEN 'warn' ELSE 'ok' END AS status FROM a""")
def source_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Age of each endpoint's newest fetch against the newest of all, by a scalar subquery."""
    p = load(spark, sf_dir, "stop_time_predictions").select("city", "endpoint", "fetched_at")
    newest = p.agg(F.max(F.col("fetched_at").cast("timestamp")).alias("now")).scalar()
    return quality.freshness(p, ["city", "endpoint"], "fetched_at", newest, 1800, 7200)


# maintenance


@query("""SELECT city_key, count(*) AS n, CAST(sum(hash_no) AS BIGINT) AS checksum FROM (SELECT city_key, event_no AS hash_no FROM fct_stop_events WHERE event_no % 3 <> 0 UNION ALL SELECT city_key, event_no FROM fct_stop_events WHERE event_no % 3 = 0) GROUP BY 1""")
def backfill_appends_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that lost rows, completed by a replay of everything."""
    everything = load(spark, sf_dir, "fct_stop_events").select("city_key", "event_no")
    existing = everything.where("event_no % 3 <> 0")
    full = existing.unionByName(sinks.append_missing(existing, everything, ["city_key", "event_no"]))
    return full.groupBy("city_key").agg(F.count(F.lit(1)).alias("n"), F.sum("event_no").alias("checksum"))


@query("""SELECT city_key, service_date, count(*) AS n, CAST(sum(v) AS BIGINT) AS newer FROM (SELECT city_key, service_date, 0 AS v FROM fct_stop_events WHERE service_date < DATE '2025-01-01' UNION ALL SELECT city_key, service_date, 1 FROM fct_stop_events WHERE service_date >= DATE '2025-01-01') GROUP BY 1, 2""")
def delete_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days rebuilt: old rows of the rebuilt keys go, the new ones come."""
    old = load(spark, sf_dir, "fct_stop_events").select("city_key", "service_date", "event_no").withColumn("v", F.lit(0))
    new = old.where("service_date >= DATE '2025-01-01'").withColumn("v", F.lit(1))
    return sinks.delete_insert(old, new, ["city_key", "service_date"]).groupBy("city_key", "service_date").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("newer"))


@query("""SELECT stop_id, city, row_no FROM (SELECT stop_id, city, row_no, row_number() OVER (PARTITION BY city, stop_id ORDER BY fetched_at DESC NULLS LAST, row_no DESC) AS rn FROM stop_time_predictions WHERE stop_id IS NOT NULL) WHERE rn = 1""")
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two halves merged on a key, the newest row of each staying."""
    p = load(spark, sf_dir, "stop_time_predictions").where("stop_id IS NOT NULL").select("city", "stop_id", "row_no", F.struct(F.col("fetched_at"), "row_no").alias("age"))
    return sinks.upsert(p.where("row_no % 2 = 0"), p.where("row_no % 2 = 1"), ["city", "stop_id"], "age").select("stop_id", "city", "row_no")


@query("""SELECT city_key, max(has_new) AS has_new, count(*) AS n FROM (SELECT city_key, 0 AS has_new FROM dim_city WHERE retired_from IS NOT NULL UNION ALL SELECT city_key, 1 FROM dim_city WHERE retired_from IS NULL) GROUP BY 1""")
def schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with an added column appended to a table without it."""
    city = load(spark, sf_dir, "dim_city")
    existing = city.where("retired_from IS NOT NULL").select("city_key", "country")
    more, changed = sinks.evolved(city.where("retired_from IS NULL").select("country", "city_key", F.lit(1).alias("added")), existing)
    both = existing.unionByName(more, allowMissingColumns=True)
    return both.groupBy("city_key").agg(F.max(F.coalesce("added", F.lit(1 if changed else 0))).alias("has_new"), F.count(F.lit(1)).alias("n"))


@query("SELECT city, CAST(sum(len(payload)) AS BIGINT) AS records FROM envelope WHERE len(payload) > 0 GROUP BY 1")
def size_bounded_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes cut into messages of bounded size, parsed again and counted: no record is lost."""
    messages = sinks.size_bounded(load(spark, sf_dir, "envelope"), 4_000)
    from tidetable.sources.readers import parse_envelopes

    return parse_envelopes(messages, "vehicle_positions").groupBy("city").agg(F.sum(F.size("payload")).alias("records"))


@query("SELECT city, count(DISTINCT (vehicle_id, t, current_status, stop_id, trip_key)) AS positions FROM (SELECT city, x.vehicle_id AS vehicle_id, coalesce(x.timestamp, feed_ts) AS t, x.current_status AS current_status, x.stop_id AS stop_id, x.trip_id AS trip_key FROM (SELECT city, feed_ts, unnest(payload) AS x FROM envelope)) GROUP BY 1")
def distinct_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicle positions without re-polled copies."""
    x = load(spark, sf_dir, "envelope").select("city", "feed_ts", F.explode("payload").alias("x"))
    own = x.select("city", F.col("x.vehicle_id").alias("vehicle_id"), F.coalesce("x.timestamp", "feed_ts").alias("t"), F.col("x.current_status").alias("s"), F.col("x.stop_id").alias("stop_id"), F.col("x.trip_id").alias("trip"))
    return own.distinct().groupBy("city").agg(F.count(F.lit(1)).alias("positions"))




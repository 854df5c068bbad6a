"""Queries of scans, projections, joins, aggregations, windows and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidetable.functions import domain
from tidetable.operators import joins, rollup, service
from tidetable.plans.base import query
from tidetable.session import broadcast_if_small, load
from tidetable.sources import readers

EPOCH = "CAST(epoch_us({0}) // 1000000 AS BIGINT)"


def epoch(c: str) -> F.Column:
    return F.unix_seconds(F.col(c).cast("timestamp"))


# sources and spines


@query("""SELECT CAST(d AS DATE) AS date, CAST(year(d) AS INT) AS year, CAST(quarter(d) AS INT) AS quarter, CAST(month(d) AS INT) AS month, CAST(day(d) AS INT) AS day, CAST(isodow(d) AS INT) AS iso_dow,
isodow(d) >= 6 AS is_weekend FROM generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2027-12-31', INTERVAL 1 DAY) t(d)""")
def date_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.date_spine(spark, "2024-01-01", "2027-12-31")


@query("""SELECT CAST(h AS INT) AS hour, CASE WHEN h BETWEEN 5 AND 9 THEN 'am_peak' WHEN h BETWEEN 10 AND 15 THEN 'midday' WHEN h BETWEEN 16 AND 19 THEN 'pm_peak' WHEN h BETWEEN 20 AND 23 THEN 'evening' ELSE 'overnight' END AS daypart,
h BETWEEN 5 AND 9 OR h BETWEEN 16 AND 19 AS is_peak FROM range(24) t(h)""")
def hour_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.hour_spine(spark)


@query("""SELECT CAST(min(d) AS DATE) AS first_day, CAST(max(d) AS DATE) AS last_day FROM generate_series(TIMESTAMP '2022-11-05', TIMESTAMP '2025-02-03', INTERVAL 1 DAY) t(d) GROUP BY year(d)""")
def year_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.year_chunks(spark, "2022-11-05", "2025-02-03")


@query("SELECT event_type, CAST(sum(CAST(json_extract(props, '$.k') AS INT)) AS BIGINT) AS k_sum, count(*) AS n FROM events GROUP BY 1")
def json_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").groupBy("event_type").agg(F.sum(F.get_json_object("props", "$.k").cast("int")).alias("k_sum"), F.count(F.lit(1)).alias("n"))


@query("""SELECT city, endpoint, count(*) AS records, count(x.trip_id) AS with_trip, CAST(max(x.timestamp) AS BIGINT) AS newest FROM (SELECT city, endpoint, unnest(payload) AS x FROM envelope) GROUP BY 1, 2""")
def envelope_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes sent through their JSON message form and parsed again by the declared schema."""
    sent = load(spark, sf_dir, "envelope").select(F.to_json(F.struct("*")).alias("value"))
    x = readers.parse_envelopes(sent, "vehicle_positions").select("city", "endpoint", F.explode("payload").alias("x"))
    return x.groupBy("city", "endpoint").agg(F.count(F.lit(1)).alias("records"), F.count("x.trip_id").alias("with_trip"), F.max("x.timestamp").alias("newest"))


@query("""SELECT timetable_id, CAST(count(*) AS BIGINT) AS calls, count(x.departure_time) AS departures, list_extract(string_split(any_value(odpt_railway), '.'), -1) AS line
FROM (SELECT timetable_id, odpt_railway, unnest(odpt_train_timetable_object) AS x FROM tokyo_odpt_train_timetable) GROUP BY 1""")
def timetable_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = load(spark, sf_dir, "tokyo_odpt_train_timetable").select("timetable_id", "odpt_railway", F.explode("odpt_train_timetable_object").alias("x"))
    return t.groupBy("timetable_id", readers.urn_tail(F.col("odpt_railway")).alias("line")).agg(F.count(F.lit(1)).alias("calls"), F.count("x.departure_time").alias("departures"))


# projections and filters


@query("""SELECT r.* FROM (SELECT DISTINCT * FROM gtfs_static_routes) r JOIN (SELECT city, max(gtfs_version_id) AS v FROM gtfs_static_routes GROUP BY 1) m ON r.city = m.city AND r.gtfs_version_id = m.v""")
def latest_version_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    routes = load(spark, sf_dir, "gtfs_static_routes")
    newest = routes.groupBy("city").agg(F.max("gtfs_version_id").alias("gtfs_version_id"))
    return routes.join(broadcast_if_small(newest), ["city", "gtfs_version_id"]).select(*routes.columns).distinct()


@query("""SELECT city, coalesce(max(gtfs_version_id) FILTER (WHERE retired_from IS NULL OR split_part(gtfs_version_id, '-', 2) < strftime(retired_from, '%Y%m%d')), 'none') AS pinned, count(DISTINCT gtfs_version_id) AS versions
FROM gtfs_static_routes r JOIN dim_city c ON c.city_key = r.city GROUP BY 1""")
def capped_version_pin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest version of each city staged before the city was retired."""
    versions = load(spark, sf_dir, "gtfs_static_routes").select("city", "gtfs_version_id").distinct()
    city = load(spark, sf_dir, "dim_city").select(F.col("city_key").alias("city"), "retired_from")
    in_time = F.col("retired_from").isNull() | (F.split_part("gtfs_version_id", F.lit("-"), F.lit(2)) < F.date_format("retired_from", "yyyyMMdd"))
    return versions.join(broadcast_if_small(city), "city").groupBy("city").agg(F.coalesce(F.max(F.when(in_time, F.col("gtfs_version_id"))), F.lit("none")).alias("pinned"), F.count(F.lit(1)).alias("versions"))


@query("""SELECT city, route_id, count(*) AS n FROM stop_time_predictions p WHERE city NOT IN ('norvale', 'sternau') OR EXISTS (SELECT 1 FROM dim_route d WHERE d.is_current AND d.city_key = p.city AND d.route_id = p.route_id) GROUP BY 1, 2""")
def allow_listed_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    allowed = load(spark, sf_dir, "dim_route").where("is_current").select(F.col("city_key").alias("city"), "route_id")
    rows = load(spark, sf_dir, "stop_time_predictions").select("city", "route_id")
    return joins.allow_listed(rows, allowed, ["norvale", "sternau"], "city", "route_id").groupBy("city", "route_id").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT city, CASE WHEN schedule_relationship IN ('NEW', 'UNSCHEDULED') OR trip_id LIKE '-%' THEN 'ADDED' ELSE schedule_relationship END AS relationship, count(*) AS n,
count(CASE WHEN trip_id IS NULL AND route_id IS NULL THEN NULL ELSE trip_uid END) AS identified FROM stop_time_predictions GROUP BY 1, 2""")
def normalised_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spellings of added trips made one; a trip without id and route has no identity."""
    rows = load(spark, sf_dir, "stop_time_predictions")
    added = F.col("schedule_relationship").isin("NEW", "UNSCHEDULED") | F.col("trip_id").like("-%")
    uid = F.when(~(F.col("trip_id").isNull() & F.col("route_id").isNull()), F.col("trip_uid"))
    return rows.groupBy("city", F.when(F.coalesce(added, F.lit(False)), "ADDED").otherwise(F.col("schedule_relationship")).alias("relationship")).agg(F.count(F.lit(1)).alias("n"), F.count(uid).alias("identified"))


@query("SELECT city_key, count(*) AS kept FROM fct_stop_events WHERE NOT coalesce(delay_arr_sec > 3600, false) GROUP BY 1")
def null_safe_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A negated predicate that keeps rows of unknown outcome."""
    return load(spark, sf_dir, "fct_stop_events").where(~F.coalesce(F.col("delay_arr_sec") > 3600, F.lit(False))).groupBy("city_key").agg(F.count(F.lit(1)).alias("kept"))


@query("""SELECT city, count(*) AS n FROM (SELECT city, unnest(payload) AS x FROM envelope) WHERE x.lat BETWEEN 40 AND 60 AND x.lon BETWEEN 0 AND 80 GROUP BY 1""")
def bounding_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = load(spark, sf_dir, "envelope").select("city", F.explode(F.transform("payload", lambda r: F.struct(r["lat"].alias("lat"), r["lon"].alias("lon")))).alias("x"))
    return x.where(F.col("x.lat").between(40, 60) & F.col("x.lon").between(0, 80)).groupBy("city").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_quantity < 30 AND l_shipdate >= TIMESTAMP '1995-01-01' GROUP BY 1")
def bound_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql("SELECT l_returnflag, count(*) AS n FROM {l} WHERE l_quantity < :most AND l_shipdate >= CAST(:since AS TIMESTAMP_NTZ) GROUP BY 1", args={"most": 30, "since": "1995-01-01"}, l=load(spark, sf_dir, "lineitem"))


# joins


@query("""SELECT city_key, service_date, gtfs_version_id FROM (SELECT d.city_key, d.service_date, v.gtfs_version_id,
row_number() OVER (PARTITION BY d.city_key, d.service_date ORDER BY v.d <= d.service_date DESC, CASE WHEN v.d <= d.service_date THEN v.d END DESC, v.d, v.gtfs_version_id DESC) AS rn
FROM (SELECT DISTINCT city_key, service_date FROM fct_stop_events) d JOIN (SELECT DISTINCT city, gtfs_version_id, CAST(strptime(split_part(gtfs_version_id, '-', 2), '%Y%m%d') AS DATE) AS d FROM gtfs_static_routes) v ON v.city = d.city_key) WHERE rn = 1""")
def version_for_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = load(spark, sf_dir, "gtfs_static_routes").select(F.col("city").alias("city_key"), "gtfs_version_id", F.try_to_date(F.split_part("gtfs_version_id", F.lit("-"), F.lit(2)), "yyyyMMdd").alias("d"))
    return joins.version_for_date(load(spark, sf_dir, "fct_stop_events"), v, ["city_key"], "service_date", "gtfs_version_id", "d")


@query("""SELECT e.city_key, r.valid_from, count(*) AS visits FROM fct_stop_events e JOIN (SELECT *, min(valid_from) OVER (PARTITION BY city_key, route_id) AS first FROM dim_route) r ON e.city_key = r.city_key AND e.route_id = r.route_id
AND (e.service_date >= r.valid_from OR r.valid_from = r.first) AND (r.valid_to IS NULL OR e.service_date < r.valid_to) GROUP BY 1, 2""")
def version_join_with_first_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions valid on the day, the first one also before its start: the start is moved back, then matched as of."""
    from tidetable.operators.asof import attributes_as_known

    dim = load(spark, sf_dir, "dim_route").select("city_key", "route_id", "valid_from", "valid_to")
    first = F.min("valid_from").over(Window.partitionBy("city_key", "route_id"))
    dim = dim.withColumn("since", F.when(F.col("valid_from") == first, F.lit("0001-01-01").cast("date")).otherwise(F.col("valid_from")))
    events = load(spark, sf_dir, "fct_stop_events").select("event_no", "city_key", "route_id", "service_date")
    known = attributes_as_known(events, dim, ["city_key", "route_id"], "service_date", "since", "valid_to", ["valid_from"])
    return known.where("known_present").groupBy("city_key", F.col("known_valid_from").alias("valid_from")).agg(F.count(F.lit(1)).alias("visits"))


_TRIPS = """rt AS (SELECT DISTINCT trip_uid, city, route_id, CAST(split_part(start_time, ':', 1) AS INT) * 3600 + CAST(split_part(start_time, ':', 2) AS INT) * 60 + CAST(split_part(start_time, ':', 3) AS INT) AS s
FROM stop_time_predictions WHERE trip_uid IS NOT NULL AND route_id IS NOT NULL AND start_time IS NOT NULL),
st AS (SELECT DISTINCT city, route_id, trip_id, CAST(split_part(origin_time, ':', 1) AS INT) * 3600 + CAST(split_part(origin_time, ':', 2) AS INT) * 60 + CAST(split_part(origin_time, ':', 3) AS INT) AS o FROM gtfs_static_trips WHERE origin_time IS NOT NULL)"""


def _trips(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rt = load(spark, sf_dir, "stop_time_predictions").where("trip_uid IS NOT NULL AND route_id IS NOT NULL AND start_time IS NOT NULL").select("trip_uid", "city", "route_id", domain.gtfs_seconds(F.col("start_time")).alias("s")).distinct()
    st = load(spark, sf_dir, "gtfs_static_trips").where("origin_time IS NOT NULL").select("city", "route_id", "trip_id", domain.gtfs_seconds(F.col("origin_time")).alias("o")).distinct()
    return rt, st


@query(f"""WITH {_TRIPS} SELECT trip_uid, trip_id, CAST(d AS INT) AS distance FROM (SELECT trip_uid, trip_id, abs(s - o) AS d, row_number() OVER (PARTITION BY trip_uid ORDER BY abs(s - o), trip_id) AS rn
FROM rt JOIN st ON rt.city = st.city AND rt.route_id = st.route_id AND abs(s - o) <= 120) WHERE rn = 1""")
def nearest_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    rt, st = _trips(spark, sf_dir)
    return joins.nearest_within(rt, st, "trip_uid", "trip_id", ["city", "route_id"], "s", "o", 120)


@query(f"""WITH {_TRIPS}, exact AS (SELECT trip_uid, min(trip_id) AS trip_id FROM rt JOIN st ON rt.city = st.city AND rt.route_id = st.route_id AND s = o GROUP BY 1),
near AS (SELECT trip_uid, trip_id FROM (SELECT trip_uid, trip_id, row_number() OVER (PARTITION BY trip_uid ORDER BY abs(s - o), trip_id) AS rn FROM rt JOIN st ON rt.city = st.city AND rt.route_id = st.route_id AND abs(s - o) <= 120) WHERE rn = 1)
SELECT trip_uid, trip_id, 'exact' AS method FROM exact UNION ALL SELECT trip_uid, trip_id, 'near' FROM near WHERE trip_uid NOT IN (SELECT trip_uid FROM exact)""")
def matcher_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Composite-key matches outrank the nearest within two minutes."""
    rt, st = _trips(spark, sf_dir)
    exact = rt.withColumnRenamed("s", "o").join(st, ["city", "route_id", "o"]).groupBy("trip_uid").agg(F.min("trip_id").alias("trip_id")).withColumn("method", F.lit("exact"))
    near = joins.nearest_within(rt, st, "trip_uid", "trip_id", ["city", "route_id"], "s", "o", 120).select("trip_uid", "trip_id").withColumn("method", F.lit("near"))
    return joins.resolve_priority([exact, near], "trip_uid")


_ORIGINS = _TRIPS.replace("city, route_id,", "city, route_id, direction_id,")
_NEAR_ORIGIN = f"""{_ORIGINS}, near AS (SELECT trip_uid, trip_id, d FROM (SELECT trip_uid, trip_id, abs(s - o) AS d, row_number() OVER (PARTITION BY trip_uid ORDER BY abs(s - o), trip_id) AS rn
FROM rt JOIN st ON rt.city = st.city AND rt.route_id = st.route_id AND abs(s - o) <= 300 AND (rt.direction_id = st.direction_id OR rt.direction_id IS NULL OR st.direction_id IS NULL)) WHERE rn = 1)"""


def _origins(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rt = load(spark, sf_dir, "stop_time_predictions").where("trip_uid IS NOT NULL AND route_id IS NOT NULL AND start_time IS NOT NULL").select("trip_uid", "city", "route_id", "direction_id", domain.gtfs_seconds(F.col("start_time")).alias("s")).distinct()
    st = load(spark, sf_dir, "gtfs_static_trips").where("origin_time IS NOT NULL").select("city", "route_id", "direction_id", "trip_id", domain.gtfs_seconds(F.col("origin_time")).alias("o")).distinct()
    return rt, st


@query(f"WITH {_NEAR_ORIGIN} SELECT trip_uid, trip_id, CAST(d AS INT) AS distance FROM near")
def nearest_origin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest scheduled origin within five minutes, of the same direction where both state one."""
    rt, st = _origins(spark, sf_dir)
    return joins.nearest_within(rt, st, "trip_uid", "trip_id", ["city", "route_id"], "s", "o", 300, "direction_id")


@query(f"""WITH {_NEAR_ORIGIN}, exact AS (SELECT trip_uid, min(trip_id) AS trip_id FROM rt JOIN st ON rt.city = st.city AND rt.route_id = st.route_id AND rt.direction_id = st.direction_id AND s = o GROUP BY 1)
SELECT trip_uid, trip_id, 'exact' AS method FROM exact UNION ALL SELECT trip_uid, trip_id, 'near' FROM near WHERE trip_uid NOT IN (SELECT trip_uid FROM exact)""")
def matcher_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches of route, direction and origin second outrank the nearest within five minutes."""
    rt, st = _origins(spark, sf_dir)
    exact = rt.withColumnRenamed("s", "o").join(st, ["city", "route_id", "direction_id", "o"]).groupBy("trip_uid").agg(F.min("trip_id").alias("trip_id")).withColumn("method", F.lit("exact"))
    near = joins.nearest_within(rt, st, "trip_uid", "trip_id", ["city", "route_id"], "s", "o", 300, "direction_id").select("trip_uid", "trip_id").withColumn("method", F.lit("near"))
    return joins.resolve_priority([exact, near], "trip_uid")


@query("""SELECT e.city_key, count(*) AS unmatched FROM fct_stop_events e WHERE NOT EXISTS (SELECT 1 FROM dim_route r WHERE r.city_key = e.city_key AND r.route_id IS NOT DISTINCT FROM e.route_id AND r.route_key IS NOT DISTINCT FROM e.route_key) GROUP BY 1""")
def null_safe_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.null_safe_anti(load(spark, sf_dir, "fct_stop_events").select("city_key", "route_id", "route_key"), load(spark, sf_dir, "dim_route"), ["city_key", "route_id", "route_key"]).groupBy("city_key").agg(F.count(F.lit(1)).alias("unmatched"))


@query("""SELECT o_orderpriority, count(*) AS n FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R') GROUP BY 1""")
def left_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    returned = load(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return load(spark, sf_dir, "orders").join(returned, "o_orderkey", "left_semi").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT n_name, count(*) AS customers FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) GROUP BY 1""")
def left_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer").join(load(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti")
    return c.join(broadcast_if_small(load(spark, sf_dir, "nation")), F.col("n_nationkey") == F.col("c_nationkey")).groupBy("n_name").agg(F.count(F.lit(1)).alias("customers"))


@query("""SELECT v.city, v.gtfs_version_id, count(*) AS grid, count(r.route_id) AS present FROM (SELECT DISTINCT city, gtfs_version_id FROM gtfs_static_routes) v JOIN (SELECT DISTINCT city, route_id FROM gtfs_static_routes) i ON i.city = v.city
LEFT JOIN (SELECT DISTINCT city, gtfs_version_id, route_id FROM gtfs_static_routes) r ON r.city = v.city AND r.gtfs_version_id = v.gtfs_version_id AND r.route_id = i.route_id GROUP BY 1, 2""")
def version_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Presence of every route in every version of its city, counted from the two sides instead of spelling the grid out."""
    listed = load(spark, sf_dir, "gtfs_static_routes").select("city", "gtfs_version_id", "route_id").distinct()
    routes = listed.groupBy("city").agg(F.countDistinct("route_id").alias("grid"))
    return listed.groupBy("city", "gtfs_version_id").agg(F.count("route_id").alias("present")).join(broadcast_if_small(routes), "city").select("city", "gtfs_version_id", "grid", "present")


@query("""SELECT city_key, service_date, CAST(coalesce(e.n, 0) AS BIGINT) AS visits, CAST(coalesce(m.n, 0) AS BIGINT) AS matched, CAST(coalesce(d.n, 0) AS BIGINT) AS published FROM
(SELECT city_key, service_date, count(*) AS n FROM fct_stop_events GROUP BY 1, 2) e FULL JOIN (SELECT city_key, service_date, count(*) AS n FROM fct_stop_events WHERE static_trip_id IS NOT NULL GROUP BY 1, 2) m USING (city_key, service_date)
FULL JOIN (SELECT city_key, service_date, count(*) AS n FROM fct_route_reliability_daily GROUP BY 1, 2) d USING (city_key, service_date)""")
def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three counts per city and day by union and sum."""
    keys = ["city_key", "service_date"]
    e = load(spark, sf_dir, "fct_stop_events")
    n = F.count(F.lit(1)).alias("n")
    return rollup.summed_streams({"visits": e.groupBy(*keys).agg(n), "matched": e.where("static_trip_id IS NOT NULL").groupBy(*keys).agg(n), "published": load(spark, sf_dir, "fct_route_reliability_daily").groupBy(*keys).agg(n)}, keys)


@query("""SELECT month, r.city_key, count(*) AS route_days FROM (SELECT DISTINCT strftime(service_date, '%Y-%m') AS month FROM fct_stop_events) m JOIN fct_route_reliability_daily r ON strftime(r.service_date, '%Y-%m-%d') LIKE m.month || '%' GROUP BY 1, 2""")
def month_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A prefix condition as an equi-join on the truncated key."""
    months = load(spark, sf_dir, "fct_stop_events").select(F.date_format("service_date", "yyyy-MM").alias("month")).distinct()
    return load(spark, sf_dir, "fct_route_reliability_daily").withColumn("month", F.date_format("service_date", "yyyy-MM")).join(months, "month").groupBy("month", "city_key").agg(F.count(F.lit(1)).alias("route_days"))


@query("""SELECT n_name, CAST(sum(CAST(l_extendedprice * 100 AS BIGINT)) AS BIGINT) AS cents FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey AND c_nationkey = s_nationkey
JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA' GROUP BY 1""")
def star_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = {n: load(spark, sf_dir, n) for n in ("customer", "orders", "lineitem", "supplier", "nation", "region")}
    asia = t["nation"].join(broadcast_if_small(t["region"].where("r_name = 'ASIA'")), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name")
    s = t["supplier"].join(broadcast_if_small(asia), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "s_nationkey", "n_name")
    j = t["lineitem"].select("l_orderkey", "l_suppkey", "l_extendedprice").join(s, F.col("l_suppkey") == F.col("s_suppkey")).join(t["orders"].select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    j = j.join(t["customer"].select("c_custkey", "c_nationkey"), (F.col("o_custkey") == F.col("c_custkey")) & (F.col("c_nationkey") == F.col("s_nationkey")))
    return j.groupBy("n_name").agg(F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("cents"))


# aggregations


@query("""SELECT l_returnflag, l_linestatus, CAST(sum(l_quantity) AS BIGINT) AS sum_qty, CAST(sum(CAST(l_extendedprice * 100 AS BIGINT)) AS BIGINT) AS cents, count(*) AS n, count(DISTINCT l_suppkey) AS suppliers FROM lineitem
WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2""")
def pricing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem").where("l_shipdate <= TIMESTAMP_NTZ '1998-09-02'")
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").cast("bigint").alias("sum_qty"), F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("cents"), F.count(F.lit(1)).alias("n"), F.countDistinct("l_suppkey").alias("suppliers"))


@query("""SELECT city_key, service_date, coalesce(route_id, '__unrouted__') AS route_id, coalesce(direction_id, -1) AS direction_id, count(*) AS events, count(delay_arr_sec) AS banded,
count(*) FILTER (WHERE delay_arr_sec < -60) AS early, count(*) FILTER (WHERE delay_arr_sec BETWEEN -60 AND 299) AS on_time, count(*) FILTER (WHERE delay_arr_sec BETWEEN 300 AND 899) AS late, count(*) FILTER (WHERE delay_arr_sec >= 900) AS very_late,
count(*) FILTER (WHERE delay_arr_sec BETWEEN -60 AND 299) / nullif(CAST(count(delay_arr_sec) AS DOUBLE), 0) AS otp_pct, round(quantile_cont(delay_arr_sec, 0.5), 4) AS median_delay_sec, round(quantile_cont(delay_arr_sec, 0.9), 4) AS p90_delay_sec
FROM fct_stop_events GROUP BY 1, 2, 3, 4""")
def route_reliability_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Route-day roll-up by on-time bands; ratios divide by evidence."""
    e = load(spark, sf_dir, "fct_stop_events")
    band = domain.otp_band(F.col("delay_arr_sec"))
    count = lambda b: F.count_if(F.coalesce(F.col("band") == b, F.lit(False)))
    g = e.select("city_key", "service_date", domain.folded_route(F.col("route_id")).alias("route_id"), domain.folded_direction(F.col("direction_id")).alias("direction_id"), "delay_arr_sec", band.alias("band"))
    return g.groupBy("city_key", "service_date", "route_id", "direction_id").agg(
        F.count(F.lit(1)).alias("events"), F.count("delay_arr_sec").alias("banded"), count("early").alias("early"), count("on_time").alias("on_time"), count("late").alias("late"), count("very_late").alias("very_late"),
        domain.ratio(count("on_time"), F.count("delay_arr_sec")).alias("otp_pct"), F.round(F.percentile("delay_arr_sec", 0.5), 4).alias("median_delay_sec"), F.round(F.percentile("delay_arr_sec", 0.9), 4).alias("p90_delay_sec"))


@query("""SELECT city_key, count(*) FILTER (WHERE delay_arr_sec IS NOT NULL) AS n, avg(delay_arr_sec) AS mean_delay, round(quantile_cont(delay_arr_sec, 0.5), 4) AS median, round(quantile_cont(delay_arr_sec, 0.9), 4) AS p90, round(quantile_cont(delay_arr_sec, 0.99), 4) AS p99
FROM fct_stop_events WHERE abs(delay_arr_sec) <= 43200 GROUP BY 1 HAVING count(*) >= 500""")
def delay_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "fct_stop_events").where(F.abs("delay_arr_sec") <= domain.DELAY_LIMIT)
    p = lambda s, n: F.round(F.percentile("delay_arr_sec", s), 4).alias(n)
    return e.groupBy("city_key").agg(F.count("delay_arr_sec").alias("n"), F.avg("delay_arr_sec").alias("mean_delay"), p(0.5, "median"), p(0.9, "p90"), p(0.99, "p99")).where("n >= 500")


@query("""SELECT city_key, CAST(max(c) AS BIGINT) AS n, min(delay_arr_sec) FILTER (WHERE i > least(c - 1, floor(c * 0.1))) AS p10, min(delay_arr_sec) FILTER (WHERE i > least(c - 1, floor(c * 0.9))) AS p90 FROM
(SELECT city_key, delay_arr_sec, row_number() OVER (PARTITION BY city_key ORDER BY delay_arr_sec) AS i, count(*) OVER (PARTITION BY city_key) AS c FROM fct_stop_events WHERE delay_arr_sec IS NOT NULL) GROUP BY 1""")
def nearest_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.nearest_rank(load(spark, sf_dir, "fct_stop_events"), ["city_key"], "delay_arr_sec", {"p10": 0.1, "p90": 0.9})


@query("SELECT city_key, CAST(floor(greatest(-600, least(1800, delay_arr_sec)) / 30.0) * 30 AS BIGINT) AS bucket, count(*) AS n FROM fct_stop_events WHERE delay_arr_sec IS NOT NULL GROUP BY 1, 2")
def delay_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.histogram(load(spark, sf_dir, "fct_stop_events"), ["city_key"], "delay_arr_sec", -600, 1800, 30)


@query("""SELECT city_key, sum(otp_pct * banded_events) / nullif(sum(CASE WHEN otp_pct IS NOT NULL THEN banded_events END), 0) IS NOT NULL AS rated, round(sum(otp_pct * banded_events) / nullif(sum(CASE WHEN otp_pct IS NOT NULL THEN banded_events END), 0), 6) AS otp FROM fct_route_reliability_daily GROUP BY 1""")
def evidence_weighted_otp(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = load(spark, sf_dir, "fct_route_reliability_daily")
    w = rollup.weighted_mean(F.col("otp_pct"), F.col("banded_events"))
    return d.groupBy("city_key").agg(w.isNotNull().alias("rated"), F.round(w, 6).alias("otp"))


@query("""SELECT city_key, bucket, count(*) AS visits, avg(delay_arr_sec) AS mean_delay FROM (SELECT city_key, delay_arr_sec, CAST(least(9, floor(10 * (stop_sequence - lo) / nullif(CAST(hi - lo AS DOUBLE), 0))) AS INT) AS bucket FROM
(SELECT *, min(stop_sequence) OVER (PARTITION BY trip_uid) AS lo, max(stop_sequence) OVER (PARTITION BY trip_uid) AS hi FROM fct_stop_events WHERE delay_arr_sec IS NOT NULL AND trip_uid IS NOT NULL)) WHERE bucket IS NOT NULL GROUP BY 1, 2""")
def delay_along_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delay by decile of the trip's progress."""
    w = Window.partitionBy("trip_uid")
    e = load(spark, sf_dir, "fct_stop_events").where("delay_arr_sec IS NOT NULL AND trip_uid IS NOT NULL").select("city_key", "trip_uid", "stop_sequence", "delay_arr_sec")
    e = e.withColumn("lo", F.min("stop_sequence").over(w)).withColumn("hi", F.max("stop_sequence").over(w))
    bucket = F.least(F.lit(9), F.floor(domain.ratio(10 * (F.col("stop_sequence") - F.col("lo")), F.col("hi") - F.col("lo")))).cast("int")
    return e.withColumn("bucket", bucket).where("bucket IS NOT NULL").groupBy("city_key", "bucket").agg(F.count(F.lit(1)).alias("visits"), F.avg("delay_arr_sec").alias("mean_delay"))


@query("""WITH s AS (SELECT city_key, stop_sequence % 5 AS stratum, direction_id = 1 AS x, delay_arr_sec BETWEEN -60 AND 299 AS y FROM fct_stop_events WHERE delay_arr_sec IS NOT NULL AND direction_id IS NOT NULL AND stop_sequence IS NOT NULL),
p AS (SELECT city_key, stratum, count(*) FILTER (WHERE x) AS n1, count(*) FILTER (WHERE NOT x) AS n0, count(*) FILTER (WHERE x AND y) AS y1, count(*) FILTER (WHERE NOT x AND y) AS y0 FROM s GROUP BY 1, 2)
SELECT city_key, CAST(sum(n1) AS BIGINT) AS exposed_n, round(sum(y1) / CAST(sum(n1) AS DOUBLE), 6) AS exposed_rate, round(sum(n1 * CAST(y0 AS DOUBLE) / n0) / sum(n1), 6) AS baseline_rate FROM p WHERE n0 > 0 AND n1 > 0 GROUP BY 1""")
def standardised_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "fct_stop_events").where("delay_arr_sec IS NOT NULL AND direction_id IS NOT NULL AND stop_sequence IS NOT NULL")
    e = e.select("city_key", (F.col("stop_sequence") % 5).alias("stratum"), (F.col("direction_id") == 1).alias("x"), F.col("delay_arr_sec").between(-60, 299).alias("y"))
    out = rollup.standardised(e, ["city_key"], "stratum", "x", "y")
    return out.select("city_key", "exposed_n", F.round("exposed_rate", 6).alias("exposed_rate"), F.round("baseline_rate", 6).alias("baseline_rate"))


@query("""SELECT event_type, count(*) FILTER (WHERE h = 0) AS h0, count(*) FILTER (WHERE h = 6) AS h6, count(*) FILTER (WHERE h = 12) AS h12, count(*) FILTER (WHERE h = 18) AS h18 FROM (SELECT event_type, hour(ts) AS h FROM events) GROUP BY 1""")
def pivot_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events").select("event_type", F.hour("ts").alias("h"))
    p = e.groupBy("event_type").pivot("h", [0, 6, 12, 18]).count()
    return p.select("event_type", *[F.coalesce(F.col(str(h)), F.lit(0)).alias(f"h{h}") for h in (0, 6, 12, 18)])


@query("SELECT event_type, " + ", ".join(f"count(*) FILTER (WHERE h = {h}) AS h{h}" for h in range(24)) + " FROM (SELECT event_type, hour(ts) AS h FROM events) GROUP BY 1")
def pivot_every_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of each type in all 24 hours."""
    p = load(spark, sf_dir, "events").select("event_type", F.hour("ts").alias("h")).groupBy("event_type").pivot("h", list(range(24))).count()
    return p.select("event_type", *[F.coalesce(F.col(str(h)), F.lit(0)).alias(f"h{h}") for h in range(24)])


@query("SELECT city_key, string_agg(DISTINCT mode, ',' ORDER BY mode) AS modes, count(DISTINCT route_id) AS routes FROM dim_route WHERE is_current GROUP BY 1")
def ordered_string_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "dim_route").where("is_current").groupBy("city_key").agg(F.array_join(F.array_sort(F.collect_set("mode")), ",").alias("modes"), F.countDistinct("route_id").alias("routes"))


@query("""SELECT city, count(DISTINCT trip_uid) AS trips, count(DISTINCT CASE WHEN schedule_relationship = 'CANCELED' THEN trip_uid END) AS cancelled, count(DISTINCT CASE WHEN schedule_relationship = 'ADDED' THEN trip_uid END) AS added FROM stop_time_predictions GROUP BY 1""")
def conditional_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several conditional distinct counts from one deduplicated pass instead of one expansion each."""
    one = load(spark, sf_dir, "stop_time_predictions").where("trip_uid IS NOT NULL").groupBy("city", "trip_uid").agg(F.bool_or(F.col("schedule_relationship") == "CANCELED").alias("c"), F.bool_or(F.col("schedule_relationship") == "ADDED").alias("a"))
    cities = load(spark, sf_dir, "stop_time_predictions").select("city").distinct()
    counted = one.groupBy("city").agg(F.count(F.lit(1)).alias("trips"), F.count_if("c").alias("cancelled"), F.count_if("a").alias("added"))
    return cities.join(counted, "city", "left").select("city", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("trips", "cancelled", "added")])


@query("""SELECT city, max(v) AS peak_vehicles, avg(v) AS mean_vehicles, count(*) AS minutes FROM (SELECT city, date_trunc('minute', fetched_at) AS m, count(DISTINCT vehicle_id) AS v FROM stop_time_predictions GROUP BY 1, 2) GROUP BY 1""")
def peak_of_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = load(spark, sf_dir, "stop_time_predictions").groupBy("city", F.date_trunc("minute", F.col("fetched_at").cast("timestamp")).alias("m")).agg(F.countDistinct("vehicle_id").alias("v"))
    return per.groupBy("city").agg(F.max("v").alias("peak_vehicles"), F.avg("v").alias("mean_vehicles"), F.count(F.lit(1)).alias("minutes"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def cube_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "lineitem").cube("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT city_key, min(first_delay) AS first_delay, min(worst) AS worst FROM (SELECT city_key, arg_min(delay_arr_sec, (last_seen_utc, event_no)) AS first_delay, max(delay_arr_sec) AS worst FROM fct_stop_events WHERE delay_arr_sec IS NOT NULL AND last_seen_utc IS NOT NULL GROUP BY 1) GROUP BY 1""")
def first_and_worst(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "fct_stop_events").where("delay_arr_sec IS NOT NULL AND last_seen_utc IS NOT NULL")
    return e.groupBy("city_key").agg(F.min_by("delay_arr_sec", F.struct("last_seen_utc", "event_no")).alias("first_delay"), F.max("delay_arr_sec").alias("worst"))


# windows, order, sets


@query("""SELECT city_key, service_date, n, rn FROM (SELECT *, CAST(row_number() OVER (PARTITION BY city_key ORDER BY service_date DESC) AS INT) AS rn FROM (SELECT city_key, service_date, count(*) AS n FROM fct_stop_events GROUP BY 1, 2)) WHERE rn <= 7""")
def last_days_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = load(spark, sf_dir, "fct_stop_events").groupBy("city_key", "service_date").agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("rn", F.row_number().over(Window.partitionBy("city_key").orderBy(F.desc("service_date")))).where("rn <= 7")


@query("""SELECT city_key, route_id, n, CAST(rank() OVER (PARTITION BY city_key ORDER BY n DESC, route_id) AS INT) AS r FROM (SELECT city_key, route_id, count(*) AS n FROM fct_stop_events WHERE route_id IS NOT NULL GROUP BY 1, 2) QUALIFY r <= 3""")
def rank_on_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = load(spark, sf_dir, "fct_stop_events").where("route_id IS NOT NULL").groupBy("city_key", "route_id").agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("r", F.rank().over(Window.partitionBy("city_key").orderBy(F.desc("n"), "route_id"))).where("r <= 3")


@query("""SELECT user_id, event_id, CAST(sum(CAST(value * 100 AS BIGINT)) OVER w AS BIGINT) AS running_cents, lag(event_type) OVER w AS previous, lead(event_type) OVER w AS next FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def running_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = load(spark, sf_dir, "events")
    return e.select("user_id", "event_id", F.sum(F.round(F.col("value") * 100).cast("bigint")).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("running_cents"), F.lag("event_type").over(w).alias("previous"), F.lead("event_type").over(w).alias("next"))


@query("""SELECT trip_uid, event_no FROM (SELECT trip_uid, event_no, row_number() OVER w AS i, count(*) OVER (PARTITION BY trip_uid) AS n FROM fct_stop_events WHERE trip_uid IS NOT NULL WINDOW w AS (PARTITION BY trip_uid ORDER BY stop_sequence, event_no)) WHERE (i - 1) % CAST(ceil(n / 5.0) AS BIGINT) = 0 OR i = n""")
def decimated_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "fct_stop_events").where("trip_uid IS NOT NULL").select("trip_uid", "event_no", "stop_sequence")
    return rollup.decimate(e, ["trip_uid"], ["stop_sequence", "event_no"], 5).select("trip_uid", "event_no")


@query("""SELECT city_key, route_id, mean_delay, n FROM (SELECT city_key, route_id, avg(delay_arr_sec) AS mean_delay, count(delay_arr_sec) AS n FROM fct_stop_events WHERE route_id IS NOT NULL GROUP BY 1, 2 HAVING count(delay_arr_sec) >= 20) ORDER BY mean_delay DESC, city_key, route_id LIMIT 10""")
def worst_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A top-10 report with a floor of evidence and a total order."""
    g = load(spark, sf_dir, "fct_stop_events").where("route_id IS NOT NULL").groupBy("city_key", "route_id").agg(F.avg("delay_arr_sec").alias("mean_delay"), F.count("delay_arr_sec").alias("n")).where("n >= 20")
    return g.orderBy(F.desc("mean_delay"), "city_key", "route_id").limit(10)


@query()
def sampled_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sampling operator: ten rows by a seeded order."""
    return load(spark, sf_dir, "events").orderBy(F.xxhash64(F.lit(42), "event_id"), "event_id").limit(10)


@query("SELECT city_key, route_id, 'both' AS side FROM (SELECT city_key, route_id FROM dim_route INTERSECT SELECT city, route_id FROM gtfs_static_routes) UNION ALL SELECT city, route_id, 'listed only' FROM (SELECT city, route_id FROM gtfs_static_routes EXCEPT SELECT city_key, route_id FROM dim_route)")
def set_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = load(spark, sf_dir, "dim_route").select("city_key", "route_id")
    s = load(spark, sf_dir, "gtfs_static_routes").select(F.col("city").alias("city_key"), "route_id")
    return d.intersect(s).withColumn("side", F.lit("both")).unionByName(s.subtract(d).withColumn("side", F.lit("listed only")))


@query("SELECT city, stop_id FROM (SELECT city, stop_id FROM stop_time_predictions WHERE stop_id IS NOT NULL UNION SELECT city_key, stop_id FROM fct_stop_events WHERE stop_id IS NOT NULL)")
def stops_served(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = load(spark, sf_dir, "stop_time_predictions").select("city", "stop_id")
    b = load(spark, sf_dir, "fct_stop_events").select(F.col("city_key").alias("city"), "stop_id")
    return a.distinct().unionByName(b.distinct()).where("stop_id IS NOT NULL").distinct()


@query("""SELECT city_key, route_id, count(*) FILTER (WHERE stop_id LIKE 'P%') / CAST(count(*) AS DOUBLE) AS share FROM (SELECT DISTINCT city_key, route_id, stop_id FROM fct_stop_events WHERE route_id IS NOT NULL AND stop_id IS NOT NULL) GROUP BY 1, 2 HAVING count(*) >= 2""")
def stop_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of a route's distinct stops that meet a condition, as an allow-list derivation takes it."""
    s = load(spark, sf_dir, "fct_stop_events").where("route_id IS NOT NULL AND stop_id IS NOT NULL").select("city_key", "route_id", "stop_id", F.col("stop_id").startswith("P").cast("double").alias("lat"), F.lit(0.5).alias("lon"))
    z = service.zone_share(s, ["city_key", "route_id"], "lat", "lon", (0.5, 0.0, 1.5, 1.0))
    return z.where("stops_total >= 2").select("city_key", "route_id", F.col("zone_share").alias("share"))

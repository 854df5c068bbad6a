"""Queries over decoded feeds, files, tables and streams: each sends a table's rows through the source, sink or stream and reads them back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidetable.functions import domain
from tidetable.operators import alerts as alert_ops
from tidetable.plans.base import query
from tidetable.session import broadcast_if_small, load, workspace
from tidetable.sources import odpt, protobuf, readers, sinks
from tidetable.streaming import silver


def _zone_of(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Zones of the fixed city table, which has a row per city."""
    return {r.city_key: r.iana_tz for r in load(spark, sf_dir, "dim_city").select("city_key", "iana_tz").collect()}


# protobuf


def _trip_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions as encoded feeds of one trip update each; a feed's message holds the rows of one trip and fetch."""
    s = lambda c: F.unix_seconds(F.col(c).cast("timestamp"))
    p = load(spark, sf_dir, "stop_time_predictions")
    call = lambda t, d: F.when(F.col(t).isNotNull() | F.col(d).isNotNull(), F.struct(s(t).alias("time"), F.col(d).alias("delay")))
    stop = F.struct("stop_id", "stop_sequence", call("arr_pred_ts_utc", "arr_delay_sec").alias("arrival"), call("dep_pred_ts_utc", "dep_delay_sec").alias("departure"), F.col("stu_schedule_relationship").alias("schedule_relationship"))
    trip = ["trip_id", "route_id", "direction_id", "start_date", "start_time", "schedule_relationship"]
    rows = p.groupBy("city", "endpoint", "feed_ts", "fetched_at", "trip_timestamp", "vehicle_id", "vehicle_label", *trip).agg(F.collect_list(stop).alias("stops"))
    entity = F.to_json(F.struct(F.struct(*trip).alias("trip"), F.col("stops").alias("stop_time_updates"), F.struct("vehicle_id", "vehicle_label").alias("vehicle"), F.col("trip_timestamp").alias("timestamp")))
    path = F.concat_ws("/", "city", "endpoint", s("fetched_at").cast("string"))
    return protobuf.encode_feeds(rows.select(path.alias("path"), "feed_ts", entity.alias("entity")), "path", "trip_updates")


@query("""SELECT city, count(*) AS updates, count(stop_id) AS with_stop, count(trip_id) AS with_trip, CAST(sum(arr_delay_sec) AS BIGINT) AS delay_sum, count(arr_pred_ts_utc) AS with_time, count(*) FILTER (WHERE coalesce(schedule_relationship, 'SCHEDULED') = 'SCHEDULED') AS scheduled,
count(*) FILTER (WHERE stu_schedule_relationship = 'SKIPPED') AS skipped, CAST(sum(feed_ts) AS BIGINT) AS feed_sum FROM stop_time_predictions GROUP BY 1""")
def decoded_trip_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions encoded as protobuf feeds, decoded, put into envelopes and parsed."""
    decoded = protobuf.decode_feeds(_trip_feeds(spark, sf_dir))
    part = lambda i: F.split_part("path", F.lit("/"), F.lit(i))
    messages = protobuf.envelopes(decoded, part(1), part(1), part(2), F.timestamp_seconds(part(3).cast("bigint")))
    r = readers.parse_envelopes(messages, "trip_updates").select("city", "feed_ts", F.explode("payload").alias("r")).select("city", "feed_ts", "r.trip_id", "r.schedule_relationship", F.explode_outer("r.stop_time_updates").alias("u"))
    return r.groupBy("city").agg(F.count(F.lit(1)).alias("updates"), F.count("u.stop_id").alias("with_stop"), F.count("trip_id").alias("with_trip"), F.sum("u.arrival.delay").alias("delay_sum"), F.count("u.arrival.time").alias("with_time"),
                                 F.count_if(F.col("schedule_relationship") == "SCHEDULED").alias("scheduled"), F.count_if(F.col("u.schedule_relationship") == "SKIPPED").alias("skipped"), F.sum("feed_ts").alias("feed_sum"))


@query("""SELECT city, count(*) AS records, count(x.trip_id) AS with_trip, count(x.vehicle_id) AS with_vehicle, CAST(max(x.timestamp) AS BIGINT) AS newest, count(*) FILTER (WHERE coalesce(x.current_status, 'IN_TRANSIT_TO') = 'STOPPED_AT') AS stopped, round(avg(x.lat), 2) AS mean_lat FROM (SELECT city, unnest(payload) AS x FROM envelope) GROUP BY 1""")
def decoded_vehicle_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicle records encoded as protobuf feeds and decoded."""
    x = load(spark, sf_dir, "envelope").select("city", "feed_ts", F.explode("payload").alias("r"))
    entity = F.to_json(F.struct(F.struct("r.trip_id", "r.route_id", "r.direction_id", "r.start_date", "r.start_time").alias("trip"), F.struct("r.lat", "r.lon", "r.bearing", "r.speed").alias("position"), "r.current_stop_sequence", "r.stop_id",
                                F.col("r.timestamp").alias("timestamp"), F.when(F.col("r.current_status").isin(*protobuf.VEHICLE_STATES.values()), F.col("r.current_status")).alias("current_status"), F.struct("r.vehicle_id", "r.vehicle_label").alias("vehicle")))
    feeds = protobuf.encode_feeds(x.select(F.col("city").alias("path"), "feed_ts", entity.alias("entity")), "path", "vehicle_positions")
    decoded = protobuf.decode_feeds(feeds)
    r = readers.parse_envelopes(protobuf.envelopes(decoded, F.col("path"), F.col("path"), F.lit("e"), F.timestamp_seconds(F.lit(0))), "vehicle_positions").select("city", F.explode("payload").alias("x"))
    return r.groupBy("city").agg(F.count(F.lit(1)).alias("records"), F.count("x.trip_id").alias("with_trip"), F.count("x.vehicle_id").alias("with_vehicle"), F.max("x.timestamp").alias("newest"), F.count_if(F.col("x.current_status") == "STOPPED_AT").alias("stopped"), F.round(F.avg("x.lat"), 2).alias("mean_lat"))


# alerts: the notices among the documents stand for their versions

_RAW_ALERTS = """raw AS (SELECT city_key AS city, doc_id AS d, 'A' || CAST(doc_id % 97 AS VARCHAR) AS alert_id, epoch_us(published_at) // 1000000 AS f, CASE doc_id % 4 WHEN 0 THEN 'DETOUR' WHEN 1 THEN 'NO_SERVICE' WHEN 2 THEN 'OTHER_EFFECT' ELSE 'SIGNIFICANT_DELAYS' END AS effect,
CASE WHEN doc_id % 6 > 0 THEN 'R' || CAST(doc_id % 13 AS VARCHAR) END AS r1, CASE WHEN doc_id % 5 = 0 THEN 'R' || CAST(doc_id % 11 AS VARCHAR) END AS r2 FROM documents WHERE kind = 'alert' AND city_key IS NOT NULL AND published_at IS NOT NULL),
days AS (SELECT raw.*, iana_tz, CAST(timezone(iana_tz, make_timestamptz(f * 1000000)) - INTERVAL 12 HOUR AS DATE) AS service_date FROM raw JOIN dim_city ON city_key = city),
p AS (SELECT *, CASE WHEN d % 3 > 0 THEN f - d % 7 * 3600 END AS s, CASE WHEN d % 3 > 0 AND d % 5 > 0 THEN f + d % 9 * 3600 END AS e FROM days UNION ALL SELECT *, f + 7200, f + 10800 FROM days WHERE d % 3 = 2),
x AS (SELECT p.*, r1 AS route FROM p UNION ALL SELECT p.*, r2 FROM p WHERE r2 IS NOT NULL)"""


def _alert_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alert versions sent as protobuf feeds, decoded, enveloped and normalised as a stream's batch would be."""
    d = load(spark, sf_dir, "documents").where("kind = 'alert' AND city_key IS NOT NULL AND published_at IS NOT NULL").select("doc_id", F.col("city_key").alias("city"), F.unix_seconds(F.col("published_at").cast("timestamp")).alias("f"))
    i = F.col("doc_id")
    first = F.when(i % 3 > 0, F.array(F.struct((F.col("f") - i % 7 * 3600).alias("start"), F.when(i % 5 > 0, F.col("f") + i % 9 * 3600).alias("end")))).otherwise(F.array().cast("array<struct<start: bigint, end: bigint>>"))
    second = F.when(i % 3 == 2, F.array(F.struct((F.col("f") + 7200).alias("start"), (F.col("f") + 10800).alias("end")))).otherwise(F.array().cast("array<struct<start: bigint, end: bigint>>"))
    route = lambda cond, n: F.when(cond, F.array(F.struct(F.concat(F.lit("R"), i % n).alias("route_id")))).otherwise(F.array().cast("array<struct<route_id: string>>"))
    named = F.when(i % 6 > 0, F.array(F.struct(F.concat(F.lit("R"), i % 13).alias("route_id")))).otherwise(F.array(F.struct(F.lit(None).cast("string").alias("route_id"))))
    effect = F.when(i % 4 == 0, "DETOUR").when(i % 4 == 1, "NO_SERVICE").when(i % 4 == 2, "OTHER_EFFECT").otherwise("SIGNIFICANT_DELAYS")
    # the id carries the document so that versions of one alert stay apart in the feed; it is cut off again below
    entity = F.to_json(F.struct(F.concat(first, second).alias("active_periods"), F.concat(named, route(i % 5 == 0, 11)).alias("informed_entities"), effect.alias("effect"), F.struct(F.array(F.struct(i.cast("string").alias("text"))).alias("translation")).alias("header")))
    rows = d.select(F.concat_ws("/", "city", F.concat(F.lit("A"), i % 97), F.col("f").cast("string"), i.cast("string")).alias("path"), F.col("f").alias("feed_ts"), entity.alias("entity"))
    decoded = protobuf.decode_feeds(protobuf.encode_feeds(rows, "path", "alerts"))
    part = lambda n: F.split_part("path", F.lit("/"), F.lit(n))
    messages = protobuf.envelopes(decoded, part(1), part(1), part(2), F.timestamp_seconds(part(3).cast("bigint")))
    built = silver.build(messages, "alerts", _zone_of(spark, sf_dir), {})
    return built.withColumn("alert_id", F.col("endpoint"))


@query(f"""WITH {_RAW_ALERTS} SELECT city, service_date, count(*) AS n, count(route) AS with_route, count(s) AS with_start, count(e) AS with_end FROM x GROUP BY 1, 2""")
def exploded_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions times periods times entities, those without either kept."""
    x = alert_ops.exploded(_alert_versions(spark, sf_dir))
    return x.groupBy("city", "service_date").agg(F.count(F.lit(1)).alias("n"), F.count("entity_route_id").alias("with_route"), F.count("period_start").alias("with_start"), F.count("period_end").alias("with_end"))


_DAILY = f"""WITH {_RAW_ALERTS}, routes AS (SELECT DISTINCT city, alert_id, route FROM x WHERE route IS NOT NULL), seen AS (SELECT city, alert_id, min(f) AS f0, max(f) AS f1 FROM x GROUP BY 1, 2),
rows AS (SELECT DISTINCT x.city, x.alert_id, service_date, effect, iana_tz, coalesce(s, f0) AS s, coalesce(e, f1) AS e, coalesce(routes.route, '_unattributed') AS route_id FROM x JOIN seen USING (city, alert_id) LEFT JOIN routes USING (city, alert_id)),
cut AS (SELECT DISTINCT city, alert_id, service_date, route_id, greatest(timezone(iana_tz, make_timestamptz(s * 1000000)), CAST(service_date AS TIMESTAMP)) AS s, least(timezone(iana_tz, make_timestamptz(e * 1000000)), CAST(service_date + 1 AS TIMESTAMP)) AS e FROM rows),
m AS (SELECT *, max(e) OVER (PARTITION BY city, alert_id, service_date, route_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM cut WHERE e >= s),
i AS (SELECT *, sum(CASE WHEN reach IS NULL OR s > reach THEN 1 ELSE 0 END) OVER (PARTITION BY city, alert_id, service_date, route_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS k FROM m),
g AS (SELECT city, alert_id, service_date, route_id, (epoch_us(max(e)) // 1000000 - epoch_us(min(s)) // 1000000) / 60.0 AS minutes FROM i GROUP BY 1, 2, 3, 4, k),
worst AS (SELECT city, route_id, service_date, effect FROM (SELECT *, row_number() OVER (PARTITION BY city, route_id, service_date ORDER BY CASE effect WHEN 'NO_SERVICE' THEN 1 WHEN 'SIGNIFICANT_DELAYS' THEN 3 WHEN 'DETOUR' THEN 4 ELSE 9 END, effect) AS rn FROM rows) WHERE rn = 1),
daily AS (SELECT g.city, g.route_id, g.service_date, count(DISTINCT alert_id) AS alerts_active, round(sum(minutes), 1) AS alert_minutes, any_value(effect) AS worst_effect FROM g JOIN worst USING (city, route_id, service_date) GROUP BY 1, 2, 3)"""


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = load(spark, sf_dir, "dim_city").select(F.col("city_key").alias("city"), F.col("iana_tz").alias("zone"))
    return alert_ops.daily(alert_ops.exploded(_alert_versions(spark, sf_dir)), zones)


@query(f"{_DAILY} SELECT * FROM daily")
def alerts_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts, their minutes and the worst effect per route and day."""
    return _daily(spark, sf_dir).select("city", "route_id", "service_date", "alerts_active", "alert_minutes", "worst_effect")


@query(f"{_DAILY} SELECT city, CAST(sum(alerts_active) AS BIGINT) AS alerts, round(sum(alert_minutes), 1) AS alert_minutes, count(DISTINCT route_id) AS routes_alerted FROM daily GROUP BY 1")
def alerts_by_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily(spark, sf_dir).groupBy("city").agg(F.sum("alerts_active").alias("alerts"), F.round(F.sum("alert_minutes"), 1).alias("alert_minutes"), F.countDistinct("route_id").alias("routes_alerted"))


@query(f"""WITH {_RAW_ALERTS} SELECT city, count(*) AS n FROM days WHERE city NOT IN ('norvale', 'sternau') OR r1 IN ('R1', 'R2', 'R3') OR r2 IN ('R1', 'R2', 'R3') GROUP BY 1""")
def allow_listed_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts of restricted cities only where one of their entities is an allowed route."""
    return alert_ops.naming_allowed(_alert_versions(spark, sf_dir), "city", ["norvale", "sternau"], ["R1", "R2", "R3"]).groupBy("city").agg(F.count(F.lit(1)).alias("n"))


# JSON-LD

_STAMP = "'2025-10-' || lpad(CAST(timetable_id % 28 + 1 AS VARCHAR), 2, '0') || 'T' || lpad(CAST(timetable_id % 24 AS VARCHAR), 2, '0') || ':30:00+09:00'"


def _objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timetables as JSON-LD responses of live trains and notices, two objects to a response."""
    t = load(spark, sf_dir, "tokyo_odpt_train_timetable")
    i = F.col("timetable_id")
    stamp = F.concat(F.lit("2025-10-"), F.lpad((i % 28 + 1).cast("string"), 2, "0"), F.lit("T"), F.lpad((i % 24).cast("string"), 2, "0"), F.lit(":30:00+09:00"))
    train = F.struct(F.lit("odpt:Train").alias("@type"), i.cast("string").alias("@id"), F.col("odpt_train").alias("owl:sameAs"), stamp.alias("dc:date"), F.col("odpt_operator").alias("odpt:operator"), F.col("odpt_railway").alias("odpt:railway"),
                     F.col("odpt_train_number").alias("odpt:trainNumber"), (i % 9 * 60).alias("odpt:delay"), F.array(F.lit("a"), F.lit("b")).alias("odpt:originStation"))
    status = F.when(i % 3 > 0, F.struct(F.when(i % 2 == 0, "Delay").alias("en"), F.lit("遅延").alias("ja")))
    notice = F.struct(F.lit("odpt:TrainInformation").alias("@type"), F.col("owl_same_as").alias("owl:sameAs"), F.col("odpt_operator").alias("odpt:operator"), F.col("odpt_railway").alias("odpt:railway"), stamp.alias("odpt:timeOfOrigin"), status.alias("odpt:trainInformationStatus"))
    value = F.concat(F.lit("["), F.to_json(train), F.lit(", "), F.to_json(notice), F.lit("]"))
    return odpt.objects(t.select(F.col("timetable_id").alias("response"), value.alias("value")))


@query(f"""SELECT line, count(*) AS trains, CAST(sum(delay) AS BIGINT) AS delay_sum, CAST(max(ts) AS BIGINT) AS newest, count(trip_id) AS with_trip FROM (SELECT odpt_railway AS line, timetable_id % 9 * 60 AS delay, epoch_us(CAST({_STAMP} AS TIMESTAMPTZ)) // 1000000 AS ts, split_part(odpt_train, ':', 2) AS trip_id FROM tokyo_odpt_train_timetable) GROUP BY 1""")
def odpt_train_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = odpt.trains(_objects(spark, sf_dir))
    return r.groupBy(F.col("railway").alias("line")).agg(F.count(F.lit(1)).alias("trains"), F.sum("delay_sec").alias("delay_sum"), F.max("timestamp").alias("newest"), F.count("trip_id").alias("with_trip"))


@query("""SELECT CASE WHEN timetable_id % 2 = 0 THEN 'Delay' ELSE '遅延' END AS header_text, split_part(odpt_operator, ':', 2) AS agency, count(*) AS n FROM tokyo_odpt_train_timetable WHERE timetable_id % 3 > 0 GROUP BY 1, 2""")
def odpt_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notices as alert records; objects without a status give none."""
    r = odpt.notices(_objects(spark, sf_dir))
    return r.groupBy("header_text", F.col("informed_entities")[0]["agency_id"].alias("agency")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""SELECT feed, count(*) AS envelopes, CAST(sum(n) AS BIGINT) AS records, CAST(max(ts) AS BIGINT) AS newest FROM (SELECT 'odpt_trains' AS feed, 1 AS n, epoch_us(CAST({_STAMP} AS TIMESTAMPTZ)) // 1000000 AS ts FROM tokyo_odpt_train_timetable
UNION ALL SELECT 'alerts', 1, epoch_us(CAST({_STAMP} AS TIMESTAMPTZ)) // 1000000 FROM tokyo_odpt_train_timetable WHERE timetable_id % 3 > 0) GROUP BY 1""")
def odpt_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One envelope per response and kind, parsed again by its declared schema."""
    e = odpt.envelopes(_objects(spark, sf_dir), ["response"])
    size = F.size(F.from_json("payload", "array<struct<timestamp: bigint>>"))
    return e.groupBy("feed").agg(F.count(F.lit(1)).alias("envelopes"), F.sum(size).cast("bigint").alias("records"), F.max("feed_ts").alias("newest"))


@query("""SELECT city, CAST(count(*) AS BIGINT) AS trains, count(DISTINCT railway) AS lines FROM (SELECT DISTINCT 'minasato' AS city, odpt_train, timetable_id % 9 * 60 AS d, timetable_id % 28 AS a, timetable_id % 24 AS b, odpt_railway AS railway FROM tokyo_odpt_train_timetable) GROUP BY 1""")
def odpt_trains_built(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes of live trains normalised to the table of train snapshots, unchanged re-polls collapsed."""
    e = odpt.envelopes(_objects(spark, sf_dir), ["response"]).where("feed = 'odpt_trains'").withColumn("error", F.lit(None).cast("string"))
    messages = protobuf.envelopes(e, F.lit("minasato"), F.lit("m"), F.lit("e"), F.timestamp_seconds("feed_ts"), "odpt_json")
    t = silver.build(messages, "odpt_trains", _zone_of(spark, sf_dir), {"minasato": 3})
    return t.groupBy("city").agg(F.count(F.lit(1)).alias("trains"), F.countDistinct("railway").alias("lines"))


@query("""SELECT odpt_railway AS railway_urn, split_part(odpt_operator, ':', 2) AS operator, count(DISTINCT s) AS stations FROM (SELECT odpt_railway, odpt_operator, unnest(odpt_train_timetable_object).departure_station AS s FROM tokyo_odpt_train_timetable) WHERE s IS NOT NULL GROUP BY 1, 2 UNION ALL SELECT 'odpt.Railway:None', 'None', 0""")
def odpt_dump_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dump of railways, written as JSON and scanned: one row per station, a railway without stations kept."""
    t = load(spark, sf_dir, "tokyo_odpt_train_timetable").select("odpt_railway", "odpt_operator", F.explode("odpt_train_timetable_object.departure_station").alias("s")).where("s IS NOT NULL")
    r = t.groupBy(F.col("odpt_railway").alias("owl:sameAs"), F.col("odpt_operator").alias("odpt:operator")).agg(F.array_sort(F.collect_set("s")).alias("s"))
    r = r.withColumn("odpt:stationOrder", F.transform("s", lambda x, i: F.struct(x.alias("odpt:station"), i.alias("odpt:index")))).drop("s")
    none = spark.range(1).select(F.lit("odpt.Railway:None").alias("owl:sameAs"), F.lit("odpt.Operator:None").alias("odpt:operator"), F.array().cast(r.schema["odpt:stationOrder"].dataType).alias("odpt:stationOrder"))
    path = workspace(spark, "dump")
    r.unionByName(none).write.json(path)
    rows = odpt.railways(odpt.objects(spark.read.text(path)))
    return rows.groupBy("railway_urn", "operator").agg(F.countDistinct("station_urn").alias("stations"))


@query("SELECT odpt_calendar AS calendar_urn, list_extract(string_split(odpt_calendar, ':'), -1) AS title_en, count(*) AS timetables FROM tokyo_odpt_train_timetable GROUP BY 1, 2")
def odpt_calendars(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = load(spark, sf_dir, "tokyo_odpt_train_timetable").select("timetable_id", F.to_json(F.struct(F.col("odpt_calendar").alias("owl:sameAs"), F.struct(F.element_at(F.split("odpt_calendar", ":"), -1).alias("en")).alias("odpt:calendarTitle"))).alias("value"))
    return odpt.calendars(odpt.objects(t)).groupBy("calendar_urn", "title_en").agg(F.count(F.lit(1)).alias("timetables"))


_CLOCK = "CASE WHEN {0} LIKE '%:%' THEN CAST(split_part({0}, ':', 1) AS INT) * 3600 + CAST(split_part({0}, ':', 2) AS INT) * 60 + coalesce(TRY_CAST(split_part({0}, ':', 3) AS INT), 0) ELSE CAST({0}[:-3] AS INT) * 3600 + CAST({0}[-2:] AS INT) * 60 END"


@query(f"""WITH c AS (SELECT timetable_id, unnest(odpt_train_timetable_object) AS x, generate_subscripts(odpt_train_timetable_object, 1) AS i FROM tokyo_odpt_train_timetable),
turns AS (SELECT timetable_id, i * 2 - 1 AS k, x.arrival_time AS t FROM c UNION ALL SELECT timetable_id, i * 2, x.departure_time FROM c),
read AS (SELECT timetable_id, k, {_CLOCK.format("t")} AS s FROM (SELECT timetable_id, k, regexp_replace(translate(t, '０１２３４５６７８９：時分', '0123456789::'), ':$', '') AS t FROM turns WHERE t IS NOT NULL)),
back AS (SELECT *, CASE WHEN s < lag(s) OVER w THEN 1 ELSE 0 END AS b, first_value(s) OVER w AS first FROM read WINDOW w AS (PARTITION BY timetable_id ORDER BY k)),
run AS (SELECT timetable_id, k, s + 86400 * sum(b) OVER (PARTITION BY timetable_id ORDER BY k ROWS UNBOUNDED PRECEDING) + CASE WHEN first < 10800 THEN 86400 ELSE 0 END AS s FROM back)
SELECT c.timetable_id, CAST(i AS INT) AS stop_sequence, coalesce(x.departure_station, x.arrival_station) AS station_urn, CAST(a.s AS BIGINT) AS arrival_seconds, CAST(d.s AS BIGINT) AS departure_seconds FROM c LEFT JOIN run a ON a.timetable_id = c.timetable_id AND a.k = i * 2 - 1 LEFT JOIN run d ON d.timetable_id = c.timetable_id AND d.k = i * 2""")
def odpt_timetable_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls of the timetables as a dump holds them, their clocks running on past midnight."""
    t = load(spark, sf_dir, "tokyo_odpt_train_timetable")
    calls = F.transform("odpt_train_timetable_object", lambda x: F.struct(x["arrival_time"].alias("odpt:arrivalTime"), x["departure_time"].alias("odpt:departureTime"), x["arrival_station"].alias("odpt:arrivalStation"), x["departure_station"].alias("odpt:departureStation")))
    dump = t.select(F.to_json(F.struct(F.col("timetable_id").cast("string").alias("owl:sameAs"), F.col("odpt_railway").alias("odpt:railway"), F.col("odpt_calendar").alias("odpt:calendar"), calls.alias("odpt:trainTimetableObject"))).alias("value"))
    return odpt.timetable_calls(odpt.objects(dump), 3).select(F.col("timetable_urn").cast("bigint").alias("timetable_id"), "stop_sequence", "station_urn", "arrival_seconds", "departure_seconds")


@query("""SELECT railway_urn, operator, count(*) AS stations, count(title_en) AS with_title, round(avg(lat), 4) AS mean_lat FROM (SELECT DISTINCT odpt_railway AS railway_urn, split_part(odpt_operator, ':', 2) AS operator, s, list_extract(string_split(s, '.'), -1) AS title_en, 35 + length(s) / 100.0 AS lat
FROM (SELECT odpt_railway, odpt_operator, unnest(odpt_train_timetable_object).departure_station AS s FROM tokyo_odpt_train_timetable) WHERE s IS NOT NULL) GROUP BY 1, 2""")
def odpt_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations as a dump holds them."""
    t = load(spark, sf_dir, "tokyo_odpt_train_timetable").select("odpt_railway", "odpt_operator", F.explode("odpt_train_timetable_object.departure_station").alias("s")).where("s IS NOT NULL").distinct()
    title = F.struct(readers.urn_tail(F.col("s")).alias("en"))
    dump = t.select(F.to_json(F.struct(F.col("s").alias("owl:sameAs"), F.col("odpt_operator").alias("odpt:operator"), F.col("odpt_railway").alias("odpt:railway"), title.alias("odpt:stationTitle"), (F.lit(35) + F.length("s") / 100.0).alias("geo:lat"))).alias("value"))
    return odpt.stations(odpt.objects(dump)).groupBy("railway_urn", "operator").agg(F.count(F.lit(1)).alias("stations"), F.count("title_en").alias("with_title"), F.round(F.avg("lat"), 4).alias("mean_lat"))


# files


@query("""SELECT city, count(*) AS n, count(nullif(trim(route_color), '')) AS with_color, CAST(sum(route_type) AS BIGINT) AS types FROM gtfs_static_routes GROUP BY 1""")
def schedule_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routes written as schedule files, one set with other columns and a byte-order mark, read by the declared header and united by name."""
    r = load(spark, sf_dir, "gtfs_static_routes").select("*", F.concat(F.col("city"), F.lit("|"), F.coalesce("agency_id", F.lit(""))).alias("agency"))
    path = workspace(spark, "schedule")
    half = F.pmod(F.xxhash64("route_id"), F.lit(2)) == 0
    r.where(half).select(F.col("route_id").alias("\ufeffroute_id"), F.col("agency").alias("agency_id"), "route_type", "route_color", F.lit("x").alias("extra")).write.option("header", True).csv(f"{path}/a")
    r.where(~half).select("route_color", F.col("agency").alias("agency_id"), "route_id", "route_type", "route_short_name").write.option("header", True).csv(f"{path}/b")
    s = readers.read_schedule(spark, [f"{path}/a", f"{path}/b"], "routes")
    return s.groupBy(F.split_part("agency_id", F.lit("|"), F.lit(1)).alias("city")).agg(F.count(F.lit(1)).alias("n"), F.count("route_color").alias("with_color"), F.sum("route_type").alias("types"))


@query("SELECT city, gtfs_version_id AS version, count(*) AS lines FROM gtfs_static_routes GROUP BY 1, 2")
def zip_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each version's routes packed into an archive, and its member unpacked on the executors."""
    r = load(spark, sf_dir, "gtfs_static_routes").groupBy(F.concat_ws("/", "city", "gtfs_version_id").alias("path")).agg(F.collect_list(F.coalesce("route_id", F.lit("?"))).alias("lines"))
    lines = readers.zip_lines(sinks.zipped(r, "path", "routes.txt", "lines"), "routes.txt")
    return lines.groupBy(F.split_part("path", F.lit("/"), F.lit(1)).alias("city"), F.split_part("path", F.lit("/"), F.lit(2)).alias("version")).agg(F.count(F.lit(1)).alias("lines"))


@query("SELECT city_key, iana_tz, peak_am_start, schedule_matchable, metrics_from FROM dim_city")
def seed_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The city table written as CSV and read with declared types; times of day stay text."""
    path = workspace(spark, "seed")
    load(spark, sf_dir, "dim_city").select("city_key", "iana_tz", "peak_am_start", "schedule_matchable", "metrics_from").write.option("header", True).csv(path)
    return readers.seed(spark, path, "city_key string, iana_tz string, peak_am_start string, schedule_matchable boolean, metrics_from date")


@query("""SELECT DISTINCT city, agency, iana_tz AS zone, endpoint, 'https://feeds.example/' || endpoint AS url, CASE WHEN hash_even THEN 'own' ELSE 'gtfs_rt' END AS adapter, CAST(CASE WHEN hash_even THEN 30 ELSE 45 END AS INT) AS poll_seconds, 'TOKEN' AS credential
FROM (SELECT *, length(endpoint) % 2 = 0 AS hash_even FROM envelope) JOIN dim_city ON city_key = city""")
def city_endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Endpoints of city configurations, some of which override the city's adapter and ask to be polled too fast."""
    e = load(spark, sf_dir, "envelope").select("city", "agency", "endpoint").distinct().join(broadcast_if_small(load(spark, sf_dir, "dim_city").select(F.col("city_key").alias("city"), "iana_tz")), "city")
    url = F.concat(F.lit("https://feeds.example/"), F.col("endpoint"))
    spec = F.when(F.length("endpoint") % 2 == 0, F.concat(F.lit('{"url": "'), url, F.lit('", "poll_seconds": 5, "adapter": "own"}'))).otherwise(F.concat(F.lit('"'), url, F.lit('"')))
    groups = e.groupBy("city", "agency", "iana_tz").agg(F.array_join(F.collect_list(F.concat(F.lit('"'), F.col("endpoint"), F.lit('": '), spec)), ", ").alias("g"))
    text = F.concat(F.lit('{"city": "'), F.col("city"), F.lit('", "agency": "'), F.col("agency"), F.lit('", "timezone": "'), F.col("iana_tz"), F.lit('", "adapter": "gtfs_rt", "poll_seconds": 45, "auth": {"env": "TOKEN"}, "feed_groups": {'), F.col("g"), F.lit("}}"))
    return readers.city_config(groups.select(text.alias("value")))


@query("SELECT city, true AS stale, true AS has_files FROM envelope GROUP BY 1")
def stale_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest file of each city's raw archive against a clock a day ahead."""
    path = workspace(spark, "raw")
    e = load(spark, sf_dir, "envelope").where("feed_ts IS NOT NULL").select("city", "envelope_id", F.timestamp_seconds("feed_ts").alias("at"))
    sinks.archive(e.withColumn("at", F.lit("2025-10-05 06:00:00").cast("timestamp")), path, "at", ["city"])
    now = F.current_timestamp() + F.make_dt_interval(days=F.lit(1))
    return readers.newest_files(spark, path, ["city"]).select("city", ((F.unix_seconds(now) - F.unix_seconds("newest")) > 40 * 60).alias("stale"), (F.col("files") > 0).alias("has_files"))


@query("""SELECT city, CAST(epoch_us(fetched_at) // 3600000000 * 3600 AS BIGINT) AS hour, count(*) AS n FROM stop_time_predictions GROUP BY 1, 2""")
def raw_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows archived under city, day and hour, and counted from the folders' own names."""
    path = workspace(spark, "archive")
    sinks.archive(load(spark, sf_dir, "stop_time_predictions").select("city", "row_no", "fetched_at"), path, "fetched_at", ["city"])
    a = spark.read.parquet(path)
    return a.groupBy("city", (F.unix_seconds(F.col("day").cast("timestamp")) + F.col("hour") * 3600).alias("hour")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT city_key, service_date, count(*) AS visits, CAST(max(delay_arr_sec) AS BIGINT) AS worst FROM fct_stop_events GROUP BY 1, 2")
def json_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A small result exported as one JSON file and read back."""
    path = workspace(spark, "json")
    sinks.export_json(load(spark, sf_dir, "fct_stop_events").groupBy("city_key", "service_date").agg(F.count(F.lit(1)).alias("visits"), F.max("delay_arr_sec").alias("worst")), path)
    return spark.read.schema("city_key string, service_date date, visits bigint, worst bigint").json(path)


@query("""SELECT city, count(*) AS n FROM envelope WHERE (city = 'norvale' AND to_timestamp(feed_ts) BETWEEN TIMESTAMPTZ '2025-10-31 22:00:00Z' AND TIMESTAMPTZ '2025-11-06 00:00:00Z') OR (city = 'sternau' AND to_timestamp(feed_ts) BETWEEN TIMESTAMPTZ '2025-10-04 22:00:00Z' AND TIMESTAMPTZ '2025-11-05 00:00:00Z') GROUP BY 1""")
def replayed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archived messages of one topic within windows of two cities, begun two hours early."""
    a = load(spark, sf_dir, "envelope").select(F.lit("positions").alias("topic"), "city", F.timestamp_seconds("feed_ts").alias("fetched_at"))
    other = a.withColumn("topic", F.lit("other"))
    return readers.replayed(a.unionByName(other), "positions", [("norvale", "2025-11-01 00:00:00", "2025-11-06 00:00:00"), ("sternau", "2025-10-05 00:00:00", "2025-11-05 00:00:00")], "2 hours").groupBy("city").agg(F.count(F.lit(1)).alias("n"))


# tables


@query("""SELECT city_key, count(*) AS n, CAST(sum(CASE WHEN city_key IN ('norvale', 'sternau') THEN 1 ELSE 0 END) AS BIGINT) AS rebuilt FROM fct_stop_events GROUP BY 1""")
def overwritten_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table by city of which two cities are rebuilt, twice over; the others stay."""
    path = workspace(spark, "partitions")
    e = load(spark, sf_dir, "fct_stop_events").select("city_key", "event_no", F.lit(0).alias("v"))
    sinks.overwrite_partitions(e, path, ["city_key"])
    for _ in range(2):
        sinks.overwrite_partitions(e.where("city_key IN ('norvale', 'sternau')").withColumn("v", F.lit(1)), path, ["city_key"])
    return spark.read.parquet(path).groupBy("city_key").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("rebuilt"))


def _name(path: str) -> str:
    return "t_" + path.rsplit("-", 1)[1]


@query("""SELECT city_key, count(*) AS n, count(CASE WHEN event_no % 2 = 1 THEN delay_arr_sec END) AS with_delay, count(CASE WHEN event_no % 2 = 0 THEN stop_id END) AS with_stop FROM fct_stop_events GROUP BY 1""")
def evolved_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table made if absent, then appended to with one column more and one less; earlier rows stay and read null there."""
    path = workspace(spark, "evolved")
    name, e = _name(path), load(spark, sf_dir, "fct_stop_events")
    for _ in range(2):
        sinks.ensure_table(spark, name, "event_no BIGINT, stop_id STRING, city_key STRING", ["city_key"], path)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    e.where("event_no % 2 = 0").select("event_no", "stop_id", "city_key").write.insertInto(name)
    sinks.evolve_table(e.where("event_no % 2 = 1").select("city_key", "event_no", "delay_arr_sec"), name)
    return spark.table(name).groupBy("city_key").agg(F.count(F.lit(1)).alias("n"), F.count("delay_arr_sec").alias("with_delay"), F.count("stop_id").alias("with_stop"))


@query("SELECT city_key, count(*) AS n FROM fct_stop_events WHERE service_date < DATE '2025-01-01' GROUP BY 1")
def rolled_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of a table, rolled back to the one before an instant."""
    root, e = workspace(spark, "versions"), load(spark, sf_dir, "fct_stop_events").select("city_key", "service_date")
    sinks.write_version(e.where("service_date < DATE '2025-01-01'"), root, "20250101")
    sinks.write_version(e, root, "20251201")
    return sinks.rolled_back(spark, root, "20250601").groupBy("city_key").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT 'visits' AS "table", count(*) AS rows, CAST(2 AS INT) AS columns FROM fct_stop_events WHERE city_key = 'norvale' UNION ALL SELECT 'routes', count(*), CAST(1 AS INT) FROM (SELECT DISTINCT route_id FROM fct_stop_events)""")
def refreshed_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table rebuilt whole, twice, a view over the facts, and the catalog's account of both."""
    path = workspace(spark, "refresh")
    name, e = _name(path), load(spark, sf_dir, "fct_stop_events")
    sinks.full_refresh(e.select("city_key", "event_no"), name, path)
    sinks.full_refresh(e.where("city_key = 'norvale'").select("city_key", "event_no"), name, path)
    e.select("route_id").distinct().createOrReplaceTempView(f"{name}_routes")
    listed = sinks.catalog(spark, [name, f"{name}_routes", "absent_table"])
    return listed.withColumn("table", F.when(F.col("table") == name, "visits").otherwise("routes"))


@query("SELECT 'delay_range' AS check_name, count(*) AS stored FROM fct_stop_events WHERE delay_arr_sec < -1800 OR delay_arr_sec > 21600")
def stored_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that violate a check, kept in a table."""
    from tidetable.operators import quality

    path = workspace(spark, "failures")
    quality.store_failures(quality.out_of_range(load(spark, sf_dir, "fct_stop_events"), "delay_arr_sec", -1800, 21600), path, "delay_range")
    return spark.read.parquet(path).groupBy(F.col("check").alias("check_name")).agg(F.count(F.lit(1)).alias("stored"))


# streams

_UIDS = """uids AS (SELECT p.*, CASE WHEN nullif(trip_id, '') IS NOT NULL THEN sha256(city || '|' || CAST(sd AS VARCHAR) || '|' || trip_id) WHEN nullif(route_id, '') IS NOT NULL THEN sha256(city || '|' || CAST(sd AS VARCHAR) || '|' || route_id || '-' || coalesce(CAST(direction_id AS VARCHAR), '') || '-' || coalesce(start_time, '')) END AS uid
FROM (SELECT stop_time_predictions.*, coalesce(CAST(try_strptime(start_date, '%Y%m%d') AS DATE), CAST(timezone(iana_tz, timezone('UTC', fetched_at)) - INTERVAL 12 HOUR AS DATE)) AS sd FROM stop_time_predictions JOIN dim_city ON city_key = city) p),
ids AS (SELECT *, (coalesce(uid, '~'), coalesce(stop_id, '~'), coalesce(stop_sequence, -9), epoch_us(arr_pred_ts_utc) // 1000000, epoch_us(dep_pred_ts_utc) // 1000000, arr_delay_sec, dep_delay_sec, coalesce(schedule_relationship, '~'), coalesce(stu_schedule_relationship, '~')) AS id FROM uids)"""


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions as JSON messages of one record each, with their fetch time."""
    s = lambda c: F.unix_seconds(F.col(c).cast("timestamp"))
    call = lambda t, d: F.struct(s(t).alias("time"), F.col(d).alias("delay"))
    update = F.array(F.struct("stop_id", "stop_sequence", call("arr_pred_ts_utc", "arr_delay_sec").alias("arrival"), call("dep_pred_ts_utc", "dep_delay_sec").alias("departure"), F.col("stu_schedule_relationship").alias("schedule_relationship")))
    record = F.struct(*[F.col(c) for c in silver.TRIP], F.col("trip_timestamp").alias("timestamp"), update.alias("stop_time_updates"))
    head = F.struct("city", "agency", F.lit("trip_updates").alias("feed"), F.date_format("fetched_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("fetched_at"), "source_format", "schema_version", "endpoint", "feed_ts", F.array(record).alias("payload"))
    return load(spark, sf_dir, "stop_time_predictions").select("fetched_at", F.to_json(head).alias("value"))


def _drain(spark: SparkSession, sf_dir: str, folder: str, source: str) -> None:
    stream = silver.build(silver.read_messages(spark, source), "stop_time_predictions", _zone_of(spark, sf_dir), {})
    silver.supervise(lambda: [silver.start(stream, f"{folder}/out", f"{folder}/checkpoint", ["city"])], restarts=1, pause=0)


@query(f"WITH {_UIDS} SELECT city, count(DISTINCT id) AS rows FROM ids GROUP BY 1")
def streamed_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages drained from files by a stream that drops repeated observations; a second drain of the same checkpoint adds nothing."""
    folder = workspace(spark, "stream")
    _messages(spark, sf_dir).select("value").write.text(f"{folder}/in")
    for _ in range(2):
        _drain(spark, sf_dir, folder, f"{folder}/in")
    return spark.read.parquet(f"{folder}/out").groupBy("city").agg(F.count(F.lit(1)).alias("rows"))


@query(f"""WITH {_UIDS}, half AS (SELECT to_timestamp(avg(epoch_us(fetched_at)) / 1000000.0) AS t FROM stop_time_predictions), t AS (SELECT city, count(DISTINCT id) AS total FROM ids GROUP BY 1), n AS (SELECT city, count(DISTINCT id) AS streamed FROM ids, half WHERE timezone('UTC', fetched_at) >= half.t GROUP BY 1)
SELECT t.city, coalesce(streamed, 0) AS streamed, total - coalesce(streamed, 0) AS recovered FROM t LEFT JOIN n USING (city)""")
def late_rows_recovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that sees the newer half first drops the older half behind its watermark; a replay of all messages appends what is missing."""
    folder, all_ = workspace(spark, "late"), _messages(spark, sf_dir)
    half = all_.agg(F.avg(F.unix_micros(F.col("fetched_at").cast("timestamp"))).alias("t")).scalar()
    newer = F.unix_micros(F.col("fetched_at").cast("timestamp")) >= half
    all_.where(newer).select("value").write.text(f"{folder}/in/1")
    _drain(spark, sf_dir, folder, f"{folder}/in/*")
    all_.where(~newer).select("value").write.text(f"{folder}/in/2")
    _drain(spark, sf_dir, folder, f"{folder}/in/*")
    table = spark.read.parquet(f"{folder}/out")
    replay = silver.build(spark.read.text([f"{folder}/in/1", f"{folder}/in/2"]), "stop_time_predictions", _zone_of(spark, sf_dir), {})
    lost = silver.backfill(replay, table, "stop_time_predictions")
    count: Column = F.count(F.lit(1))
    both = table.groupBy("city").agg(count.alias("streamed")).join(lost.groupBy("city").agg(count.alias("recovered")), "city", "full")
    return both.select("city", F.coalesce("streamed", F.lit(0)).alias("streamed"), F.coalesce("recovered", F.lit(0)).alias("recovered"))


@query("SELECT CAST(epoch_us(time_bucket(INTERVAL 6 HOUR, ts)) // 1000000 AS BIGINT) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def streamed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tumbling counts of a stream that reads a file a trigger, each corrected as its rows arrive."""
    folder = workspace(spark, "windows")
    load(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type").repartition(4).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema("ts timestamp, event_type string").option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    counts = silver.windowed_counts(stream, "ts", ["event_type"], "6 hours", lateness="100000 hours")
    q = counts.writeStream.outputMode("complete").option("checkpointLocation", f"{folder}/checkpoint").foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(f"{folder}/out")).trigger(availableNow=True).start()
    silver.supervise(lambda: [q], restarts=0)
    return spark.read.parquet(f"{folder}/out").select(F.unix_seconds("window_start").alias("window_start"), "event_type", "n")


# typed projections of the feeds


@query("""SELECT city AS city_key, agency, endpoint, service_date, trip_uid, trip_id, route_id, CAST(direction_id AS INT) AS direction_id, CASE WHEN schedule_relationship IN ('NEW', 'UNSCHEDULED') OR trip_id LIKE '-%' THEN 'ADDED' ELSE schedule_relationship END AS schedule_relationship, stop_id, stop_sequence,
CAST(epoch_us(arr_pred_ts_utc) // 1000000 AS BIGINT) AS arr_pred, arr_delay_sec, CAST(epoch_us(fetched_at) // 1000000 AS BIGINT) AS fetched FROM stop_time_predictions""")
def staged_trip_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "stop_time_predictions")
    added = F.coalesce(F.col("schedule_relationship").isin("NEW", "UNSCHEDULED") | F.col("trip_id").like("-%"), F.lit(False))
    s = lambda c, name: F.unix_seconds(F.col(c).cast("timestamp")).alias(name)
    return p.select(F.col("city").alias("city_key"), "agency", "endpoint", "service_date", "trip_uid", "trip_id", "route_id", F.col("direction_id").cast("int"), F.when(added, "ADDED").otherwise(F.col("schedule_relationship")).alias("schedule_relationship"), "stop_id", "stop_sequence",
                    s("arr_pred_ts_utc", "arr_pred"), "arr_delay_sec", s("fetched_at", "fetched"))


@query("""SELECT city AS city_key, x.vehicle_id AS vehicle_id, nullif(x.trip_id, '') AS trip_id, x.route_id AS route_id, coalesce(x.timestamp, feed_ts) AS at, x.lat AS lat, x.lon AS lon, x.current_status AS status FROM (SELECT city, feed_ts, unnest(payload) AS x FROM envelope)""")
def staged_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = load(spark, sf_dir, "envelope").select("city", "feed_ts", F.explode("payload").alias("x"))
    return x.select(F.col("city").alias("city_key"), "x.vehicle_id", F.nullif("x.trip_id", F.lit("")).alias("trip_id"), "x.route_id", F.coalesce("x.timestamp", "feed_ts").alias("at"), "x.lat", "x.lon", F.col("x.current_status").alias("status"))


@query("""SELECT city AS city_key, trip_id, route_id, service_id, direction_id, CAST(split_part(origin_time, ':', 1) AS INT) * 3600 + CAST(split_part(origin_time, ':', 2) AS INT) * 60 + CAST(split_part(origin_time, ':', 3) AS INT) AS origin_sec, CAST(strptime(split_part(gtfs_version_id, '-', 2), '%Y%m%d') AS DATE) AS version_date FROM gtfs_static_trips""")
def staged_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = load(spark, sf_dir, "gtfs_static_trips")
    return t.select(F.col("city").alias("city_key"), "trip_id", "route_id", "service_id", "direction_id", domain.gtfs_seconds(F.col("origin_time")).alias("origin_sec"), F.try_to_date(F.split_part("gtfs_version_id", F.lit("-"), F.lit(2)), "yyyyMMdd").alias("version_date"))


@query("""SELECT timetable_id, split_part(odpt_operator, ':', 2) AS operator, odpt_railway AS railway, split_part(odpt_calendar, ':', 2) AS day_type, odpt_train_number AS train_number, CAST(len(odpt_train_timetable_object) AS INT) AS calls FROM tokyo_odpt_train_timetable""")
def staged_timetables(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = load(spark, sf_dir, "tokyo_odpt_train_timetable")
    return t.select("timetable_id", odpt.tail(F.col("odpt_operator")).alias("operator"), F.col("odpt_railway").alias("railway"), odpt.tail(F.col("odpt_calendar")).alias("day_type"), F.col("odpt_train_number").alias("train_number"), F.size("odpt_train_timetable_object").alias("calls"))

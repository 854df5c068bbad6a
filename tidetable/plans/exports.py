"""Queries behind the published figures and maps, and the contracts that must hold for them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidetable.functions import domain
from tidetable.operators import joins, quality
from tidetable.plans import delivery, temporal
from tidetable.plans.base import query
from tidetable.session import broadcast_if_small, load


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits with a delay, with their band and the city's local hour of arrival."""
    zone = load(spark, sf_dir, "dim_city").select("city_key", "iana_tz", "peak_am_start", "peak_am_end", "peak_pm_start", "peak_pm_end")
    e = load(spark, sf_dir, "fct_stop_events").where("delay_arr_sec IS NOT NULL").join(broadcast_if_small(zone), "city_key")
    return e.withColumn("band", domain.otp_band(F.col("delay_arr_sec"))).withColumn("local", domain.local_time(F.col("actual_arr_ts_utc").cast("timestamp"), F.col("iana_tz")))


_SCORED = f"""scored AS (SELECT e.*, mode_peak.* EXCLUDE (city_key), {delivery._BAND} AS band, timezone(iana_tz, timezone('UTC', actual_arr_ts_utc)) AS local FROM fct_stop_events e JOIN dim_city AS mode_peak USING (city_key) WHERE delay_arr_sec IS NOT NULL)"""


def _share(cond: F.Column, name: str) -> F.Column:
    return F.round(100.0 * F.count_if(cond) / F.count(F.lit(1)), 4).alias(name)


@query("SELECT count(*) AS stop_events, count(DISTINCT service_date) AS service_days, count(DISTINCT city_key) AS cities, max(service_date) AS latest_day FROM fct_stop_events WHERE delay_arr_sec IS NOT NULL")
def summary_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "fct_stop_events").where("delay_arr_sec IS NOT NULL")
    return e.agg(F.count(F.lit(1)).alias("stop_events"), F.countDistinct("service_date").alias("service_days"), F.countDistinct("city_key").alias("cities"), F.max("service_date").alias("latest_day"))


@query(f"WITH {_SCORED} SELECT city_key, service_date, count(*) AS events, round(100.0 * count(*) FILTER (WHERE band = 'on_time') / count(*), 4) AS otp_pct, round(quantile_cont(delay_arr_sec, 0.5), 4) AS median_s FROM scored GROUP BY 1, 2")
def daily_otp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).groupBy("city_key", "service_date").agg(F.count(F.lit(1)).alias("events"), _share(F.col("band") == "on_time", "otp_pct"), F.round(F.percentile("delay_arr_sec", 0.5), 4).alias("median_s"))


@query(f"WITH {_SCORED} SELECT s.city_key, coalesce(mode, 'unknown') AS mode, count(*) AS events, round(100.0 * count(*) FILTER (WHERE band = 'on_time') / count(*), 4) AS otp_pct, count(DISTINCT s.route_key) AS routes FROM scored s LEFT JOIN dim_route r ON r.route_key = s.route_key GROUP BY 1, 2")
def otp_by_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = load(spark, sf_dir, "dim_route").select("route_key", "mode")
    s = _scored(spark, sf_dir).join(broadcast_if_small(r), "route_key", "left").withColumn("mode", F.coalesce("mode", F.lit("unknown")))
    return s.groupBy("city_key", "mode").agg(F.count(F.lit(1)).alias("events"), _share(F.col("band") == "on_time", "otp_pct"), F.countDistinct("route_key").alias("routes"))


@query(f"WITH {_SCORED} SELECT city_key, isodow(service_date) >= 6 AS weekend, count(*) AS events, round(100.0 * count(*) FILTER (WHERE band = 'on_time') / count(*), 4) AS otp_pct FROM scored GROUP BY 1, 2")
def weekday_weekend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).groupBy("city_key", (F.weekday("service_date") >= 5).alias("weekend")).agg(F.count(F.lit(1)).alias("events"), _share(F.col("band") == "on_time", "otp_pct"))


@query(f"""WITH {_SCORED} SELECT city_key, (strftime(local, '%H:%M') >= peak_am_start AND strftime(local, '%H:%M') < peak_am_end) OR (strftime(local, '%H:%M') >= peak_pm_start AND strftime(local, '%H:%M') < peak_pm_end) AS peak, count(*) AS events, round(100.0 * count(*) FILTER (WHERE band = 'on_time') / count(*), 4) AS otp_pct, round(avg(delay_arr_sec), 4) AS mean_s
FROM scored WHERE actual_arr_ts_utc IS NOT NULL GROUP BY 1, 2""")
def peak_offpeak(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Punctuality within and outside each city's own peaks."""
    clock = F.date_format("local", "HH:mm")
    peak = ((clock >= F.col("peak_am_start")) & (clock < F.col("peak_am_end"))) | ((clock >= F.col("peak_pm_start")) & (clock < F.col("peak_pm_end")))
    return _scored(spark, sf_dir).where("actual_arr_ts_utc IS NOT NULL").groupBy("city_key", peak.alias("peak")).agg(F.count(F.lit(1)).alias("events"), _share(F.col("band") == "on_time", "otp_pct"), F.round(F.avg("delay_arr_sec"), 4).alias("mean_s"))


@query(f"WITH {_SCORED} SELECT city_key, route_id, count(*) AS events, round(100.0 * count(*) FILTER (WHERE band = 'early') / count(*), 4) AS early_pct FROM scored WHERE route_id IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 50")
def early_departures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routes by the share of visits that were early, thin routes left out."""
    return _scored(spark, sf_dir).where("route_id IS NOT NULL").groupBy("city_key", "route_id").agg(F.count(F.lit(1)).alias("events"), _share(F.col("band") == "early", "early_pct")).where("events >= 50")


@query("SELECT city_key, service_date, count(*) AS events, count(DISTINCT trip_uid) AS trips, count(DISTINCT route_id) AS routes, count(DISTINCT stop_id) AS stops, count(delay_arr_sec) AS scored FROM fct_stop_events GROUP BY 1, 2")
def inventory_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "fct_stop_events").groupBy("city_key", "service_date")
    return e.agg(F.count(F.lit(1)).alias("events"), F.countDistinct("trip_uid").alias("trips"), F.countDistinct("route_id").alias("routes"), F.countDistinct("stop_id").alias("stops"), F.count("delay_arr_sec").alias("scored"))


@query("""WITH d AS (SELECT city_key, service_date, row_number() OVER (PARTITION BY city_key ORDER BY count(*) DESC, service_date DESC) AS k FROM fct_stop_events WHERE delay_arr_sec IS NOT NULL GROUP BY 1, 2),
m AS (SELECT e.city_key, e.stop_id, avg(delay_arr_sec) AS mean_s, count(*) AS n FROM fct_stop_events e JOIN d ON d.city_key = e.city_key AND d.service_date = e.service_date AND k = 1 WHERE delay_arr_sec IS NOT NULL AND stop_id IS NOT NULL GROUP BY 1, 2)
SELECT city_key, stop_id, n, CAST(trunc(greatest(0.0, least(1.0, mean_s / 600)) * 220 + 30) AS INT) AS red, CAST(trunc((1 - greatest(0.0, least(1.0, mean_s / 600))) * 170 + 40) AS INT) AS green FROM m""")
def stop_dots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stops of each city's fullest day, coloured by their mean delay."""
    e = load(spark, sf_dir, "fct_stop_events").where("delay_arr_sec IS NOT NULL")
    w = Window.partitionBy("city_key").orderBy(F.col("n").desc(), F.col("service_date").desc())
    day = e.groupBy("city_key", "service_date").agg(F.count(F.lit(1)).alias("n")).withColumn("k", F.row_number().over(w)).where("k = 1").select("city_key", "service_date")
    m = e.where("stop_id IS NOT NULL").join(broadcast_if_small(day), ["city_key", "service_date"]).groupBy("city_key", "stop_id").agg(F.avg("delay_arr_sec").alias("mean_s"), F.count(F.lit(1)).alias("n"))
    colour = domain.delay_colour(F.col("mean_s"))
    return m.select("city_key", "stop_id", "n", colour[0].alias("red"), colour[1].alias("green"))


@query("""SELECT city, '8-' || CAST(least(floor((x.lat + 90) / 180 * 256), 255) AS INT) || '-' || CAST(least(floor((x.lon + 180) / 360 * 512), 511) AS INT) AS cell, count(*) AS fixes, count(DISTINCT x.vehicle_id) AS vehicles FROM (SELECT city, unnest(payload) AS x FROM envelope) WHERE x.lat BETWEEN -90 AND 90 AND x.lon BETWEEN -180 AND 180 GROUP BY 1, 2""")
def fixes_by_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicle fixes by cell of the fixed grid."""
    x = load(spark, sf_dir, "envelope").select("city", F.explode("payload").alias("x")).select("city", "x.vehicle_id", domain.geo_cell(F.col("x.lat"), F.col("x.lon")).alias("cell")).where("cell IS NOT NULL")
    return x.groupBy("city", "cell").agg(F.count(F.lit(1)).alias("fixes"), F.countDistinct("vehicle_id").alias("vehicles"))


@query("""SELECT city, x.route_id AS route_id, round(avg(CASE WHEN x.lat BETWEEN 40 AND 60 AND x.lon BETWEEN 0 AND 80 THEN 1.0 ELSE 0 END), 6) AS share, count(*) AS fixes FROM (SELECT DISTINCT city, x.route_id AS r, x.stop_id AS s, x FROM (SELECT city, unnest(payload) AS x FROM envelope)) WHERE x.lat IS NOT NULL AND x.lon IS NOT NULL AND x.route_id IS NOT NULL GROUP BY 1, 2 HAVING avg(CASE WHEN x.lat BETWEEN 40 AND 60 AND x.lon BETWEEN 0 AND 80 THEN 1.0 ELSE 0 END) > 0.5""")
def routes_in_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routes most of whose distinct records lie in a box, which make its allow-list."""
    x = load(spark, sf_dir, "envelope").select("city", F.explode("payload").alias("x")).distinct().select("city", "x.route_id", "x.lat", "x.lon").where("lat IS NOT NULL AND lon IS NOT NULL AND route_id IS NOT NULL")
    inside = (F.col("lat").between(40, 60) & F.col("lon").between(0, 80)).cast("int")
    return x.groupBy("city", "route_id").agg(F.avg(inside).alias("s"), F.count(F.lit(1)).alias("fixes")).where("s > 0.5").select("city", "route_id", F.round("s", 6).alias("share"), "fixes")


# contracts over what the queries above and the finalization publish

_CONTRACTS = f"""WITH {delivery._DELIVERY}, {temporal._GAPS},
hw AS ({temporal.HEADWAY_SQL})
SELECT 'unscheduled_normalised' AS check_name, count(*) AS violations FROM stop_time_predictions WHERE {delivery._REL} = 'UNSCHEDULED'
UNION ALL SELECT 'added_normalised', count(*) FROM stop_time_predictions WHERE {delivery._REL} = 'NEW' OR ({delivery._REL} = 'SCHEDULED' AND trip_id LIKE '-%')
UNION ALL SELECT 'delays_plausible', count(*) FROM fct_stop_events WHERE abs(delay_arr_sec) > 43200
UNION ALL SELECT 'final_delays_plausible', count(*) FROM visits WHERE abs(delay) > 43200
UNION ALL SELECT 'gate_holds', count(*) FROM hw JOIN fct_stop_events USING (event_no) JOIN dim_city USING (city_key) WHERE NOT gap_regularity_measurable AND (bunched IS NOT NULL OR big_gap IS NOT NULL)
UNION ALL SELECT 'matched_have_route', count(*) FROM visits WHERE static_trip_id IS NOT NULL AND route_id IS NULL
UNION ALL SELECT 'final_in_gaps', count(*) FROM visits v WHERE delay IS NOT NULL AND EXISTS (SELECT 1 FROM gaps WHERE gaps.city = v.city AND arr_eff > a * 1000000 AND arr_eff < z * 1000000)
UNION ALL SELECT 'prefix_agrees', count(*) FROM fct_stop_events WHERE nullif(regexp_extract(static_trip_id, '^([a-z]+)[.]', 1), '') IS DISTINCT FROM nullif(split_part(static_trip_id, '.T', 1), '')
UNION ALL SELECT 'cities_without_scheduled_gaps', count(*) FROM (SELECT city_key FROM hw JOIN fct_stop_events USING (event_no) GROUP BY 1 HAVING count(*) >= 100 AND count(sched_gap_sec) = 0)
UNION ALL SELECT 'daytime_of_the_day_before', count(*) FROM (SELECT city_key, service_date FROM fct_stop_events JOIN dim_city USING (city_key) WHERE CAST(timezone(iana_tz, timezone('UTC', actual_arr_ts_utc)) AS DATE) > service_date AND hour(timezone(iana_tz, timezone('UTC', actual_arr_ts_utc))) >= 6 GROUP BY 1, 2 HAVING count(*) > 10)
UNION ALL SELECT 'skipped_without_delay', count(*) FROM visits WHERE stu_schedule_relationship = 'SKIPPED' AND delay IS NOT NULL
UNION ALL SELECT 'stale_without_delay', count(*) FROM fct_stop_events WHERE epoch_us(last_seen_utc) > epoch_us(actual_arr_ts_utc) + 1800000000 AND delay_arr_sec IS NOT NULL
UNION ALL SELECT 'stops_known', count(*) FROM fct_stop_events e WHERE stop_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM stop_time_predictions p WHERE p.stop_id = e.stop_id)
UNION ALL SELECT 'matching_unique', count(*) FROM (SELECT trip_uid FROM near GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'cancelled_within_scheduled', count(*) FROM delivery WHERE cancelled > scheduled
UNION ALL SELECT 'trips_covered', count(*) FROM (SELECT p.city, p.service_date, count(DISTINCT p.trip_uid) AS n, count(DISTINCT v.trip_uid) AS m FROM stop_time_predictions p LEFT JOIN visits v ON v.city = p.city AND v.service_date = p.service_date AND v.trip_uid = p.trip_uid WHERE p.trip_uid IS NOT NULL GROUP BY 1, 2 HAVING count(DISTINCT p.trip_uid) >= 5 AND count(DISTINCT v.trip_uid) < 0.9 * count(DISTINCT p.trip_uid))"""


@query(_CONTRACTS)
def published_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations of the contracts that tie the published figures to what they come from."""
    c = F.col
    p, e = load(spark, sf_dir, "stop_time_predictions"), load(spark, sf_dir, "fct_stop_events")
    added = F.coalesce(c("schedule_relationship").isin("NEW", "UNSCHEDULED"), F.lit(False))
    rel = F.when(added, "ADDED").otherwise(F.coalesce("schedule_relationship", F.lit("SCHEDULED")))
    v, hw = delivery._visits(spark, sf_dir), temporal.headways_outside_gaps(spark, sf_dir)
    t = lambda x: F.unix_micros(c(x).cast("timestamp"))
    feeds = quality.tally(p, {"unscheduled_normalised": rel == "UNSCHEDULED", "added_normalised": (rel == "NEW") | ((rel == "SCHEDULED") & c("trip_id").like("-%"))})
    facts = quality.tally(e, {"delays_plausible": F.abs("delay_arr_sec") > 43200, "prefix_agrees": ~F.nullif(F.regexp_extract("static_trip_id", r"^([a-z]+)[.]", 1), F.lit("")).eqNullSafe(F.nullif(F.split_part("static_trip_id", F.lit(".T"), F.lit(1)), F.lit(""))),
                              "stale_without_delay": (t("last_seen_utc") > t("actual_arr_ts_utc") + 1_800_000_000) & c("delay_arr_sec").isNotNull()})
    final = quality.tally(v, {"final_delays_plausible": F.abs("delay_arr_sec") > 43200, "matched_have_route": c("static_trip_id").isNotNull() & c("route_id").isNull(), "skipped_without_delay": c("skipped") & c("delay_arr_sec").isNotNull()})
    measured = hw.join(e.select("event_no", "city_key"), "event_no").join(broadcast_if_small(load(spark, sf_dir, "dim_city").select("city_key", c("gap_regularity_measurable").alias("ok"))), "city_key")
    gate = quality.tally(measured, {"gate_holds": ~c("ok") & (c("bunched").isNotNull() | c("big_gap").isNotNull())})
    zone = load(spark, sf_dir, "dim_city").select("city_key", "iana_tz")
    local = domain.local_time(c("actual_arr_ts_utc").cast("timestamp"), c("iana_tz"))
    misdated = e.join(broadcast_if_small(zone), "city_key").where((F.to_date(local) > c("service_date")) & (F.hour(local) >= 6)).groupBy("city_key", "service_date").agg(F.count(F.lit(1)).alias("n")).where("n > 10")
    seen, scored = p.where("trip_uid IS NOT NULL"), v.where("delay_arr_sec IS NOT NULL AND actual_arr_ts_utc IS NOT NULL").select("city", "actual_arr_ts_utc")
    bad = {"final_in_gaps": joins.inside_interval(scored, temporal._feed_gaps(spark, sf_dir), ["city"], "actual_arr_ts_utc", "gap_start", "gap_end").where("inside"),
           "cities_without_scheduled_gaps": measured.groupBy("city_key").agg(F.count(F.lit(1)).alias("n"), F.count("sched_gap_sec").alias("s")).where("n >= 100 AND s = 0"), "daytime_of_the_day_before": misdated,
           "stops_known": quality.orphans(e, ["stop_id"], p, ["stop_id"]), "matching_unique": quality.duplicates(delivery._matches(spark, sf_dir), ["trip_uid"]), "cancelled_within_scheduled": delivery._delivery(spark, sf_dir).where("cancelled > scheduled"),
           "trips_covered": quality.under_covered(seen, v, ["city", "service_date"], "trip_uid", 0.9, 5)}
    out = feeds.unionByName(facts).unionByName(final).unionByName(gate)
    for name, rows in bad.items():
        out = out.unionByName(rows.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check_name"), "violations"))
    return out

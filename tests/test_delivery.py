"""Operators of schedule finalization, matching, incremental builds, alerts, feeds and interval joins, on edge cases and against plain Python."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from tidetable.operators import alerts, incremental, intervals, joins, quality, rollup, service
from tidetable.sources import odpt, readers, sinks
from tidetable.streaming import silver

DAY = dt.date(2025, 3, 4)


def at(hour, minute=0, day=4):
    return dt.datetime(2025, 3, day, hour, minute)


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


# interval joins


def test_interval_joins_equal_brute_force_over_many_days(spark):
    rng = random.Random(11)
    gaps = [(rng.choice("ab"), a, a + rng.choice([0, 5, 3_000, 90_000, 900_000])) for a in (rng.randint(0, 3_000_000) for _ in range(60))]
    points = [(i, rng.choice(["a", "b", None]), rng.choice([None, *[rng.randint(0, 3_000_000)] * 9])) for i in range(400)] + [(1000 + 2 * i + j, k, x) for i, (k, a, z) in enumerate(gaps) for j, x in enumerate((a, z))]
    spans = [(i, rng.choice("ab"), a, a + rng.choice([0, 1, 600, 80_000, 200_000, 2_000_000])) for i, a in enumerate(rng.randint(0, 3_000_000) for _ in range(400))]
    g = spark.createDataFrame(gaps + gaps[:5], "k string, s int, e int")
    p = spark.createDataFrame(points, "i int, k string, t int")
    for strict in (True, False):
        got = dict(rows(joins.inside_interval(p, g, ["k"], "t", "s", "e", strict), "i", "inside"))
        assert got == {i: any(k == gk and t is not None and (s < t < e if strict else s <= t <= e) for gk, s, e in gaps) for i, k, t in points}
    kept = {i for (i,) in rows(joins.without_overlap(spark.createDataFrame(spans, "i int, k string, a int, b int"), g, ["k"], "a", "b", "s", "e"), "i")}
    assert kept == {i for i, k, a, b in spans if not any(k == gk and a < e and b > s for gk, s, e in gaps)}


def test_islands_across_days_and_touching(spark):
    df = spark.createDataFrame([("a", 0, 200_000), ("a", 90_000, 100_000), ("a", 200_000, 200_010), ("a", 300_000, 300_000), ("b", 5, 4)], "k string, a int, b int")
    assert rows(intervals.merge_islands(df, ["k"], "a", "b"), "k", "a", "b", "parts") == [("a", 0, 200_010, 3), ("a", 300_000, 300_000, 1)]
    assert rows(intervals.merge_islands(df, ["k"], "a", "b", touching=False), "a", "b") == [(0, 200_000), (200_000, 200_010), (300_000, 300_000)]


def test_passages_equal_brute_force(spark):
    rng = random.Random(5)
    snaps = [(rng.choice("xyz"), rng.choice([None, *[rng.randint(0, 20)] * 9]), t, rng.choice([None, 60, 120])) for t in range(200)]
    stops = [(k, s, p, sign) for k, sign in (("x", 1), ("y", -1), ("z", 1)) for p, s in ((p, f"s{p}") for p in range(0, 24, 3))] + [("none", "s", 1, 1)]
    met = service.passages(spark.createDataFrame(snaps, "train string, pos int, at int, delay int"), spark.createDataFrame(stops, "train string, stop string, stop_pos int, sign int"), ["train"], "pos", "at", "sign", "stop_pos", "delay")
    want = []
    for k, s, p, sign in stops:
        past = [t for tr, pos, t, _ in snaps if tr == k and pos is not None and pos * sign >= p * sign]
        if past:
            want.append((k, s, min(past)))
    assert rows(met, "train", "stop", "passed_at") == sorted(want, key=repr)


# finalization with the schedule

PREDICTION = "city string, service_date date, trip_uid string, stop_id string, stop_sequence int, row_no bigint, route_id string, schedule_relationship string, stu_schedule_relationship string, arr_delay_sec int, dep_delay_sec int, arr_pred_ts_utc timestamp, dep_pred_ts_utc timestamp, fetched_at timestamp"


def prediction(no, trip, stop, seq, fetched, arr=None, delay=None, dep=None, skipped=None):
    return ("c", DAY, trip, stop, seq, no, "r", "SCHEDULED", skipped, delay, None, arr, dep, fetched)


def finalized(spark, predictions):
    schedule = [("c", "s1", "A", 1, 8 * 3600), ("c", "s1", "B", 2, 8 * 3600 + 600), ("c", "s1", "A", 3, 10 * 3600)]
    out = service.finalize_with_schedule(spark.createDataFrame(predictions, PREDICTION), spark.createDataFrame([("t", "s1")], "trip_uid string, trip_id string"),
                                         spark.createDataFrame(schedule, "city string, trip_id string, stop_id string, stop_sequence int, sched_sec int"), spark.createDataFrame([("c", "UTC")], "city string, zone string"))
    return {(r.trip_uid, r.stop_sequence): r for r in out.collect()}


def test_finalization_takes_the_last_valid_prediction_and_the_nearest_call(spark):
    beat = prediction(99, "other", "Z", 9, at(20), arr=at(20))
    got = finalized(spark, [beat, prediction(1, "t", "A", None, at(7, 50), arr=at(8, 3)), prediction(2, "t", "A", None, at(7, 55), arr=at(8, 4)), prediction(3, "t", "A", None, at(9), arr=at(8, 5)),  # the third is stale
                            prediction(4, "t", "A", None, at(9, 55), delay=120), prediction(5, "t", "B", 2, at(8, 5), delay=-60, skipped="SKIPPED"), prediction(6, "u", "B", 2, at(8), delay=60), prediction(7, "t", None, 7, at(8), arr=at(8)),
                            prediction(8, "t", "Q", None, at(8), arr=at(8)), prediction(10, "t", "B", 5, at(8)), prediction(11, None, "B", 5, at(8), arr=at(8))])
    assert set(got) == {("t", 1), ("t", 3), ("t", 2)}
    first, loop, skipped = got["t", 1], got["t", 3], got["t", 2]
    assert (first.row_no, first.n_predictions, first.delay_arr_sec, first.method, first.sched_arr_ts_utc) == (2, 2, 240, "last_prediction", at(8))
    assert (loop.row_no, loop.actual_arr_ts_utc, loop.delay_arr_sec, loop.method) == (4, at(10, 2), 120, "delay_plus_schedule")
    assert (skipped.skipped, skipped.actual_arr_ts_utc, skipped.first_seen) == (True, at(8, 9), at(8, 5))


def test_finalization_of_implausible_delays_and_empty_tables(spark):
    beat = prediction(99, "other", "Z", 9, at(20), arr=at(20))
    got = finalized(spark, [beat, prediction(1, "t", "A", 1, at(8), arr=at(8, 1), delay=-16_245_480), prediction(2, "t", "B", 2, at(8), arr=at(8, 1, day=3) + dt.timedelta(hours=40))])
    assert got["t", 1].delay_arr_sec == 60 and ("t", 2) not in got  # still open: predicted beyond the newest fetch
    assert finalized(spark, []) == {}


# what is recomputed


def test_days_that_may_be_recomputed(spark):
    day = lambda *ds: spark.createDataFrame([("c", dt.date(2025, 1, d)) for d in ds], "city string, d date")
    out = incremental.recomputable(day(1, 2, 3, 4).unionByName(spark.createDataFrame([(None, None)], "city string, d date")), day(3, 4, 5), day(1, 3), ["city", "d"])
    assert rows(out, "d") == [(None,), *[(dt.date(2025, 1, d),) for d in (2, 3, 4)]]
    days = spark.createDataFrame([("c", dt.date(2025, 1, d)) for d in range(1, 10)], "city string, d date")
    assert incremental.lookback(days, "d", F.lit("2025-01-08").cast("date"), 49).count() == 5
    assert rows(incremental.repair(days, "city", "c", "d", "2025-01-02", "2025-01-03"), "d") == [(dt.date(2025, 1, 2),), (dt.date(2025, 1, 3),)]


def test_closed_days_and_misdated_events(spark):
    df = spark.createDataFrame([(1, DAY, at(3, 59, 5), "UTC"), (2, DAY, at(6, 0, 5), "UTC"), (3, DAY, at(23), "UTC"), (4, DAY, None, "UTC"), (5, DAY, at(20), "Asia/Tokyo"), (6, DAY, at(22), "Asia/Tokyo"), (7, DAY, at(22), None), (8, None, at(22), "UTC")], "i int, d date, t timestamp, z string")
    assert [i for (i,) in rows(incremental.well_dated(df, "d", "t", F.col("z")), "i")] == [1, 3, 4, 5, 7, 8]
    one = spark.createDataFrame([(DAY, at(2, 59, 5)), (DAY, at(3, 0, 5))], "d date, t timestamp").select(incremental.day_closed(F.col("d"), F.col("t"), F.lit("UTC")).alias("c"))
    assert sorted(r.c for r in one.collect()) == [False, True]


# matching


def test_exact_matches_inherit_and_repeat_nothing(spark):
    left = spark.createDataFrame([(1, "x", None), (2, "x", "own"), (3, "y", None), (4, None, "z")], "i int, k string, route string")
    right = spark.createDataFrame([("x", "b"), ("x", "a"), ("x", None), (None, "n")], "k string, route string")
    assert rows(joins.exact_matches(left, right, ["k"], ["route"]), "i", "route", "match_confidence") == [(1, "a", 1.0), (2, "own", 1.0)]


def test_not_in_by_the_rule_for_null(spark):
    left = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    listed = lambda *ks: spark.createDataFrame([(k,) for k in ks], "r string")
    for right in (listed("a"), listed("a", None), listed(None), listed()):
        want = {r.k for r in spark.sql("SELECT * FROM {l} WHERE k NOT IN (SELECT r FROM {r})", l=left, r=right).collect()}
        assert {r.k for r in joins.not_in(left, right, "k", "r").collect()} == want


def test_rekeyed_and_day_types(spark):
    left = spark.createDataFrame([("t1", "r", 5000), ("t2", "r", 5000), ("t3", "q", 5000)], "trip string, route string, at int")
    exact = spark.createDataFrame([("t1", 5100)], "trip string, o int")
    second = spark.createDataFrame([("r", 5000, "s9"), ("r", 5000, "s2")], "route string, at int, static string")
    assert rows(joins.rekeyed(left, exact, second, "trip", ["route"], "at", "o", "static", 1800), "trip", "static", "candidates", "match_confidence") == [("t2", "s2", 2, 0.9)]
    days = spark.createDataFrame([(dt.date(2025, 10, d),) for d in (3, 4, 5)], "d date")  # Friday to Sunday
    items = spark.createDataFrame([(1, "Weekday"), (2, "SaturdayHoliday"), (3, "Holiday"), (4, None)], "i int, kind string")
    assert rows(joins.by_day_type(days, items, "d", "kind", {"Weekday": [1, 2, 3, 4, 5], "Holiday": [7], "SaturdayHoliday": [6, 7]}), "d", "i") == [(dt.date(2025, 10, 3), 1), (dt.date(2025, 10, 4), 2), (dt.date(2025, 10, 5), 2), (dt.date(2025, 10, 5), 3)]


def test_counts_put_together_and_checks(spark):
    a, b = spark.createDataFrame([("x", 1)], "k string, m int"), spark.createDataFrame([("x", 5), ("y", 6)], "k string, n int")
    assert rows(rollup.summed_counts([a, b], ["k"], ["m", "n"]), "k", "m", "n") == [("x", 1, 5), ("y", 0, 6)]
    df = spark.createDataFrame([(1, None), (2, 5), (None, 6)], "a int, b int")
    assert rows(quality.tally(df, {"null_a": F.col("a").isNull(), "big": F.col("b") > 5}), "check_name", "violations") == [("big", 1), ("null_a", 1)]
    assert rows(quality.tally(df.where("false"), {"x": F.col("a") > 0}), "violations") == [(0,)]


# alerts


def test_alerts_by_day(spark):
    s = "city string, alert_id string, service_date date, effect string, fetched_at timestamp, active_periods array<struct<start: bigint, end: bigint>>, informed_entities array<struct<agency_id: string, route_id: string, route_type: int, stop_id: string, trip_id: string>>"
    e = lambda *routes: [(None, r, None, None, None) for r in routes]
    t = lambda h, m=0, day=4: int(dt.datetime(2025, 3, day, h, m, tzinfo=dt.UTC).timestamp())
    versions = [("c", "a", DAY, "OTHER_EFFECT", at(8), [(t(8), t(9)), (t(8, 30), t(10))], e("r1")), ("c", "a", DAY, "DETOUR", at(9), [(t(23), t(2, 0, 5))], []), ("c", "b", DAY, None, at(12), [], e("r1", "r2")), ("c", "b", DAY, None, at(13), None, None),
                ("c", "lost", DAY, "UNLISTED", at(12), [(None, None)], e(None)), ("c", "gone", DAY, "NO_SERVICE", at(12), [(t(1, 0, 1), t(2, 0, 1))], e("r3"))]
    df = spark.createDataFrame(versions, s)
    assert alerts.exploded(df).count() == 2 + 1 + 2 + 1 + 1 + 1
    out = alerts.daily(alerts.exploded(df), spark.createDataFrame([("c", "UTC")], "city string, zone string"))
    assert rows(out, "route_id", "alerts_active", "alert_minutes", "worst_effect") == [("_unattributed", 1, 0.0, "UNLISTED"), ("r1", 2, 240.0, "DETOUR"), ("r2", 1, 60.0, "UNKNOWN_EFFECT")]
    assert rows(alerts.naming_allowed(df, "city", ["c"], ["r2", "r3"]), "alert_id") == [("b",), ("gone",)]
    assert alerts.naming_allowed(df, "city", ["c"], []).count() == 0 and alerts.naming_allowed(df, "city", [], []).count() == 6
    assert alerts.daily(alerts.exploded(df.where("false")), spark.createDataFrame([("c", "UTC")], "city string, zone string")).count() == 0


# sources, sinks, streams


def test_objects_of_responses(spark):
    train = {"@type": "odpt:Train", "@id": "1", "owl:sameAs": "odpt.Train:X.L.1", "dc:date": "2026-09-01T11:02:15+09:00", "odpt:delay": 60}
    quiet, note = {"@type": "odpt:TrainInformation", "owl:sameAs": "n0"}, {"@type": "odpt:TrainInformation", "owl:sameAs": "n1", "odpt:trainInformationStatus": {"ja": "遅延"}, "dc:date": "bad"}
    df = odpt.objects(spark.createDataFrame([(1, json.dumps([train, quiet])), (2, json.dumps(note)), (3, "[]"), (4, "broken"), (5, None)], "response int, value string"))
    r = odpt.trains(df).collect()
    assert [(x.trip_id, x.timestamp, x.delay_sec, x.origin_stations) for x in r] == [("X.L.1", 1_788_228_135, 60, [])]
    assert rows(odpt.notices(df), "alert_id", "header_text") == [("n1", "遅延")]
    assert rows(odpt.envelopes(df, ["response"]), "response", "feed", "records", "feed_ts") == [(1, "odpt_trains", 1, 1_788_228_135), (2, "alerts", 1, None)]
    tails = spark.createDataFrame([("a:b:c",), ("plain",), ("",), (None,)], "u string").select(odpt.tail(F.col("u")).alias("t")).collect()
    assert [x.t for x in tails] == ["b:c", "plain", None, None]


def test_city_configurations(spark):
    text = json.dumps({"city": "c", "agency": "a", "timezone": "UTC", "adapter": "x", "feeds": {"one": "http://u", "two": {"url": "http://v", "poll_seconds": 90, "adapter": "y", "auth": {"env": "K"}}}})
    assert rows(readers.city_config(spark.createDataFrame([(text,), ("{}",), (None,)], "value string")), "endpoint", "url", "adapter", "poll_seconds", "credential") == [("one", "http://u", "x", 30, None), ("two", "http://v", "y", 90, "K")]


def test_tables_refuse_what_they_cannot_hold(spark, tmp_path):
    name = "evolving_" + tmp_path.name.replace("-", "_")
    sinks.ensure_table(spark, name, "a INT", location=str(tmp_path / "t"))
    assert sinks.evolve_table(spark.createDataFrame([(1, "x")], "a int, b string"), name) == ["b"] and sinks.evolve_table(spark.createDataFrame([(2,)], "a int"), name) == []
    assert rows(spark.table(name), "a", "b") == [(1, "x"), (2, None)]
    with pytest.raises(ValueError, match="type"):
        sinks.evolve_table(spark.createDataFrame([("z",)], "a string"), name)
    sinks.write_version(spark.range(3), str(tmp_path / "v"), "20250101")
    assert sinks.rolled_back(spark, str(tmp_path / "v"), "2026", 3).count() == 3
    for before, least in (("2024", 1), ("2026", 4)):
        with pytest.raises(ValueError):
            sinks.rolled_back(spark, str(tmp_path / "v"), before, least)


def test_batch_keeps_the_first_row_of_an_identity(spark):
    row = {"city": "c", "trip_uid": "t", "vehicle_id": "v", "ts_utc": at(8), "current_status": "S", "stop_id": "p"}
    df = spark.createDataFrame([(*row.values(), at(h), f"label{h}") for h in (9, 7, 8)], "city string, trip_uid string, vehicle_id string, ts_utc timestamp, current_status string, stop_id string, fetched_at timestamp, label string")
    assert rows(silver.deduplicated(df.repartition(3), "vehicle_positions"), "label") == [("label7",)]

"""Core operators on edge cases and against plain Python."""

import datetime as dt
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidetable.functions import domain
from tidetable.operators import intervals, joins, quality, rollup, service

D = dt.date


def ts(s):
    return dt.datetime.fromisoformat(s) if s else None


def one(spark, column, **values):
    row = [tuple(values.values())]
    schema = ", ".join(f"{k} {t}" for k, t in one.types.items() if k in values)
    return spark.createDataFrame(row, schema).select(column.alias("x")).collect()[0].x


one.types = {"s": "string", "d": "date", "i": "int", "j": "int", "t": "timestamp", "u": "timestamp", "z": "string"}


def test_clocks_and_service_days(spark):
    clocks = ["00:00:00", "08:15:30", "24:00:00", "25:30:00", "7:05:00", "", None, "x:y:z", "1:2"]
    got = [r.x for r in spark.createDataFrame([(c,) for c in clocks], "s string").select(domain.gtfs_seconds(F.col("s")).alias("x")).collect()]
    assert got == [0, 29_730, 86_400, 91_800, 25_500, None, None, None, None]
    cases = [("America/New_York", 12, "2026-08-23 05:30", D(2026, 8, 22)), ("America/New_York", 12, "2026-08-22 17:00", D(2026, 8, 22)), ("America/Toronto", 4, "2026-08-22 10:00", D(2026, 8, 22)), ("America/Toronto", 12, "2026-08-22 10:00", D(2026, 8, 21)),
             ("America/Toronto", 4, "2026-08-22 07:00", D(2026, 8, 21)), ("Asia/Tokyo", 3, "2026-08-31 16:00", D(2026, 8, 31)), ("Asia/Tokyo", 3, "2026-08-31 20:00", D(2026, 9, 1)), (None, None, "2026-08-22 11:00", D(2026, 8, 21))]
    df = spark.createDataFrame([(z, c, ts(t), None) for z, c, t, _ in cases], "z string, c int, t timestamp, s string")
    assert [r.x for r in df.select(domain.service_date(F.col("s"), F.col("t"), F.col("z"), F.col("c")).alias("x")).collect()] == [w for *_, w in cases]
    assert one(spark, domain.service_date(F.col("s"), F.col("t"), F.col("z"), F.lit(12)), s="20250102", t=ts("2025-05-05"), z="Asia/Tokyo") == D(2025, 1, 2)


def test_scheduled_instants_across_clock_changes(spark):
    for day, clock, want in [(D(2026, 8, 22), "08:15:30", "2026-08-22 12:15:30"), (D(2026, 8, 22), "25:30:00", "2026-08-23 05:30:00"), (D(2026, 3, 7), "25:30:00", "2026-03-08 06:30:00"), (D(2026, 3, 7), "27:30:00", "2026-03-08 08:30:00")]:
        got = one(spark, domain.scheduled_instant(F.col("d"), domain.gtfs_seconds(F.col("s")), "America/New_York").cast("string"), s=clock, d=day)
        assert got == want


def test_bands_identity_and_delay(spark):
    bands = [r.x for r in spark.createDataFrame([(x,) for x in (-61, -60, 299, 300, 899, 900, None)], "i int").select(domain.otp_band(F.col("i")).alias("x")).collect()]
    assert bands == ["early", "on_time", "on_time", "late", "late", "very_late", None]
    ids = spark.createDataFrame([("c", D(2025, 1, 1), None, None, None, None), ("c", D(2025, 1, 1), "", "", 1, "x"), ("c", D(2025, 1, 1), "t", None, None, None), ("c", D(2025, 1, 1), None, "r", None, None)], "c string, d date, t string, r string, i int, s string")
    got = [r.x for r in ids.select(domain.trip_uid(*[F.col(c) for c in "cdtris"]).alias("x")).collect()]
    assert got[:2] == [None, None] and got[2] and got[3] and got[2] != got[3]
    a, b = ts("2025-01-01 10:10:00"), ts("2025-01-01 10:00:00")
    assert one(spark, domain.effective_delay(F.col("i"), F.col("t"), F.col("u")), i=90_000, t=a, u=b) == 600
    assert one(spark, domain.effective_delay(F.col("i"), F.col("t"), F.col("u")), i=-5, t=a, u=b) == -5
    assert one(spark, domain.effective_delay(F.col("i"), F.col("t"), F.col("u")), i=90_000, t=a, u=None) is None


def test_small_functions(spark):
    assert one(spark, domain.alert_effect_rank(F.col("s")), s="NO_SERVICE") == 1 and one(spark, domain.alert_effect_rank(F.col("s")), s=None) == 12
    assert one(spark, domain.gtfs_mode(F.col("i")), i=702) == "bus" and one(spark, domain.gtfs_mode(F.col("i")), i=None) == "other"
    assert one(spark, domain.ratio(F.col("i"), F.col("j")), i=1, j=0) is None
    assert one(spark, domain.clamp(F.col("i"), 0.0, 9.0), i=None) is None
    assert one(spark, domain.delay_colour(F.col("i")), i=None) == [128, 128, 128, 90]
    assert one(spark, domain.geo_cell(F.col("i").cast("double"), F.col("j").cast("double"), 4), i=90, j=-180) == "4-15-0" and one(spark, domain.geo_cell(F.col("i").cast("double"), F.col("j").cast("double")), i=91, j=0) is None


def test_asof_agrees_with_join_and_rank(spark):
    rng = random.Random(3)
    left = [(i, rng.choice(["a", "b", None]), rng.choice([None, *range(50)])) for i in range(300)]
    right = [(rng.choice(["a", "b", None]), rng.choice([None, *range(50)]), rng.randint(0, 9)) for _ in range(120)]
    ldf, rdf = spark.createDataFrame(left, "i int, k string, t int"), spark.createDataFrame(right, "k string, s int, v int")
    got = {r.i: (r.asof_time, r.v) for r in joins.asof_backward(ldf, rdf, ["k"], "t", "s", ["v"]).collect()}
    assert len(got) == 300
    for i, k, t in left:
        fit = [(s, -v) for rk, s, v in right if None not in (k, t, s, rk) and rk == k and s <= t]
        want = max(fit) if fit else None
        assert got[i] == ((want[0], -want[1]) if want else (None, None))
    strict = {r.i: r.asof_time for r in joins.asof_backward(ldf, rdf, ["k"], "t", "s", ["v"], allow_equal=False).collect()}
    assert all(strict[i] is None or strict[i] < t for i, _, t in left)
    assert joins.asof_backward(ldf.where("false"), rdf, ["k"], "t", "s", ["v"]).count() == 0


def test_nearest_within_and_priority(spark):
    rng = random.Random(9)
    left = [(i, rng.choice(["a", None]), rng.choice([None, *range(-40, 200)])) for i in range(200)]
    right = [(j, rng.choice(["a", None]), rng.choice([None, *range(-40, 200)])) for j in range(60)]
    got = {r.i: (r.distance, r.j) for r in joins.nearest_within(spark.createDataFrame(left, "i int, k string, t int"), spark.createDataFrame(right, "j int, k string, s int"), "i", "j", ["k"], "t", "s", 4).collect()}
    want = {}
    for i, k, t in left:
        fit = [(abs(t - s), j) for j, rk, s in right if None not in (k, t, rk, s) and abs(t - s) <= 4]
        if fit:
            want[i] = min(fit)
    assert got == want
    a, b = spark.createDataFrame([(1, "x")], "i int, m string"), spark.createDataFrame([(1, "a"), (2, "b"), (2, "a")], "i int, m string")
    assert sorted(map(tuple, joins.resolve_priority([a, b], "i").collect())) == [(1, "x"), (2, "a")]


def test_intervals_inside_overlap_and_anti(spark):
    gaps = spark.createDataFrame([("a", 10, 20), ("a", 15, 30), (None, 0, 99), ("b", None, 5)], "k string, s int, e int")
    points = spark.createDataFrame([("a", 10), ("a", 11), ("a", 30), ("b", 3), (None, 5), ("a", None)], "k string, t int")
    assert [r.inside for r in joins.inside_interval(points, gaps, ["k"], "t", "s", "e").collect()] == [False, True, False, False, False, False]
    assert [r.inside for r in joins.inside_interval(points, gaps, ["k"], "t", "s", "e", strict=False).collect()] == [True, True, True, False, False, False]
    spans = spark.createDataFrame([("a", 0, 10), ("a", 0, 11), ("a", 29, 40), ("a", None, 40), ("c", 0, 99)], "k string, a int, b int")
    assert sorted((r.k, r.a, r.b) for r in joins.without_overlap(spans, gaps, ["k"], "a", "b", "s", "e").where("a IS NOT NULL").collect()) == [("a", 0, 10), ("c", 0, 99)]
    left, right = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string"), spark.createDataFrame([(1, None)], "a int, b string")
    assert [tuple(r) for r in joins.null_safe_anti(left, right, ["a", "b"]).collect()] == [(2, "x")]


def test_allow_list_drops_restricted_scope_without_list(spark):
    df = spark.createDataFrame([("z", "1"), ("z", "2"), ("q", "9"), (None, "1")], "city string, route string")
    listed = spark.createDataFrame([("z", "1")], "city string, route string")
    assert sorted((r.city or "", r.route) for r in joins.allow_listed(df, listed, ["z"], "city", "route").collect()) == [("", "1"), ("q", "9"), ("z", "1")]
    assert joins.allow_listed(df, listed.where("false"), ["z"], "city", "route").count() == 2


def test_rekey_recovery(spark):
    left = spark.createDataFrame([("t1", "r", 100), ("t2", "r", 5000)], "trip string, route string, at int")
    exact = spark.createDataFrame([("t1", 200), ("t2", 100)], "trip string, o int")
    second = spark.createDataFrame([("r", 5000, "s9"), ("r", 100, "s1")], "route string, at int, static string")
    assert [(r.trip, r.static) for r in joins.unmatched_then(left, exact, second, "trip", ["route"], "at", "o", 1800).collect()] == [("t2", "s9")]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 60), st.integers(0, 15)), min_size=1, max_size=40))
def test_islands_have_the_union_length(spark, spans):
    df = spark.createDataFrame([(k, a, a + n) for k, a, n in spans], "k string, a int, b int")
    merged = intervals.merge_islands(df, ["k"], "a", "b").collect()
    assert sum(r.parts for r in merged) == len(spans)
    for key in "ab":
        points = {x / 2 for k, a, n in spans if k == key for x in range(2 * a, 2 * (a + n) + 1)}
        mine = sorted((r.a, r.b) for r in merged if r.k == key)
        assert {x / 2 for a, b in mine for x in range(2 * a, 2 * b + 1)} == points
        assert all(p[1] < q[0] for p, q in zip(mine, mine[1:], strict=False))


def test_gaps_sessions_and_days(spark):
    beats = spark.createDataFrame([("a", ts(t)) for t in ("2025-01-01 00:00:05", "2025-01-01 00:00:45", "2025-01-01 00:10:00", "2025-01-01 00:21:00", None)], "k string, t timestamp")
    g = intervals.gaps(intervals.heartbeat(beats, ["k"], "t"), ["k"]).collect()
    assert [(str(r.gap_start), str(r.gap_end), r.gap_seconds) for r in g] == [("2025-01-01 00:11:00", "2025-01-01 00:21:00", 660)]
    assert sorted(r.events for r in intervals.sessions(beats, ["k"], "t", 555).collect()) == [1, 3]
    d = intervals.by_day(spark.createDataFrame([(ts("2025-01-01 23:00"), ts("2025-01-03 00:00")), (ts("2025-01-02"), ts("2025-01-01"))], "a timestamp, b timestamp"), "a", "b").collect()
    assert [(str(r.day), str(r.a), str(r.b)) for r in sorted(d, key=lambda r: r.day)] == [("2025-01-01", "2025-01-01 23:00:00", "2025-01-02 00:00:00"), ("2025-01-02", "2025-01-02 00:00:00", "2025-01-03 00:00:00"), ("2025-01-03", "2025-01-03 00:00:00", "2025-01-03 00:00:00")]


def test_composite_ignores_absent_parts_and_stays_in_bounds(spark):
    df = spark.createDataFrame([(50.0, 150.0, None), (None, None, None), (0.0, -5.0, None)], "a double, b double, c double")
    got = [r.x for r in df.select(rollup.composite([(F.col("a"), 0.5), (F.col("b"), 0.3), (F.col("c"), 0.2)]).alias("x")).collect()]
    assert abs(got[0] - (25 + 30) / 0.8) < 1e-9 and got[1] is None and got[2] == 0.0


def test_weighted_mean_without_evidence(spark):
    df = spark.createDataFrame([("a", None, 5), ("b", 2.0, 1), ("b", None, 9), ("b", 4.0, 3)], "k string, x double, w int")
    assert {r.k: r.m for r in df.groupBy("k").agg(rollup.weighted_mean(F.col("x"), F.col("w")).alias("m")).collect()} == {"a": None, "b": 3.5}


def test_service_dates_and_schedule(spark):
    cal = spark.createDataFrame([("c", "s", 1, 1, 1, 1, 1, 0, 0, "20250101", "20250110"), ("c", "x", 1, 1, 1, 1, 1, 1, 1, "bad", "20250110")], "city string, service_id string, monday int, tuesday int, wednesday int, thursday int, friday int, saturday int, sunday int, start_date string, end_date string")
    ex = spark.createDataFrame([("c", "s", "20250102", 2), ("c", "s", "20250104", 1), ("c", "s", "20250103", 1)], "city string, service_id string, date string, exception_type int")
    days = spark.sql("SELECT explode(sequence(DATE '2025-01-01', DATE '2025-01-07', INTERVAL 1 DAY)) AS service_date")
    dates = service.service_dates(cal, ex, days, ["city"])
    assert sorted(r.service_date.day for r in dates.collect()) == [1, 3, 4, 6, 7]
    trips = spark.createDataFrame([("c", "t", "s")], "city string, trip_id string, service_id string")
    calls = spark.createDataFrame([("c", "t", "A", 1, "25:30:00")], "city string, trip_id string, stop_id string, stop_sequence int, arrival_time string")
    zones = spark.createDataFrame([("c", "Asia/Tokyo")], "city string, zone string")
    got = service.scheduled_stop_times(trips, dates, calls, zones, ["city"]).where("service_date = DATE '2025-01-01'").collect()
    assert str(got[0].sched_arr_ts_utc) == "2025-01-01 16:30:00"


def test_passages_take_the_first_snapshot_past_the_stop(spark):
    snaps = spark.createDataFrame([("t", 1, 100, 5), ("t", 3, 160, 30), ("t", 5, 220, 60)], "train string, pos int, at int, delay int")
    stops = spark.createDataFrame([("t", "A", 2, 1), ("t", "B", 5, 1), ("t", "C", 6, 1), ("t", "D", 4, -1)], "train string, stop string, stop_pos int, sign int")
    got = {r.stop: (r.passed_at, r.stated_delay) for r in service.passages(snaps, stops, ["train"], "pos", "at", "sign", "stop_pos", "delay").collect()}
    assert got == {"A": (160, 30), "B": (220, 60), "D": (100, 5)}


def test_finalize_is_replayable_and_drops_stale(spark):
    rows = [("v", ts("2025-01-01 10:00"), ts("2025-01-01 09:50"), 1), ("v", ts("2025-01-01 10:05"), ts("2025-01-01 10:04"), 2), ("v", ts("2025-01-01 10:06"), ts("2025-01-01 11:00"), 3), ("w", ts("2025-01-01 12:55"), ts("2025-01-01 12:00"), 4), ("x", None, ts("2025-01-01 13:00"), 5)]
    out = service.finalize(spark.createDataFrame(rows, "visit string, arr timestamp, seen timestamp, no int"), ["visit"], "arr", "seen").collect()
    assert [(r.visit, r.no, r.n_predictions) for r in out] == [("v", 2, 2)]


def test_contracts(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", None), (2, None, -1)], "i int, s string, v int")
    assert quality.out_of_range(df, "v", 0, 4).count() == 2 and quality.out_of_range(df, "v", 5, None, strict_low=True).count() == 2
    assert quality.duplicates(df, ["i"]).collect()[0].n == 2 and quality.unaccepted(df, "s", ["a"]).count() == 1 and quality.nulls(df, "s").count() == 1
    assert quality.orphans(df, ["s"], df.where("s = 'a'"), ["s"]).count() == 1
    v = spark.createDataFrame([("a", D(2025, 1, 1), D(2025, 2, 1)), ("a", D(2025, 1, 15), None), ("a", D(2025, 3, 1), None), ("b", D(2025, 1, 1), None)], "k string, f date, t date")
    assert quality.overlapping_versions(v, ["k"], "f", "t").count() == 2


def test_rollups_on_empty_tables(spark):
    e = spark.createDataFrame([], "k string, v int, w int, x boolean, y boolean")
    assert rollup.histogram(e, ["k"], "v", 0, 10, 1).count() == rollup.nearest_rank(e, ["k"], "v", {"p": 0.5}).count() == rollup.standardised(e, ["k"], "w", "x", "y").count() == rollup.excess_wait(e, ["k"], ["w"], "v", "w").count() == 0
    assert service.headways(spark.createDataFrame([], "k string, a timestamp, s timestamp, n int"), ["k"], "a", "s", "n").count() == 0
    assert intervals.merge_islands(spark.createDataFrame([], "k string, a int, b int"), ["k"], "a", "b").count() == 0

"""Operators of the general training-data problems on edge cases, and against plain Python."""

import datetime as dt
import re

import brute
import pytest
from pyspark.sql import functions as F

from tidetable.operators import asof, dedup, history, late, timestamps
from tidetable.plans import problems
from tidetable.session import load


def ts(s):
    return dt.datetime.fromisoformat(s) if s else None


# deduplication


def messages(spark, rows):
    return spark.createDataFrame(rows, "m string, v int, fetched_at timestamp, row_no bigint, copies string")


def test_redundant_nulls_ties_and_clashing_names(spark):
    rows = [("a", 1, ts("2025-01-02"), 5, "x"), ("a", 1, ts("2025-01-01"), 9, "x"), ("a", 1, ts("2025-01-01"), 7, "y"), ("a", None, ts("2025-01-01"), 1, "x"), ("a", None, None, 2, "x"), (None, None, None, 3, "x"), (None, None, None, 4, "x"), ("b", 1, None, 8, "x")]
    out = dedup.redundant(messages(spark, rows), ["m", "v"], "fetched_at", "row_no")
    assert out.columns == ["m", "v", "fetched_at", "row_no", "copies"]
    assert sorted(r.row_no for r in out.collect()) == [2, 4, 5, 9]


def test_redundant_leaves_copies_without_a_name_unless_a_named_one_is_kept(spark):
    rows = [("a", 1, ts("2025-01-01"), None, "only"), ("b", 1, ts("2025-01-02"), None, "lost"), ("b", 1, ts("2025-01-01"), 1, "kept"), ("c", 1, ts("2025-01-01"), None, "kept"), ("c", 1, ts("2025-01-02"), 2, "lost"), (None, None, None, None, "only"),
            ("d", None, None, None, "lost"), ("d", None, None, 7, "kept")]
    assert sorted((r.m, r.copies) for r in dedup.redundant(messages(spark, rows), ["m", "v"], "fetched_at", "row_no").collect()) == [("b", "lost"), ("c", "lost"), ("d", "lost")]


def test_redundant_tells_messages_apart_as_the_keepers_do(spark):
    rows = [(m, v, ts("2025-01-01"), None, c) for m in ("", "a", "ab", None) for v in (0, 1, -1, None) for c in ("", "b", None)] * 2
    df = spark.createDataFrame(rows, "m string, v int, fetched_at timestamp, row_no bigint, copies string").withColumn("row_no", F.monotonically_increasing_id())
    df = spark.createDataFrame(df.collect(), df.schema)
    kept = dedup.keepers(df.withColumn("k", F.col("row_no")), ["m", "v", "copies"], "fetched_at", "row_no").select("row_no").collect()
    lost = dedup.redundant(df, ["m", "v", "copies"], "fetched_at", "row_no").collect()
    assert len(kept) == 48 and len(lost) == 48 and not {r.row_no for r in kept} & {r.row_no for r in lost}


def test_keepers_count_copies_and_negative_ties(spark):
    rows = [("a", 1, ts("2025-01-01"), -(2**62), "x"), ("a", 1, ts("2025-01-01"), 2**62, "x"), ("a", 1, ts("1960-01-01"), 3, "x")]
    r = dedup.keepers(messages(spark, rows), ["m", "v"], "fetched_at", "row_no").collect()
    assert [(x.row_no, x.copies) for x in r] == [(3, 3)]


def test_dedup_empty(spark):
    assert dedup.redundant(messages(spark, []), ["m"], "fetched_at", "row_no").count() == 0
    assert dedup.keep_first(messages(spark, []), ["m"], ["fetched_at"]).count() == 0


def test_keep_first_is_whole_and_unique(spark):
    rows = [("a", 1, None, 5, "x"), ("a", 2, ts("2025-01-01"), 9, "z"), ("a", 2, ts("2025-01-01"), 9, "z"), (None, 1, None, None, None)]
    out = dedup.keep_first(messages(spark, rows), ["m"], ["fetched_at"]).collect()
    assert sorted((r.m or "", r.v, r.row_no) for r in out) == [("", 1, None), ("a", 2, 9)]


def test_dedup_uses_hash_aggregation_with_partial_step(spark, data):
    plan = problems.p2_found(spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("HashAggregate") >= 2


# attributes as known


def dim(spark, rows):
    return spark.createDataFrame(rows, "k string, valid_from date, valid_to date, colour string, size int")


def events(spark, rows):
    return spark.createDataFrame(rows, "no int, k string, day date, known_colour string")


D = dt.date


def test_attributes_change_apart_and_end(spark):
    d = dim(spark, [("a", D(2025, 1, 1), D(2025, 2, 1), "red", 1), ("a", D(2025, 2, 1), D(2025, 3, 1), "red", 2), ("a", D(2025, 4, 1), None, "blue", None), (None, D(2025, 1, 1), None, "x", 1), ("a", D(2025, 1, 1), D(2025, 2, 1), "red", 1)])
    e = events(spark, [(i, k, day, "mine") for i, (k, day) in enumerate([("a", D(2024, 12, 31)), ("a", D(2025, 1, 1)), ("a", D(2025, 2, 1)), ("a", D(2025, 3, 1)), ("a", D(2025, 4, 2)), ("b", D(2025, 1, 1)), (None, D(2025, 1, 1)), ("a", None), ("a", D(2025, 2, 1))])])
    out = {r.no: (r.known_colour, r.known_size, r.known_present) for r in asof.attributes_as_known(e, d, ["k"], "day", "valid_from", "valid_to", ["colour", "size"]).collect()}
    none = (None, None, False)
    assert out == {0: none, 1: ("red", 1, True), 2: ("red", 2, True), 3: none, 4: ("blue", None, True), 5: none, 6: none, 7: none, 8: ("red", 2, True)}


def test_histories_hold_one_row_per_change(spark):
    d = dim(spark, [("a", D(2025, 1, 1), D(2025, 2, 1), "red", 1), ("a", D(2025, 2, 1), None, "red", 2)])
    h = asof.change_histories(d, ["k"], "valid_from", "valid_to", ["colour", "size"])
    assert sorted((r.attribute, str(r.since), r.value) for r in h.collect()) == [("colour", "2025-01-01", "red"), ("size", "2025-01-01", "1"), ("size", "2025-02-01", "2")]


def test_attributes_of_empty_tables(spark):
    assert asof.attributes_as_known(events(spark, []), dim(spark, []), ["k"], "day", "valid_from", "valid_to", ["colour"]).count() == 0
    one = asof.attributes_as_known(events(spark, [(1, "a", D(2025, 1, 1), None)]), dim(spark, []), ["k"], "day", "valid_from", "valid_to", ["colour"]).collect()
    assert [(r.known_colour, r.known_present) for r in one] == [(None, False)]


# history


def test_history_absence_change_and_redownload(spark):
    s = "c string, v string, d date, r string, name string, kind int"
    days = [D(2025, 1, i) for i in (1, 2, 3, 4, 5)]
    rows = [("c", f"v{i}", days[i], "a", n, 1) for i, n in [(0, "x"), (1, "x"), (2, "y"), (4, "y")]] + [("c", f"v{i}", days[i], "b", None if i % 2 else "", 1) for i in range(5)]
    rows += [rows[0], ("c", None, days[0], "a", "x", 1), (None, "v0", days[0], "a", "x", 1), ("c", "v0", days[0], None, "x", 1)]
    out = history.snapshot_history(spark.createDataFrame(rows, s), ["c"], ["r"], "v", "d", ["name", "kind"]).collect()
    got = sorted((r.r, str(r.valid_from), str(r.valid_to), r.v, r.is_current) for r in out)
    assert got == [("a", "2025-01-01", "2025-01-03", "v0", False), ("a", "2025-01-03", "2025-01-04", "v2", False), ("a", "2025-01-05", "None", "v4", True), ("b", "2025-01-01", "None", "v0", True)]
    assert history.snapshot_history(spark.createDataFrame([], s), ["c"], ["r"], "v", "d", ["name"]).count() == 0


def test_state_hash_keeps_values_apart(spark):
    rows = spark.createDataFrame([("ab", ""), ("a", "b"), (None, "ab"), ("", "ab")], "x string, y string").select(history.state_hash(["x", "y"]).alias("h")).collect()
    assert len({r.h for r in rows[:3]}) == 3 and rows[2].h == rows[3].h


# late events


def test_triangle_counts_revisions_and_cuts(spark):
    h = 3_600
    rows = [("e", "v1", 10, (h + 60) * 10**6), ("e", "v1", 10, (h + 9000) * 10**6), ("e", "v2", 20, (h + 601) * 10**6), ("e", "v3", 30, (h + 600) * 10**6), ("e", "v4", 40, (h + 7200) * 10**6), ("e", "v5", 50, (h + 7200) * 10**6 + 1),
            ("e", None, 60, (h - 9) * 10**6), ("e", None, 60, (h - 9) * 10**6), (None, "v", 10, 0), ("e", "v6", None, 5), ("e", "v7", 70, None)]
    cells = late.triangle(spark.createDataFrame(rows, "endpoint string, record string, event_s bigint, arrival_us bigint"), "endpoint", 3600, 600, 7200)
    got = sorted((r.endpoint or "", r.arrival_period, r.arrived) for r in cells.collect())
    assert got == [("", 0, 1), ("e", 0, 1), ("e", 1, 2), ("e", 2, 1), ("e", 12, 1)]
    rev = sorted((r.revision, r.total, r.is_final) for r in late.revisions(cells, "endpoint").where("endpoint = 'e'").collect())
    assert rev == [(1, 1, False), (2, 3, False), (3, 4, False), (4, 5, True)]


def test_triangle_cuts_at_the_cutoff_that_the_step_does_not_divide(spark):
    rows = [("e", f"v{late_s}", 10, (3600 + late_s) * 10**6) for late_s in (600, 650, 700, 701)]
    cells = late.triangle(spark.createDataFrame(rows, "endpoint string, record string, event_s bigint, arrival_us bigint"), "endpoint", 3600, 600, 700)
    assert sorted((r.arrival_period, r.arrived) for r in cells.collect()) == [(1, 1), (2, 2)]
    fixed = late.corrected(late.revisions(cells, "endpoint"), "endpoint", 1).collect()
    assert [(r.endpoint, r.period_start, r.first_total, r.final_total) for r in fixed] == [("e", 0, 1, 3)]
    assert late.corrected(late.revisions(cells, "endpoint"), "endpoint", 2).count() == 0


def test_p4_found_comes_from_the_running_sums(spark, data):
    assert "Window" in problems.p4_found(spark, data)._jdf.queryExecution().optimizedPlan().toString()


# timestamps

CASES = [
    ("2025-10-04T02:35:02Z", "Asia/Tokyo", None), ("2025-10-05 07:44:52", "Europe/Helsinki", None), ("2025-10-04T07:35:45.8369999Z", "Asia/Tokyo", None), ("05.10.2025 04:38:26", "Europe/Zurich", None), ("2025/10/05 13:38:08", "Asia/Tokyo", None),
    ("05/10/2025 03:04:40", "Europe/Zurich", 1759626280), ("10/05/2025 03:04:40", "America/New_York", 1759647880), ("10/11/2025 7:50:56 PM", "America/New_York", 1760226656), ("10/6/2025 12:35:20 AM", "America/St_Johns", 1759720000),
    ("2025-10-05 00:04:23+10:30", "Asia/Tokyo", None), ("2025-10-05T09:10:34+1100", "Asia/Tokyo", None), ("Mon, 06 Oct 2025 00:00:33 GMT", "Asia/Tokyo", None), ("2025-10-15 12:22:09 EEST", "Europe/Helsinki", None), ("2025-10-10 21:48:41 IST", "Asia/Kolkata", None),
    ("20251004T024850Z", "Asia/Tokyo", None), ("1759563781232", "Asia/Tokyo", None), ("1759603765.107", "Asia/Tokyo", None), ("1759602037", "Asia/Tokyo", None), ("  2025-10-05t01:31:07z ", "Asia/Tokyo", None), ("2025-10-04T11:39Z", "Asia/Tokyo", None),
    ("2025-10-06T02:10:49+02:00[Europe/Zurich]", "Asia/Tokyo", None), ("2025年9月20日 14時00分", "Asia/Tokyo", None), ("２０２５-09-20 １４：00", "Asia/Tokyo", None),
    ("2025-11-02 01:30:00", "America/New_York", 1762063200), ("2025-11-02 01:30:00", "America/New_York", 1762067000), ("2025-10-26 02:30:00 CET", "Europe/Zurich", None), ("2025-10-05 01:45:00", "Australia/Lord_Howe", None), ("2026-04-05 01:45:00", "Australia/Lord_Howe", 1775315700),
    (None, "Asia/Tokyo", 1), ("", "Asia/Tokyo", 1), ("pending", "Asia/Tokyo", 1), ("2025-02-30 10:00:00", "Asia/Tokyo", 1), ("2025-10-04T25:00:00Z", "Asia/Tokyo", 1), ("13/13/2025 10:00:00", "Asia/Tokyo", 1), ("x" * 100_000, "Asia/Tokyo", 1),
]


def normalised(spark, rows):
    df = spark.createDataFrame([(i, t, z, None if f is None else f * 10**6, s) for i, (t, z, f, s) in enumerate(rows)], "i int, t string, z string, near bigint, src string")
    return {r.i: r for r in timestamps.normalise(df, "t", "z", "src", "near").collect()}


def test_spellings_match_plain_python(spark):
    got = normalised(spark, [(*c, "s") for c in CASES])
    assert len(got) == len(CASES)
    for i, (t, z, f) in enumerate(CASES):
        want = brute.read(t, z, f) if t is None or len(t) < 1000 else None
        assert got[i].utc_micros == want, (t, z, f, got[i])
        assert (got[i].status == "unreadable") == (want is None)


def test_mixture_learns_the_order_of_a_source(spark):
    z = "Asia/Tokyo"
    clear = [(f"{d:02d}/10/2025 10:00:00", z, None, "eu") for d in range(13, 29)] + [(f"10/{d:02d}/2025 10:00:00", z, None, "us") for d in range(13, 29)]
    got = normalised(spark, [*clear, ("05/10/2025 10:00:00", z, None, "eu"), ("10/05/2025 10:00:00", z, None, "us")])
    eu, us = got[len(clear)], got[len(clear) + 1]
    assert (eu.reading, us.reading, eu.status, us.status) == ("day_first", "month_first", "by mixture", "by mixture")
    assert eu.utc_micros == us.utc_micros and eu.posterior > 0.9


def test_what_no_evidence_settles_is_marked(spark):
    got = normalised(spark, [("05/10/2025 10:00:00", "Asia/Tokyo", None, "s"), ("05/05/2025 10:00:00", "Asia/Tokyo", None, "s"), ("2025-01-01 00:00:00", None, None, "s")])
    assert got[0].status == "ambiguous" and got[0].posterior == pytest.approx(0.5)
    assert got[1].status == "certain" and got[2].status == "unreadable"


def test_evidence_is_weighed_within_the_mixture(spark):
    z = "Asia/Tokyo"
    clear = [(f"{d:02d}/10/2025 10:00:00", z, None, "eu") for d in range(13, 29)]
    at = brute.micros(dt.datetime(2025, 5, 10, 1, tzinfo=dt.UTC)) // 10**6
    got = normalised(spark, [*clear, ("10/05/2025 10:00:00", z, None, "eu"), ("10/05/2025 10:00:00", z, at + 7200, "eu"), ("05/10/2025 10:00:00", z, at + 7200, "eu"), ("2025-11-02 01:30:00", "America/New_York", None, "eu"), (None, z, 1, "eu")])
    assert [(got[i].reading, got[i].status) for i in range(len(clear), len(clear) + 5)] == [
        ("day_first", "by mixture"), ("day_first", "by evidence"), ("month_first", "by evidence"), ("plain", "ambiguous"), (None, "unreadable")]


def test_skipped_local_time_is_read_with_the_offset_before(spark):
    got = normalised(spark, [("2025-03-09 02:30:00", "America/New_York", None, "s")])
    assert got[0].utc_micros == brute.micros(dt.datetime(2025, 3, 9, 7, 30, tzinfo=dt.UTC))


def test_running_clock(spark):
    rows = [(["23:50", None, "0010", "２４：20", "0:05", "x"],), ([],), (None,)]
    out = [r.c for r in spark.createDataFrame(rows, "a array<string>").select(timestamps.running_clock(F.col("a")).alias("c")).collect()]
    assert [(x.item, x.seconds) for x in out[0]] == [(1, 85_800), (3, 87_000), (4, 86_400 + 87_600), (5, 2 * 86_400 + 300)]
    assert out[1] == [] and out[2] is None


def test_p7_and_p4_match_plain_python(spark, data):
    tz = {r.city_key: r.iana_tz for r in load(spark, data, "dim_city").collect()}
    want, arrival, first = set(), {}, {}
    envelopes = load(spark, data, "envelope").collect()
    for r in envelopes:
        m = brute.read(r.fetched_at, tz[r.city], r.feed_ts)
        if m is not None:
            arrival[r.envelope_id] = m
            if not re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", r.fetched_at):
                want.add(("envelope", r.envelope_id, 0, m))
    for r in load(spark, data, "tokyo_odpt_train_timetable").collect():
        want |= {("timetable", r.timetable_id, i, m) for i, m in brute.timetable(r.dc_date, [x.departure_time for x in r.odpt_train_timetable_object or []])}
    assert {tuple(r) for r in problems.p7_found(spark, data).collect()} == want
    for r in envelopes:
        for x in (r.payload or []) if r.envelope_id in arrival else []:
            own = x.timestamp if x.timestamp is not None else r.feed_ts
            if own is not None:
                k = (r.endpoint, x.vehicle_id, own)
                first[k] = min(first.get(k, 1 << 62), arrival[r.envelope_id])
    end = lambda o: (o // 3600 + 1) * 3600 * 10**6
    hours = {(e, o // 3600 * 3600) for (e, _, o), a in first.items() if end(o) + 600 * 10**6 < a <= end(o) + 7200 * 10**6}
    assert {tuple(r) for r in problems.p4_found(spark, data).collect()} == hours


def test_clashing_names_are_kept_or_replaced(spark):
    df = spark.createDataFrame([("2025-01-01 00:00:00", "Asia/Tokyo", "s", 7, 8, "old")], "t string, z string, src string, _t int, _kind int, status string")
    r = timestamps.normalise(df, "t", "z", "src").collect()[0]
    assert (r._t, r._kind, r.status, r.utc_micros) == (7, 8, "certain", brute.micros(dt.datetime(2024, 12, 31, 15, tzinfo=dt.UTC)))


def test_hot_entity_is_split_in_the_join_back(spark, tmp_path):
    n = 300_000
    hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 50_000))
    e = spark.range(n).select(F.col("id").alias("no"), hot.alias("k"), F.lit("2025-01-02").cast("date").alias("day"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    d = spark.range(50_001).select(F.when(F.col("id") == 50_000, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"), F.lit("2025-01-01").cast("date").alias("valid_from"), F.lit(None).cast("date").alias("valid_to"), F.col("id").alias("colour"))
    for name, df in (("e", e), ("d", d)):
        df.write.parquet(str(tmp_path / name))
    e, d = spark.read.parquet(str(tmp_path / "e")), spark.read.parquet(str(tmp_path / "d"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1m", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.shuffle.partitions": "24"}
    before = {c: spark.conf.get(c, None) for c in conf}
    for c, v in conf.items():
        spark.conf.set(c, v)
    try:
        out = asof.attributes_as_known(e, d, ["k"], "day", "valid_from", "valid_to", ["colour"])
        plan = out._jdf.queryExecution().executedPlan()
        assert plan.execute().count() == n
        assert "skew=true" in plan.toString()
        assert out.where("known_present").count() == n
    finally:
        for c, v in before.items():
            spark.conf.unset(c) if v is None else spark.conf.set(c, v)


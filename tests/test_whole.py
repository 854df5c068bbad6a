"""Queries that do the whole of their operator's job, on small tables of their own."""

import datetime as dt

import __spark_entry__

DAY = dt.date(2025, 3, 4)


def at(minute, second=0):
    return dt.datetime(2025, 3, 4, 6) + dt.timedelta(minutes=minute, seconds=second)


def write(spark, folder, **tables):
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def run(spark, name, folder):
    return sorted(map(tuple, __spark_entry__.queries()[name](spark, folder).collect()), key=repr)


EVENT = "event_no bigint, city_key string, service_date date, route_id string, direction_id int, stop_id string, sched_arr_ts_utc timestamp_ntz, actual_arr_ts_utc timestamp_ntz"
CITY = "city_key string, iana_tz string, schedule_matchable boolean, gap_regularity_measurable boolean"
FETCH = "city string, fetched_at timestamp_ntz"


def service(spark, folder, events, cities=(("a", "UTC", None, None),), dark=()):
    """``events`` as (number, city, route, direction, stop, scheduled, actual); feeds beat every minute but in ``dark`` ones."""
    rows = [(n, c, DAY, r, d, s, p, t) for n, c, r, d, s, p, t in events]
    beats = [(c[0], at(m)) for c in cities for m in range(-60, 300) if (c[0], m) not in dark]
    return write(spark, folder, fct_stop_events=(rows, EVENT), dim_city=(list(cities), CITY), stop_time_predictions=(beats, FETCH))


def test_headways_that_a_feed_gap_overlaps_are_left_out(spark, tmp_path):
    every = [(i, c, "r", d, "s", at(10 * i), at(10 * i, 30)) for c, d in (("a", None), ("b", 0)) for i in range(6)]
    events = [(n + 10 * (c == "b"), c, *rest) for n, c, *rest in every]
    folder = service(spark, tmp_path, events, (("a", "UTC", None, None), ("b", "UTC", True, False)), {("a", m) for m in range(21, 35)})
    kept = {r[0]: r for r in run(spark, "headways_outside_gaps", folder)}
    # a's feed is dark from 6:21 to 6:35: the gaps to events 3 (6:20 to 6:30) and 4 (6:30 to 6:40) measure nothing
    assert sorted(kept) == [1, 2, 5, 11, 12, 13, 14, 15]
    assert kept[2] == (2, 600, 600, False, False) and kept[12] == (12, 600, 600, None, None)


def test_excess_wait_is_by_slice_and_of_frequent_service(spark, tmp_path):
    late = [0, 0, 300, 300, 300, 600]
    # stop s is served every ten minutes, stop t of another route every twenty; arrivals bunch at s
    events = [(i, "a", "r", 0, "s", at(10 * i), at(10 * i, late[i])) for i in range(6)] + [(10 + i, "a", "q", 0, "t", at(20 * i), at(20 * i, 60 * i)) for i in range(6)]
    gaps = [600, 900, 600, 600, 900]
    planned = [600] * 5
    wait = lambda g: sum(x * x for x in g) / (2 * sum(g))
    assert run(spark, "route_day_excess_wait", service(spark, tmp_path, events)) == [("a", DAY, "r", 0, round(wait(gaps) - wait(planned), 4), 5)]


TRIP = "trip_uid string, city string, route_id string, direction_id int, start_time string"
STATIC = "city string, route_id string, direction_id int, trip_id string, origin_time string"


def test_origins_within_five_minutes_of_no_other_direction(spark, tmp_path):
    trips = [("far", "a", "r", 0, "08:04:00"), ("open", "a", "r", None, "08:05:00"), ("beyond", "a", "r", 0, "08:05:01"), ("other", "a", "q", 0, "08:00:00"), ("same", "a", "q", 1, "08:00:00")]
    static = [("a", "r", 0, "x", "08:00:00"), ("a", "q", 1, "y", "08:00:00"), ("a", "q", None, "z", "08:01:00")]
    folder = write(spark, tmp_path, stop_time_predictions=(trips, TRIP), gtfs_static_trips=(static, STATIC))
    assert run(spark, "nearest_origin", folder) == [("far", "x", 240), ("open", "x", 300), ("other", "z", 60), ("same", "y", 0)]
    assert run(spark, "matcher_precedence", folder) == [("far", "x", "near"), ("open", "x", "near"), ("other", "z", "near"), ("same", "y", "exact")]


def test_pivots_keep_types_of_other_hours(spark, tmp_path):
    events = [("click", at(0)), ("click", at(61)), ("view", at(61)), ("view", at(62))]
    folder = write(spark, tmp_path, events=(events, "event_type string, ts timestamp_ntz"))
    assert run(spark, "pivot_hours", folder) == [("click", 0, 1, 0, 0), ("view", 0, 0, 0, 0)]
    assert [(r[0], r[1 + 6], r[1 + 7], sum(r[1:])) for r in run(spark, "pivot_every_hour", folder)] == [("click", 1, 1, 2), ("view", 0, 2, 2)]

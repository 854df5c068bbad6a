"""Composite operators: service calendars, schedule explosion, last-prediction finalization, headways, ledgers, censuses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidetable.functions import domain
from tidetable.operators.joins import asof_backward, without_overlap
from tidetable.session import broadcast_if_small

WEEKDAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]


def service_dates(calendar: DataFrame, exceptions: DataFrame, days: DataFrame, scope: Sequence[str]) -> DataFrame:
    """Distinct ``scope``, ``service_id`` and ``service_date``: calendar days whose weekday flag is set, less removals, plus additions.

    ``calendar`` holds ``start_date`` and ``end_date`` as yyyyMMdd and the seven flags, ``exceptions`` ``date`` and
    ``exception_type`` (1 adds, 2 removes), ``days`` a column ``service_date``. The days of each service come from its own
    span by ``sequence``, so no theta join arises; ``days`` restricts them by a semi-join.
    """
    spans = calendar.select(*scope, "service_id", F.try_to_date("start_date", "yyyyMMdd").alias("a"), F.try_to_date("end_date", "yyyyMMdd").alias("b"), F.array(*[F.col(d).cast("int") for d in WEEKDAYS]).alias("flags"))
    regular = spans.where("a <= b").withColumn("service_date", F.explode(F.sequence("a", "b"))).where(F.element_at("flags", F.weekday("service_date") + 1) == 1).select(*scope, "service_id", "service_date")
    ex = exceptions.select(*scope, "service_id", F.try_to_date("date", "yyyyMMdd").alias("service_date"), F.col("exception_type").cast("int").alias("kind"))
    keys = [*scope, "service_id", "service_date"]
    left = regular.join(ex.where("kind = 2").select(*keys), keys, "left_anti")
    return left.unionByName(ex.where("kind = 1").select(*keys)).distinct().join(broadcast_if_small(days.select("service_date").distinct()), "service_date", "left_semi").select(*keys)


def scheduled_stop_times(trips: DataFrame, dates: DataFrame, stop_times: DataFrame, zones: DataFrame, scope: Sequence[str]) -> DataFrame:
    """Schedule instants: trips of each active service and day with their stop times as UTC. ``zones`` holds the first scope column and ``zone``."""
    active = trips.join(dates, [*scope, "service_id"])
    full = active.join(stop_times, [*scope, "trip_id"]).join(broadcast_if_small(zones), scope[0])
    return full.withColumn("sched_arr_ts_utc", domain.scheduled_instant(F.col("service_date"), domain.gtfs_seconds(F.col("arrival_time")), F.col("zone")))


def finalize(predictions: DataFrame, visit: Sequence[str], predicted: str, fetched: str, stale_minutes: int = 30, horizon_minutes: int = 20) -> DataFrame:
    """One row per ``visit``: the last prediction fetched no later than ``stale_minutes`` after the predicted time, with provenance.

    Adds ``n_predictions``, ``first_seen``, ``last_seen``. Visits predicted within ``horizon_minutes`` of the newest fetch of all
    are still open and left out; the horizon is data, not a clock, so a replay gives the same rows. Rows with a null
    visit column or prediction are ignored. Equal fetches: the later prediction, then the greatest other values.
    """
    p, f = F.unix_micros(F.col(predicted).cast("timestamp")), F.unix_micros(F.col(fetched).cast("timestamp"))
    ok = predictions.where(" AND ".join(f"`{c}` IS NOT NULL" for c in [*visit, predicted, fetched])).where(f <= p + stale_minutes * 60_000_000)
    newest = predictions.agg(F.max(f).alias("__newest")).scalar()
    rest = [c for c in predictions.columns if c not in (*visit, predicted, fetched)]
    last = F.max(F.struct(F.col(fetched), F.col(predicted), *rest)).alias("__m")
    one = ok.groupBy(*visit).agg(last, F.count(F.lit(1)).alias("n_predictions"), F.min(fetched).alias("first_seen"))
    closed = one.where(F.unix_micros(F.col(f"__m.{predicted}").cast("timestamp")) <= newest - horizon_minutes * 60_000_000)
    return closed.select(*visit, f"__m.{predicted}", *[f"__m.{c}" for c in rest], "n_predictions", "first_seen", F.col(f"__m.{fetched}").alias("last_seen"))


def finalize_with_schedule(predictions: DataFrame, matches: DataFrame, schedule: DataFrame, zones: DataFrame, fetched: str = "fetched_at", stale_minutes: int = 30, horizon_minutes: int = 20) -> DataFrame:
    """One row per stop visit (``city``, ``service_date``, ``trip_uid``, ``stop_sequence``) from its last valid prediction and the matched schedule.

    ``predictions`` hold times and delays of arrival and departure; ``matches`` ``trip_uid``, ``trip_id``; ``schedule`` ``city``,
    ``trip_id``, ``stop_id``, ``stop_sequence`` and ``sched_sec`` of the service day; ``zones`` ``city`` and ``zone``. A trip's schedule rows of one stop are
    held together (one, or few on loops), and the one nearest to the prediction, or without a predicted time to the fetch, is
    taken, of equally near ones the first. A delay without a time stands for the schedule's time plus the delay (``method`` =
    ``delay_plus_schedule``). Stale predictions, and visits still within the horizon of the newest fetch, are left out; so is what has
    neither time nor schedule, stop or sequence. ``delay_arr_sec`` is the stated delay if plausible, else actual less scheduled.
    """
    t = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    p = predictions.where("arr_pred_ts_utc IS NOT NULL OR dep_pred_ts_utc IS NOT NULL OR arr_delay_sec IS NOT NULL OR dep_delay_sec IS NOT NULL")
    p = p.select("city", "service_date", "trip_uid", "stop_id", "stop_sequence", "row_no", "route_id", "schedule_relationship", "stu_schedule_relationship", "arr_delay_sec", "dep_delay_sec",
                 t("arr_pred_ts_utc").alias("arr"), t("dep_pred_ts_utc").alias("dep"), t(fetched).alias("f")).withColumn("pred", F.coalesce("arr", "dep"))
    stale = stale_minutes * 60_000_000
    p = p.where(F.col("f").isNotNull() & (F.col("pred").isNull() | (F.col("f") <= F.col("pred") + stale)))
    newest = p.agg(F.max("f").alias("n")).scalar()
    stops = schedule.groupBy("city", "trip_id", "stop_id").agg(F.array_sort(F.collect_set(F.struct("stop_sequence", "sched_sec"))).alias("calls"))
    p = p.join(matches.select("trip_uid", "trip_id"), "trip_uid", "left").join(stops, ["city", "trip_id", "stop_id"], "left").join(broadcast_if_small(zones), "city", "left")
    midnight = F.unix_micros(domain.scheduled_instant(F.col("service_date"), F.lit(0), F.col("zone")))
    near = F.array_min(F.transform("calls", lambda c: F.struct(F.abs(F.coalesce("pred", "f") - (F.col("midnight") + c["sched_sec"].cast("bigint") * 1_000_000)).alias("far"), c["stop_sequence"].alias("seq"), (F.col("midnight") + c["sched_sec"].cast("bigint") * 1_000_000).alias("at"))))
    p = p.withColumn("midnight", midnight).withColumn("call", near).withColumn("seq", F.coalesce("stop_sequence", "call.seq"))
    p = p.withColumn("arr_eff", F.coalesce("arr", F.col("call.at") + F.col("arr_delay_sec") * F.lit(1_000_000).cast("bigint"))).withColumn("dep_eff", F.coalesce("dep", F.col("call.at") + F.col("dep_delay_sec") * F.lit(1_000_000).cast("bigint")))
    p = p.withColumn("eff", F.coalesce("pred", "arr_eff", "dep_eff"))
    p = p.where((F.col("f") <= F.col("eff") + stale) & (F.col("eff") <= newest - horizon_minutes * 60_000_000) & F.col("trip_uid").isNotNull() & F.col("seq").isNotNull() & F.col("stop_id").isNotNull())
    last = F.max(F.struct("f", "eff", "row_no", "route_id", "stop_id", "trip_id", "pred", "arr_eff", "arr_delay_sec", F.col("call.at").alias("sched"), "schedule_relationship", "stu_schedule_relationship")).alias("m")
    one = p.groupBy("city", "service_date", "trip_uid", F.col("seq").alias("stop_sequence")).agg(last, F.count(F.lit(1)).alias("n_predictions"), F.min("f").alias("first_seen"))
    moment = lambda c: F.timestamp_micros(F.col(c))
    delay = domain.effective_delay(F.col("m.arr_delay_sec"), moment("m.pred"), moment("m.sched")).cast("int")
    return one.select("city", "service_date", "trip_uid", "stop_sequence", F.col("m.row_no").alias("row_no"), F.col("m.route_id").alias("route_id"), F.col("m.stop_id").alias("stop_id"), F.col("m.trip_id").alias("static_trip_id"), moment("m.sched").alias("sched_arr_ts_utc"),
                      moment("m.arr_eff").alias("actual_arr_ts_utc"), delay.alias("delay_arr_sec"), F.col("m.schedule_relationship").alias("schedule_relationship"), (F.col("m.stu_schedule_relationship") == "SKIPPED").alias("skipped"),
                      F.when(F.col("m.pred").isNotNull(), "last_prediction").otherwise("delay_plus_schedule").alias("method"), "n_predictions", moment("first_seen").alias("first_seen"), moment("m.f").alias("last_seen"))


def headways(events: DataFrame, keys: Sequence[str], actual: str, scheduled: str, trip: str, feed_gaps: DataFrame | None = None, gap_keys: Sequence[str] = ()) -> DataFrame:
    """Gaps between consecutive arrivals per ``keys`` beside the schedule's own gap as of the arrival.

    ``gap_sec``, ``sched_gap_sec``, ``ratio``, ``bunched`` (below half the schedule) and ``big_gap`` (above twice). The scheduled gap
    is that of the latest scheduled arrival not after the actual one. Gaps that a feed gap overlaps are left out. Rows
    without a key or actual time are ignored; null ratios stay null.
    """
    ok = events.where(" AND ".join(f"`{c}` IS NOT NULL" for c in [*keys, actual]))
    w = Window.partitionBy(*keys).orderBy(actual, trip)
    seconds = lambda c: F.unix_seconds(F.col(c).cast("timestamp"))
    own = ok.withColumn("previous", F.lag(actual).over(w)).withColumn("gap_sec", seconds(actual) - seconds("previous"))
    planned = events.where(" AND ".join(f"`{c}` IS NOT NULL" for c in [*keys, scheduled])).select(*keys, F.col(scheduled).alias("__s")).distinct()
    planned = planned.withColumn("sched_gap_sec", seconds("__s") - F.unix_seconds(F.lag("__s").over(Window.partitionBy(*keys).orderBy("__s")).cast("timestamp")))
    out = asof_backward(own, planned, keys, actual, "__s", ["sched_gap_sec"]).where("gap_sec IS NOT NULL").drop("asof_time")
    if feed_gaps is not None:
        out = without_overlap(out, feed_gaps, gap_keys, "previous", actual, "gap_start", "gap_end")
    out = out.withColumn("ratio", domain.ratio(F.col("gap_sec"), F.col("sched_gap_sec")))
    return out.withColumn("bunched", F.col("ratio") < 0.5).withColumn("big_gap", F.col("ratio") > 2.0)


def service_frequency(stops: DataFrame, keys: Sequence[str], scheduled: str, slices: Sequence[Column], frequent_sec: int = 600, pooled: Sequence[str] = ()) -> DataFrame:
    """Median scheduled gap per key and slice, and whether it makes a frequent service. Gaps of all values of ``pooled`` keys make one median."""
    w = Window.partitionBy(*keys).orderBy(scheduled)
    distinct = stops.where(" AND ".join(f"`{c}` IS NOT NULL" for c in [*keys, scheduled])).select(*keys, scheduled, *slices).distinct()
    gap = F.unix_seconds(F.col(scheduled).cast("timestamp")) - F.unix_seconds(F.lag(scheduled).over(w).cast("timestamp"))
    names = [c for c in distinct.columns if c not in (*keys, scheduled)]
    out = distinct.withColumn("__g", gap).where("__g > 0").groupBy(*[k for k in keys if k not in pooled], *names).agg(F.percentile("__g", 0.5).alias("median_gap_sec"), F.count(F.lit(1)).alias("gaps"))
    return out.withColumn("is_frequent", F.col("median_gap_sec") <= frequent_sec)


def vehicle_activity(positions: DataFrame, keys: Sequence[str], at: str, vehicle: str, fallback: str) -> DataFrame:
    """Hourly distinct vehicles, by ``fallback`` where the vehicle is null, and whether all were known by their own id."""
    hour = F.date_trunc("hour", F.col(at).cast("timestamp"))
    return positions.where(f"`{at}` IS NOT NULL").groupBy(*keys, hour.alias("hour")).agg(
        F.countDistinct(F.coalesce(vehicle, fallback)).alias("vehicles"), F.count(F.lit(1)).alias("records"), F.coalesce(F.bool_and(F.col(vehicle).isNotNull()), F.lit(False)).alias("reliable"))


def minute_census(spans: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """How many spans are live in each minute they touch, per key: ``minute``, ``live``; then peaks come by a second aggregation.

    Spans become +1 and -1 at their ends, summed per minute and run up, so a long span costs two rows, not one a minute;
    minutes without a change are not listed.
    """
    def edge(c: str, add: int) -> Column:
        return F.struct((F.date_trunc("minute", F.col(c).cast("timestamp")) + F.make_dt_interval(mins=F.lit(0 if add > 0 else 1))).alias("minute"), F.lit(add).alias("d"))

    ok = spans.where(F.col(start).isNotNull() & (F.col(end) >= F.col(start)))
    edges = ok.select(*keys, F.explode(F.array(edge(start, 1), edge(end, -1))).alias("e")).groupBy(*keys, "e.minute").agg(F.sum("e.d").alias("d"))
    w = Window.partitionBy(*keys).orderBy("minute").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return edges.select(*keys, "minute", F.sum("d").over(w).alias("live"))


def latest_fix(positions: DataFrame, vehicle: Sequence[str], at: str, before: Column, within_sec: int) -> DataFrame:
    """The last row of each vehicle in the window up to an instant; ties by the greatest other values."""
    t, limit = F.unix_micros(F.col(at).cast("timestamp")), F.unix_micros(before)
    rest = [c for c in positions.columns if c not in (*vehicle, at)]
    live = positions.where((t <= limit) & (t > limit - within_sec * 1_000_000))
    return live.groupBy(*vehicle).agg(F.max(F.struct(at, *rest)).alias("m")).select(*vehicle, f"m.{at}", *[f"m.{c}" for c in rest])


def passages(snapshots: DataFrame, stops: DataFrame, train: Sequence[str], position: str, at: str, sign: str, stop_position: str, delay: str) -> DataFrame:
    """First snapshot of each train at or past each of its stops along its direction, with the delay stated then.

    A train's furthest position so far only grows, so the first snapshot at or past a stop is the one at the least such
    position that reaches it: a match as of, on positions instead of times, without pairing snapshots and stops.
    Stops that are never reached are left out. Of equal times the smallest delay.
    """
    way = stops.select(*train, sign).where(" AND ".join(f"`{c}` IS NOT NULL" for c in [*train, sign])).distinct()
    s = snapshots.select(*train, F.col(position).alias("__p"), F.col(at).alias("__t"), F.col(delay).alias("__d")).where("__p IS NOT NULL AND __t IS NOT NULL").join(way, list(train))
    w = Window.partitionBy(*train, sign).orderBy("__t", F.col("__d").asc_nulls_last())
    far = s.withColumn("__far", F.max(F.col("__p") * F.col(sign)).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    # every snapshot already at or past a position states the time; the first one to get there counts
    first = far.groupBy(*train, sign, (-F.col("__far").cast("double")).alias("__q")).agg(F.min(F.struct(F.col("__t").alias("t"), F.col("__d").isNull().alias("n"), F.col("__d").alias("d"))).alias("m"))
    first = first.select(*train, sign, "__q", F.col("m.t").alias("passed_at"), F.col("m.d").alias("stated_delay"))
    asked = stops.withColumn("__q", -(F.col(stop_position) * F.col(sign)).cast("double"))
    met = asof_backward(asked, first, [*train, sign], "__q", "__q", ["passed_at", "stated_delay"])
    return met.where("passed_at IS NOT NULL").select(*stops.columns, "passed_at", "stated_delay")


def zone_share(stops: DataFrame, keys: Sequence[str], lat: str, lon: str, box: tuple[float, float, float, float]) -> DataFrame:
    """Share of a route's distinct stops within a bounding box (south, west, north, east); routes with the majority inside make an allow-list."""
    inside = F.col(lat).between(box[0], box[2]) & F.col(lon).between(box[1], box[3])
    per = stops.groupBy(*keys, "stop_id").agg(F.max(inside.cast("int")).alias("i"))
    return per.groupBy(*keys).agg(F.sum("i").alias("stops_in_zone"), F.count(F.lit(1)).alias("stops_total"), F.avg("i").alias("zone_share"))

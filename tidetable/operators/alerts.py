"""Alerts: exploded versions, allow-lists by named route, and daily exposure per route."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidetable.functions import domain
from tidetable.operators.intervals import merge_islands
from tidetable.session import broadcast_if_small

UNATTRIBUTED = "_unattributed"


def exploded(alerts: DataFrame) -> DataFrame:
    """One row per version, active period and informed entity; a version without either keeps one row with nulls for it."""
    rows = alerts.withColumn("__p", F.explode_outer("active_periods")).withColumn("__e", F.explode_outer("informed_entities"))
    return rows.select(*[c for c in alerts.columns if c not in ("active_periods", "informed_entities")], F.timestamp_seconds("__p.start").alias("period_start"), F.timestamp_seconds("__p.end").alias("period_end"),
                       *[F.col(f"__e.{n}").alias(f"entity_{n}") for n in ("agency_id", "route_id", "route_type", "stop_id", "trip_id")])


def naming_allowed(alerts: DataFrame, scope: str, restricted: Sequence[str], allowed: Sequence[str]) -> DataFrame:
    """Alerts of scopes that are not restricted, and those of restricted ones that name an allowed route; without a list a restricted scope drops out."""
    names = F.exists("informed_entities", lambda e: e["route_id"].isin(list(allowed)))
    return alerts.where(~F.coalesce(F.col(scope).isin(list(restricted)), F.lit(False)) | F.coalesce(names, F.lit(False)))


def daily(versions: DataFrame, zones: DataFrame) -> DataFrame:
    """``alerts_active``, ``alert_minutes`` and ``worst_effect`` per ``city``, ``route_id`` and ``service_date``.

    An alert belongs to all routes that any of its versions names, or to none (``_unattributed``). A period without a start or end
    takes the alert's first or last fetch for it. Periods are cut to the local day of the service date, and those of one alert
    and day united before their minutes are added. The worst effect is that of the least severity rank, then by name.
    """
    who = ["city", "alert_id"]
    routes = versions.where("entity_route_id IS NOT NULL").select(*who, F.col("entity_route_id").alias("route_id")).distinct()
    seen = versions.groupBy(*who).agg(F.min("fetched_at").alias("first_seen"), F.max("fetched_at").alias("last_seen"))
    rows = versions.select(*who, "service_date", "effect", "period_start", "period_end").distinct().join(seen, who).join(routes, who, "left").withColumn("route_id", F.coalesce("route_id", F.lit(UNATTRIBUTED)))
    local = rows.join(broadcast_if_small(zones), "city")
    low, high = F.col("service_date").cast("timestamp"), F.date_add("service_date", 1).cast("timestamp")
    local = local.withColumn("s", F.greatest(domain.local_time(F.coalesce("period_start", "first_seen"), F.col("zone")), low)).withColumn("e", F.least(domain.local_time(F.coalesce("period_end", "last_seen"), F.col("zone")), high))
    keys = ["city", "route_id", "service_date"]
    islands = merge_islands(local.select(*keys, "alert_id", "s", "e").distinct(), [*keys, "alert_id"], "s", "e")
    minutes = islands.groupBy(*keys).agg(F.countDistinct("alert_id").alias("alerts_active"), F.round(F.sum((F.unix_seconds("e") - F.unix_seconds("s")) / 60), 1).alias("alert_minutes"))
    effect = F.coalesce("effect", F.lit("UNKNOWN_EFFECT"))
    worst = rows.groupBy(*keys).agg(F.min(F.struct(domain.alert_effect_rank(effect).alias("r"), effect.alias("e"))).alias("m")).select(*keys, F.col("m.e").alias("worst_effect"))
    return minutes.join(worst, keys)

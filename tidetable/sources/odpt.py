"""Records and rows of JSON-LD train data: live trains and notices, and the dumps of stations, railways, timetables and calendars."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidetable.operators.timestamps import running_clock
from tidetable.sources.readers import RECORDS, envelope_schema

_TITLE = "struct<en: string, ja: string>"
#: The declared fields of an object, of whatever type.
OBJECT = ("`@id` string, `@type` string, `owl:sameAs` string, `dc:date` string, `dc:title` string, `dct:valid` string, `odpt:operator` string, `odpt:railway` string, `odpt:railDirection` string, `odpt:trainNumber` string, `odpt:trainType` string, "
          "`odpt:delay` int, `odpt:fromStation` string, `odpt:toStation` string, `odpt:originStation` array<string>, `odpt:destinationStation` array<string>, `odpt:carComposition` int, `odpt:index` int, `odpt:frequency` int, "
          f"`odpt:timeOfOrigin` string, `odpt:resumeEstimate` string, `odpt:trainInformationCause` {_TITLE}, `odpt:trainInformationStatus` {_TITLE}, `odpt:trainInformationText` {_TITLE}, `odpt:lineCode` string, "
          f"`odpt:ascendingRailDirection` string, `odpt:descendingRailDirection` string, `odpt:stationOrder` array<struct<`odpt:station`: string, `odpt:index`: int>>, `odpt:railwayTitle` {_TITLE}, `odpt:calendarTitle` {_TITLE}, `odpt:calendar` string, `odpt:train` string, "
          f"`odpt:trainTimetableObject` array<struct<`odpt:arrivalTime`: string, `odpt:departureTime`: string, `odpt:arrivalStation`: string, `odpt:departureStation`: string>>, `odpt:stationCode` string, `odpt:stationTitle` {_TITLE}, `geo:lat` double, `geo:long` double")


def objects(messages: DataFrame, value: str = "value") -> DataFrame:
    """JSON-LD objects, one per message or several in an array, by the declared fields, beside the messages' other columns."""
    text = F.trim(F.col(value).cast("string"))
    array = F.from_json(F.when(text.startswith("["), text).otherwise(F.concat(F.lit("["), text, F.lit("]"))), f"array<struct<{', '.join(_field(f) for f in _split(OBJECT))}>>")
    rest = [c for c in messages.columns if c != value]
    return messages.select(*rest, F.explode(array).alias("o")).select(*rest, "o.*")


def _split(ddl: str) -> list[str]:
    """Fields of a DDL text; commas within types do not part them."""
    out, depth = [""], 0
    for c in ddl:
        depth += (c == "<") - (c == ">")
        if c == "," and depth == 0:
            out.append("")
        else:
            out[-1] += c
    return [f.strip() for f in out]


def _field(f: str) -> str:
    name, kind = f.rsplit("` ", 1)
    return f"{name}`: {kind}"


def tail(urn: Column) -> Column:
    """What follows the first colon of a URN, all of it if there is none; null for null and empty ones."""
    return F.nullif(F.regexp_replace(urn, r"^[^:]*:", ""), F.lit(""))


def epoch(text: Column) -> Column:
    """An ISO instant as epoch seconds; null if unreadable."""
    return F.unix_seconds(text.try_cast("timestamp"))


def _either(title: str) -> Column:
    return F.coalesce(F.nullif(F.col(f"`{title}`.en"), F.lit("")), F.col(f"`{title}`.ja"))


#: Which field of an object each declared column of a live train holds, as it is, without its prefix, as an instant, or as a list.
PLAIN = {"entity_id": "@id", "train_number": "odpt:trainNumber", "railway": "odpt:railway", "rail_direction": "odpt:railDirection", "train_type": "odpt:trainType", "delay_sec": "odpt:delay", "from_station": "odpt:fromStation", "to_station": "odpt:toStation",
         "car_composition": "odpt:carComposition", "train_index": "odpt:index", "frequency_sec": "odpt:frequency"}
TAILS = {"trip_id": "owl:sameAs", "operator": "odpt:operator"}
INSTANTS = {"timestamp": "dc:date", "valid_until": "dct:valid"}
LISTS = {"origin_stations": "odpt:originStation", "destination_stations": "odpt:destinationStation"}


def _declared(column: str) -> Column:
    """A declared column of a live train from its object."""
    if column in TAILS:
        return tail(F.col(f"`{TAILS[column]}`"))
    if column in INSTANTS:
        return epoch(F.col(f"`{INSTANTS[column]}`"))
    if column in LISTS:
        return F.coalesce(F.col(f"`{LISTS[column]}`"), F.array().cast("array<string>"))
    return F.col(f"`{PLAIN[column]}`")


def trains(of: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Live trains as records of the declared schema, beside the columns to ``keep``."""
    return of.where("`@type` = 'odpt:Train'").select(*keep, *[_declared(c).alias(c) for c in [f.split()[0] for f in _split(RECORDS["odpt_trains"])]])


def notices(of: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Train information as alert records, beside the columns to ``keep``; an object without a status says that service is normal and gives none.

    A notice names one railway and one span, so it has one entity and one period; what the declared record has besides is null.
    """
    told = of.where("`@type` = 'odpt:TrainInformation'").withColumn("__status", _either("odpt:trainInformationStatus")).where("__status IS NOT NULL")
    span = {"start": epoch(F.col("`odpt:timeOfOrigin`")), "end": epoch(F.col("`odpt:resumeEstimate`"))}
    line = {"agency_id": tail(F.col("`odpt:operator`")), "route_id": F.col("`odpt:railway`")}
    known = {"alert_id": F.col("`owl:sameAs`"), "cause": _either("odpt:trainInformationCause"), "header_text": F.col("__status"), "description_text": _either("odpt:trainInformationText")}
    columns = []
    for f in envelope_schema("alerts")["payload"].dataType.elementType.fields:
        inner = getattr(f.dataType, "elementType", None)
        if inner is None:
            columns.append(known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name))
        else:
            given = span if f.name == "active_periods" else line
            columns.append(F.array(F.struct(*[given.get(x.name, F.lit(None)).cast(x.dataType).alias(x.name) for x in inner.fields])).alias(f.name))
    return told.select(*keep, *columns)


def envelopes(of: DataFrame, head: Sequence[str]) -> DataFrame:
    """One envelope per response (``head``, its columns) and kind of record, if it has any: ``feed``, ``payload`` (its records as JSON), ``records`` and
    ``feed_ts``, the newest date of all its objects. A response is as long as the service sends it."""
    newest = of.groupBy(*head).agg(F.max(epoch(F.col("`dc:date`"))).alias("feed_ts"))
    out = None
    for feed, build in (("odpt_trains", trains), ("alerts", notices)):
        rows = build(of, head)
        record = F.struct(*[c for c in rows.columns if c not in head])
        one = rows.groupBy(*head).agg(F.to_json(F.collect_list(record)).alias("payload"), F.count(F.lit(1)).alias("records")).withColumn("feed", F.lit(feed))
        out = one if out is None else out.unionByName(one)
    return out.join(newest, list(head))


def railways(of: DataFrame) -> DataFrame:
    """One row per station of a railway in order; a railway without stations keeps one row."""
    c = lambda name: F.col(f"`{name}`")
    return of.select(c("owl:sameAs").alias("railway_urn"), tail(c("odpt:operator")).alias("operator"), F.coalesce(c("dc:title"), F.col("`odpt:railwayTitle`.ja")).alias("title_ja"), F.col("`odpt:railwayTitle`.en").alias("title_en"), c("odpt:lineCode").alias("line_code"),
                     c("odpt:ascendingRailDirection").alias("ascending_direction"), c("odpt:descendingRailDirection").alias("descending_direction"), F.explode_outer("`odpt:stationOrder`").alias("s")).select(
        "*", F.col("s.`odpt:station`").alias("station_urn"), F.col("s.`odpt:index`").alias("station_index")).drop("s")


def stations(of: DataFrame) -> DataFrame:
    c = lambda name: F.col(f"`{name}`")
    return of.select(c("owl:sameAs").alias("station_urn"), tail(c("odpt:operator")).alias("operator"), c("odpt:railway").alias("railway_urn"), c("odpt:stationCode").alias("station_code"), F.coalesce(c("dc:title"), F.col("`odpt:stationTitle`.ja")).alias("title_ja"),
                     F.col("`odpt:stationTitle`.en").alias("title_en"), c("geo:lat").alias("lat"), c("geo:long").alias("lon"))


def timetable_calls(of: DataFrame, cutover_hours: int) -> DataFrame:
    """One row per call of a train timetable, in order: ``stop_sequence`` from 1, ``station_urn``, and both clocks as seconds of the service day.

    A train whose first clock lies before the cutover belongs to the day before and starts at 24 h; each time the clocks run
    backwards, arrivals and departures taken in turn, a day is added. Missing and unreadable clocks are null and do not count.
    """
    c = lambda name: F.col(f"`{name}`")
    turns = F.flatten(F.transform(c("odpt:trainTimetableObject"), lambda x: F.array(x["odpt:arrivalTime"], x["odpt:departureTime"])))
    t = of.select(c("owl:sameAs").alias("timetable_urn"), c("odpt:railway").alias("railway_urn"), c("odpt:calendar").alias("calendar_urn"), c("odpt:trainNumber").alias("train_number"), c("odpt:trainTimetableObject").alias("calls"), running_clock(turns).alias("__run"))
    base = F.when(F.col("__run")[0]["seconds"] < cutover_hours * 3600, 86_400).otherwise(0)
    t = t.withColumn("__base", base).withColumn("__at", F.map_from_entries(F.transform("__run", lambda r: F.struct(r["item"], r["seconds"] + F.col("__base")))))
    rows = t.select("timetable_urn", "railway_urn", "calendar_urn", "train_number", "__at", F.posexplode("calls").alias("i", "x"))
    return rows.select("timetable_urn", "railway_urn", "calendar_urn", "train_number", (F.col("i") + 1).alias("stop_sequence"), F.coalesce("x.`odpt:departureStation`", "x.`odpt:arrivalStation`").alias("station_urn"),
                       F.try_element_at("__at", 2 * F.col("i") + 1).alias("arrival_seconds"), F.try_element_at("__at", 2 * F.col("i") + 2).alias("departure_seconds"))


def calendars(of: DataFrame) -> DataFrame:
    return of.select(F.col("`owl:sameAs`").alias("calendar_urn"), F.coalesce(F.col("`dc:title`"), F.col("`odpt:calendarTitle`.ja")).alias("title_ja"), F.col("`odpt:calendarTitle`.en").alias("title_en"))

"""Protobuf feeds, decoded and encoded on the executors from the wire format alone."""

from __future__ import annotations

import json
import struct
from collections.abc import Iterable, Iterator
from typing import Any, NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Names of the enumerations by number.
TRIP_STATES = {0: "SCHEDULED", 1: "ADDED", 2: "UNSCHEDULED", 3: "CANCELED", 5: "REPLACEMENT", 6: "DUPLICATED", 7: "DELETED", 8: "NEW"}
STOP_STATES = {0: "SCHEDULED", 1: "SKIPPED", 2: "NO_DATA", 3: "UNSCHEDULED"}
VEHICLE_STATES = {0: "INCOMING_AT", 1: "STOPPED_AT", 2: "IN_TRANSIT_TO"}
OCCUPANCY = {0: "EMPTY", 1: "MANY_SEATS_AVAILABLE", 2: "FEW_SEATS_AVAILABLE", 3: "STANDING_ROOM_ONLY", 4: "CRUSHED_STANDING_ROOM_ONLY", 5: "FULL", 6: "NOT_ACCEPTING_PASSENGERS", 7: "NO_DATA_AVAILABLE", 8: "NOT_BOARDABLE"}
CAUSES = {1: "UNKNOWN_CAUSE", 2: "OTHER_CAUSE", 3: "TECHNICAL_PROBLEM", 4: "STRIKE", 5: "DEMONSTRATION", 6: "ACCIDENT", 7: "HOLIDAY", 8: "WEATHER", 9: "MAINTENANCE", 10: "CONSTRUCTION", 11: "POLICE_ACTIVITY", 12: "MEDICAL_EMERGENCY"}
EFFECTS = {1: "NO_SERVICE", 2: "REDUCED_SERVICE", 3: "SIGNIFICANT_DELAYS", 4: "DETOUR", 5: "ADDITIONAL_SERVICE", 6: "MODIFIED_SERVICE", 7: "OTHER_EFFECT", 8: "UNKNOWN_EFFECT", 9: "STOP_MOVED", 10: "NO_EFFECT", 11: "ACCESSIBILITY_ISSUE"}
SEVERITIES = {1: "UNKNOWN_SEVERITY", 2: "INFO", 3: "WARNING", 4: "SEVERE"}


class Field(NamedTuple):
    """One field that is read: its number and what it holds. ``names`` and ``default`` are of enumerations, ``inner`` is of messages."""

    no: int
    kind: str = "text"
    many: bool = False
    names: dict[int, str] | None = None
    default: int | None = None
    inner: dict[str, Field] | None = None


def _enum(no: int, names: dict[int, str], default: int | None = None) -> Field:
    return Field(no, "enum", names=names, default=default)


def _message(no: int, inner: dict[str, Field], many: bool = False) -> Field:
    return Field(no, "message", many, inner=inner)


#: The fields of the feed's messages that are read, by their numbers.
TRIP = {"trip_id": Field(1), "start_time": Field(2), "start_date": Field(3), "schedule_relationship": _enum(4, TRIP_STATES, 0), "route_id": Field(5), "direction_id": Field(6, "int")}
VEHICLE = {"vehicle_id": Field(1), "vehicle_label": Field(2)}
CALL = {"delay": Field(1, "int"), "time": Field(2, "int"), "uncertainty": Field(3, "int")}
STOP = {"stop_sequence": Field(1, "int"), "arrival": _message(2, CALL), "departure": _message(3, CALL), "stop_id": Field(4), "schedule_relationship": _enum(5, STOP_STATES, 0)}
TRIP_UPDATE = {"trip": _message(1, TRIP), "stop_time_updates": _message(2, STOP, True), "vehicle": _message(3, VEHICLE), "timestamp": Field(4, "int")}
PLACE = {"lat": Field(1, "float"), "lon": Field(2, "float"), "bearing": Field(3, "float"), "speed": Field(5, "float")}
POSITION = {"trip": _message(1, TRIP), "position": _message(2, PLACE), "current_stop_sequence": Field(3, "int"), "current_status": _enum(4, VEHICLE_STATES, 2), "timestamp": Field(5, "int"), "stop_id": Field(7), "vehicle": _message(8, VEHICLE), "occupancy_status": _enum(9, OCCUPANCY)}
PERIOD = {"start": Field(1, "int"), "end": Field(2, "int")}
ENTITY = {"agency_id": Field(1), "route_id": Field(2), "route_type": Field(3, "int"), "trip": _message(4, {"trip_id": Field(1)}), "stop_id": Field(5)}
TEXTS = {"translation": _message(1, {"text": Field(1)}, True)}
ALERT = {"active_periods": _message(1, PERIOD, True), "informed_entities": _message(5, ENTITY, True), "cause": _enum(6, CAUSES, 1), "effect": _enum(7, EFFECTS, 8), "header": _message(10, TEXTS), "description": _message(11, TEXTS), "severity_level": _enum(14, SEVERITIES, 1)}
FEED = {"header": _message(1, {"timestamp": Field(3, "int")}), "entities": _message(2, {"id": Field(1), "trip_updates": _message(3, TRIP_UPDATE), "vehicle_positions": _message(4, POSITION), "alerts": _message(5, ALERT)}, True)}
FEEDS = ("trip_updates", "vehicle_positions", "alerts")


def fields(data: bytes) -> dict[int, list]:
    """Field number to values, in order: ints for varints, floats for fixed widths, bytes for lengths. Raises ValueError on broken input."""
    out: dict[int, list] = {}
    view, end, at = memoryview(data), len(data), 0

    def varint() -> int:
        nonlocal at
        value = 0
        for shift in range(0, 70, 7):
            if at >= end:
                raise ValueError("truncated")
            b = view[at]
            at += 1
            value |= (b & 127) << shift
            if b < 128:
                return value
        raise ValueError("varint too long")

    while at < end:
        key = varint()
        kind, size = key & 7, 0
        if kind == 0:
            value: object = varint()
        elif kind == 2:
            size = varint()
            value = bytes(view[at:at + size])
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            if at + size > end:
                raise ValueError("truncated")
            value = struct.unpack_from("<d" if kind == 1 else "<f", view, at)[0]
        else:
            raise ValueError(f"wire type {kind}")
        at += size
        if at > end:
            raise ValueError("truncated")
        out.setdefault(key >> 3, []).append(value)
    return out


def decode(data: bytes, spec: dict[str, Field]) -> dict[str, Any]:
    """A message as a dict by ``spec``. Unset and empty texts are None, unset enumerations their default's name; fields that are not read are skipped,
    whatever they hold, so a producer's own use of one breaks nothing."""
    found, out = fields(data), {}
    for name, f in spec.items():
        values = [v for v in found.get(f.no, []) if isinstance(v, bytes) == (f.kind in ("text", "message"))]
        if f.kind == "message":
            inner = [decode(v, f.inner or {}) for v in values]
            out[name] = inner if f.many else inner[-1] if inner else None
        elif f.kind == "text":
            out[name] = (values[-1].decode("utf-8", "replace") or None) if values else None
        elif f.kind == "int":
            out[name] = (values[-1] - (1 << 64) if values[-1] >= 1 << 63 else values[-1]) if values else None
        elif f.kind == "float":
            out[name] = float(values[-1]) if values else None
        else:
            no = int(values[-1]) if values else f.default
            out[name] = None if no is None else (f.names or {}).get(no, str(no))
    return out


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def encode(values: dict[str, Any], spec: dict[str, Field]) -> bytes:
    """The bytes of a message whose set fields are ``values``; None and missing ones are left unset. The inverse of :func:`decode`."""
    out = bytearray()
    for name, f in spec.items():
        given = values.get(name)
        for v in (given or []) if f.many else [] if given is None else [given]:
            if f.kind in ("int", "enum"):
                no = v if f.kind == "int" else next(k for k, n in (f.names or {}).items() if n == v)
                out += _varint(f.no << 3) + _varint(no)
            elif f.kind == "float":
                out += _varint(f.no << 3 | 5) + struct.pack("<f", v)
            else:
                raw = v.encode() if f.kind == "text" else encode(v, f.inner or {})
                out += _varint(f.no << 3 | 2) + _varint(len(raw)) + raw
    return bytes(out)


def _flat(record: dict[str, Any], *parts: str) -> dict[str, Any]:
    """A record with its parts' fields beside its own; a missing part's fields are absent."""
    return {k: v for k, v in record.items() if k not in parts} | {k: v for p in parts for k, v in (record.get(p) or {}).items()}


def _text(record: dict[str, Any] | None) -> str | None:
    return record["translation"][0]["text"] if record and record["translation"] else None


def records(feed: bytes) -> tuple[int | None, dict[str, list[dict]]]:
    """The feed's own time and its records by kind, under the names of the declared schemas. An entity gives a record for each kind it holds."""
    message = decode(feed, FEED)
    out: dict[str, list[dict]] = {k: [] for k in FEEDS}
    for e in message["entities"]:
        if e["trip_updates"]:
            out["trip_updates"].append({"entity_id": e["id"], "schedule_relationship": "SCHEDULED"} | _flat(e["trip_updates"], "trip", "vehicle"))
        if e["vehicle_positions"]:
            out["vehicle_positions"].append({"entity_id": e["id"], "schedule_relationship": "SCHEDULED"} | _flat(e["vehicle_positions"], "trip", "vehicle", "position"))
        if e["alerts"]:
            a = e["alerts"]
            entities = [{"trip_id": None} | _flat(x, "trip") for x in a["informed_entities"]]
            out["alerts"].append({"alert_id": e["id"], **{k: a[k] for k in ("active_periods", "cause", "effect", "severity_level")}, "informed_entities": entities, "header_text": _text(a["header"]), "description_text": _text(a["description"])})
    return (message["header"] or {}).get("timestamp"), out


def decode_feeds(files: DataFrame) -> DataFrame:
    """``path``, ``feed``, ``feed_ts`` and ``payload`` (its records as JSON) for every kind of record that a file (``path``, ``content``) holds.

    A broken file gives one row with ``error``, so that none is lost; an empty one gives none.
    """
    schema = pa.schema([("path", pa.string()), ("feed", pa.string()), ("feed_ts", pa.int64()), ("payload", pa.string()), ("error", pa.string())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    at, found = records(content or b"")
                    rows = [{"path": path, "feed": k, "feed_ts": at, "payload": json.dumps(v, ensure_ascii=False)} for k, v in found.items() if v]
                except (ValueError, TypeError) as e:
                    rows = [{"path": path, "error": str(e)}]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return files.select("path", "content").mapInArrow(run, "path string, feed string, feed_ts bigint, payload string, error string")


def envelopes(decoded: DataFrame, city: Column, agency: Column, endpoint: Column, fetched_at: Column, source_format: str = "gtfs_rt") -> DataFrame:
    """One message (``value``) per decoded kind of record: head fields and the payload as it is."""
    head = F.to_json(F.struct(city.alias("city"), agency.alias("agency"), F.col("feed"), F.date_format(fetched_at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("fetched_at"), F.lit(source_format).alias("source_format"), F.lit(1).alias("schema_version"),
                              endpoint.alias("endpoint"), F.col("feed_ts")))
    text = F.concat(F.substring(head, 1, F.length(head) - 1), F.lit(', "payload": '), F.col("payload"), F.lit("}"))
    return decoded.where("error IS NULL").select("feed", text.alias("value"))


def encode_feeds(rows: DataFrame, path: str, kind: str) -> DataFrame:
    """``path`` and ``content``: one feed of one entity per row. ``rows`` hold ``path``, ``feed_ts`` and ``entity``, the entity's fields as JSON."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [encode({"header": {"timestamp": at}, "entities": [{"id": name, kind: json.loads(entity)}]}, FEED) for name, at, entity in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["path", "content"])

    return rows.select(F.col(path), "feed_ts", "entity").mapInArrow(run, "path string, content binary")

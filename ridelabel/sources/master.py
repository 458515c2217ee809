"""Timetable tables: loading them, and the bundle the matcher uses."""

from __future__ import annotations

from dataclasses import dataclass, fields
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelabel.functions import tiles
from ridelabel.operators.index import (
    STOP_FIELDS,
    candidate_lists,
    line_index,
    nested_departures,
    service_table,
    serving_stops,
    stop_tiles,
)
from ridelabel.params import MatchParams
from ridelabel.sources.json_split import json_values
from ridelabel.storage import written

DEPARTURE = "STRUCT<line_id STRING, seq INT, dep_sec BIGINT>"
STOP_SCHEMA = (
    "name STRING, longitude DOUBLE, latitude DOUBLE, IFOPT STRING, direction STRING, "
    f"ref_name STRING, plannedDepartures ARRAY<{DEPARTURE}>"
)
# Fixed value: mark of index keys that are not used.
LOWER_BUCKET = "type=lower"
_POINT = "STRUCT<lon DOUBLE, lat DOUBLE>"
LINE_SCHEMA = (
    "lineLabel STRING, lineRef STRING, textRouteDirection STRING, `from` STRING, `to` STRING, "
    "network STRING, operator STRING, color STRING, transportProduct STRING, "
    f"stopNodes ARRAY<{_POINT}>, platformsNodes ARRAY<{_POINT}>, "
    f"platformWays ARRAY<ARRAY<{_POINT}>>, route ARRAY<ARRAY<{_POINT}>>"
)


#: Bytes a row takes besides its values in the hash table that a broadcast is built into: its
#: pointers, header and share of the free slots.
HASHED = 64


@dataclass(frozen=True)
class MasterData:
    """The tables the matcher looks up, each with one row per key.

    occupied  tile7
    due       tile7, bucket -> cands (lines due, with has_zero)
    details   line_id -> routeName, routeDetails
    serving   tile7, line_id -> serving (stops)
    placed    every stop with its tile7
    small     names of the tables measured to fit into ``broadcast_bytes`` together
    kept      names of the tables that were written to be measured
    """

    occupied: DataFrame
    due: DataFrame
    details: DataFrame
    serving: DataFrame
    placed: DataFrame
    small: frozenset[str]
    kept: frozenset[str] = frozenset()

    @classmethod
    def from_timetable(cls, stops: DataFrame, lines: DataFrame, departures: DataFrame, params: MatchParams,
                       sizes: list[int] | None = None) -> "MasterData":
        """Build the index from planned departures (line_id, seq, IFOPT, dep_sec).

        ``sizes`` makes it hold several bucket sizes at once (see ``line_index``).
        """
        index = line_index(departures, stops, params, sizes)
        # The index has two rows per departure and size, the service at most one per departure.
        return cls._build(stops, lines, index, service_table(departures), departures, 2 * len(sizes or [1]), params)

    @classmethod
    def from_index(cls, stops: DataFrame, lines: DataFrame, index: DataFrame,
                   params: MatchParams) -> "MasterData":
        """Use a ready-made index; stops carry their ``plannedDepartures``.

        Entries for tiles without any stop are left out: nothing may match there.
        """
        service = service_table(nested_departures(stops))
        index = index.join(stop_tiles(stops, params).select("tile7").distinct(), "tile7", "left_semi")
        entries = index.select("line_id").unionAll(service.select("line_id"))
        return cls._build(stops, lines, index, service, entries, 1, params)

    @classmethod
    def _build(cls, stops: DataFrame, lines: DataFrame, index: DataFrame, service: DataFrame, entries: DataFrame,
               factor: int, params: MatchParams) -> "MasterData":
        """``entries`` times ``factor`` bounds the rows of index and service."""
        placed = stop_tiles(stops, params)
        tables = {
            "occupied": placed.select("tile7").distinct(), "due": candidate_lists(index), "details": line_details(lines),
            "serving": serving_stops(placed, service), "placed": placed,
        }
        # One pass over the sources bounds most tables; those it leaves open are measured themselves.
        source = measured(stops=stops.select(*STOP_FIELDS), details=tables["details"], entries=entries.select("line_id"))
        (stop_rows, stop_bytes, widest), (line_rows, line_bytes, _), (rows, id_bytes, _) = (
            source[n] for n in ("stops", "details", "entries"))
        bounds = {
            "occupied": (16 + HASHED) * stop_rows, "placed": stop_bytes + (16 + HASHED) * stop_rows,
            "details": line_bytes + HASHED * line_rows, "due": factor * (id_bytes + (32 + HASHED) * rows),
            "serving": rows * (widest + 32 + HASHED),
        }
        kept = frozenset(n for n in ("due", "serving") if bounds[n] > params.broadcast_bytes)
        # Those made by joins and groups are written, or measuring and each use would make them anew.
        tables |= {n: written(tables[n]) for n in kept}
        if unsure := {n: tables[n] for n, size in bounds.items() if size > params.broadcast_bytes}:
            bounds |= {n: size + HASHED * count for n, (count, size, _) in measured(**unsure).items()}
        # The smallest first, as far as they fit together: a query may hold all of them at once.
        total, small = 0, set()
        for name in sorted(bounds, key=bounds.get):
            total += bounds[name]
            if total <= params.broadcast_bytes:
                small.add(name)
        return cls(**tables, small=frozenset(small), kept=kept)

    def stored(self) -> "MasterData":
        """The same tables, each computed once and written (see ``written``)."""
        own = {f.name: getattr(self, f.name) for f in fields(self)}
        return MasterData(**{
            k: written(v) if isinstance(v, DataFrame) and k not in self.kept else v for k, v in own.items()})

    def persisted(self) -> "MasterData":
        """The same tables kept by Spark, for callers that match more than once."""
        kept = {f.name: getattr(self, f.name) for f in fields(self)}
        return MasterData(**{k: v.persist() if isinstance(v, DataFrame) else v for k, v in kept.items()})

    def unpersist(self) -> None:
        for f in fields(self):
            if isinstance(getattr(self, f.name), DataFrame):
                getattr(self, f.name).unpersist()


def line_details(lines: DataFrame) -> DataFrame:
    """Label and full details of each line."""
    rest = [c for c in lines.columns if c != "line_id"]
    return lines.select(
        "line_id", F.col("lineLabel").alias("routeName"), F.struct("line_id", *rest).alias("routeDetails")
    )


def _bytes_of(value: Column, kind: T.DataType) -> Column:
    """What a value takes in memory: eight bytes for a field or offset, and the bytes of texts."""
    own = F.lit(8).cast("bigint")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return own + F.coalesce(F.octet_length(value), F.lit(0))
    if isinstance(kind, T.StructType):
        return reduce(Column.__add__, [_bytes_of(value[f.name], f.dataType) for f in kind], own)
    if isinstance(kind, T.MapType):
        return _bytes_of(F.map_keys(value), T.ArrayType(kind.keyType)) + _bytes_of(F.map_values(value), T.ArrayType(kind.valueType))
    if isinstance(kind, T.ArrayType):
        items = F.aggregate(value, F.lit(0).cast("bigint"), lambda total, item: total + _bytes_of(item, kind.elementType))
        return own + F.coalesce(items, F.lit(0))
    return own


def measured(**tables: DataFrame) -> dict[str, tuple[int, int, int]]:
    """Rows, bytes and widest row of each table, in one job."""
    def measure(name: str, table: DataFrame) -> DataFrame:
        size = reduce(Column.__add__, [_bytes_of(F.col(f"`{f.name}`"), f.dataType) for f in table.schema])
        return table.select(size.cast("bigint").alias("size")).agg(
            F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"),
            F.coalesce(F.sum("size"), F.lit(0)).alias("total"), F.coalesce(F.max("size"), F.lit(0)).alias("widest"))

    found = reduce(DataFrame.unionAll, [measure(n, t) for n, t in tables.items()])
    return {r["name"]: (r["n"], r["total"], r["widest"]) for r in found.toLocalIterator()}


def load_stops(spark: SparkSession, path: str, array: bool = False) -> DataFrame:
    """Stops as JSON, one object per line, or (``array``) one list of objects per file.

    Unknown fields are ignored. ``pos`` orders the stops of a file. Either form is read by many tasks.
    """
    if array:
        return _parsed_objects(json_values(spark, path, "}", 1), STOP_SCHEMA)
    rows = spark.read.schema(STOP_SCHEMA).option("mode", "FAILFAST").json(path)
    return rows.withColumn("pos", F.monotonically_increasing_id())


def _parsed_objects(values: DataFrame, schema: str) -> DataFrame:
    parsed = F.from_json("value", schema, {"mode": "FAILFAST"})
    return values.select(parsed.alias("_o"), "pos").select("_o.*", "pos")


def _json_map(spark: SparkSession, path: str, value_type: T.DataType, close: str) -> DataFrame:
    """Key/value rows of JSON maps whose values end in ``close``; a map may be larger than a task."""
    entry = F.concat(F.lit("{"), "value", F.lit("}"))
    parsed = F.from_json(entry, T.MapType(T.StringType(), value_type), {"mode": "FAILFAST"})
    return json_values(spark, path, close, 1).select(F.explode(parsed).alias("key", "value"))


def load_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines from JSON maps ``{id: route, ...}``, one or several in a file."""
    rows = _json_map(spark, path, T.StructType.fromDDL(LINE_SCHEMA), "}")
    return rows.select(F.col("key").alias("line_id"), "value.*")


def key_text_of(kind: Column, tile7: Column, bucket: Column, params: MatchParams) -> Column:
    """Text form of an index key: ``type=<kind>,mode=BUS,direction=UNKNOWN#<tile>_<bucket>``."""
    place = tiles.tile_text(tile7, params.stop_tile_chars)
    return F.concat(
        F.lit("type="), kind, F.lit(",mode=BUS,direction=UNKNOWN#"), place, F.lit("_"), bucket.cast("string")
    )


def _parse_key(rows: DataFrame) -> DataFrame:
    """``tile7`` and ``bucket`` from the part of the key behind the ``#``."""
    part = F.element_at(F.split("key", "#"), -1)
    return rows.withColumns({
        "tile7": tiles.text_tile(F.split(part, "_")[0]),
        "bucket": F.split(part, "_")[1].cast("int"),
    })


def parse_line_index(entries: DataFrame) -> DataFrame:
    """Index rows from (key, values) entries whose values read ``line#seq``.

    Keys of the lower time bucket are left out: a bus is never early.
    """
    kept = entries.where(~F.col("key").contains(LOWER_BUCKET))
    refs = kept.select("key", F.explode("value").alias("_ref"))
    value = F.split("_ref", "#")
    return _parse_key(refs).select(
        "tile7", "bucket", value[0].alias("line_id"), value[1].cast("int").alias("seq")
    ).distinct()


def load_line_index(spark: SparkSession, path: str) -> DataFrame:
    """The line index from JSON maps ``{key: [line#seq, ...], ...}``."""
    return parse_line_index(_json_map(spark, path, T.ArrayType(T.StringType()), "]"))


def parse_stop_index(entries: DataFrame) -> DataFrame:
    """(tile, bucket, IFOPT) rows from (key, values) entries."""
    return _parse_key(entries.select("key", F.explode("value").alias("IFOPT"))).select(
        "tile7", "bucket", "IFOPT"
    ).distinct()


def load_stop_index(spark: SparkSession, path: str) -> DataFrame:
    """The stop index from JSON maps ``{key: [stop id, ...], ...}``."""
    return parse_stop_index(_json_map(spark, path, T.ArrayType(T.StringType()), "]"))

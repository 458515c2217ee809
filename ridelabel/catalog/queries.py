"""Every registered query: one per operator group, over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelabel.catalog import streams
from ridelabel.functions import tiles
from ridelabel.functions.timekeys import bucket, local_second_of_day
from ridelabel.operators import index, match, osm, vote
from ridelabel.operators.collapse import DOORS
from ridelabel.operators.sessions import valid_positions, with_cell
from ridelabel.operators.skew import shuffled
from ridelabel.params import MatchParams
from ridelabel.plans import enrich as plans
from ridelabel.sources import fixtures as fx
from ridelabel.sources import master as ms
from ridelabel.sources.osm import read_osm_elements
from ridelabel.sources.waypoints import TIME_FORMAT, decode_waypoints, encode_waypoints, read_waypoints
from ridelabel.storage import shared_folder

P = MatchParams()
RUN = ["vehicle_id", "session_id", "run_id"]
LAT, LON = "geo_latitude", "geo_longitude"


def _us(column: str):
    return F.unix_micros(column)


def _runs(spark, sf):
    return plans.number_runs(fx.fixture_waypoints(spark, sf), P)


def _keypoints(spark, sf):
    return plans.collapse_waypoints(fx.fixture_waypoints(spark, sf), P)


def _keyed(spark, sf):
    return match.place_time_keys(_keypoints(spark, sf), P)


def _master(spark, sf):
    return fx.fixture_master(spark, sf, P)


def _labelled(spark, sf, master):
    return plans.label_lines(fx.fixture_waypoints(spark, sf), master, P)


def valid_positions_q(spark: SparkSession, sf: str) -> DataFrame:
    return valid_positions(fx.fixture_waypoints(spark, sf)).select(
        "seq_no", "vehicle_id", F.col(LAT).alias("lat"), F.col(LON).alias("lon")
    )


def tile_encode(spark, sf):
    placed = with_cell(valid_positions(fx.fixture_waypoints(spark, sf)))
    return placed.select("seq_no", *[
        tiles.tile_text(tiles.cell_tile(F.col("cell"), n), n).alias(f"geohash{n}") for n in (12, 8, 7)
    ])


def tile_center(spark, sf):
    placed = with_cell(valid_positions(fx.fixture_waypoints(spark, sf)))
    hashed = placed.select("seq_no", *[
        tiles.tile_text(tiles.cell_tile(F.col("cell"), n), n).alias(f"g{n}") for n in (12, 9, 8, 7)
    ])
    centers = hashed.select("seq_no", *[tiles.tile_center(F.col(f"g{n}")).alias(f"c{n}") for n in (12, 9, 8, 7)])
    return centers.select("seq_no", *[
        F.col(f"c{n}.{axis}").alias(f"{axis}{n}") for n in (12, 9, 8, 7) for axis in ("lat", "lon")
    ])


def vehicle_sessions(spark, sf):
    return _runs(spark, sf).select("seq_no", "vehicle_id", "session_id")


def tile_runs(spark, sf):
    return _runs(spark, sf).select("seq_no", *RUN)


def collapse_keypoints(spark, sf):
    return _keypoints(spark, sf).select(
        *RUN, "seq_no", _us("time").alias("t_us"), _us("time_end").alias("t_end_us"),
        F.col("geo_Hash").alias("geo_hash"), F.col(LAT).alias("lat"), F.col(LON).alias("lon"),
        F.col("event_Subtype").alias("event_subtype"),
        F.col("meta_ingestionPartition").alias("ingestion_partition"),
    )


def door_activity(spark, sf):
    return _keypoints(spark, sf).select(*RUN, F.explode(DOORS).alias("door", "a")).select(
        *RUN, "door", F.col("a.boarding").alias("boarding"), F.col("a.exiting").alias("exiting")
    )


def run_stop_names(spark, sf):
    return _keypoints(spark, sf).select(*RUN, "stop_name")


def event_type_priority(spark, sf):
    return _keypoints(spark, sf).select(*RUN, F.col("event_Type").alias("event_type"))


def local_time_bucket(spark, sf):
    return fx.fixture_waypoints(spark, sf).select(
        "seq_no", local_second_of_day(F.col("time"), P.zone).cast("bigint").alias("local_second"),
        bucket(F.col("time"), P.zone, 5).cast("bigint").alias("bucket5"),
        bucket(F.col("time"), P.zone, 15).cast("bigint").alias("bucket15"),
    )


def stop_tiles(spark, sf):
    return index.stop_tiles(fx.fixture_stops(spark, sf), P).select(
        tiles.tile_text(F.col("tile7"), 7).alias("tile"), F.col("IFOPT").alias("ifopt"), "name"
    )


def stops_first_by_ifopt(spark, sf):
    """Every part under its brand's id: many rows share one IFOPT, the first counts."""
    stops = fx.table(spark, sf, "part").select(
        F.col("p_brand").alias("IFOPT"), F.col("p_name").alias("name"), F.col("p_partkey").alias("pos")
    )
    return index.first_by_ifopt(stops).select(F.col("IFOPT").alias("ifopt"), "name", "pos")


def service_table(spark, sf):
    return index.service_table(fx.fixture_departures(spark, sf)).select(F.col("IFOPT").alias("ifopt"), "line_id")


def line_index(spark, sf):
    rows = index.line_index(fx.fixture_departures(spark, sf), fx.fixture_stops(spark, sf), P)
    return rows.select(
        tiles.tile_text(F.col("tile7"), 7).alias("tile"), F.col("bucket").cast("bigint").alias("bucket"),
        "line_id", F.col("seq").cast("bigint").alias("seq"),
    )


def stop_index(spark, sf):
    stops = fx.fixture_stops(spark, sf)
    rows = index.resolve_stops(index.stop_index(fx.fixture_departures(spark, sf), stops, P), stops)
    return rows.select(
        tiles.tile_text(F.col("tile7"), 7).alias("tile"), F.col("bucket").cast("bigint").alias("bucket"),
        F.col("IFOPT").alias("ifopt"), F.col("stop.name").alias("stop_name"),
    )


def index_entries(spark, sf):
    """The index written as text entries of all three kinds and read back."""
    rows = index.line_index(fx.fixture_departures(spark, sf), fx.fixture_stops(spark, sf), P)
    kinds = rows.withColumn("kind", F.explode(F.array(*[F.lit(k) for k in ("lower", "middle", "upper")])))
    shifted = kinds.withColumn(
        "bucket", F.when(F.col("kind") == "lower", F.lit(-1)).otherwise(F.col("bucket"))
    )
    entries = shifted.select(
        ms.key_text_of(F.col("kind"), F.col("tile7"), F.col("bucket"), P).alias("key"),
        F.concat_ws("#", "line_id", "seq").alias("ref"),
    ).groupBy("key").agg(F.collect_list("ref").alias("value"))
    return ms.parse_line_index(entries).select(
        tiles.tile_text(F.col("tile7"), 7).alias("tile"), F.col("bucket").cast("bigint").alias("bucket"),
        "line_id", F.col("seq").cast("bigint").alias("seq"),
    )


def near_stop_gate(spark, sf):
    return match.with_near_flag(_keyed(spark, sf), _master(spark, sf), P).select(*RUN, "near")


def candidate_gate(spark, sf):
    found = match.with_candidates(_keyed(spark, sf), _master(spark, sf), P)
    return found.select(*RUN, (F.size("cands") > 0).alias("has_candidate"))


def near_stops_join(spark, sf):
    return match.near_stops(_keyed(spark, sf), _master(spark, sf), P).select(
        *RUN, F.col("stop.IFOPT").alias("ifopt"), F.round("dist", 12).alias("dist")
    )


def line_candidates(spark, sf):
    found = match.with_candidates(_keyed(spark, sf), _master(spark, sf), P)
    return found.select(*RUN, F.explode("cands").alias("c")).select(*RUN, "c.line_id", "c.has_zero")


def vote_increments(spark, sf):
    found = vote.with_points(match.with_candidates(_keyed(spark, sf), _master(spark, sf), P), P)
    return found.select(*RUN, F.explode("cands").alias("c")).select(
        *RUN, "c.line_id", F.col("c.points").cast("bigint").alias("votes"))


def vote_fold(spark, sf):
    folded = plans.fold_lines(fx.fixture_waypoints(spark, sf), _master(spark, sf), P)
    return folded.select(*RUN, F.col("det").alias("decided_line"))


def vote_fold_by_vehicle(spark, sf):
    params = P.with_(scope="vehicle")
    folded = plans.fold_lines(fx.fixture_waypoints(spark, sf), _master(spark, sf), params)
    return folded.select(*RUN, F.col("det").alias("decided_line"))


def backfill_lines(spark, sf):
    return _labelled(spark, sf, _master(spark, sf)).select(*RUN, "line_id", "detected")


def line_lookup(spark, sf):
    master = _master(spark, sf)
    return match.with_line_details(_labelled(spark, sf, master), master, P).select(
        *RUN, F.col("routeName").alias("route_name"), F.col("routeDetails.to").alias("route_to")
    )


def nearest_serving_stop(spark, sf):
    master = _master(spark, sf)
    return match.with_nearest_serving_stop(_labelled(spark, sf, master), master, P).select(
        *RUN, F.col("stop_scheduleStop.IFOPT").alias("ifopt"), F.round("stop_dist", 12).alias("dist")
    )


def route_start_mark(spark, sf):
    labelled = _labelled(spark, sf, _master(spark, sf))
    return labelled.select(*RUN, match.route_start_mark(labelled).cast("bigint").alias("stop_route_index"))


def _enriched_columns(rows: DataFrame, *extra: str) -> DataFrame:
    return rows.select(
        *extra, *RUN, "seq_no", _us("time").alias("t_us"), _us("time_end").alias("t_end_us"),
        F.col("geo_Hash").alias("geo_hash"), F.col(LAT).alias("lat"), F.col(LON).alias("lon"),
        F.col("event_Type").alias("event_type"), "stop_name", "line_id", "detected",
        F.col("routeName").alias("route_name"), F.col("routeDetails.to").alias("route_to"),
        F.col("stop_scheduleStop.IFOPT").alias("stop_ifopt"),
        F.round("stop_dist", 12).alias("stop_dist"),
        F.col("stop_route_Index").cast("bigint").alias("stop_route_index"),
    )


def enrich_full(spark, sf):
    return _enriched_columns(plans.enrich(fx.fixture_waypoints(spark, sf), _master(spark, sf), P))


def region_partitioned(spark, sf):
    rows = plans.enrich_partitioned(
        fx.fixture_waypoints(spark, sf), _master(spark, sf), tiles.tile(F.col(LAT), F.col(LON), 4), P
    )
    return _enriched_columns(rows, "match_partition")


def any_entity_match(spark, sf):
    phones = fx.fixture_waypoints(spark, sf).withColumn(
        "phone", F.concat(F.lit("phone-"), "vehicle_id", F.lit("-"), F.element_at(F.map_keys(DOORS), 1))
    )
    return _enriched_columns(plans.enrich(phones, _master(spark, sf), P, entity="phone"))


def bucket_sweep(spark, sf):
    return plans.bucket_sweep(
        fx.fixture_waypoints(spark, sf), fx.fixture_stops(spark, sf), fx.fixture_lines(spark, sf),
        fx.fixture_departures(spark, sf), [5, 10, 15], P,
    ).select(F.col("bucket_minutes").cast("bigint").alias("bucket_minutes"), "keypoints", "labelled", "detected")


def region_stored(spark, sf):
    """Waypoints stored by region, matched in two runs that each read their own regions only."""
    rows, master, folder = fx.fixture_waypoints(spark, sf), _master(spark, sf), f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    plans.store_partitioned(rows, f"{folder}/in", tiles.tile(F.col(LAT), F.col(LON), 4))
    half = "m"
    for which in (F.col(plans.PARTITION) < half, F.col(plans.PARTITION) >= half):
        done = plans.enrich_partitions(spark, f"{folder}/in", rows.schema, f"{folder}/out", master, P, which)
    return _enriched_columns(plans.read_partitions(spark, f"{folder}/out", done.schema), "match_partition")


def stop_departures(spark, sf):
    """Labelled keypoints with the full record of their stop, departures included."""
    rows = plans.enrich(fx.fixture_waypoints(spark, sf), _master(spark, sf), P)
    full = plans.with_stop_departures(rows, fx.fixture_departures(spark, sf), P)
    departures = F.col("stop_scheduleStop.plannedDepartures")
    return full.select(
        *RUN, F.col("stop_scheduleStop.IFOPT").alias("stop_ifopt"),
        F.when(departures.isNotNull(), F.size(departures)).cast("bigint").alias("departures"),
        F.array_max(F.transform(departures, lambda d: d["dep_sec"])).alias("last_departure"),
        F.array_min(F.transform(departures, lambda d: d["line_id"])).alias("first_line"))


SWEEP = (
    P, P.with_(bucket_minutes=10, winning_margin=1), P.with_(session_gap_seconds=120, first_stop_votes=3),
    P.with_(session_gap_seconds=900, other_stop_votes=2, single_min_votes=3), P.with_(winning_margin=0, single_min_votes=1),
)


def parameter_sweep(spark, sf):
    swept = plans.parameter_sweep(
        fx.fixture_waypoints(spark, sf), fx.fixture_stops(spark, sf), fx.fixture_lines(spark, sf),
        fx.fixture_departures(spark, sf), list(SWEEP))
    return swept.select("choice", "keypoints", "labelled", "detected")


def _documents(entries: DataFrame, begin: str, end: str) -> str:
    """Write texts (column ``value``) as JSON documents, one for each task's rows; the folder."""
    def wrap(batches):
        yield pa.RecordBatch.from_pydict({"value": [begin]})
        first = True
        for batch in batches:
            texts = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_pydict({"value": [t if first and not i else "," + t for i, t in enumerate(texts)]})
            first &= not texts
        yield pa.RecordBatch.from_pydict({"value": [end]})

    path = f"{shared_folder(entries.sparkSession)}/{uuid.uuid4().hex}"
    entries.select("value").mapInArrow(wrap, "value string").write.text(path)
    return path


def _entry(key, value):
    return F.concat(F.to_json(F.struct(key.alias("k"))).substr(F.lit(6), F.length(F.to_json(F.struct(key.alias("k")))) - 6),
                    F.lit(":"), F.to_json(value)).alias("value")


def lines_file(spark, sf):
    """Lines written as JSON maps and loaded again."""
    lines = fx.fixture_lines(spark, sf)
    entries = lines.select(_entry(F.col("line_id").cast("string"), F.struct("lineLabel", "to")))
    back = ms.load_lines(spark, _documents(entries, "{", "}"))
    return back.select("line_id", F.col("lineLabel").alias("line_label"), F.col("to").alias("route_to"), F.col("color").alias("color"))


def stops_file(spark, sf):
    """Stops with their departures written as JSON lists and loaded again."""
    calls = fx.fixture_departures(spark, sf).groupBy("IFOPT").agg(F.array_sort(F.collect_list(F.struct(
        F.col("line_id").cast("string").alias("line_id"), F.col("seq").cast("int").alias("seq"), "dep_sec"))).alias("plannedDepartures"))
    stops = fx.fixture_stops(spark, sf).join(shuffled(calls), "IFOPT", "left")
    texts = stops.select(F.to_json(F.struct(
        "name", "longitude", "latitude", "IFOPT", "direction", "plannedDepartures", "stop_id")).alias("value"))
    back = ms.load_stops(spark, _documents(texts, "[", "]"), array=True)
    called = index.nested_departures(back).groupBy("IFOPT").agg(
        F.count(F.lit(1)).alias("departures"), F.sum("dep_sec").alias("seconds"), F.max("line_id").alias("last_line"))
    return back.join(shuffled(called), "IFOPT", "left").select(
        F.col("IFOPT").alias("ifopt"), F.col("name").alias("stop_name"), F.col("latitude").alias("lat"), F.col("longitude").alias("lon"),
        "direction", F.coalesce("departures", F.lit(0)).cast("bigint").alias("departures"), "seconds", "last_line")


def _index_documents(rows: DataFrame, ref) -> str:
    entries = rows.select(ms.key_text_of(F.lit("middle"), F.col("tile7"), F.col("bucket"), P).alias("key"), ref.alias("ref"))
    lists = entries.groupBy("key").agg(F.collect_list("ref").alias("refs"))
    return _documents(lists.select(_entry(F.col("key"), F.col("refs"))), "{", "}")


def line_index_file(spark, sf):
    """The line index written as JSON maps and loaded again."""
    rows = index.line_index(fx.fixture_departures(spark, sf), fx.fixture_stops(spark, sf), P)
    back = ms.load_line_index(spark, _index_documents(rows, F.concat_ws("#", "line_id", "seq")))
    return back.select(
        tiles.tile_text(F.col("tile7"), 7).alias("tile"), F.col("bucket").cast("bigint").alias("bucket"),
        "line_id", F.col("seq").cast("bigint").alias("seq"))


def stop_index_file(spark, sf):
    """The stop index written as JSON maps, loaded again and resolved."""
    stops = fx.fixture_stops(spark, sf)
    rows = index.stop_index(fx.fixture_departures(spark, sf), stops, P)
    back = index.resolve_stops(ms.load_stop_index(spark, _index_documents(rows, F.col("IFOPT"))), stops)
    return back.select(
        tiles.tile_text(F.col("tile7"), 7).alias("tile"), F.col("bucket").cast("bigint").alias("bucket"),
        F.col("IFOPT").alias("ifopt"), F.col("stop.name").alias("stop_name"))


def osm_file(spark, sf):
    """OSM elements written as response documents and read again."""
    elements = fx.fixture_osm_elements(spark, sf)
    texts = elements.select(F.to_json(F.struct("type", "id", "lat", "lon", "tags", "nodes", "members")).alias("value"))
    head = '{"version": 0.6, "generator": "derived", "osm3s": {"copyright": "none"}, "elements": ['
    back = read_osm_elements(spark, _documents(texts, head, "]}"))
    return back.select(
        "type", "id", "lat", "lon", F.col("tags")["name"].alias("name"), F.col("tags")["ref"].alias("ref"),
        F.size(F.coalesce("nodes", F.array().cast("array<bigint>"))).cast("bigint").alias("nodes"),
        F.aggregate(F.coalesce("members", F.array().cast(back.schema["members"].dataType)), F.lit(0).cast("bigint"),
                    lambda total, m: total + m["ref"]).alias("member_sum"))


def stored_waypoints(spark, sf):
    """Waypoints stored as JSON rows and read for a replay."""
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    rows = fx.fixture_waypoints(spark, sf)
    rows.write.json(path, timestampFormat=TIME_FORMAT)
    back = read_waypoints(spark, path, "json")
    return back.select(
        "seq_no", "vehicle_id", _us("time").alias("t_us"), F.col(LAT).alias("lat"), F.col(LON).alias("lon"),
        F.col("event_Type").alias("event_type"), "stop_name", F.element_at(F.map_keys(DOORS), 1).alias("door"),
        F.element_at(F.map_values(DOORS), 1)["boarding"].alias("boarding"),
        F.element_at(F.map_values(DOORS), 1)["exiting"].alias("exiting"))


def waypoint_json(spark, sf):
    """Waypoints written as JSON records and decoded again."""
    texts = encode_waypoints(fx.fixture_waypoints(spark, sf))
    seq = F.get_json_object("value", "$.seq_no").cast("bigint").alias("seq_no")
    back = decode_waypoints(texts.select("value", seq), mode="FAILFAST")
    return back.select(
        "seq_no", "vehicle_id", _us("time").alias("t_us"), F.col(LAT).alias("lat"), F.col(LON).alias("lon"),
        F.col("event_Type").alias("event_type"), "stop_name",
        F.element_at(F.map_keys(DOORS), 1).alias("door"),
        F.element_at(F.map_values(DOORS), 1)["boarding"].alias("boarding"),
        F.element_at(F.map_values(DOORS), 1)["exiting"].alias("exiting"),
    )


def _path_text(points):
    """Points as whole millionths of a degree, so that text compares exactly."""
    def one(p):
        return F.concat_ws(" ", *[F.round(p[a] * 1_000_000).cast("bigint").cast("string") for a in ("lon", "lat")])
    return F.array_join(F.transform(points, one), ",")


def osm_routes(spark, sf):
    rows = osm.osm_routes(fx.fixture_osm_elements(spark, sf))
    def lines(column):
        return F.array_join(F.transform(column, _path_text), "|")
    return rows.select(
        "id", F.col("lineLabel").alias("line_label"), F.col("textRouteDirection").alias("route_text"),
        F.col("lineRef").alias("line_ref"), "network", "operator", F.col("from").alias("from_name"),
        F.col("to").alias("to_name"), "color", F.col("transportProduct").alias("product"),
        _path_text(F.col("stopNodes")).alias("stop_nodes"),
        _path_text(F.col("platformsNodes")).alias("platform_nodes"),
        lines("platformWays").alias("platform_ways"), lines("route").alias("route"),
    )


def osm_stops(spark, sf):
    rows = osm.osm_stops(fx.fixture_osm_elements(spark, sf).where("type = 'node'"))
    return rows.select("pos", "name", "longitude", "latitude", F.col("IFOPT").alias("ifopt"), "ref_name", "direction")


def stop_direction(spark, sf):
    stops = fx.table(spark, sf, "part").select(
        F.lit("part").alias("doc"), F.col("p_partkey").alias("pos"), F.col("p_type").alias("name")
    )
    return osm.stop_direction(stops, "name").select("pos", "name", "direction")


SELECTIONS = (
    osm.Selection(("node",), {"highway": "bus_stop"}),
    osm.Selection(("node",), {"public_transport": "platform", "bus": "yes"}),
    osm.Selection(("way", "relation"), {"network": "N2", "type": "route", "route": "bus"}),
)
BOX = osm.BBox(49.05, 11.05, 49.4, 11.3)


def osm_select(spark, sf):
    return osm.osm_select(fx.fixture_osm_elements(spark, sf), SELECTIONS, BOX).select("type", "id")


def osm_recurse_down(spark, sf):
    elements = fx.fixture_osm_elements(spark, sf)
    relations = osm.osm_select(elements, [osm.Selection(("relation",), {"network": "N2", "route": "bus"})])
    return osm.osm_recurse_down(relations, elements).select(
        "type", "id", F.col("tags").isNotNull().alias("has_tags")
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    functions = [
        tile_encode, tile_center, vehicle_sessions, tile_runs, collapse_keypoints, door_activity,
        run_stop_names, event_type_priority, local_time_bucket, stop_tiles, stops_first_by_ifopt,
        service_table, line_index, stop_index, index_entries, near_stop_gate, candidate_gate,
        near_stops_join, line_candidates, vote_increments, vote_fold, vote_fold_by_vehicle,
        backfill_lines, line_lookup, nearest_serving_stop, route_start_mark, enrich_full,
        region_partitioned, any_entity_match, bucket_sweep, waypoint_json, osm_routes, osm_stops,
        stop_direction, osm_select, osm_recurse_down, region_stored, parameter_sweep, lines_file, stops_file,
        line_index_file, stop_index_file, osm_file, stored_waypoints, stop_departures,
        streams.stream_enrich, streams.stream_votes, streams.stream_rejects,
    ]
    return {"valid_positions": valid_positions_q, **{f.__name__: f for f in functions}}

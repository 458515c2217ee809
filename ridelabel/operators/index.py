"""Timetable tables the matcher looks up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelabel.functions import tiles
from ridelabel.functions.timekeys import second_bucket
from ridelabel.operators.skew import shuffled
from ridelabel.params import MatchParams

STOP_FIELDS = ["name", "longitude", "latitude", "IFOPT", "direction", "ref_name"]


def stop_tiles(stops: DataFrame, params: MatchParams) -> DataFrame:
    """Each distinct stop with the tile it lies in."""
    tile = tiles.tile_id(F.col("latitude"), F.col("longitude"), params.stop_tile_chars)
    return stops.select(*STOP_FIELDS, tile.alias("tile7")).dropDuplicates()


def first_by_ifopt(stops: DataFrame) -> DataFrame:
    """The first stop (lowest ``pos``) of every IFOPT; combines before the shuffle."""
    rest = [c for c in stops.columns if c != "IFOPT"]
    return (
        stops.groupBy("IFOPT")
        .agg(F.min_by(F.struct(*rest), F.col("pos")).alias("_stop"))
        .select("IFOPT", *[F.col("_stop")[c].alias(c) for c in rest])
    )


def service_table(departures: DataFrame) -> DataFrame:
    """Which line serves which stop."""
    return departures.select("IFOPT", "line_id").distinct()


def nested_departures(stops: DataFrame) -> DataFrame:
    """Departure rows out of the stops' nested ``plannedDepartures``."""
    return stops.select("IFOPT", F.explode("plannedDepartures").alias("_d")).select("IFOPT", "_d.*")


#: With several bucket sizes at once, minutes times this is added to a bucket's number.
SIZE_STEP = 10_000


def _due_buckets(departures: DataFrame, stops: DataFrame, params: MatchParams, keys: list[str],
                 sizes: list[int] | None = None) -> DataFrame:
    """IFOPT and ``keys`` of departures with their stop's tile and the buckets a waypoint may match in.

    A vehicle is on time or late, never early: the departure's own bucket and the
    one after it, wrapping at midnight.

    Departures of a stop that share their keys travel to their tile as one row with the times, at
    most as many as a day has seconds. They become rows of their own behind that exchange, so
    grouping by tile and anything else needs no further one.
    """
    tile = tiles.tile_id(F.col("latitude"), F.col("longitude"), params.stop_tile_chars)
    placed = first_by_ifopt(stops).select("IFOPT", tile.alias("tile7"))
    # In a struct, since collecting would leave out an unknown time.
    timed = departures.join(shuffled(placed), "IFOPT").groupBy("IFOPT", "tile7", *keys).agg(
        F.collect_set(F.struct("dep_sec")).alias("_times"))
    # A given number: Spark would merge parts by their size before the times are put out.
    parts = int(departures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sized = timed.repartition(parts, "tile7").withColumn("_time", F.explode("_times")).withColumn(
        "_size", F.explode(F.array(*map(F.lit, sizes or [params.bucket_minutes]))))
    own = second_bucket(F.col("_time.dep_sec"), F.col("_size"))
    per_day = (F.lit(24 * 60) / F.col("_size")).cast("int")
    mark = F.col("_size") * SIZE_STEP if sizes else F.lit(0)
    return sized.withColumn(
        "bucket", F.explode(F.array(mark + F.pmod(own, per_day), mark + F.pmod(own + 1, per_day)))
    )


def line_index(departures: DataFrame, stops: DataFrame, params: MatchParams,
               sizes: list[int] | None = None) -> DataFrame:
    """(tile, bucket) to the lines due there and the stop's index within the line.

    ``sizes`` gives the index for several bucket sizes, told apart by SIZE_STEP.
    """
    return _due_buckets(departures, stops, params, ["line_id", "seq"], sizes).select(
        "tile7", "bucket", "line_id", F.col("seq").cast("int").alias("seq")
    ).distinct()


def stop_index(departures: DataFrame, stops: DataFrame, params: MatchParams) -> DataFrame:
    """(tile, bucket) to the ids of the stops with a departure due there."""
    return _due_buckets(departures, stops, params, []).select("tile7", "bucket", "IFOPT").distinct()


def resolve_stops(references: DataFrame, stops: DataFrame) -> DataFrame:
    """Attach the stop row to each IFOPT reference; an unknown id gets a null stop."""
    known = first_by_ifopt(stops).select(
        "IFOPT", F.struct(*STOP_FIELDS).alias("stop")
    )
    return references.join(shuffled(known), "IFOPT", "left")


def candidate_lists(index: DataFrame) -> DataFrame:
    """One row per (tile, bucket) with its due lines as an array.

    The list is as long as the lines due at one place, so joining it keeps one
    row per keypoint where joining the index itself would multiply the keypoints.
    """
    per_line = index.groupBy("tile7", "bucket", "line_id").agg(
        F.bool_or(F.col("seq") == 0).alias("has_zero")
    )
    return per_line.groupBy("tile7", "bucket").agg(
        F.array_sort(F.collect_list(F.struct("line_id", "has_zero"))).alias("cands")
    )


def serving_stops(placed: DataFrame, service: DataFrame) -> DataFrame:
    """One row per (tile, line) with the stops there that the line serves."""
    return (
        placed.join(shuffled(service), "IFOPT")
        .groupBy("tile7", "line_id")
        .agg(F.collect_list(F.struct(*STOP_FIELDS)).alias("serving"))
    )

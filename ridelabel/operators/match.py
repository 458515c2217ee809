"""Join keypoints with the timetable."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelabel.functions import tiles
from ridelabel.functions.geometry import planar_dist
from ridelabel.functions.timekeys import bucket
from ridelabel.operators.index import STOP_FIELDS
from ridelabel.operators.skew import lookup
from ridelabel.params import MatchParams
from ridelabel.sources.master import MasterData


def place_time_keys(keypoints: DataFrame, params: MatchParams) -> DataFrame:
    """Add the join keys ``tile7`` and ``bucket``."""
    return keypoints.withColumns({
        "tile7": tiles.tile_id(F.col("geo_latitude"), F.col("geo_longitude"), params.stop_tile_chars),
        "bucket": bucket(F.col("time"), params.zone, params.bucket_minutes),
    })


def _find(keyed: DataFrame, name: str, table: DataFrame, keys: list[str], master: MasterData,
          params: MatchParams) -> DataFrame:
    spread = [F.col("vehicle_id"), F.col("run_id")]
    return lookup(keyed, table, keys, name in master.small, params.join_salts, spread)


def near_stops(keyed: DataFrame, master: MasterData, params: MatchParams) -> DataFrame:
    """Every keypoint with each stop of its tile (1:n; no stop gives one null row)."""
    placed = master.placed.select("tile7", F.struct(*STOP_FIELDS).alias("stop"))
    joined = _find(keyed, "placed", placed, ["tile7"], master, params)
    return joined.withColumn("dist", stop_distance(F.col("stop")))


def stop_distance(stop: Column) -> Column:
    return planar_dist(F.col("geo_longitude"), F.col("geo_latitude"), stop["longitude"], stop["latitude"])


def with_near_flag(keyed: DataFrame, master: MasterData, params: MatchParams) -> DataFrame:
    """Add ``near``: whether the keypoint's tile has any stop."""
    occupied = master.occupied.withColumn("_near", F.lit(True))
    found = _find(keyed, "occupied", occupied, ["tile7"], master, params)
    return found.withColumn("near", F.coalesce("_near", F.lit(False))).drop("_near")


def with_candidates(keyed: DataFrame, master: MasterData, params: MatchParams) -> DataFrame:
    """Add ``cands``: the lines due at the keypoint's place and time, empty if none.

    A line carries ``has_zero`` when the keypoint may be its first stop.
    """
    found = _find(keyed, "due", master.due, ["tile7", "bucket"], master, params)
    none = F.array().cast(master.due.schema["cands"].dataType)
    return found.withColumn("cands", F.coalesce("cands", none))


def line_votes(has_zero: Column, first_stop: Column, other_stop: Column) -> Column:
    """Votes one keypoint gives to a candidate line; the vote adds up these."""
    return F.when(has_zero, first_stop).otherwise(other_stop).cast("int")


def with_line_details(labelled: DataFrame, master: MasterData, params: MatchParams) -> DataFrame:
    """Add ``routeName`` and ``routeDetails`` of ``line_id``; an unknown line gets nulls.

    Rows without a line keep what they came with.
    """
    rest = _put_aside(labelled, "routeName", "routeDetails")
    return _put_back(_find(rest, "details", master.details, ["line_id"], master, params))


def _put_aside(rows: DataFrame, *names: str) -> DataFrame:
    """Columns that a lookup is about to write, out of its way."""
    return rows.withColumnsRenamed({n: f"_own_{n}" for n in names})


def _put_back(rows: DataFrame) -> DataFrame:
    own = {c.removeprefix("_own_"): c for c in rows.columns if c.startswith("_own_")}
    return rows.withColumns({
        n: F.when(F.col("line_id").isNull(), F.col(c)).otherwise(F.col(n)) for n, c in own.items()
    }).drop(*own.values()) if own else rows


def with_nearest_serving_stop(labelled: DataFrame, master: MasterData, params: MatchParams) -> DataFrame:
    """Add ``stop_scheduleStop``: the nearest stop of the line within the keypoint's tile.

    The stops of a (tile, line) come as one array, so the minimum is taken inside
    the row: no row is multiplied and nothing is grouped again. Equal distances
    are decided by IFOPT. Rows without a line keep the stop they came with.
    """
    rest = _put_aside(labelled, "stop_scheduleStop")
    found = _find(rest, "serving", master.serving, ["tile7", "line_id"], master, params)
    ranked = F.transform(
        "serving",
        lambda s: F.struct(stop_distance(s).alias("dist"), s["IFOPT"].alias("id"), s.alias("stop")),
    )
    return _put_back(
        found.withColumn("_best", F.array_min(ranked))
        .withColumns({"stop_scheduleStop": F.col("_best.stop"), "stop_dist": F.col("_best.dist")})
        .drop("serving", "_best")
    )


def with_stop_naming(labelled: DataFrame) -> DataFrame:
    """Stop name and first-stop mark of the detecting rows; other rows keep theirs."""
    changes = {
        "stop_name": F.when(
            F.col("detected") & F.col("stop_scheduleStop").isNotNull(), F.col("stop_scheduleStop.name")
        ).otherwise(F.col("stop_name")),
        "stop_route_Index": route_start_mark(labelled),
    }
    return labelled.withColumns(changes)


def route_start_mark(labelled: DataFrame) -> Column:
    """0 where the detected line may start at the detecting row."""
    kept = F.col("stop_route_Index") if "stop_route_Index" in labelled.columns else F.lit(None).cast("int")
    return F.when(F.col("detected") & F.col("at_start"), F.lit(0)).otherwise(kept)

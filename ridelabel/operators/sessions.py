"""Position filter, sessions per vehicle, and runs within one tile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridelabel.functions import tiles
from ridelabel.operators.skew import CHUNK
from ridelabel.params import MatchParams


def valid_positions(waypoints: DataFrame) -> DataFrame:
    """Waypoints with both coordinates; Catalyst moves the filter into the scan."""
    return waypoints.where(F.col("geo_latitude").isNotNull() & F.col("geo_longitude").isNotNull())


def with_cell(waypoints: DataFrame) -> DataFrame:
    return waypoints.withColumn("cell", tiles.cell(F.col("geo_latitude"), F.col("geo_longitude")))


def with_runs(waypoints: DataFrame, params: MatchParams) -> DataFrame:
    """Add ``session_id`` and ``run_id``, both counted from 1 per vehicle.

    A session ends with a gap longer than the limit; a run ends with its session
    or when the coarse tile differs from the previous waypoint's. Vehicles too
    large for one task come with their rows' chunks, which are dropped here.
    """
    rows = waypoints.withColumn("_tile", tiles.cell_tile(F.col("cell"), params.run_tile_chars))
    number = _runs_in_chunks if CHUNK in waypoints.columns else _runs_per_vehicle
    return number(rows, params).drop("_tile")


#: Column with a row's own session gap in seconds, the same for a whole vehicle.
GAP = "_gap"


def _gap(rows: DataFrame, params: MatchParams) -> Column:
    return (F.col(GAP) if GAP in rows.columns else F.lit(params.session_gap_seconds)).cast("bigint") * 1_000_000


def _flags(time, tile, prev_time, prev_tile, gap: Column):
    session = prev_time.isNull() | (F.unix_micros(time) - F.unix_micros(prev_time) > gap)
    return session, session | (tile != prev_tile)


def _runs_per_vehicle(rows: DataFrame, params: MatchParams) -> DataFrame:
    order = Window.partitionBy("vehicle_id").orderBy("time", "seq_no")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    new_session, new_run = _flags(
        F.col("time"), F.col("_tile"), F.lag("time").over(order), F.lag("_tile").over(order), _gap(rows, params)
    )
    flagged = rows.withColumns({"_s": new_session.cast("bigint"), "_r": new_run.cast("bigint")})
    return flagged.withColumns(
        {"session_id": F.sum("_s").over(so_far), "run_id": F.sum("_r").over(so_far)}
    ).drop("_s", "_r")


def _runs_in_chunks(rows: DataFrame, params: MatchParams) -> DataFrame:
    """The same numbering with one task per (vehicle, time chunk).

    Within a chunk the counts start at zero and the first row opens nothing. A
    summary with one row per chunk then says whether that first row opens a
    session or run, and how many were opened before.
    """
    order = Window.partitionBy("vehicle_id", "_chunk").orderBy("time", "seq_no")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    new_session, new_run = _flags(
        F.col("time"), F.col("_tile"), F.lag("time").over(order), F.lag("_tile").over(order), _gap(rows, params)
    )
    first = F.row_number().over(order) == 1
    flagged = rows.withColumns({
        "_s": F.when(first, 0).otherwise(new_session.cast("bigint")),
        "_r": F.when(first, 0).otherwise(new_run.cast("bigint")),
    })
    counted = flagged.withColumns({"_ls": F.sum("_s").over(so_far), "_lr": F.sum("_r").over(so_far)})

    edge = F.struct("time", "seq_no", "_tile")
    own = [F.first(GAP).alias(GAP)] if GAP in rows.columns else []
    summary = flagged.groupBy("vehicle_id", "_chunk").agg(
        *own,
        F.min(edge).alias("_first"), F.max(edge).alias("_last"),
        F.sum("_s").alias("_ns"), F.sum("_r").alias("_nr"),
    )
    chunks = Window.partitionBy("vehicle_id").orderBy("_chunk")
    before = chunks.rowsBetween(Window.unboundedPreceding, -1)
    until = chunks.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    previous = F.lag("_last").over(chunks)
    opens_session, opens_run = _flags(
        F.col("_first.time"), F.col("_first._tile"), previous["time"], previous["_tile"], _gap(summary, params)
    )
    bases = summary.withColumns({
        "_fs": opens_session.cast("bigint"), "_fr": opens_run.cast("bigint"),
    }).select(
        "vehicle_id", "_chunk",
        (F.sum("_fs").over(until) + F.coalesce(F.sum("_ns").over(before), F.lit(0))).alias("_bs"),
        (F.sum("_fr").over(until) + F.coalesce(F.sum("_nr").over(before), F.lit(0))).alias("_br"),
    ).withColumnsRenamed({"vehicle_id": "_v", "_chunk": "_c"})
    joined = counted.join(
        bases, counted["vehicle_id"].eqNullSafe(bases["_v"]) & (counted["_chunk"] == bases["_c"])
    )
    return joined.withColumns({
        "session_id": F.col("_bs") + F.col("_ls"), "run_id": F.col("_br") + F.col("_lr"),
    }).drop("_s", "_r", "_ls", "_lr", "_bs", "_br", "_v", "_c", "_chunk")

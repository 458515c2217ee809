"""Collapse each run of waypoints in one tile to a single keypoint."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelabel.functions import tiles

DOORS = "i_occupancy_doorEntryExitActivity"
# Fixed value: the event type that wins over all others.
PLANNED_STOP = "PLANNEDSTOP"

_RUN = ["vehicle_id", "session_id", "run_id"]


def collapse_runs(rows: DataFrame) -> DataFrame:
    """One row per (vehicle, session, run); a run of one row keeps its values.

    Two aggregations: per door, then per run. Both combine before they shuffle
    and need no shuffle at all when the rows already lie by vehicle.
    """
    kept = [c for c in rows.columns if c not in (*_RUN, "cell")]
    per_row = rows.select(
        *_RUN, "cell", F.struct("time", "seq_no", *[c for c in kept if c not in ("time", "seq_no")])
        .alias("_row"), F.posexplode_outer(DOORS).alias("_pos", "_door", "_activity"),
    )
    row = F.col("_row")
    # A row with several doors appears once per door; count it and its name once.
    once = F.coalesce(F.col("_pos"), F.lit(0)) == 0
    name = F.when(once & (row["stop_name"] != ""),
                  F.struct(row["time"], row["seq_no"], row["stop_name"].alias("name")))
    per_door = per_row.groupBy(*_RUN, "_door").agg(
        F.sum(once.cast("bigint")).alias("_n"),
        F.min(row["time"]).alias("_start"),
        F.max(row["time"]).alias("_end"),
        F.min("cell").alias("_cmin"),
        F.max("cell").alias("_cmax"),
        F.max_by(row, F.struct(row["time"], row["seq_no"])).alias("_last"),
        F.bool_or(row["event_Type"] == PLANNED_STOP).alias("_planned"),
        F.collect_list(name).alias("_names"),
        F.coalesce(F.sum("_activity.boarding"), F.lit(0)).alias("_boarding"),
        F.coalesce(F.sum("_activity.exiting"), F.lit(0)).alias("_exiting"),
    )
    last = F.col("_last")
    door = F.when(F.col("_door").isNotNull(), F.struct(
        "_door", F.struct(F.col("_boarding").alias("boarding"), F.col("_exiting").alias("exiting"))
    ))
    runs = per_door.groupBy(*_RUN).agg(
        F.sum("_n").alias("_n"),
        F.min("_start").alias("_start"),
        F.max("_end").alias("_end"),
        F.min("_cmin").alias("_cmin"),
        F.max("_cmax").alias("_cmax"),
        F.max_by(last, F.struct(last["time"], last["seq_no"])).alias("_last"),
        F.bool_or("_planned").alias("_planned"),
        F.flatten(F.collect_list("_names")).alias("_names"),
        F.map_from_entries(F.collect_list(door)).alias("_doors"),
    )

    many = F.col("_n") > 1
    shared = tiles.common_chars(F.col("_cmin"), F.col("_cmax"))
    center = tiles.cell_center(F.col("_cmin"), shared)
    newest_first = F.transform(F.reverse(F.array_sort("_names")), lambda x: x["name"])
    merged = {
        "time": F.col("_start"),
        "time_end": F.when(many, F.col("_end")).otherwise(last["time_end"]),
        "geo_latitude": F.when(many, center["lat"]).otherwise(last["geo_latitude"]),
        "geo_longitude": F.when(many, center["lon"]).otherwise(last["geo_longitude"]),
        "geo_Hash": tiles.prefix_text(F.col("_cmin"), shared),
        "event_Type": F.when(F.col("_planned"), PLANNED_STOP).otherwise(last["event_Type"]),
        "event_Subtype": F.when(~many, last["event_Subtype"]),
        "meta_ingestionPartition": F.when(~many, last["meta_ingestionPartition"]),
        "stop_name": F.when(many, F.array_join(newest_first, ",")).otherwise(last["stop_name"]),
        DOORS: F.when(many, F.col("_doors")).otherwise(last[DOORS]),
    }
    columns = [merged.pop(c, last[c]).alias(c) for c in kept]
    extra = [value.alias(c) for c, value in merged.items()]
    return runs.select(*_RUN, *columns, *extra)

"""Whole pipelines: collapse, match, enrich, and their partitioned and swept runs.

Vehicles with more rows than one task should hold are found by one counting pass at
the start of each pipeline. They take the same steps cut into chunks of time.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelabel.functions.timekeys import bucket
from ridelabel.operators import match, vote
from ridelabel.operators.collapse import collapse_runs
from ridelabel.operators.index import SIZE_STEP
from ridelabel.operators.sessions import GAP, valid_positions, with_cell, with_runs
from ridelabel.operators.skew import CHUNK, lookup, split_hot, with_chunks
from ridelabel.params import MatchParams
from ridelabel.sources.master import MasterData
from ridelabel.storage import written


def _by_heat(rows: DataFrame, params: MatchParams) -> list[DataFrame]:
    """Rows of ordinary vehicles and, if there are any, of hot ones with their chunks."""
    cold, hot = split_hot(rows, "vehicle_id", "time", params.hot_vehicle_rows)
    return [cold] if hot is None else [cold, hot]


def _joined(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _runs(rows: DataFrame, params: MatchParams) -> DataFrame:
    if CHUNK not in rows.columns:
        # The windows need this placement anyway; computing tiles behind it keeps
        # them out of the shuffle and spreads their cost over all tasks.
        rows = rows.repartition("vehicle_id")
    return with_runs(with_cell(rows), params)


def _keypoints(waypoints: DataFrame, params: MatchParams) -> list[DataFrame]:
    """Keypoints of ordinary vehicles, and of hot ones, which later steps read more than once."""
    cold, *hot = _by_heat(valid_positions(waypoints), params)
    found = [collapse_runs(_runs(cold, params))]
    for rows in hot:
        keypoints = written(collapse_runs(_runs(rows, params)))
        found.append(with_chunks(keypoints, "vehicle_id", "time", params.hot_vehicle_rows))
    return found


def number_runs(waypoints: DataFrame, params: MatchParams = MatchParams()) -> DataFrame:
    """Waypoints with a position, their session and their run within a coarse tile."""
    return _joined([_runs(rows, params) for rows in _by_heat(valid_positions(waypoints), params)])


def collapse_waypoints(waypoints: DataFrame, params: MatchParams = MatchParams()) -> DataFrame:
    """Keypoints: one row per vehicle, session and run within a coarse tile."""
    return _joined([collapse_runs(_runs(rows, params)) for rows in _by_heat(valid_positions(waypoints), params)])


def _vote(keyed: DataFrame, master: MasterData, params: MatchParams) -> DataFrame:
    # Every tile of the index has a stop (see MasterData), so a due line implies one near.
    found = match.with_candidates(keyed, master, params).drop("bucket")
    return vote.vote_fold(vote.with_parts(found, params), params)


def _fold(keypoints: DataFrame, master: MasterData, params: MatchParams) -> DataFrame:
    return _vote(match.place_time_keys(keypoints, params), master, params)


def _label(keypoints: DataFrame, master: MasterData, params: MatchParams) -> DataFrame:
    return vote.backfill(_fold(keypoints, master, params), params)


def with_details(labelled: DataFrame, master: MasterData, params: MatchParams = MatchParams()) -> DataFrame:
    """Labelled keypoints with nearest serving stop and route details."""
    # Route details are wide: they come last, behind the stop lookup.
    stopped = match.with_nearest_serving_stop(labelled, master, params)
    detailed = match.with_line_details(stopped, master, params)
    return match.with_stop_naming(detailed).drop("tile7", "part", "at_start")


def _match(keypoints: DataFrame, master: MasterData, params: MatchParams) -> DataFrame:
    return with_details(_label(keypoints, master, params), master, params)


def candidate_steps(waypoints: DataFrame, master: MasterData, params: MatchParams = MatchParams()) -> DataFrame:
    """Keypoints with the lines due at each (``cands``): what the vote goes through."""
    def step(keypoints: DataFrame, master: MasterData, params: MatchParams) -> DataFrame:
        return match.with_candidates(match.place_time_keys(keypoints, params), master, params).drop("bucket", CHUNK)

    return _on_keypoints(step, waypoints, master, params)


def _on_keypoints(step: Callable, waypoints: DataFrame, master: MasterData, params: MatchParams) -> DataFrame:
    return _joined([step(keypoints, master, params) for keypoints in _keypoints(waypoints, params)])


def fold_lines(waypoints: DataFrame, master: MasterData, params: MatchParams = MatchParams()) -> DataFrame:
    """Keypoints with the line decided at each (``det``); keys kept for later joins."""
    return _on_keypoints(lambda *a: _fold(*a).drop(CHUNK), waypoints, master, params)


def label_lines(waypoints: DataFrame, master: MasterData, params: MatchParams = MatchParams()) -> DataFrame:
    """Keypoints with ``line_id``, ``detected`` and ``at_start``."""
    return _on_keypoints(_label, waypoints, master, params)


def match_lines(keypoints: DataFrame, master: MasterData, params: MatchParams = MatchParams()) -> DataFrame:
    """Stored keypoints labelled with line, route details and nearest serving stop."""
    return _joined([_match(rows, master, params) for rows in _by_heat(keypoints, params)])


def enrich(waypoints: DataFrame, master: MasterData, params: MatchParams = MatchParams(),
           entity: str = "vehicle_id") -> DataFrame:
    """The whole job on stored waypoints: labelled keypoints.

    Ordinary vehicles go through one shuffle of the waypoints and one of the
    keypoints. ``entity`` names the key column of any other GPS trace.
    """
    rows = waypoints if entity == "vehicle_id" else waypoints.withColumn("vehicle_id", F.col(entity))
    return _on_keypoints(_match, rows, master, params)


def with_stop_departures(enriched: DataFrame, departures: DataFrame, params: MatchParams = MatchParams()) -> DataFrame:
    """Enriched rows whose stop carries all its planned departures, as the timetable lists them.

    Rows are as wide as their stop's timetable then, so this is a step of its own behind ``enrich``.
    The table of departures has a row per stop and is shuffled; a popular stop does not meet in one
    task (see ``lookup``).
    """
    listed = departures.groupBy("IFOPT").agg(F.array_sort(F.collect_list(
        F.struct("line_id", F.col("seq").cast("int").alias("seq"), "dep_sec"))).alias("_departures"))
    keyed = enriched.withColumn("_stop", F.col("stop_scheduleStop.IFOPT"))
    found = lookup(keyed, listed.withColumnRenamed("IFOPT", "_stop"), ["_stop"], False, params.join_salts,
                   [F.col("vehicle_id"), F.col("run_id")])
    stop = F.col("stop_scheduleStop")
    full = F.when(stop.isNotNull(), stop.withField("plannedDepartures", F.col("_departures")))
    return found.withColumn("stop_scheduleStop", full).drop("_stop", "_departures")


#: Column that names a region or time interval matched by itself.
PARTITION = "match_partition"


def enrich_partitioned(waypoints: DataFrame, master: MasterData, partition: Column,
                       params: MatchParams = MatchParams()) -> DataFrame:
    """Match every partition of the waypoints (a region, a time interval) by itself.

    One job for all partitions: the partition value becomes part of the vehicle
    key. Adds ``match_partition``.
    """
    return enrich_stored(waypoints.withColumn(PARTITION, partition), master, params)


def enrich_stored(rows: DataFrame, master: MasterData, params: MatchParams = MatchParams()) -> DataFrame:
    """The same for rows that come with their ``match_partition``."""
    keyed = rows.withColumn("vehicle_id", F.struct(F.col(PARTITION).alias("part"), F.col("vehicle_id").alias("id")))
    result = enrich(keyed.drop(PARTITION), master, params)
    return result.withColumns({PARTITION: F.col("vehicle_id.part"), "vehicle_id": F.col("vehicle_id.id")})


def store_partitioned(waypoints: DataFrame, path: str, partition: Column) -> None:
    """Store waypoints in one folder per partition (a region, a day), for runs that read their part only.

    Rows without a position are left out; they match nothing. A partition is written by as many
    tasks as its share of the rows needs. Storing again replaces the partitions that come, and
    leaves the others.
    """
    rows = valid_positions(waypoints).withColumn(PARTITION, partition.cast("string"))
    rows.repartitionByRange(PARTITION, "vehicle_id", "time").write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy(PARTITION).parquet(path)


def read_partitions(spark: SparkSession, path: str, schema: T.StructType, which: Column | None = None) -> DataFrame:
    """Stored partitions; ``which``, a condition on ``match_partition``, decides which folders are read."""
    typed = T.StructType([f for f in schema if f.name != PARTITION] + [T.StructField(PARTITION, T.StringType())])
    rows = spark.read.schema(typed).parquet(path)
    return rows if which is None else rows.where(which)


def enrich_partitions(spark: SparkSession, path: str, schema: T.StructType, out: str, master: MasterData,
                      params: MatchParams = MatchParams(), which: Column | None = None) -> DataFrame:
    """Match some stored partitions and store the results in folders of the same names.

    Only the chosen folders are read, and only theirs are replaced, so runs for different regions
    or days can follow or accompany each other. Returns the stored results of this run.
    """
    done = enrich_stored(read_partitions(spark, path, schema, which), master, params)
    done.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PARTITION).parquet(out)
    return read_partitions(spark, out, done.schema, which)


#: Parameters that a sweep may vary.
SWEPT = ("bucket_minutes", "session_gap_seconds", "first_stop_votes", "other_stop_votes", "single_min_votes", "winning_margin")


def parameter_sweep(waypoints: DataFrame, stops: DataFrame, lines: DataFrame, departures: DataFrame,
                    choices: list[MatchParams]) -> DataFrame:
    """Labelled share of the keypoints for several sets of parameters, one row per set.

    Gives ``choice`` (the place in the list), the swept parameters, ``keypoints``, ``labelled`` and
    ``detected``. One job for all: waypoints are collapsed once per session gap, keypoints then
    joined with the table of choices; gap and choice are part of the vehicle key, and the fold reads
    votes and margin from the row.
    """
    spark, params = waypoints.sparkSession, choices[0]
    if len({c.with_(**{n: getattr(params, n) for n in SWEPT}) for c in choices}) > 1:
        raise ValueError(f"a sweep varies {', '.join(SWEPT)} only")
    schema = "choice BIGINT, " + ", ".join(f"{n} INT" for n in SWEPT)
    table = spark.createDataFrame([(i, *(getattr(c, n) for n in SWEPT)) for i, c in enumerate(choices)], schema)
    master = MasterData.from_timetable(stops, lines, departures, params, sorted({c.bucket_minutes for c in choices}))

    gaps = F.array(*map(F.lit, sorted({c.session_gap_seconds for c in choices})))
    by_gap = waypoints.withColumn(GAP, F.explode(gaps)).withColumn("vehicle_id", F.struct(GAP, "vehicle_id"))

    def steps(keypoints: DataFrame) -> DataFrame:
        # As many rows as there are choices, from the call itself.
        keyed = match.place_time_keys(keypoints, params).join(
            F.broadcast(table), F.col(GAP) == F.col("session_gap_seconds"))
        rows = keyed.withColumns({
            "bucket": F.col("bucket_minutes") * SIZE_STEP + bucket(F.col("time"), params.zone, F.col("bucket_minutes")),
            # A choice has one gap.
            "vehicle_id": F.struct("choice", "vehicle_id.vehicle_id"),
            vote.RULES: F.struct("first_stop_votes", "other_stop_votes", "single_min_votes", "winning_margin"),
        })
        # What lookup, vote and backfill read: Spark cannot tell through Python which columns those are.
        narrow = rows.select("vehicle_id", "session_id", "run_id", "time", "seq_no", "tile7", "bucket", vote.RULES,
                             *[c for c in rows.columns if c == CHUNK])
        # Written, so that the shuffles up to here and those of the vote do not lie on the disks together.
        return written(match.with_candidates(narrow, master, params).drop("bucket", "tile7", "run_id"))

    labelled = _joined([
        vote.backfill(vote.vote_fold(vote.with_parts(steps(keypoints), params), params), params)
        .select("vehicle_id.choice", "line_id", "detected")
        for keypoints in _keypoints(by_gap, params)
    ])
    found = labelled.groupBy("choice").agg(
        F.count(F.lit(1)).alias("_keypoints"), F.count("line_id").alias("_labelled"),
        F.sum(F.col("detected").cast("bigint")).alias("_detected"),
    )
    # One row per choice; one without keypoints has zeros.
    return table.join(F.broadcast(found), "choice", "left").select("choice", *SWEPT, *[
        F.coalesce(f"_{c}", F.lit(0)).cast("bigint").alias(c) for c in ("keypoints", "labelled", "detected")
    ])


def bucket_sweep(waypoints: DataFrame, stops: DataFrame, lines: DataFrame, departures: DataFrame,
                 bucket_minutes: list[int], params: MatchParams = MatchParams()) -> DataFrame:
    """``parameter_sweep`` over bucket sizes alone."""
    choices = [params.with_(bucket_minutes=m) for m in bucket_minutes]
    swept = parameter_sweep(waypoints, stops, lines, departures, choices)
    return swept.select("bucket_minutes", "keypoints", "labelled", "detected")

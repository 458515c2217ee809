"""Sessions, runs, collapse, index and vote on literal rows."""

import random
from collections import Counter
from dataclasses import replace
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from ridelabel.operators import index, match, vote
from ridelabel.operators.collapse import DOORS
from ridelabel.operators.sessions import with_cell, with_runs
from ridelabel.operators.skew import lookup, split_hot, with_chunks
from ridelabel.params import MatchParams
from ridelabel.plans import enrich as plans
from ridelabel.sources import fixtures as fx
from ridelabel.sources.master import HASHED, MasterData, measured
from ridelabel.sources.waypoints import WAYPOINT_SCHEMA
from ridelabel.storage import written

P = MatchParams()
T0 = datetime(2024, 1, 15, 8, 0, tzinfo=timezone.utc)
LAT_STEP, LON_STEP = 180.0 / 2**20, 360.0 / 2**20  # one tile of eight characters
STOP_LAT = 180.0 / 2**17


def waypoint(seq, vehicle="v", sec=0.0, lat=50.0, lon=9.0, **more):
    row = dict(
        seq_no=seq, vehicle_id=vehicle, time=T0 + timedelta(seconds=sec), time_end=None, geo_latitude=lat,
        geo_longitude=lon, geo_Hash=None, event_Type="LOCATION", event_Subtype="sub", stop_name=None,
        meta_ingestionPartition="p",
    )
    row[DOORS] = None
    row.update(more)
    return row


def frame(spark, rows):
    names = [f.name for f in spark.createDataFrame([], WAYPOINT_SCHEMA).schema]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], WAYPOINT_SCHEMA)


def by_seq(df, *columns):
    return {r.seq_no: tuple(r[c] for c in columns) for r in df.collect()}


def test_session_needs_more_than_five_minutes(spark):
    rows = [waypoint(1), waypoint(2, sec=300), waypoint(3, sec=600.000001), waypoint(4, vehicle="w", sec=1)]
    got = by_seq(with_runs(with_cell(frame(spark, rows)), P), "session_id")
    assert got == {1: (1,), 2: (1,), 3: (2,), 4: (1,)}


def test_run_compares_with_the_previous_waypoint_and_equal_times_use_seq_no(spark):
    there = 50.0 + 3 * LAT_STEP
    rows = [waypoint(3, lat=50.0), waypoint(1, lat=50.0), waypoint(2, lat=there), waypoint(4, sec=5, lat=50.0)]
    got = by_seq(with_runs(with_cell(frame(spark, rows)), P), "run_id")
    assert got == {1: (1,), 2: (2,), 3: (3,), 4: (3,)}


def test_collapse_of_a_run(spark):
    base = (round(50.0 / LAT_STEP) + 0.5) * LAT_STEP
    doors = {"a": (1, 2)}, {"a": (10, 20), "b": (5, 0)}
    rows = [
        waypoint(1, sec=0, lat=base, stop_name="X", event_Type="PLANNEDSTOP", **{DOORS: doors[0]}),
        waypoint(2, sec=1, lat=base + LAT_STEP / 4, stop_name=""),
        waypoint(3, sec=2, lat=base, stop_name="Y", **{DOORS: doors[1]}),
        waypoint(4, sec=3, lat=base + 9 * LAT_STEP, stop_name=None),
        waypoint(5, sec=4, lat=None),
        waypoint(6, sec=5, lat=base + 90 * LAT_STEP), waypoint(7, sec=6, lat=base + 90 * LAT_STEP),
    ]
    first, single, bare = plans.collapse_waypoints(frame(spark, rows), P).orderBy("run_id").collect()
    assert first.time.timestamp() == T0.timestamp() and first.time_end - first.time == timedelta(seconds=2)
    assert first.event_Type == "PLANNEDSTOP" and first.stop_name == "Y,X" and first.seq_no == 3
    assert first.event_Subtype is None and first.meta_ingestionPartition is None
    assert {k: tuple(v) for k, v in first[DOORS].items()} == {"a": (11, 22), "b": (5, 0)}
    assert 8 <= len(first.geo_Hash) < 12
    assert single.time_end is None and single.event_Subtype == "sub" and single[DOORS] is None
    assert single.stop_name is None and len(single.geo_Hash) == 12 and single.geo_latitude == base + 9 * LAT_STEP
    assert bare.stop_name == "" and bare[DOORS] == {} and bare.event_Type == "LOCATION"


def walk(vehicles=3, steps=400, seed=1):
    """Vehicles that wander, rest and pause, over many time chunks."""
    rng = random.Random(seed)
    rows, seq = [], 0
    for v in range(vehicles):
        sec, cell = 0.0, 0
        for _ in range(steps):
            seq += 1
            sec += rng.choice([1, 5, 60, 290, 300, 301, 2000, 9000])
            cell += rng.choice([0, 0, 0, 1, -1, 4])
            rows.append(waypoint(seq, f"v{v}", sec, 50.0 + cell * LAT_STEP, stop_name=rng.choice([None, "", "N"]),
                                 **{DOORS: {"d": (seq % 3, 1)}}))
    return rows


@pytest.mark.parametrize("most", [0, 20, 400])
def test_time_chunks_give_the_same_keypoints(spark, most):
    w = frame(spark, walk())
    def rows(df):
        return sorted(repr((r.vehicle_id, r.session_id, r.run_id, r)) for r in df.collect())

    direct = rows(plans.collapse_waypoints(w, P))
    assert len(direct) > 500
    assert rows(plans.collapse_waypoints(w, P.with_(hot_vehicle_rows=most))) == direct


RESULT = ["vehicle_id", "session_id", "run_id", "geo_Hash", "line_id", "detected", "routeName",
          "stop_scheduleStop", "stop_name", "stop_route_Index"]


@pytest.mark.parametrize("scope", ["session", "vehicle"])
def test_hot_vehicles_get_the_same_result(master, waypoints, scope):
    """Every vehicle driven through the time-chunk way, and some only."""
    params = P.with_(scope=scope)
    w = waypoints
    want = plans.enrich(w, master, params).select(RESULT).persist()
    for limit in (0, 66):
        hot = plans.enrich(w, master, params.with_(hot_vehicle_rows=limit)).persist()
        assert hot.count() == want.count()
        assert hot.select(RESULT).exceptAll(want).isEmpty()


def test_one_vehicle_id_for_all_is_cut_into_parts(master, waypoints):
    """All waypoints under one id: restarts cut it, the result stays."""
    params = P.with_(scope="vehicle")
    w = waypoints.withColumn("vehicle_id", F.lit(1))
    keypoints = written(plans.collapse_waypoints(w, params))
    keyed = match.place_time_keys(keypoints, params)
    steps = match.with_candidates(keyed, master, params)
    parts = vote.with_parts(with_chunks(steps, "vehicle_id", "time", 10), params)
    assert parts.select("part").distinct().count() > 20
    want = plans.match_lines(keypoints, master, params).select(RESULT)
    got = plans.match_lines(keypoints, master, params.with_(hot_vehicle_rows=10)).select(RESULT).persist()
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()


@pytest.mark.parametrize("column", ["seq_no", "time", "vehicle_id"])
def test_hot_vehicles_with_nulls_get_the_same_result(spark, column):
    """Order numbers missing everywhere; times or vehicles missing in every fifth row."""
    w = frame(spark, walk())
    gone = F.lit(True) if column == "seq_no" else F.col("seq_no") % 5 == 0
    w = w.withColumn(column, F.when(~gone, F.col(column)))
    def rows(df):
        return sorted(repr(tuple(r)) for r in df.select("vehicle_id", "session_id", "run_id", "time", "geo_Hash").collect())

    want = rows(plans.collapse_waypoints(w, P))
    assert len(want) > 100
    for most in (0, 20):
        assert rows(plans.collapse_waypoints(w, P.with_(hot_vehicle_rows=most))) == want


def test_labels_of_unmatched_rows_stay(spark, master, waypoints):
    kept = plans.collapse_waypoints(waypoints, P).withColumn("routeName", F.lit("own"))
    got = plans.match_lines(kept, master, P)
    assert got.where("line_id IS NULL AND routeName = 'own'").count() == got.where("line_id IS NULL").count() > 0
    assert got.where("line_id IS NOT NULL AND routeName = 'own'").isEmpty()


def test_large_timetables_are_shuffled_with_the_same_result(spark, sf_dir, master, waypoints):
    everything = {"occupied", "due", "details", "serving", "placed"}
    assert master.small == everything
    assert not fx.fixture_master(spark, sf_dir, P.with_(broadcast_bytes=10)).small
    some = fx.fixture_master(spark, sf_dir, P.with_(broadcast_bytes=30_000)).small
    assert "occupied" in some and "due" not in some
    want = plans.enrich(waypoints, master, P).select(RESULT).persist()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for large in ({"due"}, everything):
            got = plans.enrich(waypoints, replace(master, small=frozenset(everything - large)), P).select(RESULT)
            plan = got._jdf.queryExecution().executedPlan().toString()
            assert plan.count("SortMergeJoin") == len(large & {"due", "serving", "details"})
            assert got.count() == want.count() and got.exceptAll(want).isEmpty()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_split_and_lookup_with_hot_and_null_keys(spark):
    big = spark.range(1000).select(F.when(F.col("id") < 600, 1).when(F.col("id") < 900, F.col("id")).alias("k"), "id", F.timestamp_seconds("id").alias("time"))
    cold, hot = split_hot(big, "k", "time", 50)
    assert hot.groupBy("k", "_chunk").count().agg(F.max("count")).first()[0] <= 60
    assert hot.count() == 700 and cold.count() == 300
    assert split_hot(big, "k", "time", 5000)[1] is None
    small = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("twice"))
    for flag in (True, False):
        found = lookup(big, small, ["k"], flag, 8, [F.col("id")])
        assert found.count() == 1000 and found.where("twice IS NULL").count() == 100


def stops_frame(spark, rows):
    return spark.createDataFrame(rows, "IFOPT STRING, name STRING, latitude DOUBLE, longitude DOUBLE, direction STRING,"
                                       " ref_name STRING, pos BIGINT")


def test_index_has_own_and_next_bucket_and_wraps_at_midnight(spark):
    stops = stops_frame(spark, [("A", "first", 50.0, 9.0, "a", None, 0), ("A", "second", 10.0, 9.0, "b", None, 1)])
    departures = spark.createDataFrame([(7, 0, "A", 86_399), (7, 1, "A", 600)],
                                       "line_id INT, seq INT, IFOPT STRING, dep_sec BIGINT")
    rows = index.line_index(departures, stops, P)
    assert sorted((r.bucket, r.line_id, r.seq) for r in rows.collect()) == [(0, 7, 0), (2, 7, 1), (3, 7, 1), (287, 7, 0)]
    assert rows.select("tile7").distinct().count() == 1
    refs = spark.createDataFrame([("A",), ("Z",)], "IFOPT STRING")
    assert {r.IFOPT: r.stop and r.stop.name for r in index.resolve_stops(refs, stops).collect()} == {"A": "first", "Z": None}


def python_fold(steps):
    """The vote rules, spelled out for one group."""
    votes, det, out = {}, None, []
    for due in steps:
        if not due:
            out.append(None)
            continue
        if det is not None and (any(due.values()) or det not in due):
            det, votes = None, {}
        votes = {l: (2 if z else 1) + votes.get(l, 0) for l, z in due.items()}
        best = sorted(votes.values(), reverse=True)
        det = None
        if len(best) == 1 and best[0] > 1 or len(best) > 1 and best[0] > best[1] + 2:
            det = max(votes, key=votes.get)
        out.append(det)
    return out


def test_vote_fold_and_backfill_against_plain_python(spark):
    rng = random.Random(11)
    groups, rows = {}, []
    for g in range(60):
        steps = []
        for i in range(rng.randrange(1, 40)):
            lines = rng.sample("abcd", rng.choice([0, 1, 1, 2, 3]))
            steps.append({l: rng.random() < 0.15 for l in lines})
            rows.append((f"v{g % 7}", g, i, i, T0 + timedelta(seconds=i), [(l, z) for l, z in steps[-1].items()]))
        groups[g] = steps
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "vehicle_id STRING, session_id INT, run_id INT, seq_no INT, time TIMESTAMP,"
                                     " cands ARRAY<STRUCT<line_id: STRING, has_zero: BOOLEAN>>")
    folded = vote.vote_fold(vote.with_parts(df, P), P)
    assert folded.where("det IS NOT NULL").count() > 100
    got = {(r.session_id, r.run_id): r for r in vote.backfill(folded, P).collect()}
    for g, steps in groups.items():
        want = python_fold(steps)
        for i, det in enumerate(want):
            r = got[g, i]
            later = next((d for d in want[i:] if d is not None), None)
            assert (r.line_id, r.detected) == (later, det is not None)
            assert r.at_start == (det is not None and steps[i][det])


def one_long_group(rng, steps, restarts):
    """Candidates of one vehicle; `restarts` says how often the vote may start anew.

    Neighbouring keypoints always share a line and never decide by themselves, so no restart is certain.
    """
    out = []
    for _ in range(steps):
        lines = ["a", *rng.sample("bcd", rng.choice([1, 1, 2]))]
        out.append({line: rng.random() < restarts for line in lines})
    return out


@pytest.mark.parametrize("restarts, most_open", [(0.15, 0), (0.0, 40)])
def test_a_group_without_certain_restarts_is_folded_by_many_tasks(spark, restarts, most_open):
    """The result is that of one fold, whether the votes forget their beginning or never do."""
    rng = random.Random(17)
    dues = one_long_group(rng, 600, restarts)
    rows = [("v", 1, i, i, T0 + timedelta(seconds=i), [(l, z) for l, z in due.items()], i // 15) for i, due in enumerate(dues)]
    # Another vehicle, whose chunks hold whole groups.
    rows += [(None, g, i, i, T0 + timedelta(seconds=i), [("a", False)], g) for g in range(3) for i in range(4)]
    df = spark.createDataFrame(rows, "vehicle_id STRING, session_id INT, run_id INT, seq_no INT, time TIMESTAMP,"
                                     " cands ARRAY<STRUCT<line_id: STRING, has_zero: BOOLEAN>>, _chunk INT")
    parts = vote.with_parts(df, P).persist()
    assert parts.where("vehicle_id = 'v'").select("part").distinct().count() == 1
    started = vote.with_true_starts(vote.with_points(parts, P), P)
    pieces = started.where("vehicle_id = 'v'").select(vote.PIECE).distinct().count()
    assert pieces >= 40 - most_open if restarts else pieces >= P.vote_rounds
    assert started.where("vehicle_id IS NULL").select(vote.PIECE).distinct().collect()[0][0] == vote.NO_PART
    got = [r.det for r in vote.vote_fold(parts, P).where("vehicle_id = 'v'").orderBy("seq_no").collect()]
    assert got == python_fold(dues) and sum(d is not None for d in got) > 50
    assert vote.vote_fold(parts, P).count() == len(rows)
    assert [r.det for r in vote.vote_fold(parts, P.with_(vote_rounds=0)).where("vehicle_id = 'v'").orderBy("seq_no").collect()] == got


def test_naming_unknown_lines_and_missing_stops(spark):
    stops = stops_frame(spark, [("B", "far", 50.0 + STOP_LAT / 8, 9.0, "a", None, 0), ("A", "near", 50.0, 9.0, "a", None, 1),
                                ("C", "twin", 50.0, 9.0, "b", None, 2)])
    lines = spark.createDataFrame([("1", "L1", "east")], "line_id STRING, lineLabel STRING, `to` STRING")
    departures = spark.createDataFrame(
        [("1", 0, s, 9 * 3600) for s in "ABC"] + [("2", 0, "A", 10 * 3600)],
        "line_id STRING, seq INT, IFOPT STRING, dep_sec BIGINT")
    master = MasterData.from_timetable(stops, lines, departures, P)
    rows = [waypoint(1, sec=0, stop_name="own"), waypoint(2, "w", sec=3600), waypoint(3, "x", lat=10.0)]
    got = {r.vehicle_id: r for r in plans.enrich(frame(spark, rows), master, P).collect()}
    assert (got["v"].stop_name, got["v"].routeName, got["v"].stop_route_Index) == ("near", "L1", 0)
    assert got["v"].stop_scheduleStop.IFOPT == "A"      # equal distance: the lower id
    assert (got["w"].line_id, got["w"].routeName, got["w"].routeDetails) == ("2", None, None)
    assert got["x"].line_id is None and got["x"].stop_scheduleStop is None


def test_partitioning_of_the_input_does_not_matter(master, waypoints):
    want = plans.enrich(waypoints, master, P).select(RESULT)
    got = plans.enrich(waypoints.repartition(7, "event_Type").orderBy(F.desc("time")), master, P).select(RESULT)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()


def test_parameters_are_checked():
    with pytest.raises(ValueError):
        MatchParams(scope="bus")
    with pytest.raises(ValueError):
        MatchParams(bucket_minutes=7)


def test_stored_partitions_are_read_and_replaced_alone(spark, master, waypoints, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    day = F.date_format("time", "yyyy-MM-dd-HH")
    plans.store_partitioned(waypoints, path, day)
    hours = sorted(r[0] for r in waypoints.where("geo_latitude IS NOT NULL").select(day).distinct().collect())
    assert len(hours) > 2
    one = F.col("match_partition") == hours[0]
    rows = plans.read_partitions(spark, path, waypoints.schema, one)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "match_partition" in plan.split("PartitionFilters:")[1].split("]")[0] and len(rows.inputFiles()) > 0
    first = plans.enrich_partitions(spark, path, waypoints.schema, out, master, P, one)
    want = plans.enrich_partitioned(waypoints, master, day, P).select(*RESULT, "match_partition")
    same = want.where(F.col("match_partition") == hours[0])
    assert first.count() == same.count() > 0 and first.select(same.columns).exceptAll(same).isEmpty()
    # A second run adds the others; a repeated one leaves a single copy.
    for which in (~one, one):
        plans.enrich_partitions(spark, path, waypoints.schema, out, master, P, which)
    every = plans.read_partitions(spark, out, first.schema)
    assert every.count() == want.count() and every.select(want.columns).exceptAll(want).isEmpty()


@pytest.mark.parametrize("limit", [5_000_000, 60])
def test_sweep_equals_separate_runs(spark, sf_dir, waypoints, limit):
    """Also with hot vehicles, whose sessions and votes are cut."""
    base = P.with_(hot_vehicle_rows=limit)
    choices = [base, base.with_(session_gap_seconds=60, winning_margin=0), base.with_(bucket_minutes=10, first_stop_votes=4),
               base.with_(other_stop_votes=3, single_min_votes=4)]
    tables = [make(spark, sf_dir) for make in (fx.fixture_stops, fx.fixture_lines, fx.fixture_departures)]
    got = plans.parameter_sweep(waypoints, *tables, choices).orderBy("choice").collect()
    assert [r.session_gap_seconds for r in got] == [300, 60, 300, 300]
    for choice, r in zip(choices, got):
        alone = plans.label_lines(waypoints, MasterData.from_timetable(*tables, choice), choice).agg(
            F.count("*"), F.count("line_id"), F.sum(F.col("detected").cast("int"))).first()
        assert (r.keypoints, r.labelled, r.detected) == tuple(alone)
    assert len({(r.keypoints, r.labelled, r.detected) for r in got}) == 4


def test_a_sweep_refuses_other_parameters(spark, sf_dir, waypoints):
    tables = [make(spark, sf_dir) for make in (fx.fixture_stops, fx.fixture_lines, fx.fixture_departures)]
    with pytest.raises(ValueError):
        plans.parameter_sweep(waypoints, *tables, [P, P.with_(zone="UTC")])


def broadcasts(table):
    """Joins of the plan that Spark chose to broadcast for."""
    plan = table._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "BroadcastHashJoin" in line or "BroadcastNestedLoopJoin" in line]


def test_derived_departures_meet_their_stops_in_a_shuffle(spark, sf_dir):
    """Exploded calls look as small as the lines they come from."""
    assert not broadcasts(fx.fixture_departures.__wrapped__(spark, sf_dir))


def test_growing_tables_of_the_index_are_shuffled(spark, sf_dir):
    stops, departures = fx.fixture_stops(spark, sf_dir), fx.fixture_departures(spark, sf_dir)
    placed, service = index.stop_tiles(stops, P), index.service_table(departures)
    for table in (
        index.line_index(departures, stops, P, [5, 10, 15]),
        index.resolve_stops(index.stop_index(departures, stops, P), stops),
        index.serving_stops(placed, service),
    ):
        assert not broadcasts(table)


def test_a_lookup_without_broadcast_is_a_shuffle_whatever_the_estimate(spark):
    big, small = spark.range(100).selectExpr("id % 7 AS k", "id"), spark.range(7).selectExpr("id AS k", "id * 2 AS v")
    found = lookup(big, small, ["k"], False, 16, [F.col("id")])
    assert not broadcasts(found)
    assert found.where("v = 2 * k").count() == 100


def test_a_shuffled_lookup_sends_every_row_of_the_table_once(spark):
    """A copy for each salt made the timetable the largest table of the job."""
    big, small = spark.range(100).selectExpr("id % 7 AS k", "id"), spark.range(7).selectExpr("id AS k", "id * 2 AS v")
    found = lookup(big, small, ["k"], False, 16, [F.col("id")])
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()


def with_settings(spark, settings, run):
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        return run()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_popular_and_null_keys_of_a_shuffled_lookup_meet_in_many_tasks(spark):
    kind = "CASE WHEN id % 10 < 4 THEN 1L WHEN id % 10 < 8 THEN NULL ELSE id END AS k"
    big = spark.range(0, 40_000, 1, 8).selectExpr(kind, "id", "repeat(uuid(), 4) AS text")
    small = spark.range(40_000).selectExpr("id AS k", "id * 2 AS v")
    size = "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"
    settings = {size: "64k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.shuffle.partitions": "16",
                "spark.sql.adaptive.coalescePartitions.enabled": "false"}

    def split():
        found = lookup(big, small, ["k"], False, 16, [F.col("id")])
        rows = found.select("k", "id", "v", F.spark_partition_id().alias("task"))
        got = rows.collect()
        return got, rows._jdf.queryExecution().executedPlan().toString()

    got, plan = with_settings(spark, settings, split)
    assert "skew=true" in plan
    assert len(got) == 40_000 and all(r.v == (None if r.k is None else 2 * r.k) for r in got)
    assert len({r.task for r in got if r.k == 1}) > 1
    nulls = Counter(r.task for r in got if r.k is None)
    assert len(nulls) >= 16 and max(nulls.values()) < 16_000 / 4


def test_a_shuffled_lookup_spreads_popular_keys_over_salts_where_spark_does_not(spark):
    big, small = spark.range(1000).selectExpr("IF(id < 900, 1L, NULL) AS k", "id"), spark.range(7).selectExpr("id AS k", "id * 2 AS v")
    for name in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled"):
        def salted():
            found = lookup(big, small, ["k"], False, 8, [F.col("id")])
            return found.where("v = 2").count(), found._jdf.queryExecution().executedPlan().toString()

        count, plan = with_settings(spark, {name: "false"}, salted)
        assert count == 900 and "Generate" in plan


@pytest.mark.parametrize("limit", [20_000, 60_000, 200_000, 1_000_000])
def test_broadcast_tables_fit_together_with_their_hash_tables(spark, sf_dir, limit):
    """Each alone, its rows' values alone: several times the limit came together in the driver."""
    tables = [make(spark, sf_dir) for make in (fx.fixture_stops, fx.fixture_lines, fx.fixture_departures)]
    master = MasterData.from_timetable(*tables, P.with_(broadcast_bytes=limit))
    sizes = measured(**{n: getattr(master, n) for n in master.small})
    assert 0 < sum(size + HASHED * rows for rows, size, _ in sizes.values()) <= limit


def shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return blocks.mkString(" ").count("shuffle_")


def test_a_written_table_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    table = written(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    assert table.count() == 7 and shuffle_files(spark) <= before


def test_departures_reach_the_lists_of_lines_by_two_exchanges(spark, sf_dir):
    """One by stop, one by tile; the stops' own grouping is the third of the plan."""
    rows = index.line_index(fx.fixture_departures(spark, sf_dir), fx.fixture_stops(spark, sf_dir), P, [5, 15])
    plan = index.candidate_lists(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 3


def test_index_of_repeated_and_unknown_departures(spark):
    stops = spark.createDataFrame([("A", 50.0, 9.0, 1), ("A", 10.0, 9.0, 2), ("B", 50.0, 9.0, 3)], "IFOPT STRING, latitude DOUBLE, longitude DOUBLE, pos INT")
    calls = [(1, 0, "A", 0), (1, 0, "A", 0), (1, 0, "A", 86_399), (1, 1, "B", 299), (2, 0, "B", None), (None, 0, "B", 600), (3, 0, "C", 0), (3, 0, None, 0)]
    departures = spark.createDataFrame(calls, "line_id BIGINT, seq BIGINT, IFOPT STRING, dep_sec BIGINT")
    lines = index.line_index(departures, stops, P)
    assert lines.select("tile7").distinct().count() == 1
    assert Counter(tuple(r) for r in lines.select("line_id", "seq", "bucket").collect()) == Counter([
        (1, 0, 0), (1, 0, 1), (1, 0, 287), (1, 1, 0), (1, 1, 1), (2, 0, None), (None, 0, 2), (None, 0, 3)])
    stopped = index.stop_index(departures, stops, P)
    assert Counter(tuple(r) for r in stopped.select("IFOPT", "bucket").collect()) == Counter([
        ("A", 0), ("A", 1), ("A", 287), ("B", 0), ("B", 1), ("B", None), ("B", 2), ("B", 3)])


def test_tables_written_to_be_measured_are_not_made_again(spark, sf_dir):
    tables = (fx.fixture_stops(spark, sf_dir), fx.fixture_lines(spark, sf_dir), fx.fixture_departures(spark, sf_dir))
    large = MasterData.from_timetable(*tables, P.with_(broadcast_bytes=0))
    assert large.kept == {"due", "serving"} and not large.small
    stored = large.stored()
    assert stored.due is large.due and stored.serving is large.serving and stored.placed is not large.placed
    small = MasterData.from_timetable(*tables, P)
    assert not small.kept and sorted(map(repr, small.due.collect())) == sorted(map(repr, stored.due.collect()))


def test_a_sweep_takes_to_the_vote_what_it_reads(spark, sf_dir, waypoints, monkeypatch):
    tables = (fx.fixture_stops(spark, sf_dir), fx.fixture_lines(spark, sf_dir), fx.fixture_departures(spark, sf_dir))
    steps = []
    monkeypatch.setattr(plans, "written", lambda rows: steps.append(written(rows)) or steps[-1])
    plans.parameter_sweep(waypoints, *tables, [P, P.with_(session_gap_seconds=60)])
    assert [s.columns for s in steps] == [["vehicle_id", "session_id", "time", "seq_no", vote.RULES, "cands"]]

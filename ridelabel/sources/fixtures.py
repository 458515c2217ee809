"""Waypoints, stops, lines and departures derived from the supplied tables.

The recipe is the one in FIXTURES.md, written with DataFrames. It works on whole
tables, so the waypoints grow with ``events``. The first query of a session writes what it derives
to the shared folder; the others read that.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelabel.operators.collapse import DOORS
from ridelabel.operators.skew import shuffled
from ridelabel.params import MatchParams
from ridelabel.sources.master import MasterData
from ridelabel.storage import written


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_kept: dict[tuple, DataFrame | MasterData] = {}


def _once(derive: Callable) -> Callable:
    """Write the derived table at the first call of a session for a folder; read it from then on."""
    @wraps(derive)
    def kept(spark: SparkSession, sf_dir: str, *more):
        key = (spark.sparkContext.applicationId, derive.__name__, sf_dir, *more)
        if key not in _kept:
            made = derive(spark, sf_dir, *more)
            _kept[key] = made.stored() if isinstance(made, MasterData) else written(made)
        return _kept[key]

    return kept


def derive_all(spark: SparkSession, sf_dir: str, params: MatchParams = MatchParams()) -> None:
    """Derive and write whatever the queries of a folder read."""
    for make in (fixture_waypoints, fixture_osm_elements):
        make(spark, sf_dir)
    fixture_master(spark, sf_dir, params)


def _bounds(spark: SparkSession, sf_dir: str, name: str, key: str) -> tuple[Column, Column]:
    """Lowest key and number of rows of a table, as scalar subqueries."""
    keys = table(spark, sf_dir, name)
    return keys.agg(F.min(key)).scalar(), keys.agg(F.count(F.lit(1))).scalar()


@_once
def fixture_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    return parts.withColumn("pf", F.explode(F.array(F.lit(0), F.lit(1)))).selectExpr(
        "p_partkey*2 + pf AS stop_id",
        "concat('S', p_partkey, if(pf = 0, 'a', 'b')) AS IFOPT",
        "p_name AS name",
        "(90000 + (p_partkey div 1000) % 40000 + 0.5625D) * (180D/131072D) - 90D AS latitude",
        "(137700 + p_partkey % 1000 + 0.3125D + 0.5D*pf) * (360D/262144D) - 180D AS longitude",
        "if(pf = 0, 'a', 'b') AS direction",
        "CAST(NULL AS STRING) AS ref_name",
        "p_partkey*2 + pf AS pos",
    )


@_once
def fixture_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier").withColumn("k", F.explode(F.array(F.lit(0), F.lit(1))))
    return suppliers.selectExpr(
        "CAST(s_suppkey*2 + k AS BIGINT) AS line_id",
        "concat(if(k = 0, 'L', 'X'), s_suppkey) AS lineLabel",
        "s_name AS `to`",
        "k",
    )


@_once
def fixture_departures(spark: SparkSession, sf_dir: str) -> DataFrame:
    lowest, count = _bounds(spark, sf_dir, "part", "p_partkey")
    calls = (
        fixture_lines(spark, sf_dir)
        .withColumns({"base": F.expr("line_id div 2"), "lowest": lowest, "count": count})
        .withColumn("seq", F.explode(F.sequence(F.lit(0), F.lit(9))))
        .where("k = 0 OR seq < 3 OR (seq > 7 AND base % 2 = 0)")
        .withColumn("stop_id", F.expr("(lowest + (base*3 + seq) % count)*2 + base % 2"))
    )
    # A call meets its stop once, before it is repeated through the day.
    ids = fixture_stops(spark, sf_dir).select("stop_id", "IFOPT")
    return (
        calls.join(shuffled(ids), "stop_id")
        .withColumn("cyc", F.explode(F.sequence(F.lit(0), F.lit(27))))
        .where("NOT (cyc = 9 AND line_id % 3 = 0)")
        .selectExpr(
            "line_id", "CAST(seq AS BIGINT) AS seq", "stop_id", "IFOPT",
            "CAST(((base % 4)*5 + seq*5 + cyc*50)*60 AS BIGINT) AS dep_sec",
        )
    )


@_once
def fixture_waypoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    lowest, count = _bounds(spark, sf_dir, "part", "p_partkey")
    first_line, lines = _bounds(spark, sf_dir, "supplier", "s_suppkey")
    e = table(spark, sf_dir, "events").selectExpr(
        "event_id", "user_id", "event_type", "ts", "CAST(get_json_object(props, '$.k') AS INT) AS kk",
    ).withColumns({"lowest": lowest, "count": count, "first_line": first_line, "lines": lines})
    e = e.selectExpr(
        "*", "1704085200000000 + (unix_micros(CAST(ts AS TIMESTAMP)) - 1704067200000000) div 256 AS t_us")
    e = e.selectExpr("*", "((t_us div 1000000 + 3600) % 86400) div 60 AS lmin")
    e = e.selectExpr("*", "first_line + (user_id + lmin div 38) % lines AS ln")
    e = e.selectExpr("*", "((lmin - (ln % 4)*5) div 5) % 10 AS sq")
    e = e.selectExpr("*", "lowest + (ln*3 + sq) % count AS place", "(kk % 7 = 0) AS off")
    return e.selectExpr(
        "event_id AS seq_no",
        "user_id AS vehicle_id",
        "timestamp_micros(t_us) AS time",
        "CAST(NULL AS TIMESTAMP) AS time_end",
        "if(kk % 19 = 0, NULL, (90000 + (place div 1000) % 40000 + 0.5D + (kk % 4)/64D)"
        " * (180D/131072D) - 90D) AS geo_latitude",
        "(137700 + place % 1000 + if(off, 20000, 0) + 0.375D + (kk % 3)/64D + if(kk % 11 = 0, 0.5D, 0D))"
        " * (360D/262144D) - 180D AS geo_longitude",
        "CAST(NULL AS STRING) AS geo_Hash",
        "if(event_type IN ('purchase', 'signup'), 'PLANNEDSTOP', 'LOCATION') AS event_Type",
        "event_type AS event_Subtype",
        "CASE WHEN event_type = 'signup' THEN concat('N', kk) WHEN event_type = 'view' THEN '' END AS stop_name",
        "map(concat('door', kk % 3), named_struct('boarding', CAST(kk % 5 AS BIGINT),"
        f" 'exiting', CAST(kk % 4 AS BIGINT))) AS {DOORS}",
        "concat('p', event_id % 8) AS meta_ingestionPartition",
    )


@_once
def fixture_master(spark: SparkSession, sf_dir: str, params: MatchParams) -> MasterData:
    return MasterData.from_timetable(
        fixture_stops(spark, sf_dir), fixture_lines(spark, sf_dir), fixture_departures(spark, sf_dir), params)


@_once
def fixture_osm_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OSM-shaped elements: parts as nodes, orders as ways, customers as route relations.

    An order's line items are the way's nodes; a customer's orders are the
    relation's members, each as a way and with its first part as a node. Some
    references lead nowhere, some names and tags are missing.
    """
    part = table(spark, sf_dir, "part")
    nodes = part.selectExpr(
        "'derived' AS doc", "p_partkey AS pos", "'node' AS type", "p_partkey AS id",
        "49D + (p_partkey % 1000)/1024D AS lat", "11D + (p_partkey % 777)/1024D AS lon",
        "if(p_size % 11 = 0, NULL, map_filter(map("
        "'highway', if(p_size % 3 = 0, 'bus_stop', NULL),"
        "'public_transport', if(p_size % 5 = 0, 'platform', NULL), 'bus', if(p_size % 2 = 0, 'yes', 'no'),"
        "'name', CASE WHEN p_size % 7 = 0 THEN '' WHEN p_size % 7 = 1 THEN NULL ELSE p_brand END,"
        "'ref_name', CASE WHEN p_size % 4 = 0 THEN p_type WHEN p_size % 4 = 1 THEN '' END,"
        "'ref:IFOPT', concat('de:', p_partkey)), (k, v) -> v IS NOT NULL)) AS tags",
        "CAST(NULL AS ARRAY<BIGINT>) AS nodes",
        "CAST(NULL AS ARRAY<STRUCT<type: STRING, ref: BIGINT, role: STRING>>) AS members",
    )
    items = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "if((l_partkey + l_linenumber) % 13 = 0, l_partkey + 1000000000, l_partkey) AS node"
    )
    ordered = items.groupBy("l_orderkey").agg(
        F.expr("transform(array_sort(collect_list(struct(l_linenumber, node))), x -> x.node)").alias("nodes")
    )
    ways = ordered.selectExpr(
        "'derived' AS doc", "10000000000 + l_orderkey AS pos", "'way' AS type", "l_orderkey AS id",
        "CAST(NULL AS DOUBLE) AS lat", "CAST(NULL AS DOUBLE) AS lon",
        "map('network', concat('N', l_orderkey % 5), 'type', 'route', 'route', 'bus') AS tags", "nodes",
        "CAST(NULL AS ARRAY<STRUCT<type: STRING, ref: BIGINT, role: STRING>>) AS members",
    )
    firsts = ordered.select("l_orderkey", F.col("nodes")[0].alias("first_node"))
    orders = table(spark, sf_dir, "orders").join(
        shuffled(firsts), F.col("o_orderkey") == F.col("l_orderkey")
    ).selectExpr(
        "o_custkey", "o_orderkey",
        "struct('way' AS type, if(o_orderkey % 9 = 0, o_orderkey + 1000000000, o_orderkey) AS ref,"
        " CASE o_orderkey % 4 WHEN 0 THEN 'platform' WHEN 1 THEN 'forward' ELSE '' END AS role) AS w",
        "struct('node' AS type, first_node AS ref,"
        " CASE o_orderkey % 3 WHEN 0 THEN 'platform' WHEN 1 THEN 'stop' ELSE 'stop' END AS role) AS n",
    )
    members = orders.groupBy("o_custkey").agg(
        F.expr("flatten(transform(array_sort(collect_list(struct(o_orderkey, w, n))), x -> array(x.w, x.n)))")
        .alias("members")
    )
    relations = table(spark, sf_dir, "customer").join(
        shuffled(members), F.col("c_custkey") == F.col("o_custkey"), "left"
    ).selectExpr(
        "'derived' AS doc", "20000000000 + c_custkey AS pos", "'relation' AS type", "c_custkey AS id",
        "CAST(NULL AS DOUBLE) AS lat", "CAST(NULL AS DOUBLE) AS lon",
        "map_filter(map('type', 'route', 'network', concat('N', c_custkey % 5), 'operator', c_mktsegment,"
        "'name', CASE c_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN c_name ELSE concat('Line ', c_nationkey, ': ', c_name, ': x') END,"
        "'ref', if(c_custkey % 10 = 0, NULL, concat('R', c_nationkey)),"
        "'from', c_mktsegment, 'to', c_name,"
        "'route', CASE c_custkey % 7 WHEN 0 THEN 'hiking' WHEN 1 THEN 'tram' WHEN 2 THEN NULL ELSE 'bus' END,"
        "'colour', if(c_custkey % 3 = 0, '#f00', NULL), 'color', if(c_custkey % 4 = 0, 'blue', NULL)),"
        " (k, v) -> v IS NOT NULL) AS tags",
        "CAST(NULL AS ARRAY<BIGINT>) AS nodes", "members",
    )
    return nodes.unionByName(ways).unionByName(relations)

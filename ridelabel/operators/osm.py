"""Routes, stops and selections out of OpenStreetMap elements.

References meet the elements they name in shuffle joins on the element id. A node
or way that very many others refer to makes a skewed partition on one side only,
which adaptive execution splits; each group collected afterwards is one way's
nodes or one relation's members.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelabel.functions.geometry import point

# Route tag values, upper-cased, that are public transport products.
PRODUCTS = [
    "BUS", "TRAM", "SUBWAY", "TRAIN", "FERRY", "LIGHT_RAIL", "TROLLEYBUS", "MONORAIL",
    "FUNICULAR", "AERIALWAY",
]

_ELEMENT = ["doc", "pos"]


def transport_product(route: Column) -> Column:
    """The product of a route tag; null when it is none."""
    name = F.upper(route)
    return F.when(name.isin(PRODUCTS), name)


def _latest(elements: DataFrame, kind: str, value: Column, wanted: DataFrame) -> DataFrame:
    """``ref`` and value of the wanted elements of one type; the last of equal ids counts.

    Others are left out before anything is aggregated. Both steps use the same placement.
    """
    rows = elements.where(F.col("type") == kind).select(F.col("id").alias("ref"), *_ELEMENT, value.alias("_v"))
    return (
        rows.join(wanted.select("ref").distinct(), "ref", "left_semi")
        .groupBy("ref")
        .agg(F.max_by("_v", F.struct(*_ELEMENT)).alias("value"))
        .where(F.col("value").isNotNull())
    )


def node_points(elements: DataFrame, wanted: DataFrame) -> DataFrame:
    """Points of the wanted nodes (``ref``)."""
    at = F.when(F.col("lat").isNotNull() & F.col("lon").isNotNull(), point(F.col("lon"), F.col("lat")))
    return _latest(elements, "node", at, wanted)


def way_lines(elements: DataFrame, wanted: DataFrame) -> DataFrame:
    """Polyline of each wanted way (``ref``); missing nodes and single points drop out."""
    ways = _latest(elements, "way", F.col("nodes"), wanted)
    steps = ways.select(F.col("ref").alias("way"), F.posexplode("value").alias("at", "ref"))
    placed = steps.join(node_points(elements, steps), "ref")
    lines = placed.groupBy(F.col("way").alias("ref")).agg(_in_order(F.struct("at", "value")).alias("value"))
    return lines.where(F.size("value") > 1)


def _in_order(item: Column) -> Column:
    """Values of the collected (at, value) pairs by their place."""
    return F.transform(F.array_sort(F.collect_list(item)), lambda x: x["value"])


def route_members(relations: DataFrame) -> DataFrame:
    """Stop and platform nodes, platform ways and way parts of each relation."""
    exploded = relations.select(*_ELEMENT, F.posexplode("members").alias("at", "m"))
    kind = (
        F.when((F.col("m.type") == "node") & (F.col("m.role") == "stop"), "stopNodes")
        .when((F.col("m.type") == "node") & (F.col("m.role") == "platform"), "platformsNodes")
        .when((F.col("m.type") == "way") & (F.col("m.role") == "platform"), "platformWays")
        .when((F.col("m.type") == "way") & (F.col("m.role") == ""), "route")
    )
    return exploded.select(*_ELEMENT, "at", kind.alias("kind"), F.col("m.ref").alias("ref")).where("kind IS NOT NULL")


def osm_routes(elements: DataFrame) -> DataFrame:
    """One row per usable route relation, with its geometry.

    A relation needs a name, a line reference, a label, a known product and at
    least one stop whose node is in the extract.
    """
    relations = elements.where((F.col("type") == "relation") & F.col("tags")["name"].isNotNull())
    tag = F.col("tags")
    parts = F.split(tag["name"], ":", 2)
    labelled = F.size(parts) > 1
    heads = relations.select(
        *_ELEMENT, "id",
        F.when(labelled, parts[0]).otherwise(tag["ref"]).alias("lineLabel"),
        F.when(labelled, F.get(parts, F.lit(1))).otherwise(parts[0]).alias("textRouteDirection"),
        tag["ref"].alias("lineRef"),
        tag["network"].alias("network"),
        tag["operator"].alias("operator"),
        tag["from"].alias("from"),
        tag["to"].alias("to"),
        F.coalesce(tag["colour"], tag["color"]).alias("color"),
        transport_product(tag["route"]).alias("transportProduct"),
    ).where("lineRef IS NOT NULL AND lineLabel IS NOT NULL AND transportProduct IS NOT NULL")

    members = route_members(relations)
    of_nodes = members.where(F.col("kind").isin("stopNodes", "platformsNodes"))
    of_ways = members.where(F.col("kind").isin("platformWays", "route"))
    points = of_nodes.join(node_points(elements, of_nodes), "ref")
    lines = of_ways.join(way_lines(elements, of_ways), "ref")
    placed = points.select(*_ELEMENT, "kind", F.struct("at", "value").alias("p")).unionByName(
        lines.select(*_ELEMENT, "kind", F.struct("at", "value").alias("l")), allowMissingColumns=True
    )

    def part(kind: str, column: str) -> Column:
        return _in_order(F.when(F.col("kind") == kind, F.col(column))).alias(kind)

    geometry = placed.groupBy(*_ELEMENT).agg(
        part("stopNodes", "p"), part("platformsNodes", "p"), part("platformWays", "l"), part("route", "l")
    )
    return heads.join(geometry.where(F.size("stopNodes") > 0), _ELEMENT).drop(*_ELEMENT)


def stop_direction(stops: DataFrame, name: str) -> DataFrame:
    """Add ``direction``: "a" for the first row of a name, "b" for later ones.

    The first places are found by a minimum and matched by place, which is unique,
    so a name shared by very many rows never gathers them in one task.
    """
    firsts = stops.groupBy(name).agg(F.min(F.struct(*_ELEMENT)).alias("_at")).select("_at.*")
    marked = stops.join(firsts.withColumn("_first", F.lit(True)), _ELEMENT, "left")
    return marked.withColumn("direction", F.when(F.col("_first"), "a").otherwise("b")).drop("_first")


def osm_stops(elements: DataFrame, require_name: bool = False) -> DataFrame:
    """Stops of an extract. Elements without any tags are geometry, not stops.

    Empty names are left out, missing ones kept unless ``require_name``.
    """
    tag = F.col("tags")
    named = elements.where(tag.isNotNull()).where(tag["name"].isNull() | (tag["name"] != ""))
    if require_name:
        named = named.where(tag["name"].isNotNull())
    rows = named.select(
        *_ELEMENT, tag["name"].alias("name"), F.col("lon").alias("longitude"), F.col("lat").alias("latitude"),
        tag["ref:IFOPT"].alias("IFOPT"), tag["ref_name"].alias("ref_name"),
        F.when(tag["ref_name"] != "", tag["ref_name"]).otherwise(tag["name"]).alias("_key"),
    )
    return stop_direction(rows, "_key").drop("_key")


@dataclass(frozen=True)
class Selection:
    """Elements of some types carrying all of the given tag values."""

    types: tuple[str, ...]
    tags: dict[str, str] = field(default_factory=dict)

    def condition(self) -> Column:
        wanted = [F.col("tags")[key] == value for key, value in self.tags.items()]
        return reduce(Column.__and__, wanted, F.col("type").isin(*self.types))


@dataclass(frozen=True)
class BBox:
    south: float
    west: float
    north: float
    east: float

    def condition(self) -> Column:
        return F.col("lat").between(self.south, self.north) & F.col("lon").between(self.west, self.east)


def osm_select(elements: DataFrame, selections: Iterable[Selection], bbox: BBox | None = None) -> DataFrame:
    """Union of several selections, each element once.

    One pass tests all selections at a time. A way lies in the box when one of
    its nodes does, a relation when one of its node or way members does.
    """
    anyone = reduce(Column.__or__, [s.condition() for s in selections])
    chosen = elements.where(F.coalesce(anyone, F.lit(False)))
    if bbox is not None:
        inside = elements.where((F.col("type") == "node") & bbox.condition()).select(F.col("id").alias("ref"))
        relations = chosen.where("type = 'relation'")
        members = relations.select("id", F.explode("members").alias("m")).select("id", "m.type", "m.ref")
        # Only chosen ways and ways of chosen relations matter.
        of_relations = members.where("type = 'way'").select(F.col("ref").alias("id"))
        asked = chosen.where("type = 'way'").select("id").unionByName(of_relations).distinct()
        way_hits = _referring(elements.where("type = 'way'").join(asked, "id", "left_semi"), F.col("nodes"), inside)
        by_node = members.where("type = 'node'").join(inside, "ref", "left_semi")
        by_way = members.where("type = 'way'").join(
            way_hits.withColumnRenamed("id", "ref"), "ref", "left_semi"
        )
        relation_hits = by_node.unionByName(by_way).select("id").distinct()
        chosen = (
            chosen.where((F.col("type") == "node") & bbox.condition())
            .unionByName(chosen.where("type = 'way'").join(way_hits, "id", "left_semi"))
            .unionByName(relations.join(relation_hits, "id", "left_semi"))
        )
    return _once(chosen)


def _referring(elements: DataFrame, refs: Column, wanted: DataFrame) -> DataFrame:
    return (
        elements.select("id", F.explode(refs).alias("ref")).join(wanted, "ref", "left_semi").select("id").distinct()
    )


def _once(elements: DataFrame) -> DataFrame:
    """The first row of each (type, id)."""
    rest = [c for c in elements.columns if c not in ("type", "id")]
    firsts = elements.groupBy("type", "id").agg(F.min_by(F.struct(*rest), F.struct(*_ELEMENT)).alias("_e"))
    return firsts.select(*[c if c in ("type", "id") else F.col("_e")[c].alias(c) for c in elements.columns])


def osm_recurse_down(selected: DataFrame, elements: DataFrame) -> DataFrame:
    """The selection plus the ways and nodes it refers to.

    Added elements are skeletons: they carry no tags.
    """
    refs = selected.where("type = 'relation'").select(F.explode("members").alias("m")).select("m.type", "m.ref")
    ways = elements.where("type = 'way'")
    added_ways = ways.join(
        refs.where("type = 'way'").select(F.col("ref").alias("id")).distinct(), "id", "left_semi"
    )
    of_ways = added_ways.unionByName(selected.where("type = 'way'")).select(F.explode("nodes").alias("id"))
    node_ids = refs.where("type = 'node'").select(F.col("ref").alias("id")).unionByName(of_ways).distinct()
    added_nodes = elements.where("type = 'node'").join(node_ids, "id", "left_semi")
    added = added_ways.select(elements.columns).unionByName(added_nodes.select(elements.columns))
    new = added.join(selected.select("type", "id"), ["type", "id"], "left_anti").select(elements.columns)
    return selected.unionByName(_once(new.withColumn("tags", F.lit(None).cast("map<string,string>"))))

"""OSM routes, stops and selections on a small literal extract."""

import json

import pytest

from ridelabel.operators import osm
from ridelabel.sources.osm import read_osm_elements


def node(i, lat, lon, **tags):
    return {"type": "node", "id": i, "lat": lat, "lon": lon, **({"tags": tags} if tags else {})}


def way(i, nodes, **tags):
    return {"type": "way", "id": i, "nodes": nodes, **({"tags": tags} if tags else {})}


def relation(i, members, **tags):
    return {"type": "relation", "id": i, "tags": tags,
            "members": [{"type": t, "ref": r, "role": role} for t, r, role in members]}


MEMBERS = [
    ("node", 3, "stop"), ("node", 1, "stop"), ("node", 404, "stop"), ("node", 2, "platform"), ("node", 4, "other"),
    ("way", 21, "platform"), ("way", 22, ""), ("way", 20, ""), ("way", 23, ""), ("way", 405, ""), ("way", 21, "forward"),
]
ELEMENTS = [
    node(1, 1.0, 10.0, name="One", highway="bus_stop"), node(2, 2.0, 20.0, name="", highway="bus_stop"),
    node(3, 3.0, 30.0), node(4, 4.0, 40.0, highway="bus_stop", public_transport="platform", bus="yes"),
    node(5, 5.0, 50.0, name="One", ref_name="Alias"), node(6, 6.0, 60.0, name="Alias", ref_name=""),
    node(7, 7.0, 70.0, name="One"),
    way(20, [1, 404, 2]), way(21, [2, 3]), way(22, [3, 2, 1], network="N"), way(23, [1, 404]),
    relation(30, MEMBERS, name="Bus 5: A => B: C", ref="5", route="bus", colour="red", color="blue", network="N",
             operator="O", **{"from": "A", "to": "C"}),
    relation(31, MEMBERS, name="Plain", ref="6", route="tram", color="blue"),
    relation(32, MEMBERS, name="No ref", route="bus"), relation(33, MEMBERS, name="x: y", ref="7", route="hiking"),
    relation(34, MEMBERS[2:], name="x: y", ref="8", route="bus"), relation(35, MEMBERS, ref="9", route="bus"),
    relation(36, MEMBERS, name="x: y", ref="9"),
]


@pytest.fixture(scope="module")
def elements(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("osm") / "extract.json"
    path.write_text(json.dumps({"elements": ELEMENTS}))
    return read_osm_elements(spark, str(path)).persist()


def points(path):
    return [(p.lon, p.lat) for p in path]


def test_routes(elements):
    first, second = osm.osm_routes(elements).orderBy("id").collect()
    assert (first.id, first.lineLabel, first.textRouteDirection, first.lineRef) == (30, "Bus 5", " A => B: C", "5")
    assert (first.color, first.transportProduct, first["from"], first.to) == ("red", "BUS", "A", "C")
    assert points(first.stopNodes) == [(30.0, 3.0), (10.0, 1.0)]
    assert points(first.platformsNodes) == [(20.0, 2.0)]
    assert [points(w) for w in first.platformWays] == [[(20.0, 2.0), (30.0, 3.0)]]
    assert [points(w) for w in first.route] == [[(30.0, 3.0), (20.0, 2.0), (10.0, 1.0)], [(10.0, 1.0), (20.0, 2.0)]]
    assert (second.lineLabel, second.textRouteDirection, second.color, second.transportProduct) == ("6", "Plain", "blue", "TRAM")


def test_stops(elements):
    nodes = elements.where("type = 'node'")
    rows = [(r.name, r.ref_name, r.longitude, r.direction) for r in osm.osm_stops(nodes).orderBy("pos").collect()]
    assert rows == [("One", None, 10.0, "a"), (None, None, 40.0, "a"), ("One", "Alias", 50.0, "a"),
                    ("Alias", "", 60.0, "b"), ("One", None, 70.0, "b")]
    assert osm.osm_stops(nodes, require_name=True).count() == 4


def ids(df):
    return sorted((r.type, r.id) for r in df.collect())


def test_select_and_recurse(elements):
    bus = [osm.Selection(("node",), {"highway": "bus_stop"}),
           osm.Selection(("node",), {"public_transport": "platform", "bus": "yes"})]
    assert ids(osm.osm_select(elements, bus)) == [("node", 1), ("node", 2), ("node", 4)]
    assert ids(osm.osm_select(elements, bus, osm.BBox(0, 0, 2, 15))) == [("node", 1)]
    network = [osm.Selection(("way", "relation"), {"network": "N"})]
    assert ids(osm.osm_select(elements, network, osm.BBox(3, 30, 3, 30))) == [("relation", 30), ("way", 22)]
    assert ids(osm.osm_select(elements, network, osm.BBox(7, 70, 7, 70))) == []
    ways = osm.osm_select(elements, [osm.Selection(("way",), {"network": "N"})])
    down = osm.osm_recurse_down(ways, elements)
    assert ids(down) == [("node", 1), ("node", 2), ("node", 3), ("way", 22)]
    assert down.where("type = 'node' AND tags IS NOT NULL").isEmpty() and down.where("type = 'way'").first().tags
    whole = osm.osm_recurse_down(osm.osm_select(elements, network[:1], osm.BBox(3, 30, 3, 30)), elements)
    assert ids(whole) == [("node", 1), ("node", 2), ("node", 3), ("node", 4), ("relation", 30),
                          ("way", 20), ("way", 21), ("way", 22), ("way", 23)]

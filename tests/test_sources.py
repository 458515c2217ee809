"""Loaders, decoding and encoding on small files."""

import json
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ridelabel.functions import tiles
from ridelabel.operators.collapse import DOORS
from ridelabel.params import MatchParams
from ridelabel.plans.enrich import enrich
from ridelabel.sources import json_split
from ridelabel.sources import master as ms
from ridelabel.sources.fixtures import fixture_osm_elements
from ridelabel.sources.json_split import json_values
from ridelabel.sources.osm import read_osm_elements
from ridelabel.sources.waypoints import CORRUPT, decode_waypoints, encode_waypoints, read_waypoints

P = MatchParams()
RECORD = {
    "vehicle": {"vehicle_uniqueId": "bus-1", "ignored": 1}, "time": "2024-01-15T08:00:30.5Z",
    "geo_latitude": 50.0, "geo_longitude": 9.0, "event_Type": "PLANNEDSTOP", "stop_name": "S",
    DOORS: {"1": {"boarding": 2, "exiting": 1}},
}


def records(spark, *texts):
    return spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "value STRING, seq_no BIGINT")


def test_decode(spark):
    good, bad = decode_waypoints(records(spark, json.dumps(RECORD), "{oops"), mode="PERMISSIVE").orderBy("seq_no").collect()
    assert good.vehicle_id == "bus-1" and good.time.second == 30 and good.time.microsecond == 500_000
    assert good[DOORS]["1"].boarding == 2 and good[CORRUPT] is None and good.time_end is None
    assert bad.vehicle_id is None and bad[CORRUPT] == "{oops"
    with pytest.raises(Exception):
        decode_waypoints(records(spark, "{oops")).collect()


def test_encode_writes_iso_times_and_the_nested_vehicle(spark):
    rows = decode_waypoints(records(spark, json.dumps(RECORD)), mode="FAILFAST")
    out = json.loads(encode_waypoints(rows).first().value)
    assert out["time"] == "2024-01-15T08:00:30.500000Z"
    assert out["vehicle"] == {"vehicle_uniqueId": "bus-1"} and out[DOORS] == RECORD[DOORS]


def test_stored_waypoints(spark, tmp_path):
    rows = decode_waypoints(records(spark, json.dumps(RECORD)), mode="FAILFAST")
    for fmt in ("parquet", "json"):
        rows.write.format(fmt).save(str(tmp_path / fmt))
        back = read_waypoints(spark, str(tmp_path / fmt), fmt).select(rows.columns)
        assert back.collect() == rows.collect()


@pytest.fixture
def timetable(spark, tmp_path):
    """A stop, its line and an index as files."""
    tile = spark.range(1).select(tiles.tile(F.lit(50.0), F.lit(9.0), 7).alias("t")).first().t
    stop = {"name": "Market", "longitude": 9.0, "latitude": 50.0, "IFOPT": "de:1", "unknown": 5,
            "plannedDepartures": [{"line_id": "L", "seq": 0, "dep_sec": 32400}]}
    files = {
        "stops": [stop, {**stop, "name": "Again"}],
        "lines": {"L": {"lineLabel": "12", "to": "Harbour", "route": [[{"lon": 1.0, "lat": 2.0}]]}},
        "index": {f"type=middle,mode=BUS#{tile}_108": ["L#0", "L#4"], f"type=lower,mode=BUS#{tile}_107": ["L#0"],
                  f"type=upper,mode=BUS#{tile}_109": ["L#0"]},
        "stop_index": {f"type=middle,mode=BUS#{tile}_108": ["de:1", "de:9"]},
    }
    for name, content in files.items():
        (tmp_path / name).write_text(json.dumps(content))
    return tmp_path


def test_master_files(spark, timetable):
    stops = ms.load_stops(spark, str(timetable / "stops"))
    assert [(r.name, r.IFOPT) for r in stops.orderBy("pos").collect()] == [("Market", "de:1"), ("Again", "de:1")]
    lines = ms.load_lines(spark, str(timetable / "lines")).collect()
    assert [(r.line_id, r.lineLabel, r.to, r.color) for r in lines] == [("L", "12", "Harbour", None)]
    assert lines[0].route[0][0].lat == 2.0
    index = ms.load_line_index(spark, str(timetable / "index"))
    assert sorted((r.bucket, r.line_id, r.seq) for r in index.collect()) == [(108, "L", 0), (108, "L", 4), (109, "L", 0)]
    refs = ms.load_stop_index(spark, str(timetable / "stop_index"))
    assert sorted((r.bucket, r.IFOPT) for r in refs.collect()) == [(108, "de:1"), (108, "de:9")]


def test_matching_with_a_ready_made_index(spark, timetable):
    stops = ms.load_stops(spark, str(timetable / "stops"))
    lines = ms.load_lines(spark, str(timetable / "lines"))
    master = ms.MasterData.from_index(stops, lines, ms.load_line_index(spark, str(timetable / "index")), P)
    rows = decode_waypoints(records(spark, json.dumps({**RECORD, "time": "2024-01-15T08:02:00Z"})), mode="FAILFAST")
    (r,) = enrich(rows, master, P).collect()
    assert (r.line_id, r.routeName, r.stop_route_Index, r.stop_scheduleStop.IFOPT) == ("L", "12", 0, "de:1")
    assert encode_waypoints(enrich(rows, master, P)).first().value.startswith('{"vehicle"')


def test_osm_files(spark, tmp_path):
    node = {"type": "node", "id": 1, "lat": 1.5, "lon": 2.5, "tags": {"name": "A", "x:y": "z"}, "extra": 1}
    way = {"type": "way", "id": 2, "nodes": [1, 3]}
    relation = {"type": "relation", "id": 3, "members": [{"type": "way", "ref": 2, "role": ""}]}
    doc = tmp_path / "doc.json"
    doc.write_text(json.dumps({"version": 0.6, "osm3s": {"copyright": "c"}, "elements": [node, way, relation]}, indent=1))
    lines = tmp_path / "lines.json"
    lines.write_text("\n".join(json.dumps(e) for e in (node, way, relation)))
    for rows in (read_osm_elements(spark, str(doc)), read_osm_elements(spark, str(lines), lines=True)):
        a, b, c = rows.orderBy("pos").collect()
        assert (a.type, a.id, a.lat, a.tags["x:y"]) == ("node", 1, 1.5, "z")
        assert b.nodes == [1, 3] and b.tags is None
        assert (c.members[0].type, c.members[0].ref, c.members[0].role) == ("way", 2, "")


def _value(rng, deep):
    """Any JSON value, with brackets, quotes and escapes in its strings."""
    kind = rng.random()
    if not deep or kind < 0.4:
        return rng.choice(["a]b", "}{", 'q"\\', "x\n", "[", 1, None, True, "é字"])
    if kind < 0.7:
        return [_value(rng, deep - 1) for _ in range(rng.randrange(4))]
    return {rng.choice(['k"', "}", "a", "[b"]): _value(rng, deep - 1) for _ in range(rng.randrange(3))}


@pytest.fixture
def small_splits(spark):
    """Splits of 1 kB, so that a small document is read by many tasks."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, "1000")
    yield
    for n, value in before.items():
        spark.conf.set(n, value)


@pytest.mark.parametrize("indent", [None, 1])
def test_values_are_cut_out_of_documents_in_splits(spark, tmp_path, small_splits, indent):
    rng = random.Random(4)
    want = {}
    for name in "ab":
        elements = [{"id": i, "tags": _value(rng, 3), "long": "}" * rng.choice([0, 3, 3000])} for i in range(40)]
        document = {"version": 0.6, "osm3s": {"c": "}]"}, "elements": elements, "remark": "end"}
        (tmp_path / name).write_text(json.dumps(document, indent=indent, ensure_ascii=name == "a"))
        want[name] = elements
    rows = json_values(spark, str(tmp_path), "}", 2)
    found = sorted((r.doc.rsplit("/", 1)[1], r.pos, r.value) for r in rows.collect())
    assert {n: [json.loads(v) for d, _, v in found if d == n] for n in "ab"} == want
    assert spark.read.text(str(tmp_path), lineSep="}").rdd.getNumPartitions() > 20


def test_a_map_larger_than_a_split(spark, tmp_path, small_splits):
    tiles_ = [r.t for r in spark.range(50).select(tiles.tile(F.lit(50.0), F.lit(9.0) + F.col("id") / 100, 7).alias("t")).collect()]
    index = {f"type=middle,x=]}}#{t}_{b}": [f"L{i}#{i}" for i in range(5)] for t in tiles_ for b in (1, 2)}
    (tmp_path / "index").write_text(json.dumps(index))
    assert ms.load_line_index(spark, str(tmp_path / "index")).count() == 500
    stops = {f"type=middle#{t}_3": ["de:1", "de:2"] for t in tiles_}
    (tmp_path / "stops").write_text(json.dumps(stops, indent=2))
    assert ms.load_stop_index(spark, str(tmp_path / "stops")).count() == 100
    lines = {f"id{i}": {"lineLabel": f"{i}]", "route": [[{"lon": 1.0, "lat": i}]]} for i in range(100)}
    (tmp_path / "lines").write_text(json.dumps(lines) + "\n" + json.dumps({"more": {"lineLabel": "m"}}))
    rows = {r.line_id: r for r in ms.load_lines(spark, str(tmp_path / "lines")).collect()}
    assert len(rows) == 101 and rows["id7"].route[0][0].lat == 7 and rows["more"].lineLabel == "m"


def test_a_list_of_stops_keeps_its_order(spark, tmp_path, small_splits):
    stops = [{"name": f"S{i}", "IFOPT": f"de:{i}", "plannedDepartures": [{"line_id": "L", "seq": i}]} for i in range(200)]
    (tmp_path / "stops").write_text(json.dumps(stops, indent=1))
    rows = ms.load_stops(spark, str(tmp_path / "stops"), array=True).orderBy("pos").collect()
    assert [r.name for r in rows] == [s["name"] for s in stops] and rows[9].plannedDepartures[0].seq == 9


def test_empty_and_broken_documents(spark, tmp_path):
    for name, text in {"map": "{}", "list": '{"elements": []}', "blank": " \n"}.items():
        (tmp_path / name).write_text(text)
    assert ms.load_line_index(spark, str(tmp_path / "map")).count() == 0
    assert read_osm_elements(spark, str(tmp_path / "list")).count() == 0
    assert ms.load_lines(spark, str(tmp_path / "blank")).count() == 0
    (tmp_path / "cut").write_text('{"elements": [{"type": "node", "id": 1}, {"type": "node", "id"')
    with pytest.raises(Exception):
        read_osm_elements(spark, str(tmp_path / "cut")).collect()


def test_pieces_of_a_split_are_cut_together(monkeypatch):
    """Work per batch and split, not per bracket; the values are those of the documents, wherever batches end."""
    calls = []
    cut = json_split.ValueCutter.cut
    monkeypatch.setattr(json_split.ValueCutter, "cut", lambda self, text: calls.append(text) or cut(self, text))
    rng = random.Random(7)
    documents = {d: [{"id": i, "tags": _value(rng, 3), "s": rng.choice(['"', '\\', '\\"}', "é}"])} for i in range(300)] for d in "ab"}
    pieces = [(d, p) for d, v in documents.items() for p in json.dumps({"e": v}, ensure_ascii=d == "a").split("}")[:-1]]
    batches = []
    for begin in range(0, len(pieces), 97):
        docs, texts = zip(*pieces[begin:begin + 97])
        n = len(docs)
        batches.append(pa.RecordBatch.from_pydict({
            "doc": docs, "block": [0] * n, "inside": [False] * n, "depth": [0] * n, "value": texts}))
    rows = [r for b in json_split._cutter(2, "}")(iter(batches)) for r in b.to_pylist()]
    found = {d: [json.loads(r["value"].lstrip(", ")) for r in rows if r["doc"] == d and r["kind"] == json_split.WHOLE] for d in "ab"}
    assert found == documents
    assert len(calls) == len(batches) + 1
    sums = [r for b in json_split._summer("}")(iter([b.select(["doc", "block", "value"]) for b in batches])) for r in b.to_pylist()]
    assert [(r["doc"], r["flips"], r["out"]) for r in sums] == [("a", False, 0), ("b", False, 0)]


def test_documents_are_cut_once_and_orders_grouped_once(spark, sf_dir, tmp_path):
    (tmp_path / "a").write_text('{"e": [{"id": 1}, {"id": 2}]}')
    plan = json_values(spark, str(tmp_path), "}", 2)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan
    derived = fixture_osm_elements.__wrapped__(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "min(" not in derived

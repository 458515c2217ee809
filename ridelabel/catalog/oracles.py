"""The registered queries again as DuckDB SQL, built from a chain of named steps."""

from __future__ import annotations

from ridelabel.catalog.queries import SWEEP
from ridelabel.params import MatchParams

ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"

_BASE = [
    ("hub", "select p_partkey, p_name from part"),
    ("stops", """
select p_partkey*2+pf as stop_id, 'S'||p_partkey||(case pf when 0 then 'a' else 'b' end) as ifopt, p_name as stop_name,
  (90000 + (p_partkey // 1000) % 40000 + 0.5625::double) * (180::double/131072) - 90 as lat,
  (137700 + p_partkey % 1000 + 0.3125::double + 0.5::double*pf) * (360::double/262144) - 180 as lon
from hub, (select unnest([0,1]) as pf)"""),
    ("lines", """
select s_suppkey*2 + k as line_id, (case k when 0 then 'L' else 'X' end) || s_suppkey as line_label, s_name as route_to, k
from supplier, (select unnest([0,1]) as k)"""),
    ("departures", """
select l.line_id::bigint as line_id, q.seq::bigint as seq, st.stop_id, st.ifopt,
  ((((l.line_id // 2) % 4)*5 + q.seq*5 + c.cyc*50)*60)::bigint as dep_sec
from lines l, (select unnest(range(0,10)) as seq) q, (select unnest(range(0,28)) as cyc) c,
  (select count(*) n, min(p_partkey) m from hub) z, stops st
where (l.k = 0 or q.seq < 3 or (q.seq > 7 and (l.line_id // 2) % 2 = 0)) and not (c.cyc = 9 and l.line_id % 3 = 0)
  and st.stop_id = (z.m + ((l.line_id // 2)*3 + q.seq) % z.n)*2 + (l.line_id // 2) % 2"""),
    ("waypoints", """
with e as (select event_id, user_id, event_type, value, cast(json_extract(props,'$.k') as int) as kk,
    1704085200000000 + (epoch_us(ts) - 1704067200000000) // 256 as t_us from events),
o as (select *, ((t_us // 1000000 + 3600) % 86400) // 60 as lmin from e),
p as (select *, (select min(s_suppkey) from supplier) + (user_id + lmin // 38) % (select count(*) from supplier) as ln from o),
q as (select *, ((lmin - (ln % 4)*5) // 5) % 10 as sq from p),
r as (select *, (select min(p_partkey) from hub) + (ln*3 + sq) % (select count(*) from hub) as pos, (kk % 7 = 0) as off from q)
select event_id as seq_no, user_id as vehicle_id, t_us,
  case when kk % 19 = 0 then null else (90000 + (pos // 1000) % 40000 + 0.5::double + (kk % 4) / 64::double) * (180::double/131072) - 90 end as lat,
  (137700 + pos % 1000 + (case when off then 20000 else 0 end) + 0.375::double + (kk % 3) / 64::double + (case when kk % 11 = 0 then 0.5::double else 0 end)) * (360::double/262144) - 180 as lon,
  case when event_type in ('purchase','signup') then 'PLANNEDSTOP' else 'LOCATION' end as event_type,
  event_type as event_subtype, 'p' || (event_id % 8) as ingestion_partition,
  case when event_type = 'signup' then 'N' || kk when event_type = 'view' then '' end as stop_name,
  'door' || (kk % 3) as door, (kk % 5)::bigint as boarding, (kk % 4)::bigint as exiting
from r"""),
]


def _axis(value: str, low: int, span: int) -> str:
    guess = f"least(floor(({value} - ({low}))/{span}::double*1073741824)::bigint, 1073741823)"
    edge = f"{span}::double/1073741824"
    return (f"case when {guess}*({edge}) + ({low}) > {value} then {guess} - 1 "
            f"when {guess} < 1073741823 and ({guess}+1)*({edge}) + ({low}) <= {value} then {guess} + 1 else {guess} end")


def _encode(lat: str, lon: str, source: str, extra: str = "*") -> str:
    """SQL adding ``gh`` (12 characters) to the rows of ``source``."""
    bit = ("(case when (5*c+j) % 2 = 0 then (ilon >> (29 - (5*c+j)//2)::int) & 1 "
           "else (ilat >> (29 - (5*c+j)//2)::int) & 1 end) << (4-j)::int")
    return f"""
select * exclude (ilat, ilon), array_to_string(list_transform(range(0,12), lambda c:
    substr('{ALPHABET}', 1 + list_sum(list_transform(range(0,5), lambda j: {bit}))::int, 1)), '') as gh
from (select {extra}, ({_axis(lat, -90, 180)}) as ilat, ({_axis(lon, -180, 360)}) as ilon from {source})"""


def _center(gh: str) -> tuple[str, str]:
    """SQL of the centre latitude and longitude of the geohash ``gh``."""
    def axis(parity: int, bits: str, low: int, span: int) -> str:
        bit = (f"((strpos('{ALPHABET}', substr({gh}, (b//5 + 1)::int, 1)) - 1) >> (4 - b % 5)::int) & 1")
        index = (f"coalesce(list_sum(list_transform(list_filter(range(0, 5*length({gh})), lambda b: b % 2 = {parity}), "
                 f"lambda b: ({bit})::bigint << ({bits} - 1 - b//2)::int)), 0)::bigint")
        return f"(({index} + 0.5::double) * {span}::double / (1::bigint << ({bits})::int) + ({low}))"
    return (axis(1, f"((5*length({gh}))//2)", -90, 180), axis(0, f"((5*length({gh})+1)//2)", -180, 360))


def _steps(vehicle: str, group: str, buckets: tuple[int, ...], scope: str, p: MatchParams) -> list[tuple[str, str]]:
    v = "grp, v"
    lat, lon = _center("geo_hash")
    vote = v if scope == "vehicle" else f"{v}, sid"
    same = "s.grp = f.grp and s.v = f.v" + ("" if scope == "vehicle" else " and s.sid = f.sid")
    sid = "0::bigint as sid" if scope == "vehicle" else "sid"
    return [
        ("valid", "select * from waypoints where lat is not null and lon is not null"),
        ("geo0", _encode("lat", "lon", "valid")),
        ("geo", f"select *, {vehicle} as v, {group} as grp from geo0"),
        ("sess", f"""
select *, sum(new_s::int) over (partition by {v} order by t_us, seq_no)::bigint as sid from (
  select *, coalesce(t_us - lag(t_us) over (partition by {v} order by t_us, seq_no) > {p.session_gap_seconds * 1_000_000}, true) as new_s from geo)"""),
        ("runs", f"""
select *, sum(new_r::int) over (partition by {v} order by t_us, seq_no)::bigint as rid from (
  select *, new_s or left(gh,8) <> lag(left(gh,8)) over (partition by {v} order by t_us, seq_no) as new_r from sess)"""),
        ("kp0", """
select grp, v, sid, rid, count(*) n, min(t_us) t_us, max(t_us) t_max, max(seq_no) filter (rn = 1) seq_no,
  left(min(gh), list_max(list_filter(range(0,13), lambda i: left(min(gh),i::int) = left(max(gh),i::int)))::int) geo_hash,
  max(lat) filter (rn = 1) lat1, max(lon) filter (rn = 1) lon1,
  case when bool_or(event_type = 'PLANNEDSTOP') then 'PLANNEDSTOP' else max(event_type) filter (rn = 1) end event_type,
  max(event_subtype) filter (rn = 1) sub1, max(ingestion_partition) filter (rn = 1) part1,
  max(stop_name) filter (rn = 1) name1,
  string_agg(stop_name, ',' order by t_us desc, seq_no desc) filter (stop_name <> '') names
from (select *, row_number() over (partition by grp, v, rid order by t_us desc, seq_no desc) rn from runs)
group by grp, v, sid, rid"""),
        ("kp", f"""
select grp, v, sid, rid, n, seq_no, t_us, case when n > 1 then t_max end t_end_us, geo_hash,
  case when n > 1 then {lat} else lat1 end lat, case when n > 1 then {lon} else lon1 end lon, event_type,
  case when n = 1 then sub1 end event_subtype, case when n = 1 then part1 end ingestion_partition,
  case when n > 1 then coalesce(names, '') else name1 end stop_name, left(geo_hash, 7) tile,
  ((t_us // 1000000 + 3600) % 86400) sec
from kp0"""),
        ("stopgeo", "select *, left(gh, 7) as tile from (" + _encode("lat", "lon", "stops") + ")"),
        ("buckets", "select unnest(" + str(list(buckets)) + ")::bigint as bm"),
        ("idx", """
select distinct bm, tile, (dep_sec // (60*bm) + late) % (1440 // bm) as bucket, line_id, seq
from departures join stopgeo using (stop_id), buckets, (select unnest([0,1]) as late)"""),
        ("cand", """
select k.grp, k.v, k.sid, k.rid, i.bm, i.line_id, bool_or(i.seq = 0) as has_zero
from kp k join idx i on i.tile = k.tile and i.bucket = k.sec // (60*i.bm) group by all"""),
        ("steps", f"""
select grp, v, {sid}, rid, bm, row_number() over (partition by {vote}, bm order by rid) n, cs, first0 from (
  select grp, v, sid, rid, bm, list({{'l': line_id, 'p': case when has_zero then {p.first_stop_votes} else {p.other_stop_votes} end}}) cs, bool_or(has_zero) first0
  from cand group by all)"""),
        ("fold", f"""
select grp, v, sid, bm, 0::bigint n, null::bigint rid, null::bigint det, []::struct(l bigint, p bigint)[] votes
  from (select distinct grp, v, sid, bm from steps)
 union all
  select grp, v, sid, bm, n, rid,
    case when len(sc) = 1 then (case when sc[1].p >= {p.single_min_votes} then sc[1].l end)
         when sc[1].p > sc[2].p + {p.winning_margin} then sc[1].l end, sc
  from (select s.grp, s.v, s.sid, s.bm, s.n, s.rid,
     list_transform(list_sort(list_transform(list_transform(s.cs, lambda x: {{'l': x.l::bigint, 'p': (x.p +
       case when f.det is not null and (s.first0 or not list_contains(list_transform(s.cs, lambda y: y.l), f.det)) then 0
            else coalesce(list_sum(list_transform(list_filter(f.votes, lambda z: z.l = x.l), lambda w: w.p)), 0) end)::bigint}}),
       lambda x: {{'p': -x.p, 'l': x.l}})), lambda x: {{'l': x.l, 'p': -x.p}}) sc
   from fold f join steps s on {same} and s.bm = f.bm and s.n = f.n + 1)"""),
        ("lab", f"""
select k.*, b.bm, f.det, f.det is not null as detected,
  first_value(f.det ignore nulls) over (partition by k.grp, k.v{"" if scope == "vehicle" else ", k.sid"}, b.bm order by k.rid
    rows between current row and unbounded following) as line_id
from kp k cross join buckets b left join fold f on f.grp = k.grp and f.v = k.v and f.rid = k.rid and f.bm = b.bm"""),
        ("near", """
select l.grp, l.v, l.rid, arg_min(s.ifopt, {'d': sqrt((l.lon-s.lon)*(l.lon-s.lon)+(l.lat-s.lat)*(l.lat-s.lat)), 'i': s.ifopt}) ifopt,
  min(sqrt((l.lon-s.lon)*(l.lon-s.lon)+(l.lat-s.lat)*(l.lat-s.lat))) dist
from lab l join (select distinct stop_id, line_id from departures) d on d.line_id = l.line_id
  join stopgeo s on s.stop_id = d.stop_id and s.tile = l.tile group by all"""),
        ("final", """
select l.*, e.line_label, e.route_to, n.ifopt, n.dist, s.stop_name as found_name,
  case when l.detected and c.has_zero then 0::bigint end as start_mark
from lab l left join lines e on e.line_id = l.line_id
  left join near n on n.grp = l.grp and n.v = l.v and n.rid = l.rid
  left join stops s on s.ifopt = n.ifopt
  left join cand c on c.grp = l.grp and c.v = l.v and c.rid = l.rid and c.bm = l.bm and c.line_id = l.det"""),
    ]


def _with(last: str, select: str, vehicle: str = "vehicle_id", group: str = "''",
          buckets: tuple[int, ...] = (5,), scope: str = "session", p: MatchParams = MatchParams()) -> str:
    chain = []
    for name, body in [*_BASE, *_steps(vehicle, group, buckets, scope, p)]:
        chain.append(f"{name} as ({body})")
        if name == last:
            return "with recursive " + ",\n".join(chain) + "\n" + select
    raise KeyError(last)


_RUN = "v as vehicle_id, sid as session_id, rid as run_id"
_ENRICHED = f"""select {_RUN}, seq_no, t_us, t_end_us, geo_hash, lat, lon, event_type,
  case when detected and ifopt is not null then found_name else stop_name end as stop_name,
  line_id, detected, line_label as route_name, route_to, ifopt as stop_ifopt, round(dist, 12) as stop_dist,
  start_mark as stop_route_index from final"""

_STREAMED = """select v as vehicle_id, t_us, t_end_us, geo_hash,
  case when detected and ifopt is not null then found_name else stop_name end as stop_name,
  line_id, detected, line_label as route_name, ifopt as stop_ifopt, round(dist, 12) as stop_dist,
  start_mark as stop_route_index"""

_OSM_BASE = """with nodes as (
  select p_partkey as id, 49::double + (p_partkey % 1000)/1024::double as lat, 11::double + (p_partkey % 777)/1024::double as lon,
    p_size % 11 = 0 as bare, p_size % 3 = 0 as bus_stop, p_size % 5 = 0 as platform, p_size % 2 = 0 as bus,
    case when p_size % 7 = 0 then '' when p_size % 7 = 1 then null else p_brand end as name,
    case when p_size % 4 = 0 then p_type when p_size % 4 = 1 then '' end as ref_name
  from part),
wn as (select l_orderkey as way, l_linenumber as ord,
    case when (l_partkey + l_linenumber) % 13 = 0 then l_partkey + 1000000000 else l_partkey end as node from lineitem),
ways as (select distinct way as id from wn),
rels as (select c_custkey as id, case c_custkey % 6 when 0 then null when 1 then c_name
      else 'Line ' || c_nationkey || ': ' || c_name || ': x' end as name,
    case when c_custkey % 10 = 0 then null else 'R' || c_nationkey end as ref, c_mktsegment, c_name,
    case c_custkey % 7 when 0 then 'hiking' when 1 then 'tram' when 2 then null else 'bus' end as route,
    coalesce(case when c_custkey % 3 = 0 then '#f00' end, case when c_custkey % 4 = 0 then 'blue' end) as color
  from customer),
mem as (
  select o_custkey as rel, o_orderkey as ord, 'way' as type,
    case when o_orderkey % 9 = 0 then o_orderkey + 1000000000 else o_orderkey end as ref,
    case o_orderkey % 4 when 0 then 'platform' when 1 then 'forward' else '' end as role
  from orders where o_orderkey in (select id from ways)
  union all
  select o_custkey, o_orderkey, 'node', f.node, case o_orderkey % 3 when 0 then 'platform' else 'stop' end
  from orders join (select way, arg_min(node, {'o': ord, 'n': node}) as node from wn group by way) f on f.way = o_orderkey)
"""

_PT = "round(n.lon*1000000)::bigint || ' ' || round(n.lat*1000000)::bigint"


def _share(choice: int) -> str:
    return f"""select {choice}::bigint as choice, count(*) as keypoints, count(line_id) as labelled,
  coalesce(sum(detected::int), 0)::bigint as detected from lab"""


def oracle_sql() -> dict[str, str]:
    centers = {n: _center(f"left(gh,{n})") for n in (12, 9, 8, 7)}
    return {
        "valid_positions": _with("valid", "select seq_no, vehicle_id, lat, lon from valid"),
        "tile_encode": _with("geo0", "select seq_no, gh as geohash12, left(gh,8) as geohash8, left(gh,7) as geohash7 from geo0"),
        "tile_center": _with("geo0", "select seq_no, " + ", ".join(
            f"{c[0]} as lat{n}, {c[1]} as lon{n}" for n, c in centers.items()) + " from geo0"),
        "vehicle_sessions": _with("sess", "select seq_no, vehicle_id, sid as session_id from sess"),
        "tile_runs": _with("runs", f"select seq_no, {_RUN} from runs"),
        "collapse_keypoints": _with("kp", f"""select {_RUN}, seq_no, t_us, t_end_us, geo_hash, lat, lon,
  event_subtype, ingestion_partition from kp"""),
        "door_activity": _with("runs", f"""select {_RUN}, door, sum(boarding)::bigint as boarding,
  sum(exiting)::bigint as exiting from runs group by all"""),
        "run_stop_names": _with("kp", f"select {_RUN}, stop_name from kp"),
        "event_type_priority": _with("kp", f"select {_RUN}, event_type from kp"),
        "local_time_bucket": _with("waypoints", """select seq_no, s as local_second, s // 300 as bucket5, s // 900 as bucket15
from (select seq_no, (t_us // 1000000 + 3600) % 86400 as s from waypoints)"""),
        "stop_tiles": _with("stopgeo", "select distinct tile, ifopt, stop_name as name from stopgeo"),
        "stops_first_by_ifopt": """select p_brand as ifopt, arg_min(p_name, p_partkey) as name, min(p_partkey) as pos
from part group by p_brand""",
        "service_table": _with("departures", "select distinct ifopt, line_id from departures"),
        "line_index": _with("idx", "select tile, bucket::bigint as bucket, line_id, seq from idx"),
        "stop_index": _with("buckets", """select distinct tile, ((dep_sec // 300 + late) % 288)::bigint as bucket, s.ifopt,
  s.stop_name from departures d join stopgeo s using (stop_id), (select unnest([0,1]) as late)"""),
        "index_entries": _with("idx", "select tile, bucket::bigint as bucket, line_id::varchar as line_id, seq from idx"),
        "near_stop_gate": _with("stopgeo", f"select {_RUN}, tile in (select tile from stopgeo) as near from kp"),
        "candidate_gate": _with("cand", f"""select {_RUN},
  exists (select 1 from cand c where c.v = kp.v and c.rid = kp.rid) as has_candidate from kp"""),
        "near_stops_join": _with("stopgeo", f"""select {_RUN}, s.ifopt,
  round(sqrt((k.lon-s.lon)*(k.lon-s.lon)+(k.lat-s.lat)*(k.lat-s.lat)), 12) as dist
from kp k left join stopgeo s on s.tile = k.tile"""),
        "line_candidates": _with("cand", f"select {_RUN}, line_id, has_zero from cand"),
        "vote_increments": _with("cand", f"""select {_RUN}, line_id,
  (case when has_zero then 2 else 1 end)::bigint as votes from cand"""),
        "vote_fold": _with("lab", f"select {_RUN}, det as decided_line from lab"),
        "vote_fold_by_vehicle": _with("fold", """select kp.v as vehicle_id, kp.sid as session_id, kp.rid as run_id,
  f.det as decided_line from kp left join fold f on f.v = kp.v and f.rid = kp.rid""", scope="vehicle"),
        "backfill_lines": _with("lab", f"select {_RUN}, line_id, detected from lab"),
        "line_lookup": _with("final", f"select {_RUN}, line_label as route_name, route_to from final"),
        "nearest_serving_stop": _with("final", f"select {_RUN}, ifopt, round(dist, 12) as dist from final"),
        "route_start_mark": _with("final", f"select {_RUN}, start_mark as stop_route_index from final"),
        "enrich_full": _with("final", _ENRICHED),
        "region_partitioned": _with("final", _ENRICHED.replace("select", "select grp as match_partition,", 1),
                                    group="left(gh, 4)"),
        "any_entity_match": _with("final", _ENRICHED, vehicle="'phone-' || vehicle_id || '-' || door"),
        "bucket_sweep": _with("lab", """select bm as bucket_minutes, count(*) as keypoints, count(line_id) as labelled,
  sum(detected::int)::bigint as detected from lab group by bm""", buckets=(5, 10, 15)),
        "region_stored": _with("final", _ENRICHED.replace("select", "select grp as match_partition,", 1),
                               group="left(gh, 4)"),
        "parameter_sweep": " union all ".join(
            f"select * from ({_with('lab', _share(i), buckets=(p.bucket_minutes,), p=p)})" for i, p in enumerate(SWEEP)),
        "stop_departures": _with("final", f"""select {_RUN}, l.ifopt as stop_ifopt, t.departures, t.last_departure, t.first_line
from final l left join (select ifopt, count(*) as departures, max(dep_sec) as last_departure, min(line_id) as first_line
  from departures group by ifopt) t on t.ifopt = l.ifopt"""),
        "lines_file": _with("lines", """select line_id::varchar as line_id, line_label, route_to, null::varchar as color
from lines"""),
        "stops_file": _with("departures", """select s.ifopt, s.stop_name, s.lat, s.lon, case right(s.ifopt, 1) when 'a' then 'a' else 'b' end as direction,
  count(d.line_id) as departures, sum(d.dep_sec)::bigint as seconds, max(d.line_id::varchar) as last_line
from stops s left join departures d on d.stop_id = s.stop_id group by all"""),
        "line_index_file": _with("idx", "select tile, bucket::bigint as bucket, line_id::varchar as line_id, seq from idx"),
        "stop_index_file": _with("buckets", """select distinct tile, ((dep_sec // 300 + late) % 288)::bigint as bucket, s.ifopt,
  s.stop_name from departures d join stopgeo s using (stop_id), (select unnest([0,1]) as late)"""),
        "osm_file": _OSM_BASE + """
select 'node' as type, id, lat, lon, case when not bare then name end as name, null::varchar as ref, 0::bigint as nodes,
  0::bigint as member_sum from nodes
union all select 'way', way, null, null, null, null, count(*), 0 from wn group by way
union all select 'relation', r.id, null, null, r.name, r.ref, 0, coalesce(sum(m.ref), 0)::bigint from rels r left join mem m on m.rel = r.id
  group by all""",
        "stored_waypoints": _with("waypoints", """select seq_no, vehicle_id::varchar as vehicle_id, t_us, lat, lon, event_type,
  stop_name, door, boarding, exiting from waypoints"""),
        "stream_enrich": _with("final", _STREAMED + " from final"),
        "stream_votes": _with("final", _STREAMED + " from final where line_id is not null", scope="vehicle"),
        "stream_rejects": _with("waypoints", """select * from (
  select 'late' as reason, vehicle_id, count(*) as records from waypoints
  where seq_no % 37 = 0 and lat is not null and vehicle_id in (select vehicle_id from waypoints where lat is not null) group by all
  union all select 'no time', vehicle_id, count(*) from waypoints where seq_no % 31 = 0 group by all
  union all select 'corrupt', vehicle_id, count(*) from waypoints where seq_no % 29 = 0 group by all)"""),
        "waypoint_json": _with("waypoints", """select seq_no, vehicle_id::varchar as vehicle_id, t_us, lat, lon, event_type,
  stop_name, door, boarding, exiting from waypoints"""),
        "osm_routes": _OSM_BASE + f""",
wl as (select w.way, string_agg({_PT}, ',' order by w.ord, w.node) as txt from wn w join nodes n on n.id = w.node
  group by w.way having count(*) > 1),
np as (select m.rel, m.role, string_agg({_PT}, ',' order by m.ord) as txt from mem m join nodes n on n.id = m.ref
  where m.type = 'node' group by all),
wp as (select m.rel, m.role, string_agg(wl.txt, '|' order by m.ord) as txt from mem m join wl on wl.way = m.ref
  where m.type = 'way' group by all)
select r.id,
  case when contains(name, ':') then split_part(name, ':', 1) else ref end as line_label,
  case when contains(name, ':') then substr(name, strpos(name, ':') + 1) else name end as route_text,
  ref as line_ref, 'N' || (r.id % 5) as network, c_mktsegment as operator, c_mktsegment as from_name, c_name as to_name,
  color, upper(route) as product, s.txt as stop_nodes, coalesce(p.txt, '') as platform_nodes,
  coalesce(w.txt, '') as platform_ways, coalesce(t.txt, '') as route
from rels r join np s on s.rel = r.id and s.role = 'stop' left join np p on p.rel = r.id and p.role = 'platform'
  left join wp w on w.rel = r.id and w.role = 'platform' left join wp t on t.rel = r.id and t.role = ''
where name is not null and ref is not null and route in ('bus', 'tram')""",
        "osm_stops": _OSM_BASE + """
select id as pos, name, lon as longitude, lat as latitude, 'de:' || id as ifopt, ref_name,
  case when row_number() over (partition by case when ref_name <> '' then ref_name else name end order by id) = 1
    then 'a' else 'b' end as direction
from nodes where not bare and (name is null or name <> '')""",
        "stop_direction": """select p_partkey as pos, p_type as name,
  case when row_number() over (partition by p_type order by p_partkey) = 1 then 'a' else 'b' end as direction from part""",
        "osm_select": _OSM_BASE + """,
inside as (select id from nodes where lat between 49.05 and 49.4 and lon between 11.05 and 11.3),
hitways as (select distinct way as id from wn where node in (select id from inside))
select 'node' as type, id from nodes where not bare and (bus_stop or (platform and bus)) and id in (select id from inside)
union select 'way', id from hitways where id % 5 = 2
union select 'relation', id from rels where id % 5 = 2 and route = 'bus' and id in (
  select rel from mem where (type = 'node' and ref in (select id from inside)) or (type = 'way' and ref in (select id from hitways)))""",
        "osm_recurse_down": _OSM_BASE + """,
sel as (select id from rels where id % 5 = 2 and route = 'bus'),
aw as (select id from ways where id in (select ref from mem where type = 'way' and rel in (select id from sel))),
an as (select id from nodes where id in (select ref from mem where type = 'node' and rel in (select id from sel))
  or id in (select node from wn where way in (select id from aw)))
select 'relation' as type, id, true as has_tags from sel union all select 'way', id, false from aw
union all select 'node', id, false from an""",
    }

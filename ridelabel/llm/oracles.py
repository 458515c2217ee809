"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

from ridelabel.llm.infill import FimParams
from ridelabel.llm.mixing import Curriculum
from ridelabel.llm.queries import MANGLED, PAGE_WORD
from ridelabel.llm.urls import CELLS, RULES, SECOND_LEVEL, ReputationParams

_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

def _urls(rules=RULES, params: ReputationParams = ReputationParams()) -> str:
    cases = [
        (f"(host = '{own}' or ends_with(host, '.{own}')) and starts_with(path, '{slash + rest}')", rule, what)
        for (rule, what) in sorted(rules, key=lambda r: (len(r[0]), r[0]), reverse=True)
        for own, slash, rest in [rule.partition("/")]]
    name = " ".join(f"when {fits} then '{rule}'" for fits, rule, _ in cases)
    verdict = " ".join(f"when {fits} then '{what}'" for fits, _, what in cases)
    second = ", ".join(f"'{s}'" for s in SECOND_LEVEL)
    angle = f"(low + (i + 0.5::double) * width)"
    log_density = "((2 * a - 1) * ln(sin({0})) + (2 * b - 1) * ln(cos({0})))"
    density = f"exp({log_density.format(angle)} - {log_density.format('greatest(least(mid, 1.55::double), 0.02::double)')})"
    part = f"greatest(0, least(1, (low + i * width + width - asin(sqrt({params.limit}::double))) / width))"

    def level(name: str, table: str, by: str) -> str:
        rho = ("(sum((k - n * prior) ** 2) - sum(n * prior * (1 - prior))) / nullif(sum(n * (n - 1) * prior * (1 - prior)), 0)")
        return f"""{name}_m as (select case when {rho} > 0 then least(greatest(1 / ({rho}) - 1, {params.weakest}), {params.strongest})
    else {params.strongest} end m from {table}),
{name} as (select {table}.*, (k + m * prior) / (n + m) rate, m from {table}, {name}_m)"""

    return f"""
with u as (select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end rest from pages),
p as (select page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) path from u),
w as (select page_id, len(regexp_extract_all(html, '{PAGE_WORD}')) words, len(regexp_extract_all(html, '{MANGLED}')) mangled from pages),
o as (select regexp_replace(regexp_replace(host, '^.*@', ''), '(:[0-9]*)?\\.?$|\\.:[0-9]*$', '') site, (5 * mangled >= words)::int bad
  from p join w using (page_id) where words >= 20),
h0 as (select site host, sum(bad)::double k, count(*)::double n, string_split(site, '.') l from o group by site),
h as (select host, k, n, case when ip then host else array_to_string(l[greatest(len(l) - m, 1):len(l)], '.') end as dom,
  case when ip then host else array_to_string(l[greatest(len(l) - m + 1, 1):len(l)], '.') end as suf
  from (select *, regexp_matches(host, '^\\[|^[0-9]+(\\.[0-9]+){{3}}$') ip,
    case when len(l) > 2 and length(l[-1]) = 2 and l[-2] in ({second}) then 2 else 1 end m from h0)),
d as (select dom, suf, sum(k) k, sum(n) n from h group by all),
s as (select suf, sum(k) k, sum(n) n, (select sum(k) / sum(n) from h) prior from d group by suf),
{level("sx", "s", "suf")},
dp as (select d.*, sx.rate prior from d join sx using (suf)),
{level("dx", "dp", "dom")},
hp as (select h.*, dx.rate prior from h join dx using (dom, suf)),
{level("hx", "hp", "host")},
c as (select host, k + m * prior a, n - k + m * (1 - prior) b from hx where rate > {params.sure} * {params.limit}),
g as (select *, asin(sqrt(a / (a + b))) mid, 4 / sqrt(a + b + 1) reach from c),
e as (select *, greatest(mid - reach, 0) low, (least(mid + reach, pi() / 2) - greatest(mid - reach, 0)) / {CELLS} width from g),
b as (select host from e where b <= 0 or list_sum(list_transform(range({CELLS}), lambda i: {density} * {part}))
  / list_sum(list_transform(range({CELLS}), lambda i: {density})) >= {params.sure})
select page_id, host, path, case {name} end as "rule",
  coalesce(case {verdict} end, case when regexp_replace(regexp_replace(host, '^.*@', ''), '(:[0-9]*)?\\.?$|\\.:[0-9]*$', '') in (select host from b)
    then 'block' else 'allow' end) verdict
from p
"""


_EXACT = rf"""
with d as (select doc_id, coalesce(text, '') t from documents),
n as (select doc_id, length(t) n, translate(t, {_WHITE}, '') k from d)
select doc_id, first_value(doc_id) over w keep_id, count(*) over (partition by k) group_size,
  doc_id = first_value(doc_id) over w kept, sha256(k) text_sha256
from n window w as (partition by k order by n desc, doc_id rows between unbounded preceding and unbounded following)
"""

_LINES = rf"""
with d as (select row_number() over () row, doc_id, string_split(coalesce(text, ''), chr(10)) ls from documents),
l as (select row, doc_id, unnest(ls) line, generate_subscripts(ls, 1) i from d),
k as (select *, translate(trim(line, {_WHITE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') k from l),
n as (select k from k where k <> '' group by k having count(distinct row) >= 10),
f as (select k.*, n.k is not null gone from k left join n on n.k = k.k)
select doc_id, count(*) n_lines, count(*) filter (gone) n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) kept_sha256
from f group by row, doc_id
"""

_DECONTAMINATION = r"""
with w as (
  select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') ws from documents),
b as (
  select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') ws from benchmark),
bw as (
  select distinct item_id, least(13, len(ws)) n, array_to_string(ws[i:i + least(13, len(ws)) - 1], ' ') win
  from (select *, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) i from b where len(ws) > 0)),
ln as (select distinct n from bw),
dw as (
  select doc_id, i, n, array_to_string(ws[i:i + n - 1], ' ') win
  from (select doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) i from w, ln where len(ws) >= n)),
o as (select doc_id, i, dw.n, item_id from dw join bw on dw.n = bw.n and dw.win = bw.win),
h as (select doc_id, count(distinct p) n_hit from (select doc_id, unnest(range(i, i + n)) p from o) group by 1),
t as (select doc_id, count(*) n_items, string_agg(x, ',' order by x) s
  from (select distinct doc_id, item_id::varchar x from o) group by 1)
select w.doc_id, coalesce(len(ws), 0)::bigint n_words, coalesce(n_hit, 0)::bigint n_hit,
  coalesce(n_items, 0)::bigint n_items, sha256(coalesce(s, '')) items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= coalesce(len(ws), 0) contaminated
from w left join h on h.doc_id = w.doc_id left join t on t.doc_id = w.doc_id
"""


_NEAR = r"""
with recursive d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') w from documents),
s as (
  select distinct doc_id, case when len(w) = 1 then w[1] else w[i] || ' ' || w[i + 1] end s
  from (select *, unnest(range(1, greatest(2, len(w)))) i from d where len(w) > 0)),
n as (select doc_id, count(*) n from s group by 1),
p as (select a.doc_id x, b.doc_id y, count(*) c from s a join s b on a.s = b.s and a.doc_id <> b.doc_id group by 1, 2),
e as (select x, y from p join n nx on nx.doc_id = x join n ny on ny.doc_id = y where 100 * c >= 80 * (nx.n + ny.n - c)),
r as (select doc_id x, doc_id y from d union select r.x, e.y from r join e on e.x = r.y),
m as (select x, min(y) c from r group by 1)
select d.doc_id, coalesce(n.n, 0)::bigint n_shingles, m.c component_id, d.doc_id = m.c kept
from d join m on m.x = d.doc_id left join n on n.doc_id = d.doc_id
"""


def _mixing(plan: Curriculum = Curriculum()) -> str:
    weights = ", ".join(f"{float(w)!r}::double" for w in plan.weights)

    def time_of(share: str, knots) -> str:
        areas, out = [0.0], "1.0::double"
        for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
            areas.append(areas[-1] + (w0 + w1) / 2 * (t1 - t0))
        demand = f"({share} * {areas[-1]!r}::double)"
        for i in reversed(range(len(knots) - 1)):
            (t0, w0), (t1, w1) = knots[i], knots[i + 1]
            rest = f"({demand} - {areas[i]!r}::double)"
            root = f"sqrt(greatest({w0 * w0!r}::double + {rest} * {2 * (w1 - w0) / (t1 - t0)!r}::double, 0))"
            out = (f"case when {demand} <= {areas[i + 1]!r}::double then {t0!r}::double + "
                   f"case when {rest} > 0 then {rest} * 2 / ({root} + {w0!r}::double) else 0 end else {out} end")
        return out

    def position(offset: str) -> str:
        cases = " ".join(
            f"when {i} then {time_of(f'({offset} / goal::double)', knots)}" for i, knots in enumerate(plan.knots))
        return f"case when taken > 0 then round(case rank % {len(plan.knots)} {cases} end, 9) end"

    return f"""
with d as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint size,
    md5(coalesce(doc_id::varchar, '')) k from documents),
e as (select *, ('0x' || substr(k, 1, 4))::bigint % 4096 bucket from d),
s as (select source, sum(size)::double source_size, row_number() over (order by source is null, source) - 1 rank from d group by source),
w as (select *, list_value({weights})[rank % {len(plan.weights)} + 1] weight, source_size * {float(plan.most)!r}::double cap from s),
r as (select *, cap / weight ratio from w),
v as (select *, (sum(source_size) over () * {float(plan.budget)!r}::double
    - coalesce(sum(cap) over (order by ratio, rank rows between unbounded preceding and 1 preceding), 0))
    / sum(weight) over (order by ratio, rank rows between current row and unbounded following) lvl from r),
f as (select arg_min(lvl, ratio * 1e6 + rank) lvl from v where lvl <= ratio),
t as (select source, rank, source_size::bigint source_size, least(cap, coalesce((select lvl from f) * weight, cap)) target from w),
p as (select e.doc_id, e.size, t.source_size, t.target, t.rank,
    (sum(size) over (partition by e.source order by bucket, k, size rows unbounded preceding) - size)::bigint o,
    floor(target)::bigint goal
  from e join t on e.source is not distinct from t.source),
q as (select *, case when source_size > 0 then goal // source_size else 0 end passes from p),
x as (select *, greatest(0, least(size, goal - passes * source_size - o)) extra from q),
y as (select *, passes * size + extra taken from x)
select doc_id, size, source_size, target, taken::bigint taken, {position('o')} as position,
  {position('(o + (passes - case when extra > 0 then 0 else 1 end) * source_size)')} as last_position
from y
"""


_RANKED = r"""
with w as (
  select row_number() over () row, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') ws from documents),
d as (select row, doc_id, ws, len(ws) n from w where len(ws) > 0),
s as (select count(*) docs, sum(n)::bigint total from d),
t as (select row, term, count(*) tf from (select row, unnest(ws) term from d) group by all),
q as (
  select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) term from benchmark),
f as (select term, count(*) df from t group by term),
wt as (select term, floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)::double))::bigint weight from f, s),
h as (
  select item_id, row, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * docs) // total)))))::bigint score
  from q join t using (term) join wt using (term) join d using (row), s group by all),
r as (
  select item_id, (row_number() over (partition by item_id order by score desc, doc_id))::int as rank, doc_id, score
  from h join d using (row) where score > 0)
select * from r where rank <= 10
"""


def _infill(params: FimParams = FimParams()) -> str:
    p, s, m = (f"'{x.decode()}'" for x in params.sentinels)
    first, second = "least(a, b)", "greatest(a, b)"

    def lines(begin: str, end: str) -> str:
        return f"array_to_string(ls[{begin} + 1:{end}], '')"

    return f"""
with d as (
  select doc_id, coalesce(text, '') t, regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') ls,
    sha256('{params.seed}:' || coalesce(doc_id::varchar, '')) x from documents),
h as (select *, len(ls) n, {', '.join(f"('0x' || substr(x, {8 * i + 1}, 8))::bigint h{i + 1}" for i in range(4))} from d),
c as (select *, h1 % (n + 1) a, h2 % (n + 1) b,
  case when t = '' or contains(t, {p}) or contains(t, {s}) or contains(t, {m}) or h3 % 100 >= {params.rate} then 'plain'
    when h4 % 100 < {params.spm} then 'spm' else 'psm' end form from h),
q as (select doc_id, n, form, t, {lines('0', first)} pre, {lines(first, second)} mid, {lines(second, 'n')} suf from c)
select doc_id, n, form, case when form <> 'plain' then length(pre) end prefix_chars,
  case when form <> 'plain' then length(mid) end middle_chars,
  sha256(case form when 'plain' then t when 'psm' then {p} || pre || {s} || suf || {m} || mid
    else {s} || suf || {p} || pre || {m} || mid end) output_sha256, sha256(t) restored_sha256
from q
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_url_filter": _urls(),
        "op2_exact_dedup": _EXACT,
        "op5_line_dedup": _LINES,
        "op7_mixing": _mixing(),
        "op8_decontamination": _DECONTAMINATION,
        "op10_near_duplicates": _NEAR,
        "op12_search": _RANKED,
        "op13_fill_in_middle": _infill(),
    }

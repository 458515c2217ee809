"""Personal data: checked patterns, and further candidates that boosted trees select."""

from __future__ import annotations

from dataclasses import dataclass
from math import exp, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelabel.llm.common import stored

# Kinds in the order of the contract, and their patterns. Where a match can only begin
# at the first character of a run, or right behind the match before, the pattern says so; with
# possessive repeats, long runs then take linear time and no stack.
KINDS = ("email", "ip", "card", "phone")
#: All kinds; the last has no checked pattern, its outcomes come from the words in front.
ALL_KINDS = (*KINDS, "secret")
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    # Of the digit runs that the contract matches, those long enough to pass; a run begins where neither
    # a digit nor a digit and one separator stands before.
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Generators of further candidates (written-out mail addresses, long form addresses,
# digit groups with dots or slashes, numbers in national form), and what must be there to try them.
MORE = {
    "email": (
        r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{1,64}+ ?(?:\(at\)|\[at\]|\{at\}|&#64;| at (?=[a-z0-9-]{1,63} (?:dot|\(dot\)|\[dot\]) )) ?"
        r"[a-z0-9-]{1,63}(?: ?(?:\.|\(dot\)|\[dot\]|\{dot\}| dot ) ?[a-z0-9-]{1,63})+", r"(?i)[(\[{ ;]at[)\]} ]|&#64;"),
    "ip": (r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])", r"[0-9A-Fa-f]:[0-9A-Fa-f]"),
    "card": (r"(?<![0-9./])[0-9]{4}([./_])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}(?![0-9./])", r"[0-9]{4}[./_][0-9]{4}"),
    "phone": (
        r"(?<![0-9+.-])(?:\([0-9]{2,5}\) ?|00[0-9]{1,3}[ -]?|0[0-9]{2,4}[ /-]|[0-9]{3}[ .-])[0-9]{3,4}[ .-][0-9]{3,5}(?![0-9.-])",
        r"[0-9)][ .-][0-9]{3,5}"),
    "secret": (
        r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])(?=[0-9+/_-]*+[A-Za-z])[A-Za-z0-9+/_-]{20,}+(?![A-Za-z0-9+/_-])",
        r"[A-Za-z0-9+/_-]{20}"),
}
# Words before a span that speak of its kind.
CUES = {
    "email": r"(?i)(?:e-?mail|mail|contact|write|kontakt|correo|courriel)\W*$",
    "ip": r"(?i)(?:\bip|address|host|server|from)\W*$",
    "card": r"(?i)(?:card|visa|credit|account|carte|karte|tarjeta)\W*$",
    "phone": r"(?i)(?:tel|phone|call|fax|mobile|cell|number|telefon|llam)\w*\W*$",
    "secret": r"(?i)(?:token|secret|passwor[dt]|passwd|credential|api_?key|access_?key|private_?key|bearer|authorization)[\x22']?\s*[:=]?\s*[\x22']?$",
}
# What is taken off or put back before the format is looked at, so that a further
# candidate looks like the checked ones: the country code, and written-out signs of a mail address.
MASKS = {
    "email": ((r"(?i)\s?(?:\(at\)|\[at\]|\{at\}|&#64;|\bat\b)\s?", "@"), (r"(?i)\s?(?:\(dot\)|\[dot\]|\{dot\}|\bdot\b)\s?", ".")),
    "phone": ((r"^(?:\+|00)[0-9]{1,3}[ -]?", ""), (r"^0+(?=[1-9])", "")),
}
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
CONTEXT = 24

# Values of each feature, in the order of the code's digits.
SIZES = {"digits": 20, "groups": 8, "before": 4, "after": 4, "cue": 2, "length": 16}


@dataclass(frozen=True)
class PiiParams:
    """Boosting of two-level trees, the share of true spans that a threshold must reach among the
    candidates it selects, and how many labelled ones a kind needs in each half to learn at all."""

    rounds: int = 20
    rate: float = 0.3
    precision: float = 0.9
    least: int = 20


def _digits(match: Column) -> Column:
    return F.length(F.regexp_replace(match, "[^0-9]", ""))


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return F.rlike(match, F.lit(rf"^{_PART}(?:\.{_PART}){{3}}$"))
    if kind == "card":
        plain = F.regexp_replace(match, r"[\x20-]", "")
        return F.length(plain).between(12, 19) & F.call_function("luhn_check", plain)
    if kind == "phone":
        return _digits(match).between(9, 15)
    return F.lit(True)


def _open(kind: str, base: bool, match: Column) -> Column:
    """Whether a span without a passed check may be selected, however likely it looks.

    A failed check is final but for cards, whose check digit a single wrong digit spoils.
    """
    if kind == "card":
        plain = F.regexp_replace(match, "[^0-9]", "")
        return F.length(plain).between(12, 19) & ~F.rlike(plain, F.lit(r"^([0-9])\1*$"))
    if kind == "secret":
        return F.length(match) <= 128
    if kind == "phone":
        return F.lit(not base) & _digits(match).between(9, 15)
    return F.lit(not base)


def _side(char: Column) -> Column:
    """Class of a neighbouring character: none or white space, letter, digit, other."""
    return F.when(char.isNull() | F.rlike(char, F.lit(r"^\s*$")), 0).when(F.rlike(char, F.lit(r"^\p{L}$")), 1) \
        .when(F.rlike(char, F.lit("^[0-9]$")), 2).otherwise(3)


def _code(kind: str, match: Column, left: Column, right: Column) -> Column:
    """Format and context of a span as one number, without what its label was read from.

    Checks look at a leading plus, at check digits and the sizes of parts, secrets at the words in
    front: none of them is a feature of that kind.
    """
    for pattern, put in MASKS.get(kind, ()):
        match = F.regexp_replace(match, pattern, put)
    values = {
        "digits": F.least(_digits(match), F.lit(19)),
        "groups": F.least(F.size(F.split(match, r"[^A-Za-z0-9]+")), F.lit(7)),
        "before": _side(F.right(left, F.lit(1))),
        "after": _side(F.left(right, F.lit(1))),
        "cue": F.lit(0) if kind == "secret" else F.rlike(left, F.lit(CUES[kind])).cast("int"),
        "length": F.least(F.floor(F.length(match) / 4), F.lit(15)),
    }
    code = F.lit(ALL_KINDS.index(kind))
    for name, size in SIZES.items():
        code = code * size + F.coalesce(values[name].cast("int"), F.lit(0))
    return code


def _features(code: int) -> tuple[int, list[int]]:
    """Kind and feature values of a code."""
    values = []
    for size in reversed(SIZES.values()):
        code, value = divmod(code, size)
        values.append(value)
    return code, values[::-1]


_SPAN = "struct<start:int,kind:int,end:int,sure:boolean,open:boolean,label:boolean,code:int>"
_ARRAY = f"array<{_SPAN}>"


def _let(value: Column, body) -> Column:
    """`body` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running_sums(steps: Column) -> Column:
    """Sums of an array of whole numbers up to each place.

    Appending to one array would copy it for every element; blocks of about the root of the
    length, and then their totals, keep the copies short.
    """
    def within(block: Column) -> Column:
        empty = F.array().cast("array<int>")
        return F.aggregate(block, F.struct(F.lit(0).alias("at"), empty.alias("sums")), lambda done, step: F.struct(
            (done["at"] + step).alias("at"),
            F.concat(done["sums"], F.array(done["at"] + step)).alias("sums")), lambda done: done["sums"])

    def of(values: Column) -> Column:
        size = F.greatest(F.lit(16), F.ceil(F.sqrt(F.size(values)))).cast("int")
        starts = F.sequence(F.lit(1), F.size(values), size)
        inner = F.transform(starts, lambda at: within(F.slice(values, at, size)))

        def joined(blocks: Column) -> Column:
            totals = within(F.transform(blocks, lambda b: F.element_at(b, -1)))
            before = F.concat(F.array(F.lit(0)), totals)
            return F.flatten(F.zip_with(
                blocks, F.slice(before, F.lit(1), F.size(blocks)), lambda block, add: F.transform(block, lambda x: x + add)))

        return _let(inner, joined)

    return F.when(F.size(steps) > 0, _let(steps, of)).otherwise(F.array().cast("array<int>"))


def _positioned(kind: str, base: bool) -> Column:
    """Spans of the matches in `_m`, placed by the lengths of the text between them, `_p`."""
    matches, pieces = F.col(f"_m_{kind}_{int(base)}"), F.col(f"_p_{kind}_{int(base)}")
    count = F.size(matches)
    before = F.concat(F.array(F.lit(0)), F.transform(matches, lambda m: F.length(m)))
    lefts, rights = F.slice(pieces, F.lit(1), count), F.slice(pieces, F.lit(2), count)
    steps = F.zip_with(lefts, F.slice(before, F.lit(1), count), lambda text, match: F.length(text) + match)
    sides = F.zip_with(lefts, rights, lambda a, b: F.struct(F.right(a, F.lit(CONTEXT)).alias("left"), F.left(b, F.lit(1)).alias("right")))
    placed = F.zip_with(matches, running_sums(steps), lambda m, at: F.struct(m.alias("m"), at.alias("at")))

    def span(p: Column, side: Column) -> Column:
        sure = F.coalesce(_valid(kind, p["m"]), F.lit(False)) if base else F.lit(False)
        label = F.rlike(side["left"], F.lit(CUES[kind])) if kind == "secret" else sure
        return F.struct(
            p["at"].alias("start"), F.lit(ALL_KINDS.index(kind)).alias("kind"), (p["at"] + F.length(p["m"])).alias("end"),
            sure.alias("sure"), (~sure & F.coalesce(_open(kind, base, p["m"]), F.lit(False))).alias("open"),
            F.coalesce(label, F.lit(False)).alias("label"), _code(kind, p["m"], side["left"], side["right"]).alias("code"))

    empty = F.array().cast(_ARRAY)
    return F.when(count > 0, F.zip_with(placed, sides, span).cast(_ARRAY)).otherwise(empty)


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans) of every row: all matches of the checked and of the further patterns."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    text, none = F.col("_t"), F.array().cast("array<string>")
    matches, pieces = {}, {}
    for kind in ALL_KINDS:
        needs = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+"))}.get(kind, F.lit(True))
        further, trigger = MORE[kind]
        searches = [(1, BASE[kind], needs)] if kind in BASE else []
        for base, pattern, tried in (*searches, (0, further, F.rlike(text, F.lit(trigger)))):
            own = f"{kind}_{base}"
            matches["_m_" + own] = F.when(tried, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none)
            pieces["_p_" + own] = F.when(F.size("_m_" + own) > 0, F.split(text, pattern, -1))
    rows = rows.withColumns(matches).withColumns(pieces)
    return rows.select("doc_id", F.concat(*(
        _positioned(kind, base) for kind in ALL_KINDS for base in (True, False) if kind in BASE or not base)).alias("spans"))


def boosted(rows: list[tuple[list[int], float, float]], params: PiiParams) -> list[tuple]:
    """Trees of two levels over (features, count, valid ones): logistic loss, Newton steps.

    A tree is (feature, most, left, right); left and right are (feature, most, value, value).
    """
    total, good = sum(n for _, n, _ in rows), sum(k for _, _, k in rows)
    base = log((good + 1) / (total - good + 1))
    scores, trees = [base] * len(rows), [(0, -1, (0, -1, base, base), (0, -1, base, base))]
    for _ in range(params.rounds):
        slopes = []
        for (_, n, k), score in zip(rows, scores):
            p = 1 / (1 + exp(-score))
            slopes.append((k - n * p, n * p * (1 - p)))
        feature, most = _best_split(rows, slopes, range(len(rows)))
        sides = []
        for own in ([i for i, r in enumerate(rows) if r[0][feature] <= most], [i for i, r in enumerate(rows) if r[0][feature] > most]):
            f, m = _best_split(rows, slopes, own)
            sides.append((f, m, *(params.rate * _newton(slopes, [i for i in own if (rows[i][0][f] <= m) == low]) for low in (True, False))))
        trees.append((feature, most, *sides))
        scores = [s + _value(trees[-1], r[0]) for s, r in zip(scores, rows)]
    return trees


def _newton(slopes: list[tuple[float, float]], own) -> float:
    return sum(slopes[i][0] for i in own) / (sum(slopes[i][1] for i in own) + 1.0)


def _best_split(rows, slopes, own) -> tuple[int, int]:
    """Feature and largest value of the left side with the greatest gain; ties: the first."""
    best = (0.0, 0, -1)
    for f in range(len(SIZES)):
        sums: dict[int, list[float]] = {}
        for i in own:
            pair = sums.setdefault(rows[i][0][f], [0.0, 0.0])
            pair[0] += slopes[i][0]
            pair[1] += slopes[i][1]
        g, h = (sum(p[j] for p in sums.values()) for j in (0, 1))
        left = [0.0, 0.0]
        for value in sorted(sums)[:-1]:
            left = [left[0] + sums[value][0], left[1] + sums[value][1]]
            right = [g - left[0], h - left[1]]
            gain = left[0] ** 2 / (left[1] + 1) + right[0] ** 2 / (right[1] + 1) - g ** 2 / (h + 1)
            if gain > best[0] + 1e-9:
                best = (gain, f, value)
    return best[1], best[2]


def _value(tree: tuple, x: list[int]) -> float:
    side = tree[2] if x[tree[0]] <= tree[1] else tree[3]
    return side[2] if x[side[0]] <= side[1] else side[3]


def score(trees: list[tuple], x: list[int]) -> float:
    return 1 / (1 + exp(-sum(_value(t, x) for t in trees)))


def calibrated(rows: list[tuple[float, int, int]]) -> list[tuple[float, float]]:
    """(lowest score, share) steps, rising: the shares nearest to those seen that never fall with the score.

    `rows` are (score, count, labelled ones); neighbours that fall are pooled.
    """
    steps: list[list[float]] = []
    for score_, n, k in sorted(rows):
        if steps and steps[-1][0] == score_:
            steps[-1][1] += n
            steps[-1][2] += k
        else:
            steps.append([score_, n, k])
    pools: list[list[float]] = []
    for step in steps:
        pools.append(step)
        while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
            low, n, k = pools.pop()
            pools[-1] = [pools[-1][0], pools[-1][1] + n, pools[-1][2] + k]
    return [(low, k / n) for low, n, k in pools]


def _share(steps: list[tuple[float, float]], p: float) -> float:
    """The share at a score; between steps that of the one below."""
    found = [share for low, share in steps if low <= p + 1e-12]
    return found[-1] if found else steps[0][1]


def selected_codes(counts: list[tuple[int, bool, bool, int, int]], params: PiiParams) -> dict[int, float]:
    """Codes whose open candidates are taken, with the probability that they are true.

    From (code, label, open, fold, n). Labelled spans are certain, all others may be either: a
    check says nothing about spans it was not made for. So the trees learn, on fold 0, how likely a
    span of some format and context is to carry a label, and fold 1 calibrates that. The typical
    labelled span carries one with probability c; where spans are labelled as often as that, nearly
    all of them are true, labelled or not, and where seldom, few. By the odds rule an unlabelled
    span of labelling probability g is true with probability (1 - c) / c * g / (1 - g). Codes are
    taken in falling order of it as long as the expected share of true ones among all that they
    select reaches `precision`.

    A kind with fewer than `least` labelled spans in either half selects nothing; so does one whose
    open candidates resemble no labelled span.
    """
    chosen: dict[int, float] = {}
    for kind in range(len(ALL_KINDS)):
        table: dict[int, dict[tuple, int]] = {}
        for code, label, open_, fold, n in counts:
            if _features(code)[0] == kind:
                own = table.setdefault(code, {})
                own[label, open_, fold] = own.get((label, open_, fold), 0) + n
        total = lambda own, label, fold: sum(n for (l, _, f), n in own.items() if f == fold and (label is None or l == label))
        halves = [[(c, _features(c)[1], total(own, None, f), total(own, True, f)) for c, own in sorted(table.items()) if total(own, None, f)]
                  for f in (0, 1)]
        if min(sum(k for *_, k in half) for half in halves) < params.least:
            continue
        trees = boosted([(x, n, k) for _, x, n, k in halves[0]], params)
        scores = {c: score(trees, _features(c)[1]) for c in table}
        steps = calibrated([(scores[c], n, k) for c, _, n, k in halves[1]])
        typical = sum(k * _share(steps, scores[c]) for c, _, _, k in halves[1]) / sum(k for *_, k in halves[1])
        ranked = []
        for c, own in table.items():
            taken = sum(n for (_, open_, _), n in own.items() if open_)
            if taken:
                g = _share(steps, scores[c])
                odds = (1 - typical) * g, typical * (1 - g)
                ranked.append((1.0 if odds[0] >= odds[1] else odds[0] / odds[1], taken, c))
        n = true = 0.0
        for p, taken, c in sorted(ranked, key=lambda r: (-r[0], r[2])):
            n, true = n + taken, true + taken * p
            if true < params.precision * n:
                break
            chosen[c] = p
    return chosen


def find_pii(docs: DataFrame, params: PiiParams = PiiParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id and spans, an array of (start, kind, end, base), by start and kind.

    `kind` is the number in ALL_KINDS, places count code points from 0, `end` is exclusive. Base spans
    are the checked patterns' leftmost matches that pass their check; they always stay. A further
    candidate is added if its format and context pass the calibrated threshold of its kind and it
    overlaps no base span: digit runs that look like cards but for the check digit, numbers in
    national form, written-out mail addresses, long keys.

    Null and empty texts have no spans. Rows that repeat an id are searched one by one. A very long
    text is searched in time nearly proportional to its length. An empty table gives no rows; other
    columns are ignored, whatever their names.

    Texts are searched once; what is stored is each row's few candidates. For training they are
    added up by feature code over all documents, so the driver sees a row per code at most (of
    409,600 possible), however large the corpus. A code's candidates all get the same score, so
    selecting codes is the same as running the trees on each candidate.
    """
    found = stored(candidates(docs, id_col, text_col))
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 2
    each = found.where(F.size("spans") > 0).select(fold.alias("fold"), F.explode("spans").alias("s"))
    counts = each.groupBy("s.code", "s.label", "s.open", "fold").agg(F.count(F.lit(1)).alias("n"))
    chosen = selected_codes([tuple(r) for r in counts.orderBy("code", "label", "open", "fold").collect()], params)

    likely = (lambda s: s["code"].isin(sorted(chosen))) if chosen else (lambda s: F.lit(False))
    rows = found.select(
        "doc_id", F.filter("spans", lambda s: s["sure"]).alias("sure"),
        F.filter("spans", lambda s: s["open"] & likely(s)).alias("more"))
    apart = F.when(F.size("more") == 0, F.col("more")).otherwise(F.filter(
        "more", lambda m: ~F.exists("sure", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"]))))
    short = lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["sure"].alias("base"))
    return rows.select("doc_id", F.array_sort(F.transform(F.concat("sure", apart), short)).alias("spans"))


def listed(spans: Column) -> Column:
    """kind:start:end of the spans, comma-joined."""
    names = F.array(*(F.lit(k) for k in ALL_KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; overlapping spans become one."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(done: Column, s: Column) -> Column:
        names = F.array(*(F.lit(f"[{k}]") for k in ALL_KINDS))
        before = F.substring(text, done["at"] + 1, F.greatest(s["start"] - done["at"], F.lit(0)))
        mark = F.when(s["start"] >= done["at"], F.get(names, s["kind"])).otherwise("")
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), F.concat(done["out"], before, mark).alias("out"))

    return F.aggregate(spans, start, step, lambda done: F.concat(
        done["out"], F.substring(text, done["at"] + 1, F.length(text))))

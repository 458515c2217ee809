"""The vote over consecutive keypoints, and labelling backwards from a decision."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelabel.operators.match import line_votes
from ridelabel.operators.skew import CHUNK
from ridelabel.params import MatchParams
from ridelabel.storage import written

#: The part of rows before any cut; below every chunk number.
NO_PART = -1


def _scope(params: MatchParams) -> list[str]:
    return ["vehicle_id", "session_id"] if params.scope == "session" else ["vehicle_id"]


def vote_group(params: MatchParams) -> list[str]:
    """Columns whose rows share one vote."""
    return [*_scope(params), "part"]


def with_parts(steps: DataFrame, params: MatchParams) -> DataFrame:
    """Add ``part``, which cuts a vote group where cutting cannot change the vote.

    For ordinary vehicles there is one part. For hot ones, whose rows carry their
    chunk, a part starts at the first row of a chunk where the vote is certain to
    start anew, seen from neighbouring keypoints alone. Either no line due here was
    due at the last keypoint with any: no vote is carried over. Or the keypoint
    before was decided whatever the votes were (its only candidate may start there,
    or was the only candidate of the one before it, too) and this one clears the
    votes (a line may start here, or the decided line is not due).
    """
    if CHUNK not in steps.columns:
        return steps.withColumn("part", F.lit(NO_PART))
    order = Window.partitionBy("vehicle_id", CHUNK).orderBy("time", "seq_no")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    any_due = F.size("cands") > 0
    lines = F.transform("cands", lambda c: c["line_id"])
    group = F.col("session_id").cast("bigint") if params.scope == "session" else F.lit(0).cast("bigint")
    rows = steps.withColumns({
        "_lines": F.when(any_due, lines),
        "_seen": F.struct(F.when(F.size("cands") == 1, F.get("cands", F.lit(0))).alias("only"), group.alias("group")),
    })
    rows = rows.withColumns({
        "_earlier": F.last("_lines", ignorenulls=True).over(before),
        "_p1": F.lag("_seen", 1).over(order), "_p2": F.lag("_seen", 2).over(order),
    })
    apart = ~F.arrays_overlap("_earlier", "_lines")
    line = F.col("_p1.only.line_id")
    first, other, least = (rule(steps, n, params) for n in ("first_stop_votes", "other_stop_votes", "single_min_votes"))
    certain = (first >= least) & (least <= 2 * other)
    decided = certain & (F.col("_p1.group") == F.col("_seen.group")) & (
        F.col("_p1.only.has_zero")
        | F.coalesce((F.col("_p2.group") == F.col("_seen.group")) & (F.col("_p2.only.line_id") == line), F.lit(False))
    )
    clears = F.exists("cands", lambda c: c["has_zero"]) | ~F.array_contains("_lines", F.col("_p1.only.line_id"))
    restart = any_due & (F.coalesce(apart, F.lit(False)) | F.coalesce(decided & clears, F.lit(False)))
    rows = rows.withColumn("_cut", restart)
    rows = rows.withColumn("_any", F.max("_cut").over(so_far))

    # One row per chunk: where no restart was seen yet, the part goes on from an earlier chunk.
    chunks = rows.groupBy("vehicle_id", CHUNK).agg(F.max("_cut").alias("_has"))
    earlier = Window.partitionBy("vehicle_id").orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carried = chunks.select(
        F.col("vehicle_id").alias("_v"), F.col(CHUNK).alias("_c"),
        F.coalesce(F.last(F.when(F.col("_has"), F.col(CHUNK)), ignorenulls=True).over(earlier), F.lit(NO_PART))
        .alias("_carried"),
    )
    joined = rows.join(carried, rows["vehicle_id"].eqNullSafe(carried["_v"]) & (rows[CHUNK] == carried["_c"]))
    return joined.withColumn(
        "part", F.when(F.col("_any"), F.col(CHUNK)).otherwise(F.col("_carried"))
    ).drop("_lines", "_seen", "_earlier", "_p1", "_p2", "_cut", "_any", "_v", "_c", "_carried")


def vote_fold(steps: DataFrame, params: MatchParams) -> DataFrame:
    """Replace ``cands`` by ``det`` (the line decided at this keypoint) and ``at_start``.

    Each decision depends on the ones before it, which no window expresses. The
    numbering window makes Spark place and sort each group; the fold then reads
    the sorted partition batch by batch and holds only the votes of the current
    group, however long it is. Parts of hot vehicles that span several chunks are
    folded chunk by chunk (see ``with_true_starts``).
    """
    passed = [c for c in steps.columns if c not in ("cands", RULES)]
    group = vote_group(params)
    steps = with_points(steps, params)
    if CHUNK in steps.columns:
        steps = with_true_starts(steps, params)
        group = [*group, PIECE]
    schema = T.StructType([
        *[steps.schema[c] for c in passed],
        T.StructField("det", _line_type(steps)),
        T.StructField("at_start", T.BooleanType()),
    ])
    return _in_order(steps, group).mapInArrow(_folder(passed, params), schema)


def _line_type(steps: DataFrame) -> T.DataType:
    return steps.schema["cands"].dataType.elementType["line_id"].dataType


def _in_order(steps: DataFrame, group: list[str]) -> DataFrame:
    numbered = steps.withColumn(
        "_step", F.row_number().over(Window.partitionBy(*group).orderBy("time", "seq_no")))
    return numbered.sortWithinPartitions(*group, "time", "seq_no")


#: Column with a row's own rules (first_stop_votes, other_stop_votes, single_min_votes,
#: winning_margin), the same for a whole vote group; without it the parameters hold.
RULES = "_rules"


def rule(steps: DataFrame, name: str, params: MatchParams) -> Column:
    return F.col(RULES)[name] if RULES in steps.columns else F.lit(getattr(params, name))


def with_points(steps: DataFrame, params: MatchParams) -> DataFrame:
    """The candidates with the votes that one keypoint gives each of them (``points``)."""
    first, other = (rule(steps, n, params) for n in ("first_stop_votes", "other_stop_votes"))
    return steps.withColumn("cands", F.transform("cands", lambda c: F.struct(
        c["line_id"], c["has_zero"], line_votes(c["has_zero"], first, other).alias("points"))))


#: Columns of a fold that goes on: what is folded in one go, and the votes it starts with.
PIECE, START = "_piece", "_start"


def _state_type(steps: DataFrame) -> T.StructType:
    line = _line_type(steps)
    vote = T.StructType([T.StructField("line", line), T.StructField("votes", T.IntegerType())])
    return T.StructType([T.StructField("votes", T.ArrayType(vote)), T.StructField("decided", line)])


def _same_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> list:
    return [left[k].eqNullSafe(right[f"_of_{k}"]) for k in keys]


def with_true_starts(steps: DataFrame, params: MatchParams) -> DataFrame:
    """Add what is folded in one go (``_piece``) and the votes it starts with (``_start``).

    The steps come with chunks and parts. A part within one chunk is one piece and starts without
    votes. In a longer part every chunk is a piece. All pieces are folded at once as if they started
    without votes, which gives the votes each ends with. A piece is repeated, again beside all
    others, when the one before it ends with other votes than it started with. Votes soon forget
    how they began (a restart clears them), so few pieces need this and hardly any twice. What
    ``vote_rounds`` repetitions leave open is folded in one go from the first open piece on, whose
    start is certain by then.
    """
    rows = written(steps)
    keys = [*vote_group(params), CHUNK]
    state = _state_type(rows)
    chunks = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    in_part = Window.partitionBy(*keys[:-1])
    # A part that spans chunks is the only one of its vehicle at each chunk's edge, so there are
    # at most about two of these pieces for every chunk: the bound of the broadcasts below.
    pieces = written(chunks.withColumn("_n", F.count(F.lit(1)).over(in_part)).where("_n > 1").select(
        *keys, F.lit(None).cast(state).alias(START)))
    if pieces.isEmpty():
        return rows.withColumns({PIECE: F.lit(NO_PART), START: F.lit(None).cast(state)})

    order = in_part.orderBy(CHUNK)
    known = written(_ends(rows, pieces, keys, params))
    for _ in range(params.vote_rounds):
        wanted = known.withColumn("_wanted", F.lag("_end").over(order))
        marked = written(wanted.withColumn("_differ", _differs()))
        again = marked.where("_differ").select(*keys, F.col("_wanted").alias(START))
        if again.isEmpty():
            break
        known = written(
            marked.where("not _differ").select(*keys, START, "_end").unionByName(_ends(rows, again, keys, params)))
    wanted = known.withColumn("_wanted", F.lag("_end").over(order))
    first_open = F.min(F.when(_differs(), F.col(CHUNK))).over(in_part)
    rest = F.col(CHUNK) >= F.col("_first")
    found = wanted.withColumn("_first", first_open).select(
        *keys, F.when(rest, F.col("_first")).otherwise(F.col(CHUNK)).alias(PIECE),
        F.when(rest, F.col("_wanted")).otherwise(F.col(START)).alias(START))
    found = written(found.withColumnsRenamed({k: f"_of_{k}" for k in keys}))
    joined = rows.join(F.broadcast(found), _same_keys(rows, found, keys), "left")
    return joined.withColumn(PIECE, F.coalesce(PIECE, F.lit(NO_PART))).drop(*[f"_of_{k}" for k in keys])


def _differs() -> Column:
    """Whether a piece was folded from other votes than the piece before it ends with."""
    wanted, start = F.col("_wanted"), F.col(START)
    none = start.isNull() & (F.size("_wanted.votes") == 0) & F.col("_wanted.decided").isNull()
    return wanted.isNotNull() & ~wanted.eqNullSafe(start) & ~none


def _ends(rows: DataFrame, pieces: DataFrame, keys: list[str], params: MatchParams) -> DataFrame:
    """Fold pieces from their ``_start``; one row per piece with the votes at its end (``_end``)."""
    named = pieces.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    own = [RULES] if RULES in rows.columns else []
    chosen = rows.join(F.broadcast(named), _same_keys(rows, named, keys)).select(
        *keys, "time", "seq_no", "cands", START, *own)
    ordered = _in_order(chosen, keys).select(*keys, "cands", START, "_step", *own)
    schema = T.StructType([*[rows.schema[k] for k in keys], T.StructField("_end", _state_type(rows))])
    ends = ordered.mapInArrow(_end_folder(keys, params, schema), schema)
    # The start comes from the table of pieces, not through Python.
    found = ends.join(F.broadcast(named), _same_keys(ends, named, keys))
    return found.select(*[ends[k] for k in keys], START, "_end")


class Votes:
    """Votes of one group and the rule that decides; `step` takes one keypoint after the other.

    ``decided`` is the line that the last keypoint with any line due was given.
    """

    __slots__ = ("params", "votes", "decided")

    def __init__(self, params: MatchParams, votes: dict | None = None, decided=None):
        self.params, self.votes, self.decided = params, votes or {}, decided

    def step(self, due: dict):
        """(line, whether it may start here), or (None, None) if none wins.

        ``due`` has for each line due here whether it may start here, and its points. A keypoint
        without any line changes nothing.
        """
        if not due:
            return None, None
        carried = self.votes
        if self.decided is not None and (self.decided not in due or any(zero for zero, _ in due.values())):
            carried = {}
        self.votes = {line: points + carried.get(line, 0) for line, (_, points) in due.items()}
        self.decided = line = self._winner()
        return (None, None) if line is None else (line, due[line][0])

    def _winner(self):
        """The winning line, or None; equal scores never win."""
        scores = self.votes
        if len(scores) == 1:
            ((line, score),) = scores.items()
            return line if score >= self.params.single_min_votes else None
        best, second = sorted(scores.values())[:-3:-1]
        return max(scores, key=scores.get) if best > second + self.params.winning_margin else None


def _walk(batch: pa.RecordBatch, state: Votes, params: MatchParams) -> Iterator[tuple[bool, Votes, object, object]]:
    """For each row: whether it starts a group, the votes behind it, its line and whether that may start here."""
    lists = batch.column("cands")
    bounds = lists.offsets.to_pylist()
    lines = lists.values.field("line_id").to_pylist()
    zeros = lists.values.field("has_zero").to_pylist()
    points = lists.values.field("points").to_pylist()
    rules = batch.column(RULES) if RULES in batch.schema.names else None
    steps = batch.column("_step").to_pylist()
    starts = batch.column(START) if START in batch.schema.names else None
    for i, step in enumerate(steps):
        if step == 1:
            start = starts[i].as_py() if starts is not None else None
            held = {v["line"]: v["votes"] for v in start["votes"]} if start else None
            own = params.with_(**rules[i].as_py()) if rules is not None else params
            state = Votes(own, held, start["decided"] if start else None)
        low, high = bounds[i], bounds[i + 1]
        line, at_start = state.step(dict(zip(lines[low:high], zip(zeros[low:high], points[low:high]))))
        yield step == 1, state, line, at_start


def _folder(passed: list[str], params: MatchParams):
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = Votes(params)
        for batch in batches:
            det, at_start = [], []
            for _, state, line, start in _walk(batch, state, params):
                det.append(line)
                at_start.append(start)
            line_type = batch.column("cands").type.value_type.field("line_id").type
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in passed], pa.array(det, line_type), pa.array(at_start, pa.bool_())],
                names=[*passed, "det", "at_start"],
            )

    return fold


def _end_folder(keys: list[str], params: MatchParams, schema: T.StructType):
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, last = Votes(params), None

        def end(place: tuple[pa.RecordBatch, int], votes: Votes) -> pa.RecordBatch:
            key = place[0].slice(place[1], 1)
            held = [{"line": line, "votes": n} for line, n in sorted(votes.votes.items())]
            line = key.column("cands").type.value_type.field("line_id").type
            kind = pa.struct([
                ("votes", pa.list_(pa.struct([("line", line), ("votes", pa.int32())]))), ("decided", line)])
            value = pa.array([{"votes": held, "decided": votes.decided}], kind)
            return pa.RecordBatch.from_arrays([*[key.column(k) for k in keys], value], names=schema.names)

        for batch in batches:
            for i, (first, new, _, _) in enumerate(_walk(batch, state, params)):
                if first and last is not None:
                    yield end(last, state)
                state, last = new, (batch, i)
        if last is not None:
            yield end(last, state)

    return fold


def backfill(folded: DataFrame, params: MatchParams) -> DataFrame:
    """Add ``line_id``: the line decided here or at the next decision of the scope.

    Looking backwards in descending order keeps the frame growing by one row; a
    frame to the end of the group would be evaluated anew for every row. Hot
    vehicles look within their chunk first; a summary with one row per chunk then
    brings the first decision of later chunks.
    """
    scope, chunked = _scope(params), CHUNK in folded.columns
    place = [*scope, CHUNK] if chunked else vote_group(params)
    newest_first = Window.partitionBy(*place).orderBy(F.desc("time"), F.desc("seq_no"))
    so_far = newest_first.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = folded.withColumn("line_id", F.last("det", ignorenulls=True).over(so_far))
    if chunked:
        filled = _from_later_chunks(filled, folded, scope)
    return filled.withColumns({
        "detected": F.col("det").isNotNull(), "at_start": F.coalesce("at_start", F.lit(False)),
    }).drop("det")


def _from_later_chunks(filled: DataFrame, folded: DataFrame, scope: list[str]) -> DataFrame:
    first = F.min_by("det", F.when(F.col("det").isNotNull(), F.struct("time", "seq_no")))
    chunks = folded.groupBy(*scope, CHUNK).agg(first.alias("_first"))
    later = Window.partitionBy(*scope).orderBy(F.desc(CHUNK)).rowsBetween(Window.unboundedPreceding, -1)
    names = {c: f"_of_{c}" for c in [*scope, CHUNK]}
    carried = chunks.withColumn("_next", F.last("_first", ignorenulls=True).over(later)).drop("_first")
    carried = carried.withColumnsRenamed(names)
    same = [filled[c].eqNullSafe(carried[names[c]]) for c in names]
    joined = filled.join(carried, same)
    return joined.withColumn("line_id", F.coalesce("line_id", "_next")).drop(*names.values(), "_next", CHUNK)

"""The whole job on a stream: close sessions, then run the batch steps on them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ridelabel.params import MatchParams
from ridelabel.plans.enrich import candidate_steps, enrich, with_details
from ridelabel.sources.master import MasterData
from ridelabel.sources.waypoints import CORRUPT, decode_waypoints, encode_waypoints
from ridelabel.storage import held
from ridelabel.streaming.closing import LATE, PARTITION, REASON, packed_sessions, unpacked
from ridelabel.streaming.ledger import Ledger
from ridelabel.streaming.votes import continued_votes

#: Where results go: a writer's format, path and options, or a function of (rows, batch id).
Sink = dict[str, str] | Callable[[DataFrame, int], None]

# Reasons beside LATE why a record is set aside.
BAD, NO_TIME = "corrupt", "no time"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
IDLE_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
PARTITIONS = "spark.sql.shuffle.partitions"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def write_batch(result: DataFrame, sink: Sink, batch_id: int) -> None:
    """Write the labelled rows of one micro-batch.

    Files go to a folder of their own per batch, so a repeated batch replaces
    what it wrote before. Kafka gets records without key. A function gets the rows as they are.
    """
    if callable(sink):
        sink(result, batch_id)
        return
    options = {k: v for k, v in sink.items() if k not in ("format", "path")}
    kind = sink.get("format", "parquet")
    if kind == "kafka":
        encode_waypoints(result).write.format("kafka").options(**options).save()
        return
    rows = encode_waypoints(result) if kind == "text" else result
    rows.write.format(kind).options(**options).mode("overwrite").save(f"{sink['path']}/batch_id={batch_id}")


def _set_aside(waypoints: DataFrame) -> DataFrame:
    """(row, reason) of decoded records that cannot become waypoints."""
    text = F.col(CORRUPT) if CORRUPT in waypoints.columns else F.lit(None).cast("string")
    whole = F.to_json(F.struct(*(c for c in waypoints.columns if c not in (CORRUPT, PARTITION))))
    marked = waypoints.select(
        F.coalesce(text, whole).alias("row"),
        F.when(text.isNotNull(), BAD).when(F.col("time").isNull(), NO_TIME).alias(REASON))
    return marked.where(F.col(REASON).isNotNull())


def _counted(rows: DataFrame) -> DataFrame:
    """The same rows, their numbers by reason reported with the stream's progress."""
    sums = [F.count_if(F.col(REASON) == r).alias(r) for r in (LATE, BAD, NO_TIME)]
    return rows.observe("rows", F.count_if(F.col(REASON).isNull()).alias("taken"), *sums)


def _write_rejects(packed: DataFrame, waypoints: DataFrame, folder: str, batch_id: int) -> None:
    late = encode_waypoints(unpacked(packed.where(F.col(REASON) == LATE), waypoints).drop(REASON, CORRUPT))
    others = packed.where(F.col(REASON).isNotNull() & (F.col(REASON) != LATE)).select(F.col("row").alias("value"), REASON)
    late.withColumn(REASON, F.lit(LATE)).unionByName(others) \
        .write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")


def _start(packed: DataFrame, checkpoint: str, act: Callable[[DataFrame, int], None], trigger: dict,
           partitions: int | None) -> StreamingQuery:
    """Run `act` once for each micro-batch of a stream.

    A batch is written below the checkpoint and read by the session that started the stream: the
    stream's own deals no popular key to several tasks, and every lookup there would send its table
    once for each salt. The rows, and the shuffles made of them, go with the batch.
    """
    spark = packed.sparkSession
    # The closing state is a list per vehicle, which only this store appends to.
    spark.conf.set(STATE_STORE, ROCKS_DB)
    ledger = Ledger(spark, f"{checkpoint}/ledger")

    def once(batch: DataFrame, batch_id: int) -> None:
        if ledger.has(batch_id):
            # Written before, but the state must move on with the batch.
            batch.write.format("noop").mode("overwrite").save()
            return
        # Several jobs read the batch; if it were not written, each would run the state again.
        with held(batch, spark, f"{checkpoint}/rows/batch_id={batch_id}") as rows:
            act(rows, batch_id)
            ledger.note(batch_id, rows.count())

    writer = packed.writeStream.foreachBatch(once).outputMode("append").option("checkpointLocation", checkpoint)
    # Timers need batches without data, with which a run over what is there would never end.
    endless = not {"availableNow", "once"} & set(trigger)
    settings = {IDLE_BATCHES: str(endless).lower()} | ({PARTITIONS: str(partitions)} if partitions else {})
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        return writer.trigger(**trigger).start()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def _of(rows: DataFrame, step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The step's result; without rows it is empty, and no table is shuffled to find that."""
    return step(rows).limit(0) if rows.isEmpty() else step(rows)


def _packed(waypoints: DataFrame, params: MatchParams, close: str, silence_seconds: int | None) -> DataFrame:
    if close not in ("event_time", "silence"):
        raise ValueError(f"unknown close {close!r}")
    by_event_time = close == "event_time"
    wait = params.idle_flush_seconds if by_event_time else params.detection_gap_seconds
    rows = waypoints.where(F.col(CORRUPT).isNull()).drop(CORRUPT) if CORRUPT in waypoints.columns else waypoints
    closed = packed_sessions(rows, params, by_event_time, wait if silence_seconds is None else silence_seconds)
    return _counted(closed.unionByName(_set_aside(waypoints)))


def enrich_stream(waypoints: DataFrame, master: MasterData, sink: Sink, checkpoint: str,
                  params: MatchParams = MatchParams(), close: str = "event_time",
                  silence_seconds: int | None = None, trigger: dict | None = None,
                  rejects: str | None = None, partitions: int | None = None) -> StreamingQuery:
    """Start labelling a stream of decoded waypoints.

    ``close="event_time"`` ends sessions by each vehicle's event time, or when it sent nothing for
    ``idle_flush_seconds``; ``close="silence"`` ends them by silence alone, of
    ``detection_gap_seconds``. ``silence_seconds`` replaces either time. Each micro-batch of complete
    sessions runs through the same ``enrich`` as stored data; pass ``master.persisted()`` so that its
    tables are derived once. Session and run numbers count within a micro-batch. With the trigger
    ``availableNow`` the run ends with the data; sessions still open then stay for the next run. After a restart timers run from the first new record on.

    Records that could not be decoded (``decode_waypoints(..., "PERMISSIVE")``), have no time or
    come late are counted (see ``rejected_rows``) and, with ``rejects``, written to that folder as
    (value, reason), from where ``read_rejects`` brings them back. Rows without position are left
    out, as in the batch job.

    ``partitions`` is the number of parts of the state, which a checkpoint keeps for good; without
    it the session's shuffle partitions count. Votes stay within a session here; for ``scope="vehicle"`` use ``enrich_stream_by_vehicle``.
    """
    if params.scope != "session":
        raise ValueError("votes that cross sessions need enrich_stream_by_vehicle")

    def label(batch: DataFrame, batch_id: int) -> None:
        done = unpacked(batch.where(F.col(REASON).isNull()), waypoints).drop(REASON, CORRUPT)
        write_batch(_of(done, lambda rows: enrich(rows, master, params)), sink, batch_id)
        if rejects:
            _write_rejects(batch, waypoints, rejects, batch_id)

    regular = {"processingTime": f"{params.idle_flush_seconds} seconds"}
    return _start(_packed(waypoints, params, close, silence_seconds), checkpoint, label, trigger or regular, partitions)


def enrich_stream_by_vehicle(waypoints: DataFrame, master: MasterData, sink: Sink, checkpoint: str,
                             params: MatchParams = MatchParams(scope="vehicle"), close: str = "event_time",
                             silence_seconds: int | None = None, vote_silence_seconds: int | None = None,
                             trigger: dict | None = None, rejects: str | None = None, partitions: int | None = None,
                             ) -> tuple[StreamingQuery, StreamingQuery]:
    """The same with votes that go on from one session of a vehicle to its next.

    Two streams: the first closes sessions and writes keypoints with their candidate lines below the
    checkpoint; the second reads them, votes with each vehicle's votes and waiting keypoints as
    state, and writes the labelled ones. A keypoint waits until a later one is decided. When a
    vehicle brought none for ``detection_gap_seconds`` (or ``vote_silence_seconds``), the waiting
    ones come out without a line and the votes start anew.
    """
    spark = waypoints.sparkSession
    folder = f"{checkpoint}/keypoints"
    regular = trigger or {"processingTime": f"{params.idle_flush_seconds} seconds"}
    by_session = params.with_(scope="session")

    def steps(rows: DataFrame) -> DataFrame:
        return candidate_steps(rows, master, by_session)

    def collapse(batch: DataFrame, batch_id: int) -> None:
        done = unpacked(batch.where(F.col(REASON).isNull()), waypoints).drop(REASON, CORRUPT)
        _of(done, steps).write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")
        if rejects:
            _write_rejects(batch, waypoints, rejects, batch_id)

    columns = [c for c in waypoints.columns if c not in (CORRUPT, PARTITION)]
    schema = steps(spark.createDataFrame([], waypoints.select(*columns).schema)).schema
    # The folder must exist before the second stream looks into it.
    spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{folder}/batch_id=-1")
    first = _start(_packed(waypoints, params, close, silence_seconds), f"{checkpoint}/sessions", collapse, regular, partitions)

    stored = spark.readStream.schema(schema).parquet(f"{folder}/batch_id=*")
    wait = params.detection_gap_seconds if vote_silence_seconds is None else vote_silence_seconds
    voted = continued_votes(stored, params, wait)

    def label(batch: DataFrame, batch_id: int) -> None:
        write_batch(_of(voted.unpack(batch), lambda rows: with_details(rows, master, params)), sink, batch_id)

    return first, _start(voted.packed, f"{checkpoint}/votes", label, regular, partitions)


def rejected_rows(query: StreamingQuery) -> dict[str, int]:
    """Rows taken and set aside, by reason, over the kept progress reports."""
    total: dict[str, int] = {}
    for progress in query.recentProgress:
        seen = progress.observedMetrics.get("rows")
        for name, n in (seen.asDict() if seen else {}).items():
            total[name] = total.get(name, 0) + n
    return total


def late_rows(query: StreamingQuery) -> int:
    """Rows set aside as late, over the kept progress reports."""
    return rejected_rows(query).get(LATE, 0)


def read_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Records set aside: value, reason, seq_no and the batch that brought them; none yet is no error."""
    schema = f"value STRING, {REASON} STRING, batch_id BIGINT"
    try:
        rows = spark.read.schema(schema).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], schema)
    own = F.get_json_object("value", "$.seq_no").cast("bigint")
    return rows.withColumn("seq_no", F.coalesce(own, F.xxhash64("value")))


def replayed(rejects: DataFrame) -> DataFrame:
    """Waypoints of late records, for a batch run that takes them in."""
    late = rejects.where(F.col(REASON) == LATE).select("value", "seq_no")
    return decode_waypoints(late)

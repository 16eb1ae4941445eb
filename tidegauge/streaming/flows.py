"""Running streams to the end of what is there, with checkpoints, and the targets they append to."""

from __future__ import annotations

import json
import threading
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidegauge.plans.tables import apply_changes_table, upsert_table
from tidegauge.session import is_local
from tidegauge.sources.files import SharedFiles
from tidegauge.sources.versions import VersionedTable

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Session settings of a flow. State lives off-heap in RocksDB and checkpoints upload changes only;
# a join keeps one store per partition instead of four; sessions of one key are merged within a
# task before the shuffle.
FLOW_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.join.stateFormatVersion": "3",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}

_EVENTS_DONE_S = 60


def state_partitions(spark: SparkSession) -> int:
    """How many state partitions a new checkpoint gets; they cannot be changed later.

    A cluster session's shuffle setting is taken as it is. A local session has no use for more
    partitions than cores, and every partition costs a state store commit per micro-batch.
    """
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(wanted, spark.sparkContext.defaultParallelism) if is_local(spark) else wanted


@contextmanager
def settings(spark: SparkSession, **conf: str) -> Iterator[None]:
    """Session settings for the time a query starts; a started query keeps its own copy."""
    before = {key: spark.conf.get(key, None) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


class _Progress(StreamingQueryListener):
    """Keeps the progress of every micro-batch of a run, however many the session remembers."""

    def __init__(self):
        self.seen: dict[str, list[dict]] = {}
        self.ended: dict[str, threading.Event] = {}

    def _end(self, run: str) -> threading.Event:
        return self.ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryProgress(self, event):
        self.seen.setdefault(str(event.progress.runId), []).append(json.loads(event.progress.json))

    def onQueryTerminated(self, event):
        self._end(str(event.runId)).set()

    def of(self, run: str) -> list[dict]:
        """All of a run that has ended; the events of one query arrive in order."""
        if not self._end(run).wait(_EVENTS_DONE_S):
            raise TimeoutError("the listener bus did not report the end of the query")
        return self.seen.get(run, [])


@dataclass
class FlowRun:
    """What one run of a flow did, batch by batch."""

    flow: str
    progress: list[dict] = field(default_factory=list)

    @property
    def input_rows(self) -> int:
        return sum(p["numInputRows"] for p in self.progress)

    @property
    def dropped_rows(self) -> int:
        return sum(
            op.get("numRowsDroppedByWatermark", 0) or 0
            for p in self.progress
            for op in p.get("stateOperators", [])
        )

    @property
    def watermark(self) -> str | None:
        marks = [p.get("eventTime", {}).get("watermark") for p in self.progress]
        return max((m for m in marks if m), default=None)


def run_flow(
    stream: DataFrame,
    checkpoint: str,
    name: str,
    path: str | None = None,
    each_batch: Callable[[DataFrame, int], None] | None = None,
    watermark_policy: str = "min",
    state_store: str = ROCKSDB,
    partitions: int | None = None,
) -> FlowRun:
    """Process all available data in append mode, then stop.

    Rows go to Parquet files below ``path``, or to ``each_batch``. The checkpoint holds offsets,
    state and watermark; the next run goes on from there.
    """
    spark = stream.sparkSession
    conf = {
        **FLOW_CONF,
        "spark.sql.streaming.stateStore.providerClass": state_store,
        "spark.sql.streaming.multipleWatermarkPolicy": watermark_policy,
        "spark.sql.shuffle.partitions": str(partitions or state_partitions(spark)),
    }
    if state_store != ROCKSDB:
        conf["spark.sql.streaming.join.stateFormatVersion"] = "2"
    writer = (
        stream.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if each_batch is not None:
        writer = writer.foreachBatch(each_batch)
    elif path is not None:
        writer = writer.format("parquet").option("path", path)
    else:
        raise ValueError("a flow needs a path or a batch function")
    listener = _Progress()
    spark.streams.addListener(listener)
    try:
        with settings(spark, **conf):
            query = writer.start()
        query.awaitTermination()
        return FlowRun(name, listener.of(str(query.runId)))
    finally:
        spark.streams.removeListener(listener)


class ResetNotAllowed(PermissionError):
    pass


class FlowTarget:
    """A table that several flows append to, each with its own checkpoint and folder.

    A flow has generations: a full refresh starts a new one and hides the old data, a checkpoint
    reset starts a new one and keeps it.
    """

    def __init__(self, spark: SparkSession, path: str, reset_allowed: bool = True):
        self.spark = spark
        self.path = path.rstrip("/")
        self.reset_allowed = reset_allowed
        self.files = SharedFiles(spark)

    def _state_folder(self, flow: str) -> str:
        return f"{self.path}/_flows/{flow}"

    def _state_numbers(self, flow: str) -> list[int]:
        names = self.files.children(self._state_folder(flow))
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def state(self, flow: str) -> dict:
        numbers = self._state_numbers(flow)
        if not numbers:
            return {"first": 1, "current": 1, "logic": None}
        return json.loads(self.files.read_text(f"{self._state_folder(flow)}/{numbers[-1]:06d}.json"))

    def _save(self, flow: str, state: dict) -> None:
        # A new file each time, the highest one counts: there is no moment without a state.
        numbers = self._state_numbers(flow)
        following = numbers[-1] + 1 if numbers else 1
        self.files.write_text(f"{self._state_folder(flow)}/{following:06d}.json", json.dumps(state))
        for old in numbers[:-1]:
            self.files.delete(f"{self._state_folder(flow)}/{old:06d}.json")

    def flows(self) -> list[str]:
        return self.files.children(f"{self.path}/_flows")

    def data_folder(self, flow: str, generation: int) -> str:
        return f"{self.path}/flow={flow}/generation={generation}"

    def checkpoint(self, flow: str) -> str:
        return f"{self.path}/_checkpoints/{flow}/generation={self.state(flow)['current']}"

    def append(self, flow: str, stream: DataFrame, logic: str = "1", **options) -> FlowRun:
        """Run one flow into the target. A changed ``logic`` falls back to a full refresh."""
        state = self.state(flow)
        if state["logic"] not in (None, logic):
            self.full_refresh(flow)
            state = self.state(flow)
        if state["logic"] != logic:
            self._save(flow, {**state, "logic": logic})
        folder = self.data_folder(flow, state["current"])
        return run_flow(stream, self.checkpoint(flow), flow, path=folder, **options)

    def full_refresh(self, flow: str) -> None:
        """Forget data and checkpoint: the next run reads its source from the start."""
        if not self.reset_allowed:
            raise ResetNotAllowed(f"resets are switched off for {self.path}")
        following = self.state(flow)["current"] + 1
        self._save(flow, {"first": following, "current": following, "logic": None})

    def reset_checkpoint(self, flow: str) -> None:
        """Forget the checkpoint and keep the data. Readers then see what is read again twice,
        so this is for flows whose sink or reader is idempotent by key."""
        if not self.reset_allowed:
            raise ResetNotAllowed(f"resets are switched off for {self.path}")
        state = self.state(flow)
        self._save(flow, {**state, "current": state["current"] + 1})

    def read(self, flows: list[str] | None = None) -> DataFrame:
        """Everything the flows have committed, with a ``flow`` column."""
        parts = []
        for flow in flows or self.flows():
            state = self.state(flow)
            for generation in range(state["first"], state["current"] + 1):
                folder = self.data_folder(flow, generation)
                # Reading a flow's own folder goes by the sink's commit log.
                if self.files.exists(f"{folder}/_spark_metadata"):
                    rows = self.spark.read.parquet(folder)
                    parts.append(rows.withColumn("flow", F.lit(flow)))
        if not parts:
            raise LookupError(f"no flow has written to {self.path}")
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _once_per_batch(
    table: VersionedTable,
    checkpoint: str,
    write: Callable[[DataFrame, dict[str, int]], int],
    keep: int | None = None,
) -> Callable[[DataFrame, int], None]:
    """A batch function that passes over batches the table already holds.

    Batch numbers belong to a checkpoint, so they are stored under the query id in it: a reset
    checkpoint starts over instead of being taken for a repeat.
    """

    def each(batch: DataFrame, number: int) -> None:
        query = json.loads(table.files.read_text(f"{checkpoint}/metadata"))["id"]
        if table.batch_of(query) >= number:
            return  # published before the last stop; the engine is repeating it
        kept = batch.persist()
        try:
            write(kept, {query: number})
        finally:
            kept.unpersist()
        if keep is not None:
            table.expire(keep)

    return each


def upsert_flow(
    stream: DataFrame,
    table: VersionedTable,
    keys: list[str],
    sequence_by: list[str],
    checkpoint: str,
    name: str,
    keep: int | None = 10,
) -> FlowRun:
    """Upsert every micro-batch into a versioned table, once even if a batch is repeated.

    A batch rewrites the slices it touches, so slices should be of a size that a batch may rewrite.
    Of the versions, one per batch, the last ``keep`` stay; readers of changes must not fall behind
    further than that.
    """

    def write(rows: DataFrame, batches: dict[str, int]) -> int:
        return upsert_table(table, rows, keys, sequence_by, batches)

    each = _once_per_batch(table, checkpoint, write, keep)
    return run_flow(stream, checkpoint, name, each_batch=each)


def apply_changes_flow(
    stream: DataFrame,
    table: VersionedTable,
    keys: list[str],
    sequence_by: list[str],
    checkpoint: str,
    name: str,
    delete_when: Column | None = None,
    keep: int | None = 10,
) -> FlowRun:
    """Apply every micro-batch of changes to a versioned table by key and sequence.

    ``keep`` versions stay, as in ``upsert_flow``.
    """

    def write(rows: DataFrame, batches: dict[str, int]) -> int:
        return apply_changes_table(table, rows, keys, sequence_by, delete_when, batches)

    each = _once_per_batch(table, checkpoint, write, keep)
    return run_flow(stream, checkpoint, name, each_batch=each)

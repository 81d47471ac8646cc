"""O2, O3: a retry frontier as states of items that go from batch to batch, and a sink that takes every micro-batch once and can prove what it holds."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.session import ship, spread
from tributary.sources.commits import CommitLog

SCHEMA_VERSION = 1
STATES = "attempts int, early int, repeats int, ready_at long, reason string, seen_at long"


def advance(state: tuple, at: int, failed: bool, most_attempts: int, backoff_ms: int) -> tuple:
    """One attempt at a time (milliseconds) on an item's (attempts, early, repeats, ready_at, reason).

    An attempt after the end is a repeat; one before the back-off is over is early, and counts. A success ends an item (``done``), so does the
    last failure allowed (``exhausted``); another failure makes it wait (``retry``) twice as long as the one before.
    """
    attempts, early, repeats, ready_at, reason = state
    if reason in ("done", "exhausted"):
        return attempts, early, repeats + 1, ready_at, reason
    early += reason == "retry" and at < ready_at
    attempts += 1
    if not failed:
        return attempts, early, repeats, 0, "done"
    if attempts >= most_attempts:
        return attempts, early, repeats, 0, "exhausted"
    return attempts, early, repeats, at + backoff_ms * 2 ** (attempts - 1), "retry"


@dataclass(frozen=True)
class Producer:
    """Who writes a table of batches: only the same one may go on with it."""

    name: str
    code: str


class BatchTable:
    """O3: a table of micro-batches, each a folder that counts once its manifest stands in a commit log.

    A manifest holds the schema version, the producer, the columns, the number of rows, a digest of the rows and the digest of the manifest before it, so
    that a table is what its producer wrote, in its order, or is refused. A batch that comes again (a stream was
    restarted before it noted the batch) must have the same rows and changes nothing.
    """

    def __init__(self, spark: SparkSession, root: str, producer: Producer):
        self.spark, self.root, self.producer = spark, root, producer
        self.log = CommitLog(spark, f"{root}/manifests")
        self.check()

    @staticmethod
    def digest(manifest: dict | None) -> str:
        return hashlib.sha256(json.dumps(manifest, sort_keys=True, ensure_ascii=False).encode()).hexdigest() if manifest else ""

    def check(self) -> None:
        """Refuse a table of another schema version or producer, with a broken chain, or without a batch's data."""
        before = None
        for _, manifest in self.log.entries():
            if manifest.get("schema_version") != SCHEMA_VERSION:
                raise ValueError(f"the table has schema version {manifest.get('schema_version')}, not {SCHEMA_VERSION}")
            if manifest.get("producer") != vars(self.producer):
                raise ValueError("the table has another producer")
            if manifest.get("before") != self.digest(before):
                raise ValueError("the table's manifests do not follow each other")
            before = manifest

    def verify(self) -> None:
        """Read all data again and compare them with their manifests."""
        for _, manifest in self.log.entries():
            if self._told(self.spark.read.parquet(manifest["path"])) != (manifest["rows"], manifest["content"]):
                raise ValueError(f"{manifest['path']} is not what its manifest says")

    @staticmethod
    def _told(rows: DataFrame) -> tuple[int, str]:
        """Number of rows, and a digest that no order changes: the sum of the rows' hashes, modulo 2^128."""
        text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(rows.columns)]), {"ignoreNullFields": "false"})
        hash_ = F.sha2(text, 256)
        part = lambda a: F.sum(F.conv(F.substring(hash_, a, 15), 16, 10).cast("decimal(38,0)"))
        n, a, b = rows.agg(F.count(F.lit(1)), part(1), part(16)).first()
        return n, hashlib.sha256(f"{a}:{b}".encode()).hexdigest()

    def add(self, rows: DataFrame, batch: int) -> bool:
        """Take a batch by its number; False if it is there already."""
        told = self.log.get(batch + 1)
        path = f"{self.root}/batches/{batch:012d}"
        if told is None:
            rows.write.mode("overwrite").parquet(path)  # what a failed try has left goes
            rows = self.spark.read.parquet(path)
        n, content = self._told(rows)
        if told is not None:
            if (told["rows"], told["content"]) != (n, content):
                raise ValueError(f"batch {batch} came again with other rows")
            return False
        manifest = {
            "schema_version": SCHEMA_VERSION, "producer": vars(self.producer), "columns": rows.schema.simpleString(), "rows": n,
            "content": content, "path": path, "before": self.digest(self.log.get(batch)),
        }
        return self.log.put(batch + 1, manifest)

    def read(self) -> DataFrame:
        """All rows of batches with a manifest, and their batch's number."""
        out = None
        for number, manifest in self.log.entries():
            part = self.spark.read.parquet(manifest["path"]).withColumn("batch", F.lit(number - 1).cast("long"))
            out = part if out is None else out.unionByName(part)
        if out is None:
            raise FileNotFoundError(f"{self.root} has no batch yet")
        return out


def advanced(states: DataFrame, attempts: DataFrame, key: str, most_attempts: int, backoff_ms: int, mark: int | None) -> DataFrame:
    """The items' states after a batch of attempts (key, at, order, failed), and whether each has ``changed``.

    Attempts of a batch count in the order of time, then of ``order``. An item that waits is ``ready`` once its back-off ends before ``mark``. Rows come
    sorted and are walked one by one, so that neither an item is a call of its own nor are all of its attempts held.
    """
    ship(attempts.sparkSession)
    kind = attempts.schema[key].dataType.simpleString()
    names = [key, "attempts", "early", "repeats", "ready_at", "reason", "seen_at", "changed"]
    schema = f"`{key}` {kind}, {STATES}, changed boolean"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        item = now = seen = was = None

        def close() -> None:
            state = now
            if state[4] == "retry" and mark is not None and state[3] < mark:
                state = (*state[:4], "ready")
            out.append((item, *state, seen, state != was))

        def sent() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
            out.clear()
            return batch

        for batch in batches:
            types = [batch.schema.field("item").type, pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
            columns = [batch.column(c).to_pylist() for c in ("item", "state", "at", "failed")]
            for k, state, at, bad in zip(*columns):
                if now is None or k != item:
                    if now is not None:
                        close()
                    item, now, seen, was = k, (0, 0, 0, 0, "waiting"), None, None
                if state is not None:
                    was = now = tuple(state[c] for c in names[1:6])
                    seen = at
                    continue
                now = (*now[:4], "retry") if now[4] == "ready" else now
                now = advance(now, at, bad, most_attempts, backoff_ms)
                seen = at if seen is None else max(seen, at)
            if len(out) >= 10_000:
                yield sent()
        if now is not None:
            close()
            yield sent()

    known = states.select(F.col(key).alias("item"), F.struct(*names[1:6]).alias("state"), F.col("seen_at").alias("at"))
    fresh = attempts.select(F.col(key).alias("item"), "at", "order", "failed")
    both = spread(known.unionByName(fresh, allowMissingColumns=True), "item")
    return both.sortWithinPartitions("item", F.col("state").isNull(), "at", "order", "failed").drop("order").mapInArrow(work, schema)


@dataclass(frozen=True)
class Frontier:
    """O2: how attempts are read, and when an item is given up or tried again."""

    key: str
    ts: str
    order: str
    failed: str
    most_attempts: int
    backoff_ms: int
    late_ms: int


def run_frontier(stream: DataFrame, frontier: Frontier, table: BatchTable, checkpoint: str) -> None:
    """O2, O3: all that is there of a stream of attempts into a table of the items' states: key, attempts, early, repeats, ready_at (milliseconds), reason.

    An item gives a row whenever a batch touches it, or when the watermark (the latest time so far less ``late_ms``) passes the end of its back-off
    without another attempt (``ready``). Attempts that the watermark had passed before their batch are dropped, as a stream does. All states after a batch stand
    in a folder with its number, from which the next batch goes on: a batch that comes again finds those before it, and gives the same rows.
    """
    f, root = frontier, f"{table.root}/states"

    def changes(rows: DataFrame, batch: int) -> DataFrame:
        spark = rows.sparkSession
        at = F.unix_millis(F.col(f.ts).cast("timestamp"))
        sent = rows.select(f.key, at.alias("at"), F.col(f.order).alias("order"), F.col(f.failed).alias("failed"))
        schema = f"`{f.key}` {sent.schema[f.key].dataType.simpleString()}, {STATES}, changed boolean"
        before = spark.read.schema(schema).parquet(f"{root}/{batch - 1:012d}") if batch else spark.createDataFrame([], schema)
        passed, latest = before.agg(F.max("seen_at")).first()[0], sent.agg(F.max("at")).first()[0]
        latest = max((x for x in (passed, latest) if x is not None), default=None)
        if passed is not None:
            sent = sent.where(F.col("at") > passed - f.late_ms)
        mark = None if latest is None else latest - f.late_ms
        path = f"{root}/{batch:012d}"
        advanced(before, sent, f.key, f.most_attempts, f.backoff_ms, mark).write.mode("overwrite").parquet(path)
        return spark.read.schema(schema).parquet(path).where("changed").drop("changed", "seen_at")

    run_batches(stream, table, checkpoint, "append", changes)


def run_batches(stream: DataFrame, table: BatchTable, checkpoint: str, mode: str = "update", keep: Callable[[DataFrame, int], DataFrame] = lambda rows, batch: rows) -> None:
    """O3: all that is there of a stream into a table of batches; ``keep`` says what of a batch, by its rows and number."""
    writer = stream.writeStream.foreachBatch(lambda rows, batch: table.add(keep(rows, batch), batch) and None)
    writer.option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start().awaitTermination()

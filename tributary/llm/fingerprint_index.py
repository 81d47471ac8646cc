"""Substring dedup by a log-structured fingerprint index.

Every window of ``window`` words has a fingerprint: the least hash of the ``gram``-word runs inside it. Windows next to
each other that share it form a segment, so that a passage leaves about one fingerprint for twenty words, and equal
passages leave equal segments but for those at their ends. A run of the index is an immutable table
(fingerprint, segment digest, first document), bucketed and sorted by its key. A new batch is merge-joined with each run, which stays
where it is; a match is verified by the digest of the
segment's own words. What the batch adds becomes a run itself, and ``FANOUT`` runs of a level are compacted into one of the next.

Where a fingerprint has segments of different words (ends of passages, edits), their windows are compared one by
one: the segments' documents are read once more and each window's first document is found by hash and words' digest.

A word is removed if a window over it also starts in a document with a smaller id; windows are judged on the input.

Cases: null and empty texts have no words; shorter texts than a window are never touched; a null doc_id counts as larger than any
other; copies inside one document, and rows that repeat a doc_id, don't remove each other; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm.common import join_by_key, packed, rolling, split_words, text_batches, word_hashes
from tributary.session import materialise, scratch, ship

WINDOW = 50
GRAM = 8
FANOUT = 3
#: Stands for a null doc_id inside the index.
LAST = (1 << 63) - 1


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Least value of each window of ``width``, by doubling."""
    n, done, part = len(x) - width + 1, 1, x
    while done * 2 <= width:
        part = np.minimum(part[:-done], part[done:])
        done *= 2
    return np.minimum(part[:n], part[width - done : width - done + n])


class Segments:
    """A text's words and its segments: fingerprints, first and last windows."""

    def __init__(self, text: str | bytes | None, window: int, gram: int):
        self.window = window
        self.words = text.split() if isinstance(text, bytes) else split_words(text)
        self.prints = self.first = self.last = np.empty(0, np.int64)
        if len(self.words) >= window:
            self.hashes = word_hashes().of(self.words)
            v = sliding_least(rolling(self.hashes, gram), window - gram + 1)
            cut = np.flatnonzero(v[1:] != v[:-1]) + 1
            self.first = np.concatenate([[0], cut])
            self.last = np.concatenate([cut - 1, [len(v) - 1]])
            self.prints = v[self.first].view(np.int64)
            self.joined = b" ".join(self.words)
            self.at = np.concatenate([[0], np.cumsum(np.fromiter(map(len, self.words), np.int64, len(self.words)) + 1)])

    def digest(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Digests of the words of windows first to last."""
        a, b = self.at[first].tolist(), (self.at[last + self.window] - 1).tolist()
        joined, make = self.joined, hashlib.blake2b
        raw = b"".join([make(joined[x:y], digest_size=8).digest() for x, y in zip(a, b)])
        return np.frombuffer(raw, "<i8")

    def digests(self) -> np.ndarray:
        return self.digest(self.first, self.last) if len(self.first) else np.empty(0, np.int64)

    def window_hashes(self) -> np.ndarray:
        return rolling(self.hashes, self.window).view(np.int64)


class FingerprintIndex:
    """Runs of (print, digest, owner), each written once; see the module's text."""

    def __init__(self, spark: SparkSession, window: int = WINDOW, gram: int = GRAM, fanout: int = FANOUT):
        ship(spark)
        self.spark, self.window, self.gram, self.fanout = spark, window, gram, fanout
        self.runs: list[tuple[int, DataFrame]] = []
        self.hits: list[DataFrame] = []
        self.names: list[str] = []

    def _occurrences(self, batch: DataFrame) -> DataFrame:
        window, gram = self.window, self.gram

        def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in text_batches(frames):
                docs, prints, digests = [], [], []
                for doc, text in zip(frame["doc_id"], frame["text"]):
                    s = Segments(text, window, gram)
                    if len(s.prints):
                        docs.append(np.full(len(s.prints), doc, np.int64))
                        prints.append(s.prints)
                        digests.append(s.digests())
                if docs:
                    yield pd.DataFrame(
                        {"print": np.concatenate(prints), "digest": np.concatenate(digests), "doc_id": np.concatenate(docs)}
                    )

        return batch.select("doc_id", "text").mapInPandas(work, "print long, digest long, doc_id long")

    def _write_run(self, rows: DataFrame, level: int) -> None:
        """A run is a table bucketed and sorted by its key, so that later joins move the new batch only."""
        name, n = f"run_{uuid.uuid4().hex}", int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        ordered = rows.select("print", "digest", "owner").repartition(n, "print", "digest")
        writer = ordered.write.bucketBy(n, "print", "digest").sortBy("print", "digest")
        writer.option("path", scratch(self.spark, f"run-{level}")).saveAsTable(name)
        self.runs.append((level, self.spark.table(name)))
        self.names.append(name)

    def close(self) -> None:
        """Take the runs out of the session's catalog, which bucketed tables need. Their data stay in the shared folder."""
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.runs, self.names = [], []

    def add(self, batch: DataFrame) -> None:
        """Look a batch (doc_id, text) up in all runs, note its hits, and add it as a run.

        Every document of the batch must have a larger id than all before.
        """
        found = materialise(self._occurrences(batch), "occurrences")
        own = found.groupBy("print", "digest").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("latest"), F.count(F.lit(1)).alias("n"))
        merged, before = own, [F.lit(None).cast("long")]
        for i, (_, run) in enumerate(self.runs):
            run = run.select("print", "digest", F.col("owner").alias(f"before{i}"))
            merged = merged.join(run.hint("merge"), ["print", "digest"], "left")
            before.append(F.col(f"before{i}"))
        # a segment is in one run only: the batch that added it was joined with all before
        merged = merged.select("print", "digest", "owner", "latest", "n", F.coalesce(*before).alias("before"))
        merged = materialise(merged, "merged")
        # hits: the segment's words already stand in an earlier document
        first = merged.withColumn("owner", F.coalesce("before", "owner")).where("owner < latest").select("print", "digest", "owner", "n")
        # a passage that very many documents share is broadcast with its owner: its places stay where they are
        hits = join_by_key(found, materialise(first, "first-segments"), ["print", "digest"], "n").where("owner < doc_id")
        self.hits.append(materialise(hits.select("doc_id", "digest"), "hits"))
        self._write_run(merged.where("before is null"), 0)
        self.compact()

    def compact(self) -> None:
        """Merge the runs of a level into one of the next wherever there are ``fanout`` of them."""
        level = 0
        while sum(x == level for x, _ in self.runs) >= self.fanout:
            merged = None
            for x, run in self.runs:
                if x == level:
                    merged = run if merged is None else merged.unionByName(run)
            self.runs = [r for r in self.runs if r[0] != level]
            self._write_run(merged, level + 1)
            level += 1

    def window_hits(self, corpus: DataFrame) -> DataFrame:
        """(doc_id, window) of windows that stand in an earlier document with other words around them.

        corpus: packed documents (doc_id, packed), all that the index has seen.
        """
        window, gram = self.window, self.gram
        rows = None
        for _, run in self.runs:
            rows = run if rows is None else rows.unionByName(run)
        several = rows.groupBy("print").agg(F.min("digest").alias("a"), F.max("digest").alias("b"), F.count(F.lit(1)).alias("n"))
        several = materialise(several.where("a <> b").select("print", "n"), "several")
        wanted = join_by_key(rows, several, ["print"], "n").groupBy(F.col("owner").alias("doc_id")).agg(F.collect_set("digest").alias("digests"))

        def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            unpack = zstandard.ZstdDecompressor().decompress
            for frame in frames:
                out, size = [], 0
                for doc, packed, digests in zip(frame["doc_id"], frame["packed"], frame["digests"]):
                    s = Segments(unpack(packed), window, gram)
                    if not len(s.first):
                        continue  # another row of a repeated doc_id
                    chosen = np.isin(s.digests(), np.asarray(digests, np.int64))
                    at = np.flatnonzero(np.repeat(chosen, s.last - s.first + 1))
                    if len(at):
                        found = s.window_hashes()[at]
                        at = at[np.unique(found, return_index=True)[1]]  # a window that a document repeats counts once
                        out.append(pd.DataFrame({"window": s.window_hashes()[at], "check": s.digest(at, at), "doc_id": doc}))
                        size += len(at)
                    if size > 200_000:
                        yield pd.concat(out)
                        out, size = [], 0
                if out:
                    yield pd.concat(out)

        windows = corpus.join(wanted, "doc_id").mapInPandas(work, "window long, check long, doc_id long")
        windows = materialise(windows, "windows")
        first = windows.groupBy("window", "check").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n"))
        first = materialise(first.where("n > 1"), "first-windows")
        return join_by_key(windows, first, ["window", "check"], "n").where("doc_id > least").select("doc_id", "window")


def dedup(docs: DataFrame, window: int = WINDOW, batches: int = 3, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_removed, kept (remaining words joined by single spaces) of every document.

    The corpus enters the index in ``batches`` batches of ascending doc_id, as it would arrive over time.
    """
    spark = docs.sparkSession
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc_id"), "text")
    marks = [i / batches for i in range(1, batches)]
    cuts = docs.agg(F.percentile_approx("doc_id", marks).alias("c")).first()["c"] if marks else []
    edges = [None, *sorted(set(cuts or [])), None]
    index = FingerprintIndex(spark, window, gram)
    for low, high in zip(edges[:-1], edges[1:]):
        part = docs
        if low is not None:
            part = part.where(F.col("doc_id") > low)
        if high is not None:
            part = part.where(F.col("doc_id") <= high)
        index.add(part)
    found = index.window_hits(packed(docs)).groupBy("doc_id").agg(F.collect_set("window").alias("windows"))
    found = materialise(found, "window-hits")
    index.close()
    hits = index.hits[0]
    for x in index.hits[1:]:
        hits = hits.unionByName(x)
    hits = hits.groupBy("doc_id").agg(F.collect_set("digest").alias("digests"))
    spans = hits.join(found, "doc_id", "full")

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack = zstandard.ZstdDecompressor().decompress
        for frame in frames:
            rows = []
            for doc, data, digests, windows in zip(frame["doc_id"], frame["packed"], frame["digests"], frame["windows"]):
                text = unpack(data)
                if digests is None and windows is None:
                    words = text.split()
                    rows.append((doc, len(words), 0, b" ".join(words)))
                    continue
                s = Segments(text, window, gram)
                n = len(s.words)
                hit = np.zeros(max(0, n - window + 1), bool)
                if digests is not None and len(hit):
                    hit |= np.repeat(np.isin(s.digests(), np.asarray(digests, np.int64)), s.last - s.first + 1)
                if windows is not None and len(hit):
                    hit |= np.isin(s.window_hashes(), np.asarray(windows, np.int64))
                step = np.zeros(n + 1, np.int64)
                at = np.flatnonzero(hit)
                step[at] += 1
                step[at + window] -= 1
                gone = np.cumsum(step)[:n] > 0
                kept = [s.words[i] for i in np.flatnonzero(~gone).tolist()]
                rows.append((doc, n, int(gone.sum()), b" ".join(kept)))
            yield pd.DataFrame(rows, columns=["doc_id", "n_words", "n_removed", "kept"])

    result = packed(docs).join(spans, "doc_id", "left").mapInPandas(
        work, "doc_id long, n_words long, n_removed long, kept binary"
    )
    return result.select(F.nullif("doc_id", F.lit(LAST)).alias("doc_id"), "n_words", "n_removed", F.col("kept").cast("string").alias("kept"))

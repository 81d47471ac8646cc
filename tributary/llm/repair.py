"""Token ids stored by Re-Pair grammar compression.

Documents are range-partitioned by id; each partition cuts its documents, in order, into shards of about
``SHARD_IDS`` ids. In each shard the most frequent pairs of neighbouring ids are replaced by nonterminals,
round after round, until no pair is frequent enough. A shard stores its rules, the expansion length of each
rule and where each document starts among the symbols, so that any document, or any range of ids in it,
is decoded alone. Pairs never cross the end of a document.

The files are Parquet tables of shards, written by Spark's committer into a folder that executors share;
``payload`` holds the shard in the format of ``pack``. Each document's place among all ids comes from
totals of partitions (one row each), never from a global sort in one task.

Cases: null and empty texts hold just the end id; a null doc_id sorts first; repeated rows are stored
each; a document longer than a shard has a shard of its own; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tributary.llm.common import TableEncoder, gather, library_encoder, text_batches
from tributary.session import ship

#: Ids that a shard holds at least before the next one begins.
SHARD_IDS = 1 << 19
#: A pair is replaced if it occurs so often; each round replaces at most so many different pairs.
MIN_COUNT = 10
RULES_A_ROUND = 4096
SLOT_BITS = 19
SLOTS = 1 << SLOT_BITS
MAGIC = b"RPG1"


def frequent(a: np.ndarray, last: np.ndarray, min_count: int, fresh: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The pairs that occur min_count times without overlapping themselves: positions, each position's pair as an
    index, the pairs and their counts. Counts are exact; the hashed count only sets aside slots that can't hold such a pair.
    ``fresh``: where to look, all places of a pair or none of them."""
    inside = ~last[:-1]
    if fresh is not None:
        inside &= fresh[:-1]
    equal = np.flatnonzero((a[:-1] == a[1:]) & inside)
    if len(equal):
        # In a run of one symbol every other pair counts.
        start = np.flatnonzero(np.diff(equal, prepend=-2) != 1)
        nth = np.arange(len(equal)) - np.repeat(start, np.diff(np.append(start, len(equal))))
        inside[equal[nth % 2 == 1]] = False
    at = np.flatnonzero(inside)
    pairs = (a[at].astype(np.uint64) << np.uint64(32)) | a[at + 1]
    slot = ((pairs * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
    often = np.flatnonzero((np.bincount(slot, minlength=SLOTS) >= min_count).take(slot))
    at, pairs = at[often], pairs[often]
    names, which, counts = np.unique(pairs, return_inverse=True, return_counts=True)
    good = counts >= min_count
    number = np.cumsum(good) - 1
    stay = good[which]
    return at[stay], number[which[stay]], names[good], counts[good]


def compress(ids: np.ndarray, ends: np.ndarray, first: int, min_count: int = MIN_COUNT):
    """Replace frequent pairs by nonterminals first, first + 1, ... until none is left.

    ends: for each document the position after its last id. Returns symbols, each document's end among
    them, the rules' left and right symbols, and the number of rules of each round.
    """
    min_count = max(2, min_count)
    a = ids.astype(np.uint32)
    last = np.zeros(len(a), bool)
    last[ends[ends > 0] - 1] = True
    left: list[np.ndarray] = []
    right: list[np.ndarray] = []
    top = first
    fresh = None
    while len(a) > 1:
        every, pair, names, counts = frequent(a, last, min_count, fresh)
        if not len(names):
            break
        order = np.argsort(-counts, kind="stable")
        # Pairs that overlap can leave each other too few places: then the most frequent one goes alone.
        for most in (RULES_A_ROUND, 1):
            wanted = np.zeros(len(names), bool)
            wanted[order[:most]] = True
            chosen = wanted[pair]
            at, which = every[chosen], pair[chosen]
            # Of overlapping occurrences in a row, every other one from the first is replaced.
            start = np.flatnonzero(np.diff(at, prepend=-2) != 1)
            inside = np.arange(len(at)) - np.repeat(start, np.diff(np.append(start, len(at))))
            at, which = at[inside % 2 == 0], which[inside % 2 == 0]
            used = np.bincount(which, minlength=len(names)) >= max(2, min_count // 2)
            if used.any():
                break
        at, which = at[used[which]], which[used[which]]
        rules = names[used]
        left.append(rules >> np.uint64(32))
        right.append(rules & np.uint64(0xFFFFFFFF))
        a[at] = (np.cumsum(used) - 1 + top)[which]
        last[at] = last[at + 1]
        stay = np.ones(len(a), bool)
        stay[at + 1] = False
        # Only a pair that was frequent, or has a new symbol, can be frequent in the next round; of a run of one symbol, any place can count then.
        fresh = np.zeros(len(a), bool)
        fresh[every] = True
        fresh[:-1] |= a[:-1] == a[1:]
        a, last, fresh = a[stay], last[stay], fresh[stay]
        new = a >= top
        fresh |= new
        fresh[:-1] |= new[1:]
        top += len(rules)
    cat = lambda x: np.concatenate(x).astype("<u4") if x else np.empty(0, "<u4")
    waves = np.array([len(x) for x in left], "<u4")
    return a, np.flatnonzero(last) + 1, cat(left), cat(right), waves


def expansion_lengths(left: np.ndarray, right: np.ndarray, waves: np.ndarray, first: int) -> np.ndarray:
    lengths = np.ones(first + len(left), np.int64)
    a = 0
    for n in waves.tolist():
        lengths[first + a : first + a + n] = lengths[left[a : a + n]] + lengths[right[a : a + n]]
        a += n
    return lengths


def expansions(left, right, waves, lengths: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
    """All symbols' expansions in one array, and where each starts; terminals stand for themselves."""
    starts = np.concatenate([np.arange(first), first + np.cumsum(lengths[first:]) - lengths[first:]]).astype(np.int64)
    flat = np.empty(first + int(lengths[first:].sum()), "<u4")
    flat[:first] = np.arange(first)
    a = 0
    for n in waves.tolist():
        both = np.stack([left[a : a + n], right[a : a + n]], 1).ravel().astype(np.int64)
        got = flat[gather(starts[both], lengths[both])]
        at = int(starts[first + a]) if n else 0
        flat[at : at + len(got)] = got
        a += n
    return flat, starts


class Shard:
    """A stored shard: decodes any document, or a range of its ids."""

    def __init__(self, payload: bytes):
        magic, docs, rules, waves, symbols, first = struct.unpack_from("<4sIIIIq", payload)
        if magic != MAGIC:
            raise ValueError("not a shard")
        at = struct.calcsize("<4sIIIIq")

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(payload, kind, n, at)
            at += out.nbytes
            return out

        self.doc_ids, self.known = take("<i8", docs), take("u1", docs)
        self.counts, self.ends = take("<u4", docs), take("<u4", docs)
        self.left, self.right, self.lengths = take("<u4", rules), take("<u4", rules), take("<u4", rules)
        self.waves = take("<u4", waves)
        small = first + rules <= 1 << 16
        self.symbols = take("<u2" if small else "<u4", symbols)
        self.sizes = np.concatenate([np.ones(first, np.int64), self.lengths.astype(np.int64)])
        self.flat, self.starts = expansions(self.left, self.right, self.waves, self.sizes, first)

    def document(self, i: int) -> np.ndarray:
        return self.ids(self.ends[i - 1] if i else 0, self.ends[i])

    def ids(self, a: int, b: int) -> np.ndarray:
        """The ids of symbols a to b."""
        s = self.symbols[int(a) : int(b)].astype(np.int64)
        return self.flat[gather(self.starts[s], self.sizes[s])]

    def span(self, i: int, start: int, stop: int) -> np.ndarray:
        """Ids start to stop of document i: only symbols that overlap them are expanded."""
        a = int(self.ends[i - 1]) if i else 0
        reach = np.cumsum(self.sizes[self.symbols[a : int(self.ends[i])].astype(np.int64)])
        x = int(np.searchsorted(reach, start, "right"))
        y = int(np.searchsorted(reach, stop, "left")) + 1
        before = int(reach[x - 1]) if x else 0
        return self.ids(a + x, a + y)[start - before : stop - before]


def pack(doc_ids: list, counts: np.ndarray, ids: np.ndarray, first: int) -> bytes:
    """One shard in stored form."""
    symbols, ends, left, right, waves = compress(ids, np.cumsum(counts), first)
    lengths = expansion_lengths(left, right, waves, first)[first:]
    known = np.array([x is not None for x in doc_ids], "u1")
    numbers = np.array([0 if x is None else x for x in doc_ids], "<i8")
    kind = "<u2" if first + len(left) <= 1 << 16 else "<u4"
    parts = [numbers, known, counts.astype("<u4"), ends.astype("<u4"), left, right, lengths.astype("<u4"), waves, symbols.astype(kind)]
    head = struct.pack("<4sIIIIq", MAGIC, len(doc_ids), len(left), len(waves), len(symbols), first)
    return head + b"".join(x.tobytes() for x in parts)


def write(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0, first: int = 50257) -> None:
    """Encode every whole text, append end_id, and store all in ascending doc_id order under path.

    first: the size of the vocabulary, where nonterminals begin.
    """
    ship(docs.sparkSession)

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = library_encoder(tokenizer_path, TableEncoder)
        part, number, inside = TaskContext.get().partitionId(), 0, 0
        names: list = []
        counts: list[np.ndarray] = []
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pd.DataFrame:
            nonlocal names, counts, held, size, number, inside
            payload = pack(names, np.concatenate(counts), np.concatenate(held), first)
            row = pd.DataFrame({"part": [part], "shard": [number], "inside": [inside], "n_ids": [size], "payload": [payload]})
            inside += size
            names, counts, held, size, number = [], [], [], 0, number + 1
            return row

        for frame in text_batches(frames):
            ids, n = encoder.encode(list(frame["text"]))
            ids = np.insert(ids, np.cumsum(n), end_id)
            names += [None if pd.isna(x) else int(x) for x in frame["doc_id"]]
            counts.append(n + 1)
            held.append(ids)
            size += len(ids)
            if size >= SHARD_IDS:
                yield flush()
        if names:
            yield flush()

    # Ids pass as text: pandas would turn longs beside nulls into floats.
    (
        docs.select(F.col("doc_id").cast("long"), F.col("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id")
        .select(F.col("doc_id").cast("string"), "text")
        .mapInPandas(work, "part int, shard int, inside long, n_ids long, payload binary")
        .write.parquet(path)
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, ids (little-endian unsigned 32-bit integers) of all stored documents."""
    ship(spark)
    stored = spark.read.schema("part int, shard int, inside long, n_ids long, payload binary").parquet(path)

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for offset, payload in zip(frame["offset"], frame["payload"]):
                shard = Shard(payload)
                ids = shard.ids(0, len(shard.symbols)).tobytes()
                edge = np.concatenate([[0], np.cumsum(shard.counts.astype(np.int64))])
                names = pd.array(shard.doc_ids, dtype="Int64")
                names[shard.known == 0] = pd.NA
                # whole shards are decoded in pieces of a bounded number of rows
                for a in range(0, len(names), 2000):
                    b = min(a + 2000, len(names))
                    cuts = zip(edge[a:b].tolist(), edge[a + 1 : b + 1].tolist())
                    yield pd.DataFrame(
                        {"doc_id": names[a:b], "start": offset + edge[a:b], "ids": [ids[4 * x : 4 * y] for x, y in cuts]}
                    )

    # Offsets of the parts: one row for each task that wrote, which is what bounds the broadcast.
    parts = stored.groupBy("part").agg(F.sum("n_ids").alias("n"))
    ahead = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("part", F.coalesce(ahead, F.lit(0)).alias("ahead"))
    return (
        stored.select("part", "inside", "payload")
        .join(F.broadcast(parts), "part")
        .select((F.col("inside") + F.col("ahead")).alias("offset"), "payload")
        .mapInPandas(work, "doc_id long, start long, ids binary")
    )

"""Packing token ids into sequences of at most ``WINDOW`` ids, by non-negative least squares.

Every document is encoded once. Its full windows become sequences of their own; what is left over is a
piece shorter than the window. The histogram of those pieces' lengths (at most WINDOW - 1 counts, however
large the corpus) is all that the driver sees: it enumerates combinations of two and three lengths that fill
a window, solves for how often to use each so that the histogram is met (non-negative least squares), rounds
to whole numbers that the histogram can serve, and leaves the rest as residuals. Residual pieces are packed greedily: laid end to end, longest first,
and cut where a window is full, so that only the very last sequence may need padding.

A piece's place follows by arithmetic from its rank among the pieces of its length; ranks come from
counts of (shard, length), so that no task sees all pieces of one length.

Cases: null and empty texts hold just the end id; repeated and null doc_ids are separate rows, each
packed; a text of any length is cut into windows; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import library_encoder, map_rows, text_batches
from tributary.session import scratch, ship

WINDOW = 1024
#: Each round of the solver adds so many of the combinations that promise most, and then sweeps over those it has.
ADDED = 128
ROUNDS, SWEEPS = 60, 12


def combinations(histogram: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """All combinations of two and three lengths that occur and fill a window, longest first; 0 in the third place of pairs."""
    there = np.flatnonzero(histogram)
    has = np.zeros(window + 1, bool)
    has[there] = True
    has[0] = True  # nothing as a third piece
    a, b = np.meshgrid(there, there, indexing="ij")
    a, b = a.ravel(), b.ravel()
    c = window - a - b
    good = (a >= b) & (b >= c) & (c >= 0)
    good[good] = has[c[good]]
    return np.stack([a[good], b[good], c[good]], 1)


def least_squares(columns: np.ndarray, histogram: np.ndarray) -> np.ndarray:
    """Non-negative repeat counts x of all columns that minimise the squared error of the histogram.

    Coordinate descent over a growing set: each round adds the columns along which the error falls most, found
    over all of them at once, and ends when along none it falls.
    """
    x = np.zeros(len(columns))
    rest = histogram.astype(float)
    rest[0] = 0
    active: dict[int, list[tuple[int, int]]] = {}
    for _ in range(ROUNDS):
        gain = rest[columns].sum(1)  # length 0 never has any
        gain[list(active)] = 0
        best = np.argsort(-gain, kind="stable")[:ADDED]
        best = best[gain[best] > 0.5]
        if not len(best) and active:
            break
        for i in best.tolist():
            lengths, n = np.unique(columns[i][columns[i] > 0], return_counts=True)
            active[i] = list(zip(lengths.tolist(), n.tolist()))
        left, value = rest.tolist(), {i: float(x[i]) for i in active}
        for _ in range(SWEEPS):
            moved = 0.0
            for i, terms in active.items():
                step = sum(left[length] * n for length, n in terms) / sum(n * n for _, n in terms)
                step = max(step, -value[i])
                if step:
                    value[i] += step
                    for length, n in terms:
                        left[length] -= step * n
                    moved = max(moved, abs(step))
            if moved < 0.05:
                break
        rest = np.array(left)
        for i, v in value.items():
            x[i] = v
    return x


def plan(histogram: np.ndarray, window: int = WINDOW) -> tuple[list[tuple[tuple[int, ...], int]], np.ndarray]:
    """Combinations with how often to use each, and how many pieces of each length they take."""
    columns = combinations(histogram, window)
    x = least_squares(columns, histogram)
    left = histogram.astype(np.int64).copy()
    chosen = []
    for i in np.argsort(-x, kind="stable"):  # rounded, never more than there are
        if x[i] < 0.5:
            break
        lengths, n = np.unique(columns[i][columns[i] > 0], return_counts=True)
        times = int(min(round(x[i]), (left[lengths] // n).min()))
        if times > 0:
            chosen.append((tuple(columns[i][columns[i] > 0].tolist()), times))
            left[lengths] -= times * n
    return chosen, histogram - left


def encoded(docs: DataFrame, tokenizer_path: str, end_id: int, window: int) -> DataFrame:
    """One row per document: row (a number of its own), shard, doc_id, n, rest, ranks inside the shard, ids."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = library_encoder(tokenizer_path)
        shard = TaskContext.get().partitionId()
        seen = np.zeros(window, np.int64)
        number = full = 0
        for frame in text_batches(frames):
            ids, n = encoder.encode(list(frame["text"]))
            ids = np.insert(ids, np.cumsum(n), end_id)
            n = n + 1
            edge = np.concatenate([[0], np.cumsum(n)])
            rest = n % window
            rank = np.empty(len(n), np.int64)
            for i, r in enumerate(rest.tolist()):
                rank[i] = seen[r]
                seen[r] += 1
            fulls = n // window
            kind = "<u2" if len(ids) == 0 or ids.max() < 1 << 16 else "<u4"
            yield pd.DataFrame(
                {
                    "row": (shard << 33) + number + np.arange(len(n)),
                    "shard": shard,
                    "doc_id": frame["doc_id"].to_numpy(),
                    "n": n,
                    "rest": rest,
                    "rank": rank,
                    "full": full + np.cumsum(fulls) - fulls,
                    "wide": kind == "<u4",
                    "ids": [ids[a:b].astype(kind).tobytes() for a, b in zip(edge[:-1], edge[1:])],
                }
            )
            number += len(n)
            full += int(fulls.sum())

    return map_rows(
        docs.select("doc_id", "text"), work, "row long, shard int, doc_id long, n long, rest int, rank long, full long, wide boolean, ids binary"
    )


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 0, window: int = WINDOW) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids (little-endian unsigned 32-bit)."""
    spark = docs.sparkSession
    ship(spark)
    path = scratch(spark, "packing")
    encoded(docs, tokenizer_path, end_id, window).write.option("compression", "zstd").parquet(path)
    stored = spark.read.parquet(path)
    counts = stored.groupBy("shard", "rest").agg(F.count(F.lit(1)).alias("c"))
    before = Window.partitionBy("rest").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    ranks = counts.where("rest > 0").withColumn("ahead", F.coalesce(F.sum("c").over(before), F.lit(0))).drop("c")
    fulls = stored.groupBy("shard").agg(F.sum(F.expr(f"n div {window}")).alias("c"))
    ahead = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard
    fulls = fulls.withColumn("full_ahead", F.coalesce(F.sum("c").over(ahead), F.lit(0)))

    histogram = np.zeros(window, np.int64)  # at most window counts reach the driver
    for r in counts.where("rest > 0").groupBy("rest").agg(F.sum("c").alias("c")).collect():
        histogram[r["rest"]] = r["c"]
    n_full = fulls.agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    chosen, taken = plan(histogram, window)

    # Slots: pieces of a length with ranks from ``first`` on go to sequences from ``base`` on.
    slots: dict[int, list[tuple[int, int, int]]] = {}
    used = np.zeros(window, np.int64)
    sequence = int(n_full)
    for lengths, times in chosen:
        offset = 0
        for length in lengths:
            slots.setdefault(length, []).append((int(used[length]), sequence, offset))
            used[length] += times
            offset += length
        sequence += times
    # Residuals lie end to end, longest first; a length's first one begins at ``at``.
    left = histogram - taken
    sizes = (left * np.arange(window))[::-1]
    at = (np.cumsum(sizes) - sizes)[::-1]
    tail = sequence
    tables = {r: (np.array(s, np.int64)) for r, s in slots.items()}

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Pieces of each document as parallel lists."""
        for frame in frames:
            out = []
            for row, n, rest, rank, full in zip(frame["row"], frame["n"], frame["rest"], frame["rank"], frame["full"]):
                whole = n // window
                starts = [i * window for i in range(whole)]
                lengths = [window] * whole
                sequences = [full + i for i in range(whole)]
                offsets = [0] * whole
                if rest and rank < taken[rest]:
                    table = tables[rest]
                    first, base, offset = table[np.searchsorted(table[:, 0], rank, "right") - 1].tolist()
                    starts.append(whole * window), lengths.append(rest)
                    sequences.append(base + rank - first), offsets.append(offset)
                elif rest:
                    where = int(at[rest] + (rank - taken[rest]) * rest)
                    begin = whole * window
                    while rest:
                        length = min(rest, window - where % window)
                        starts.append(begin), lengths.append(length)
                        sequences.append(tail + where // window), offsets.append(where % window)
                        begin, where, rest = begin + length, where + length, rest - length
                out.append((row, starts, lengths, sequences, offsets))
            yield pd.DataFrame(out, columns=["row", "starts", "lengths", "sequences", "offsets"])

    places = (
        stored.select("row", "shard", "n", "rest", "rank", "full")
        .join(ranks, ["shard", "rest"], "left")
        .join(fulls.select("shard", "full_ahead"), "shard")
        .select(
            "row",
            "n",
            "rest",
            (F.col("rank") + F.coalesce("ahead", F.lit(0))).alias("rank"),
            (F.col("full") + F.col("full_ahead")).alias("full"),
        )
        .mapInPandas(place, "row long, starts array<long>, lengths array<long>, sequences array<long>, offsets array<long>")
    )

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for doc, n, wide, ids, starts, lengths, sequences, offsets in frame[
                ["doc_id", "n", "wide", "ids", "starts", "lengths", "sequences", "offsets"]
            ].itertuples(index=False):
                array = np.frombuffer(ids, "<u4" if wide else "<u2").astype("<u4", copy=False)
                for a, k, s, o in zip(starts, lengths, sequences, offsets):
                    rows.append((doc, a, k, n, s, o, array[a : a + k].tobytes()))
            yield pd.DataFrame(rows, columns=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

    return map_rows(
        stored.select("row", "doc_id", "n", "wide", "ids").join(places, "row").drop("row"),
        cut,
        "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary",
    )

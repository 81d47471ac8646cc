"""Filter interaction audit by the Hart-Mas-Colell potential.

Five filters, each a failure condition on a whole text, make a game: the worth of a coalition of filters is the number of
documents that at least one of them removes. A document is reduced to the set of filters it fails (5 bits), so the games of
a part (a value of ``lang``) are played on at most 32 counts, whatever the part's size. Potentials of all 32 coalitions follow
recursively, P(S) = (v(S) + sum of P(S without i)) / |S|; a filter's Shapley value is P(all) - P(all without it); the steps of an
order are differences of coalitions' worths. Potentials are kept 120-fold, which makes all of them integers.

Filters: A under 200 words; B fewer than half of the words distinct; C more than 3 % of the code points are A-Z; D holds one
of ``#$%&*|``; E the text is that of a smaller doc_id, anywhere in the table, removed or not.

Cases: a null text is empty (fails A only, and E if it is repeated); a null lang is the part ''; a null doc_id is neither smaller nor larger
than another, so E passes it and it makes no other row fail; rows that repeat a doc_id with the same text do not fail E by each other; labels
with several rows of a document count with their largest values, null ones as 0; an empty table has no parts and no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import join_by_key, only, utf8
from tributary.session import materialise, ship

#: The filters' names, the least number of words and the characters of D.
FILTERS = "ABCDE"
LEAST_WORDS = 200
MARKS = b"#$%&*|"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"

ALL = (1 << len(FILTERS)) - 1
E_BIT = 1 << FILTERS.index("E")
COUNTS = ("documents", "good", "toxic")
COLUMNS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def fails(text: str | None) -> int:
    """The filters that a text fails by itself, as bits."""
    raw = utf8(text)
    words = raw.split()
    capitals = len(raw) - len(raw.translate(None, CAPITALS))
    return (
        (len(words) < LEAST_WORDS)
        | (100 * len(set(words)) < 50 * len(words)) << 1
        | (100 * capitals > 3 * len(text or "")) << 2
        | (len(raw.translate(None, MARKS)) < len(raw)) << 3
    )


def _reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id and part as they are, the failed filters and the text's digest."""
    for batch in batches:
        masks, digests = [], []
        for value in batch.column("text"):
            text = value.as_py()
            masks.append(fails(text))
            digests.append(hashlib.sha256(utf8(text)).digest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("part"), pa.array(masks, pa.int32()), pa.array(digests, pa.binary())],
            ["doc_id", "part", "mask", "digest"],
        )


def reduced(docs: DataFrame) -> DataFrame:
    """doc_id, part, mask (filters A to D) and digest of every row, written once."""
    ship(docs.sparkSession)
    docs = only(docs, "doc_id", "lang", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"), "text")
    return materialise(docs.mapInArrow(_reduce, "doc_id long, part string, mask int, digest binary"), "audit")


def repeats(rows: DataFrame) -> DataFrame:
    """The rows whose text a smaller doc_id has."""
    firsts = materialise(
        rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null"), "firsts"
    )
    return join_by_key(rows, firsts, ["digest"], "n").where("doc_id > first").select(*rows.columns)


def labelled(labels: DataFrame) -> DataFrame:
    """One row per labelled document: doc_id, good, toxic (0 or 1)."""
    one = lambda c: F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0)).alias(c)
    return (
        only(labels, "doc_id", "quality", "toxic").where("doc_id is not null").groupBy("doc_id").agg(one("quality"), one("toxic"))
        .where("quality = 1 or toxic = 1").withColumnRenamed("quality", "good")
    )


def histogram(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask (all five filters) and how many documents, good and toxic ones it has: at most 32 rows a part."""
    rows = reduced(docs)
    again = repeats(rows)
    labels = labelled(labels)
    plain = [F.lit(1).alias("documents"), F.lit(0).alias("good"), F.lit(0).alias("toxic")]
    marked = [F.lit(0).alias("documents"), "good", "toxic"]

    def counted(rows: DataFrame, sign: int, mask) -> DataFrame:
        # Inner joins only: ids without a label, null ones among them, stay where they are.
        every = rows.select("part", "mask", *plain).unionByName(rows.join(labels, "doc_id").select("part", "mask", *marked))
        return every.groupBy("part", mask.alias("mask")).agg(*[(sign * F.sum(c)).alias(c) for c in COUNTS])

    mask = F.col("mask")
    parts = counted(rows, 1, mask), counted(again, -1, mask), counted(again, 1, mask.bitwiseOR(F.lit(E_BIT)))
    total = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return total.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in COUNTS])


def worths(counts: list[int]) -> list[int]:
    """For each coalition, how many documents fail one of its filters; counts are by failed filters."""
    total = sum(counts)
    return [total - sum(n for mask, n in enumerate(counts) if not mask & s) for s in range(ALL + 1)]


def potentials(worth: list[int]) -> list[int]:
    """120-fold potentials of all coalitions."""
    out = [0] * (ALL + 1)
    for s in range(1, ALL + 1):
        members = [i for i in range(len(FILTERS)) if s >> i & 1]
        out[s] = (120 * worth[s] + sum(out[s ^ 1 << i] for i in members)) // len(members)
    return out


def steps(part: str, counts: dict[str, list[int]]) -> list[tuple]:
    """All steps of all orders of one part."""
    worth, good, toxic = (worths(counts[c]) for c in COUNTS)
    potential = potentials(worth)
    shapley = [potential[ALL] - potential[ALL ^ 1 << i] for i in range(len(FILTERS))]
    failing = [sum(n for mask, n in enumerate(counts["documents"]) if mask >> i & 1) for i in range(len(FILTERS))]
    total, rows = sum(counts["documents"]), []
    for order in permutations(range(len(FILTERS))):
        name, before = "".join(FILTERS[i] for i in order), 0
        for step, i in enumerate(order, 1):
            after = before | 1 << i
            removed = worth[after] - worth[before]
            rows.append(
                (part, name, step, total - worth[after], removed, failing[i] - removed, counts["documents"][1 << i],
                 good[after] - good[before], toxic[after] - toxic[before], shapley[i])
            )
            before = after
    return rows


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley: 600 rows a part."""
    cells = F.transform(
        F.sequence(F.lit(0), F.lit(ALL)),
        lambda m: F.coalesce(F.element_at("by_mask", m), F.struct(*[F.lit(0).cast("long").alias(c) for c in COUNTS])),
    )
    # A group has one row per set of failed filters: 32 at most.
    entries = F.collect_list(F.struct("mask", F.struct(*[F.col(c).cast("long").alias(c) for c in COUNTS]).alias("n")))
    games = histogram(docs, labels).groupBy("part").agg(F.map_from_entries(entries).alias("by_mask"))
    games = games.select("part", *[cells[c].alias(c) for c in COUNTS])

    def play(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.to_dict("records"):
                found = steps(row["part"], {c: [int(x) for x in row[c]] for c in COUNTS})
                yield pd.DataFrame(found, columns=["part", "filter_order", "step", *COLUMNS])

    return games.mapInPandas(play, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COLUMNS))

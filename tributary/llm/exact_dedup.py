"""Exact dedup by skew-safe combining, in DataFrame operations only.

Texts are grouped by digest and full content. Copies first combine inside each map task (partial
aggregation), then among groups of (digest, salt, text), then the winners of the salts of one digest
combine. Only digests that hold a measurable share of all rows are salted; there can be at most
``HOT_MOST`` of them whatever the input's size, so that they may be broadcast.

Cases: null text counts as empty; empty texts equal each other; a null doc_id loses to any other; where
every doc_id of a group is null, keep_id is null and no row is marked kept (``keep`` returns one if asked); rows
that repeat the winning doc_id are all marked kept (``keep`` returns one of them); an empty table gives an empty result; further columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import text_or_empty

#: At most so many digests are salted: those of at least this fraction of all rows.
HOT_MOST = 512
SALTS = 64


def _salted(rows: DataFrame) -> DataFrame:
    """rows (doc_id, text, ...) with digest, is_hot and salt."""
    rows = rows.withColumn("text_sha256", F.sha2("text", 256)).withColumn("digest", F.unhex("text_sha256"))
    counts = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    # Digests of at least total / HOT_MOST rows: no more than HOT_MOST can exist, so their broadcast is bounded.
    hot = (
        counts.join(F.broadcast(total), (F.col("n") > 1) & (F.col("n") * HOT_MOST >= F.col("total")))
        .select("digest", F.lit(True).alias("is_hot"))
    )
    marked = (
        rows.join(F.broadcast(hot), "digest", "left")
        .withColumn("is_hot", F.coalesce("is_hot", F.lit(False)))
    )
    salt = F.when(F.col("is_hot"), F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).otherwise(F.lit(0))
    return marked.withColumn("salt", salt.cast("int"))


def groups_of_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    salted_rows = _salted(docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text_column).alias("text")))
    # Every stage groups and joins by the whole text. Local combining and the salted stage:
    place = ["digest", "salt", "text"]
    best = [F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")]
    winners = (
        salted_rows.where("is_hot")
        .groupBy(*place)
        .agg(*best)
        .groupBy("digest", "text")
        .agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))  # back to the salts: at most HOT_MOST digests
    )
    classes = salted_rows.where("not is_hot").groupBy(*place).agg(*best)  # lies where the join below wants it
    cold = salted_rows.where("not is_hot").join(classes, place)
    warm = salted_rows.where("is_hot").join(winners, place)
    return cold.unionByName(warm.select(*cold.columns)).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False)).alias("kept"),
        "text_sha256",
    )


def keep(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", without_id: bool = False) -> DataFrame:
    """One document of each text, with all its columns: the one with the largest id (without_id: where none has an id, one of those).

    The winning rows themselves combine, locally, by salt and over the salts, with one shuffle of the texts. Of rows that also share the
    id, a hash of their other columns decides.
    """
    others = [c for c in docs.columns if c != text_column]
    rest = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)], F.col(f"`{text_column}`").isNull().alias("blank"))
    order = F.struct(F.col(f"`{id_column}`").cast("long").alias("id"), F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in others]).alias("tie"))
    rows = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"), text_or_empty(f"`{text_column}`").alias("text"), rest.alias("rest"), order.alias("order")
    )
    best = [F.max_by("rest", "order").alias("rest"), F.max("order").alias("order")]
    salted = _salted(rows).groupBy("digest", "salt", "text", "is_hot").agg(*best)
    warm = salted.where("is_hot").groupBy("digest", "text").agg(*best)
    kept = salted.where("not is_hot").select("text", "rest", "order").unionByName(warm.select("text", "rest", "order"))
    if not without_id:
        kept = kept.where("order.id is not null")
    text = F.when(~F.col("rest.blank"), F.col("text"))
    return kept.select(*[(text if c == text_column else F.col(f"rest.c{others.index(c)}")).alias(c) for c in docs.columns])

"""The record model: fixed identity columns and attributes as a map, ordered by ``ordinal``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions.scalars import is_missing

IDENTITY = ("row_id", "ordinal", "source", "brand", "series", "year", "model")


def to_attrs(df: DataFrame, columns: list[str], name: str = "attrs", drop_missing: bool = True) -> DataFrame:
    """Fold columns into a map of strings."""
    pairs = F.array(*[F.struct(F.lit(c).alias("k"), F.col(f"`{c}`").cast("string").alias("v")) for c in columns])
    if drop_missing:
        pairs = F.filter(pairs, lambda p: ~is_missing(p["v"]))
    return df.withColumn(name, F.map_from_entries(pairs)).drop(*columns)


def from_attrs(df: DataFrame, columns: list[str], name: str = "attrs", missing: str | None = "-") -> DataFrame:
    """Unfold a map into the given columns, in their order."""
    def value(c: str) -> Column:
        v = F.element_at(name, F.lit(c))
        return F.coalesce(v, F.lit(missing)) if missing is not None else v

    return df.select(*[c for c in df.columns if c != name], *[value(c).alias(c) for c in columns])


def cells(df: DataFrame, key: str = "row_id", name: str = "attrs") -> DataFrame:
    """One row per cell: row key, attribute, value, and the attribute's position in its row."""
    return df.select(key, F.posexplode(F.map_entries(name)).alias("pos", "entry")).select(
        key, "pos", F.col("entry.key").alias("key"), F.col("entry.value").alias("value")
    )


def column_order(df: DataFrame, configured: list[str], name: str = "attrs") -> DataFrame:
    """All attribute names with their place: configured ones first, then by first appearance, then by name."""
    seen = cells(df.select("ordinal", name), "ordinal").groupBy("key").agg(F.min(F.struct("ordinal", "pos")).alias("first"))
    listed = F.array_position(F.array(*[F.lit(c) for c in configured]), F.col("key")) if configured else F.lit(0)
    rank = F.when(listed > 0, listed).otherwise(len(configured) + 1)
    return seen.select("key", rank.alias("rank"), F.col("first.ordinal").alias("ordinal"), F.col("first.pos").alias("pos"))

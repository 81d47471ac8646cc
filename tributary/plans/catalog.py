"""Registered queries of the fusion engine, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tributary.plans import entities, files, interactive, pages, reports, texts

MODULES = (interactive, entities, reports, texts, files, pages)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The resolved and fused records of two sources."""
    return entities.QUERIES["fuse_values"](spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: q for m in MODULES for name, q in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: q for m in MODULES for name, q in m.ORACLES.items()}

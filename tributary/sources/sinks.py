"""Writers: CSV and JSON exports, several datasets of one run, and atomic replacement."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.model import from_attrs
from tributary.sources.commits import CommitLog


def write_csv(df: DataFrame, path: str, columns: list[str], missing: str = "-", bom: bool = True) -> None:
    """The given columns as CSV; nothing is written as ``missing``; the first header starts with a byte order mark."""
    out = df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(missing)).alias(("﻿" if bom and i == 0 else "") + c) for i, c in enumerate(columns)])
    out.write.mode("overwrite").option("header", True).option("escape", '"').option("quoteAll", False).csv(path)


def write_wide(df: DataFrame, path: str, columns: list[str]) -> None:
    """B1: attributes unfolded into columns, as JSON lines."""
    from_attrs(df, columns).write.mode("overwrite").json(path)


def write_assets(frames: dict[str, DataFrame], root: str) -> int:
    """Several datasets of one run, which one entry of a commit log makes current, all or none; the entry's number.

    Data go to a folder of their own and never move, so that nothing depends on a store's rename. A run that fails before its entry leaves what
    was current before it; of two writers each gets a number of its own, and the later number is current.
    """
    spark = next(iter(frames.values())).sparkSession
    folder = f"{root}/data/{uuid.uuid4().hex}"
    for name, frame in frames.items():
        frame.write.parquet(f"{folder}/{name}")
    return CommitLog(spark, f"{root}/log").append({"datasets": {name: f"{folder}/{name}" for name in frames}})


def read_asset(spark: SparkSession, root: str, name: str, number: int | None = None) -> DataFrame:
    """The current version of a dataset, or that of a number."""
    log = CommitLog(spark, f"{root}/log")
    entry = log.current() if number is None else log.get(number)
    if entry is None:
        raise FileNotFoundError(f"{root} has no version {'yet' if number is None else number}")
    return spark.read.parquet(entry["datasets"][name])

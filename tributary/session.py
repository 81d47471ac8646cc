"""Session, table and scratch-folder helpers shared by every module."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

_shipped: set[str] = set()


def build_session(app: str = "tributary", cores: str = "*", partitions: int = 8, driver_memory: str = "8g") -> SparkSession:
    """A local session with the settings the tests and the benchmark use."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver tables, lazily."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, *by: str) -> DataFrame:
    """df dealt to as many tasks as the session shuffles to: a small file is one task, however much is computed of each of its rows."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path inside the folder that driver and executors share.

    The folder is the session's ``spark.checkpoint.dir``; only where that is unset, on a local master (tests),
    a temporary folder is made and set as the checkpoint folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = f"file://{tempfile.mkdtemp(prefix='spark-')}"
        spark.conf.set("spark.checkpoint.dir", base)
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it again: cuts the lineage, survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once, so that their Python workers can import it."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    target = os.path.join(tempfile.mkdtemp(prefix="spark-ship-"), "tributary.zip")
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, f"tributary/{p.relative_to(root)}")
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)

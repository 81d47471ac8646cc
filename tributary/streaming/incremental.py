"""Incremental work: registries, bounded streaming runs, event-time windows and saved queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def unseen(arrivals: DataFrame, registry: DataFrame, key: str) -> DataFrame:
    """Arrivals that the registry doesn't know, each key once."""
    return arrivals.dropDuplicates([key]).join(registry.select(key), key, "left_anti")


def registered(registry: DataFrame, arrivals: DataFrame, key: str) -> DataFrame:
    """The registry with all arrivals; what it already has stays as it is."""
    return registry.select(key, "seen_at").unionByName(unseen(arrivals, registry, key).select(key, "seen_at"))


def run_available(spark: SparkSession, source: str, schema: StructType | str, target: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame], files: int = 4) -> None:
    """O1, O3: process what has arrived since the last run, a bounded number of files at a time, exactly once into Parquet."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(source)
    query = (
        transform(stream).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def windowed(events: DataFrame, ts: str, every: str, late: str, keys: list[str], value: str) -> DataFrame:
    """Counts and sums per event-time window; the same for batches and (with its watermark) streams."""
    base = events.withWatermark(ts, late) if events.isStreaming else events
    return base.groupBy(F.window(ts, every).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total")).select(
        F.col("w.start").alias("window_start"), *keys, "n", "total"
    )


def chunk_state(done: DataFrame, items: DataFrame, key: str, most: int) -> DataFrame:
    """O1, O3: one row that says where a bounded run stands: items, those done (reconciled with what is there, not with what was noted), what the
    next chunk takes, the state (running: 10, complete: 0), and whether all done ones are known items."""
    finished = items.select(key).distinct().join(done.select(key).distinct().withColumn("there", F.lit(True)), key, "left")
    strange = done.select(key).distinct().join(items.select(key), key, "left_anti").agg(F.count(F.lit(1)).alias("unknown"))
    counts = finished.agg(F.count(F.lit(1)).alias("items"), F.count_if(F.col("there")).alias("done"))
    left = F.col("items") - F.col("done")
    one = counts.join(F.broadcast(strange), F.lit(True))  # single rows
    return one.select("items", "done", F.least(left, F.lit(most)).alias("next"), F.when(left > most, 10).otherwise(0).alias("exit"), (F.col("unknown") == 0).alias("consistent"))


def frontier(items: DataFrame, failures: DataFrame, key: str, most_attempts: int) -> DataFrame:
    """O2: items still to fetch: each key once, with its attempts and the back-off in seconds before the next one."""
    marked = frontier_states(items, failures, items.limit(0), key, most_attempts)
    return marked.where("reason = 'waiting' or reason = 'retry'").select(key, "attempts", "backoff")


def frontier_states(items: DataFrame, failures: DataFrame, seen: DataFrame, key: str, most_attempts: int) -> DataFrame:
    """O2: why each item is or isn't fetched: seen, exhausted, retry or waiting; with its attempts and back-off."""
    tried = failures.groupBy(key).agg(F.count(F.lit(1)).alias("attempts"))
    known = seen.select(key).distinct().withColumn("known", F.lit(True))
    joined = items.select(key).distinct().join(tried, key, "left").join(known, key, "left").withColumn("attempts", F.coalesce("attempts", F.lit(0)))
    n = F.col("attempts")
    reason = F.when(F.col("known"), "seen").when(n >= most_attempts, "exhausted").when(n > 0, "retry").otherwise("waiting")
    return joined.select(key, "attempts", F.when(n > 0, F.pow(F.lit(2.0), n - 1)).otherwise(0.0).alias("backoff"), reason.alias("reason"))


def saved_queries(rows: DataFrame, profile: str, created: Column, name: str, most: int = 50, longest: int = 80) -> DataFrame:
    """The last queries of each profile; profiles keep letters, digits, - and _ only, names are cut."""
    clean = F.regexp_replace(F.col(profile).cast("string"), "[^A-Za-z0-9_-]", "")
    rank = F.row_number().over(Window.partitionBy("profile").orderBy(created.desc(), "event_id"))
    return rows.withColumn("profile", clean).withColumn("name", F.substring(F.trim(name), 1, longest)).withColumn("rank", rank).where(F.col("rank") <= most)

"""Gates, audits and replays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions import scalars as S
from tributary.functions.scalars import NUMBER, is_missing
from tributary.operators import fuse


def gate(rules: list[tuple[str, Column]]) -> Column:
    """The first failing rule's name, null for a row that passes. Rules: (reason, test that must hold)."""
    return F.coalesce(*[F.when(~F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in rules])


def split(rows: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """Valid and invalid rows."""
    marked = rows.withColumn("reason", reason)
    return marked.where("reason is null").drop("reason"), marked.where("reason is not null")


def boundary_valid(rows: DataFrame, as_of: Column, prices: dict[str, str]) -> DataFrame:
    """Rows with their price set to the valid one (D12), and ``valid``: rows of a source need a price and a listing date up to as_of, and their
    own source's identity; rows without a source need brand, model and year.

    rows: source, brand, series, model, year, car_id, status, price, listed, and the columns of prices (source name to price column).
    """
    text = lambda c: F.when(S.is_missing(F.col(c), S.IDENTITY_MISSING), "").otherwise(S.trimmed(F.col(c).cast("string")))
    has = lambda c: text(c) != ""
    priced = S.with_price(rows, "source", "price", prices)
    year = text("year").rlike(r"^(?:19|20)\d{2}$")
    digits = text("car_id").rlike(r"^\d+$")
    named = has("brand") & has("model") & S.has_han(text("brand")) & digits & year
    slug = S.is_slug(text("series"))
    own = {
        "易车": named & has("series") & ~slug & (text("status") == "approved"),
        "汽车之家": named & has("series") & ~slug,
    }
    some_year = year | text("model").rlike(r"(?:19|20)\d{2}")
    valid = F.when(~has("source"), has("brand") & has("model") & some_year)
    for name, test in own.items():
        valid = valid.when(F.contains("source", F.lit(name)), test)
    valid = valid.otherwise(has("brand") & has("series") & has("model") & some_year & ~slug)
    listed = has("listed") & S.listed_by(F.col("listed"), as_of)
    return priced.withColumn("valid", F.coalesce(valid & (~has("source") | (F.col("priced") & listed)), F.lit(False))).drop("priced")


def require_rows(rows: DataFrame, least: int, failed: Column | None = None, most_failed: float = 0.1) -> DataFrame:
    """One row of counts; raises where there are too few rows or too many failures."""
    bad = F.count_if(failed) if failed is not None else F.lit(0)
    counted = rows.agg(F.count(F.lit(1)).alias("n"), bad.cast("long").alias("failed"))
    short = F.col("n") < least
    many = F.col("failed") > most_failed * F.col("n")
    return counted.withColumn("n", F.when(short | many, F.raise_error(F.concat(F.lit("gate: rows "), F.col("n").cast("string"), F.lit(", failed "), F.col("failed").cast("string")))).otherwise(F.col("n")))


def audit(baseline: DataFrame, candidate: DataFrame, bucket: list[str]) -> DataFrame:
    """Missing identities, and sources lost by an identity unless they survive in its bucket; keys are hashed.

    Both have key, source and the bucket's columns.
    """
    lost = baseline.select("key").distinct().join(candidate.select("key").distinct(), "key", "left_anti").select(
        F.lit("missing_identity").alias("kind"), F.substring(F.sha2("key", 256), 1, 16).alias("key_hash"), F.lit(None).cast("string").alias("source")
    )
    kept = candidate.select("key").distinct()
    gone = (
        baseline.select("key", "source", *bucket)
        .distinct()
        .join(kept, "key", "left_semi")
        .join(candidate.select("key", "source").distinct(), ["key", "source"], "left_anti")
        .join(candidate.select("source", *bucket).distinct(), ["source", *bucket], "left_anti")
        .select(F.lit("source_regression").alias("kind"), F.substring(F.sha2("key", 256), 1, 16).alias("key_hash"), "source")
    )
    return lost.unionByName(gone)


def provenance_contradictions(rows: DataFrame, fields: list[str], known_sources: tuple[str, ...] = fuse.KNOWN_SOURCES, component: str = "component") -> DataFrame:
    """Values that name a source which neither their row nor another row of its component has: key_hash, field, source.

    rows: key, component (may be null), sources (array) and the fields. A component's sources are joined once, by the component.
    """
    alone, grouped = rows.where(F.col(component).isNull()), rows.where(F.col(component).isNotNull())
    every = alone.withColumn("effective", F.col("sources")).unionByName(fuse.effective_sources(grouped, component))
    parts = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])
    values = every.select("key", "effective", F.explode(parts).alias("p")).where("p.value is not null")
    named = values.select("key", "effective", "p.field", F.explode(fuse.segments(F.col("p.value"), known_sources)).alias("part"))
    named = named.withColumn("source", fuse.source_label(F.col("part"), known_sources)).where("source <> ''")
    return named.where(~F.array_contains("effective", F.col("source"))).select(F.substring(F.sha2("key", 256), 1, 16).alias("key_hash"), "field", "source").distinct()


def annotation_changes(candidate: DataFrame, recomputed: DataFrame, column: str = "component_id") -> DataFrame:
    """Keys (hashed) of which the stored annotation isn't what a recomputation gives, with both. Both have key and the column."""
    again = recomputed.select("key", F.col(column).alias("recomputed"))
    both = candidate.select("key", F.col(column).alias("stored")).join(again, "key", "full")
    return both.where(~F.col("stored").eqNullSafe(F.col("recomputed"))).select(F.substring(F.sha2("key", 256), 1, 16).alias("key_hash"), "stored", "recomputed")


def fingerprint(rows: DataFrame, key: str = "key") -> DataFrame:
    """One row that tells a set of keys by their number and the sum of their hashes, in whatever order they come."""
    digits = F.conv(F.substring(F.sha2(F.col(key), 256), 1, 12), 16, 10).cast("decimal(20,0)")
    return rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(digits), F.lit(0)).cast("string").alias("fingerprint"))


def replay(before: DataFrame, after: DataFrame, key: str, metric: str, contradicts: Column | None = None) -> DataFrame:
    """Whether row counts agree, how many rows changed, how many contradict themselves afterwards, and whether the metric's sum got better."""
    a = before.agg(F.count(F.lit(1)).alias("rows_before"), F.sum(metric).alias("metric_before"))
    bad = F.count_if(contradicts) if contradicts is not None else F.lit(0)
    b = after.agg(F.count(F.lit(1)).alias("rows_after"), F.sum(metric).alias("metric_after"), bad.cast("long").alias("contradictions"))
    changed = before.select(key).exceptAll(after.select(key)).agg(F.count(F.lit(1)).alias("changed"))
    one = a.join(F.broadcast(b), F.lit(True)).join(F.broadcast(changed), F.lit(True))  # single rows
    same = (F.col("rows_before") == F.col("rows_after")) & (F.col("changed") == 0) & (F.col("contradictions") == 0)
    return one.withColumn("ok", same & (F.col("metric_after") > F.col("metric_before")))


def accept_edits(edits: DataFrame, targets: DataFrame, most: int) -> DataFrame:
    """Proposed aliases with the reason why one is refused: low confidence, unknown target, duplicate, or over the cap.

    Only the ``most`` best of the good edits (a configuration file's cap) are ranked, none of the refused ones.
    """
    known = targets.select(F.col("target"), F.lit(True).alias("known")).distinct()
    copies = edits.groupBy("key").agg(F.count(F.lit(1)).alias("copies"))
    marked = edits.join(known, "target", "left").join(copies, "key")
    reason = gate([("low_confidence", F.col("confidence") >= 0.9), ("unknown_target", F.col("known")), ("duplicate", F.col("copies") == 1)])
    marked = marked.withColumn("reason", reason)
    first = marked.where("reason is null").orderBy(F.desc("confidence"), "key").limit(most).select("key", F.lit(True).alias("taken"))
    over = F.when(F.col("reason").isNull() & F.col("taken").isNull(), "over_cap")
    return marked.join(first, "key", "left").select("key", "target", F.coalesce("reason", over).alias("reason"))


def classify_log(text: Column, families: list[tuple[str, str]], progress: str = NUMBER + " rows", threshold: int = 1) -> tuple[Column, Column]:
    """The first family of patterns that matches, and the largest captured progress."""
    amount = F.coalesce(F.array_max(F.transform(F.regexp_extract_all(text, F.lit(progress), 1), lambda v: v.cast("double"))), F.lit(0.0))
    out = F.when(amount >= threshold, F.lit("progress"))
    for name, pattern in families:
        out = out.when(text.rlike(pattern), F.lit(name))
    return out.otherwise("unknown"), amount


def in_window(ts: Column, start: int, stop: int, zone: str = "Asia/Shanghai") -> Column:
    """Whether the time of day in the zone, in minutes, lies inside the window; windows may pass midnight."""
    local = F.from_utc_timestamp(ts, zone)
    minute = F.hour(local) * 60 + F.minute(local)
    return minute.between(start, stop) if start <= stop else (minute >= start) | (minute <= stop)


def sparse(attrs: Column) -> Column:
    """Attributes without missing cells."""
    return F.map_filter(attrs, lambda _, v: ~is_missing(v))

"""Aggregate reports over sources, series and brands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.functions import scalars as S
from tributary.functions.scalars import is_missing
from tributary.operators.query import placed


def rate(part: Column, whole: Column) -> Column:
    """A percentage rounded to twelve decimals; 0 of nothing."""
    return F.round(F.when(whole > 0, part * 100.0 / whole).otherwise(0.0), 12)


def visible_stats(rows: DataFrame, key: str) -> DataFrame:
    """H1: distinct visible groups, split by how many sources they unite."""
    groups = rows.groupBy(key).agg(F.count_distinct("source").alias("n"))
    multi = F.count_if(F.col("n") > 1)
    return groups.agg(F.count(F.lit(1)).alias("visible"), multi.alias("multi"), F.count_if(F.col("n") == 1).alias("single"), rate(multi, F.count(F.lit(1))).alias("multi_rate"))


def source_distribution(rows: DataFrame, source: str, top: int = 20) -> DataFrame:
    """H2: the most frequent sources with shares of all rows."""
    total = F.sum("n").over(Window.partitionBy())  # over one row per source
    return (
        rows.groupBy(source).agg(F.count(F.lit(1)).alias("n")).withColumn("share", F.round(F.col("n") * 100.0 / total, 6)).orderBy(F.desc("n"), source).limit(top)
    )


def single_source_groups(rows: DataFrame, keys: list[str]) -> DataFrame:
    """H3, H4: per group its rows, sources and rows of single-source items; whether the group is seen by one source only."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("source").alias("sources")).withColumn(
        "kind", F.when(F.col("sources") > 1, "multi").otherwise("single")
    )


def brand_samples(rows: DataFrame, brands: int = 4, sample: int = 30) -> DataFrame:
    """H5: brands of two series and four sources' rows or more, by distinct series; the first rows of the first brands."""
    chosen = (
        rows.groupBy("brand").agg(F.count_distinct("series").alias("series_n"), F.count(F.lit(1)).alias("n")).where("series_n >= 2 and n >= 4")
        .orderBy(F.desc("series_n"), F.desc("n"), "brand").limit(brands)
    )
    rank = F.row_number().over(Window.partitionBy("brand").orderBy("ordinal"))
    return rows.join(F.broadcast(chosen.select("brand")), "brand").withColumn("rank", rank).where(F.col("rank") <= sample)


def series_alias_gaps(rows: DataFrame, suffixes: tuple[str, ...], least: int = 3, longer: int = 6) -> DataFrame:
    """H6: series of one brand of which one is the other and a powertrain suffix."""
    names = rows.groupBy("brand", "series").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    other = names.select("brand", F.col("series").alias("long"), F.col("n").alias("long_n"))
    tail = F.trim(F.substr("long", F.length("series") + 1))
    return names.join(other, "brand").where(
        (F.length("long") > F.length("series")) & (F.length("long") - F.length("series") <= longer) & F.startswith("long", "series") & tail.isin(*suffixes)
    ).select("brand", F.col("series").alias("short"), "long", tail.alias("suffix"), "n", "long_n")


def source_gaps(rows: DataFrame, keys: list[str], sources: list[str], least: int = 5, top: int = 60) -> DataFrame:
    """H7: groups of enough rows that lack a source."""
    held = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.collect_set("source").alias("have")).where(F.col("n") >= least)
    lack = F.array_except(F.array(*[F.lit(s) for s in sources]), F.col("have"))
    return held.select(*keys, "n", F.array_join(F.array_sort(lack), "+").alias("missing")).where("missing <> ''").orderBy(F.desc("n"), *keys).limit(top)


def brand_alias_gaps(rows: DataFrame) -> DataFrame:
    """H8: minor brand spellings of a series (two rows or more, fewer than the dominant one's)."""
    counts = rows.groupBy("series", "brand").agg(F.count(F.lit(1)).alias("n"))
    top = counts.groupBy("series").agg(F.max_by("brand", F.struct("n", "brand")).alias("dominant"), F.max("n").alias("dominant_n"))
    return counts.join(top, "series").where("brand <> dominant and n >= 2 and n < dominant_n").select("series", "brand", "n", "dominant", "dominant_n")


def quality_counts(rows: DataFrame, fields: list[str]) -> DataFrame:
    """H9: how many rows lack each field."""
    return rows.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(is_missing(F.col(f))).alias(f"no_{f}") for f in fields])


def identity_counts(rows: DataFrame) -> DataFrame:
    """H9: how many rows have no Chinese brand or series, no name, no year of four digits, or no approved status. rows: brand, series, model, year, status."""
    text = lambda c: S.trimmed(F.coalesce(F.col(c).cast("string"), F.lit("")))
    return rows.agg(
        F.count_if(is_missing(F.col("brand")) | ~S.has_han(text("brand"))).alias("invalid_brand"),
        F.count_if(is_missing(F.col("model"))).alias("invalid_model_name"),
        F.count_if(is_missing(F.col("series")) | ~S.has_han(text("series"))).alias("invalid_series"),
        F.count_if(~text("year").rlike(r"^(?:19|20)\d{2}$")).alias("invalid_year"),
        F.count_if(text("status") != "approved").alias("unapproved_status"),
    )


def best_sales(rows: DataFrame, item: str, amount: str) -> DataFrame:
    """Each item's largest positive amount over all lists that have it."""
    return rows.where(F.col(amount) > 0).groupBy(item).agg(F.max(amount).alias("amount"))


def heat(rows: DataFrame, group: str, amount: str) -> DataFrame:
    """All positive amounts of a group summed, an item of several lists as often as they have it, and the group's place by that sum."""
    sums = rows.where(F.col(amount) > 0).groupBy(group).agg(F.sum(amount).alias("heat"))
    return placed(sums, [F.desc("heat"), F.col(group).asc()]).select(group, "heat", F.col("place").alias("rank"))


def single_source_totals(rows: DataFrame, keys: list[str]) -> DataFrame:
    """H3: rows of groups that one source has, single-source rows of groups that several have, and how many groups there are of both. rows: sources (array)."""
    held = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.size("sources") <= 1).alias("alone"), F.size(F.array_distinct(F.flatten(F.collect_set("sources")))).alias("s")
    )
    one = F.col("s") <= 1
    return held.agg(
        F.coalesce(F.sum(F.when(one, F.col("n"))), F.lit(0)).alias("single_series_rows"), F.coalesce(F.sum(F.when(~one, F.col("alone"))), F.lit(0)).alias("multi_series_single_rows"),
        F.count(F.lit(1)).alias("total_series"), F.count_if(one).alias("single_source_series"), F.count_if(~one).alias("multi_source_series"),
    )


def single_source_top(rows: DataFrame, keys: list[str], top: int = 30) -> DataFrame:
    """H3: the largest groups that one source has."""
    held = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.array_distinct(F.flatten(F.collect_set("sources"))).alias("s"))
    return held.where(F.size("s") <= 1).orderBy(F.desc("n"), *keys).limit(top).select(*keys, F.coalesce(F.get("s", F.lit(0)), F.lit("?")).alias("source"), "n")


def kind_identity(kind: str, fields: dict[str, Column]) -> Column:
    """H4: the identity of a car, phone or laptop: its known parts joined, null where a part that it needs is missing."""
    def part(n: str) -> Column:
        text = S.half_width(F.coalesce(fields[n].cast("string"), F.lit(""))) if n in fields else F.lit("")
        return F.lower(F.regexp_replace(S.trimmed(text), r"(?U)\s+", " "))

    names = {"cars": ("brand", "series", "model", "year"), "phones": ("brand", "model", "memory", "storage"), "laptops": ("brand", "model", "cpu")}[kind]
    needed = {"cars": ("model", "year"), "phones": ("model",), "laptops": ("brand", "model")}[kind]
    whole = F.array_join(F.filter(F.array(*[part(n) for n in names]), lambda x: x != ""), "|")
    there = F.lit(True)
    for n in needed:
        there = there & (part(n) != "")
    out = F.when(there, whole)
    if kind == "laptops" and "identity_key" in fields:
        key = part("identity_key")
        out = F.when(fields["identity_key"].isNotNull(), F.when(key.rlike("^[0-9a-f]{24,64}$"), F.concat(F.lit("identity:"), key))).otherwise(out)
    return out


def attribute_evidence(cells_: DataFrame, sources: tuple[str, ...], top: int = 25) -> DataFrame:
    """H5: of each attribute how many cells it has, how many hold several parts or name a source, and how many parts are synonyms; the
    most frequent of each kind. cells_: key, value."""
    named = F.lit(False)
    for source in sources:
        named = named | F.contains("value", F.lit(source + ":"))
    words = [S.match_text(F.lit(w)) for w in S.SYNONYMS]
    parts = F.transform(F.split("value", r"\|"), lambda p: S.match_text(F.regexp_replace(p, "^[^:]*:", "")))
    rows = cells_.where(~is_missing(F.col("value"))).select(
        "key", (named | (F.size(F.split("value", r"\|")) > 1)).alias("conflict"), F.size(F.filter(parts, lambda p: F.array_contains(F.array(*words), p))).alias("synonyms")
    )
    sums = rows.groupBy("key").agg(F.count(F.lit(1)).alias("attribute"), F.count_if("conflict").alias("conflict"), F.sum("synonyms").alias("synonym"))
    long = sums.unpivot(["key"], ["attribute", "conflict", "synonym"], "kind", "n").where("n > 0")
    rank = F.row_number().over(Window.partitionBy("kind").orderBy(F.desc("n"), "key"))
    return long.withColumn("rank", rank).where(F.col("rank") <= top).drop("rank")


def reasons(rows: DataFrame, reason: Column) -> DataFrame:
    """Histogram of reasons; rows without one count as valid."""
    return rows.groupBy(F.coalesce(reason, F.lit("valid")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))

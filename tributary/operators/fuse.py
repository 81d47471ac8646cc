"""Conflict-aware value merge with provenance."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.functions.scalars import DATE_FIELDS, canonical_compare, canonical_value, date_parts, is_missing, is_positive
from tributary.operators.headers import distinct_join
from tributary.session import ship


#: The sources whose names stand before values.
KNOWN_SOURCES = ("汽车之家", "懂车帝", "易车")


def fuse_values(rows: DataFrame, date_keys: tuple[str, ...] = (), identity_keys: tuple[str, ...] = ()) -> DataFrame:
    """G1. rows: entity, key, src_ord, source, value. One value per entity and key, in one shuffle.

    Identity keys keep the longest value (the first of equally long ones); nothing is "-"; one canonical value stands as it is; dates
    of one month fold to the longest where at most one has a day; one comparison key keeps the longest; anything else lists
    source:value. date_keys: attributes that are compared as dates, besides DATE_FIELDS.
    """
    value = F.coalesce("value", F.lit(""))
    there = canonical_value(value) != "-"
    dates = (*DATE_FIELDS, *date_keys)
    said = rows.select(
        "entity", "key", "src_ord", "source", "value",
        F.when(there, canonical_value(value)).alias("canonical"),
        F.when(there, canonical_compare(value, F.col("key"), dates)).alias("compare"),
        F.when(there & F.col("key").isin(*dates), date_parts(value)).alias("date"),
        there.alias("there"),
    )
    one = lambda c: F.min(c) == F.max(c)
    listed = F.array_sort(F.collect_list(F.when(F.col("there"), F.struct("src_ord", "source", "value"))))
    grouped = said.groupBy("entity", "key").agg(
        F.max(F.when(F.col("there"), F.struct(F.length("value"), -F.col("src_ord"), "value")))["value"].alias("longest"),
        one("canonical").alias("same"),
        F.min("canonical").alias("canonical"),
        one("compare").alias("alike"),
        (one("date.year") & one("date.month") & (F.count("date") == F.count_if("there")) & (F.count("date.day") <= 1)).alias("folds"),
        F.array_join(F.transform(listed, lambda x: F.concat(x["source"], F.lit(":"), x["value"])), "|").alias("listed"),
    )
    identity = F.col("key").isin(*identity_keys) if identity_keys else F.lit(False)
    fused = F.when(identity | (~F.col("same") & (F.coalesce("folds", F.lit(False)) | F.col("alike"))), F.col("longest"))
    fused = fused.when(F.col("same"), F.col("canonical")).otherwise(F.col("listed"))
    return grouped.select("entity", "key", F.when(F.col("longest").isNull(), "-").otherwise(fused).alias("value"))


def source_label(part: Column, known: tuple[str, ...]) -> Column:
    """The known source that a part begins with, before a colon; empty for others, whatever colons they hold."""
    return F.regexp_extract(part, f"^({'|'.join(re.escape(s) for s in known)}):", 1)


def add_source(
    current: Column, current_sources: Column, source: str, incoming: Column, field: Column | str | None = None, known_sources: tuple[str, ...] = KNOWN_SOURCES
) -> Column:
    """Add a source's value without nesting prefixes; an unlabelled value gets each of its own sources. A value that compares
    like one of those there adds nothing; dates of one month fold to the longest. Only known sources are labels."""
    parts = F.transform(F.split(F.coalesce(current, F.lit("")), r"\|"), lambda p: F.trim(p))
    label = lambda p: source_label(p, (*known_sources, source))
    labelled = F.forall(parts, lambda p: label(p) != "")
    values = F.transform(parts, lambda p: F.when(label(p) != "", F.substr(p, F.length(label(p)) + 2)).otherwise(p))
    field = field if isinstance(field, Column) else F.lit(field).cast("string")
    known = F.exists(values, lambda v: canonical_compare(v, field) == canonical_compare(incoming, field))
    every = F.array_append(values, incoming)
    dated = F.transform(every, date_parts)
    day = F.filter(dated, lambda d: d["day"].isNotNull())
    folds = field.isin(*DATE_FIELDS) & F.forall(dated, lambda d: d.isNotNull() & (d["year"] == dated[0]["year"]) & (d["month"] == dated[0]["month"])) & (F.size(day) <= 1)
    longest = F.aggregate(every, F.lit(""), lambda a, v: F.when(F.length(v) > F.length(a), v).otherwise(a))
    old = F.when(labelled, current).otherwise(F.array_join(F.transform(current_sources, lambda s: F.concat(s, F.lit(":"), current)), "|"))
    nothing, missing = canonical_value(incoming) == "-", canonical_value(current) == "-"
    return (
        F.when(nothing & missing, "-").when(nothing, current).when(missing, incoming).when(known, current)
        .when(F.coalesce(folds, F.lit(False)), longest).otherwise(F.concat(old, F.lit(f"|{source}:"), incoming))
    )


def merge_verified(rows: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Per visible key the first positive value of each column, all sources, and whether several agree."""
    firsts = [F.min_by(F.when(is_positive(F.col(v)), F.col(v)), F.when(is_positive(F.col(v)), F.col("ordinal"))).alias(v) for v in values]
    return rows.groupBy(*keys).agg(*firsts, F.array_join(F.array_sort(F.collect_set("source")), "+").alias("sources"), F.count_distinct("source").alias("n")).withColumn(
        "verification", F.when(F.col("n") > 1, "multi").otherwise("single")
    ).drop("n")


def enrich(baseline: DataFrame, candidate: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """Missing fields filled from the candidate of the same key (its first row), with a changed flag."""
    first = candidate.groupBy(*key).agg(*[F.min_by(f, "ordinal").alias(f"c_{f}") for f in fields])
    joined = baseline.join(first, key, "left")
    fill = {f: F.when(is_missing(F.col(f)) & ~is_missing(F.col(f"c_{f}")), F.col(f"c_{f}")) for f in fields}
    changed = F.lit(False)
    for f in fields:
        changed = changed | fill[f].isNotNull()
    return joined.select(*[c for c in baseline.columns if c not in fields], *[F.coalesce(fill[f], F.col(f)).alias(f) for f in fields], changed.alias("changed"))


def segments(value: Column, known_sources: tuple[str, ...] = KNOWN_SOURCES) -> Column:
    """The parts of a value that begin with a known source and a colon, at its start or after a bar, and what stands before
    them; a part without a known source stays with the one before it."""
    names = "|".join(re.escape(s) for s in known_sources)
    parts = F.split(value, rf"\|(?=(?:{names}):)")
    tidy = F.transform(parts, lambda p, i: F.when(source_label(p, known_sources) == "", F.regexp_replace(p, r"\|+$", "")).otherwise(F.regexp_replace(p, r"\|$", "")))
    return F.filter(tidy, lambda p: p != "")


def contradictions(rows: DataFrame, value: str = "value", sources: str = "sources", known_sources: tuple[str, ...] = KNOWN_SOURCES) -> DataFrame:
    """How many segments source:value name a source that is none of the row's (``removed``), and the value without them
    (``clean``; null if nothing remains). Only known sources are labels: a value with other colons stays as it is."""
    parts = segments(F.col(value), known_sources)
    label = lambda p: source_label(p, known_sources)
    wrong = lambda p: (label(p) != "") & ~F.array_contains(F.col(sources), label(p))
    bad, good = F.filter(parts, wrong), F.filter(parts, lambda p: ~wrong(p))
    return rows.withColumn("removed", F.coalesce(F.size(bad), F.lit(0))).withColumn(
        "clean", F.when(F.col("removed") == 0, F.col(value)).when(F.size(good) > 0, F.array_join(good, "|"))
    )


def effective_sources(rows: DataFrame, component: str = "component") -> DataFrame:
    """A row's sources widened to those of its component."""
    own = rows.select(component, F.explode("sources").alias("s")).groupBy(component).agg(F.array_sort(F.collect_set("s")).alias("effective"))
    return rows.join(own, component, "left")


def _leaves(value: object, path: tuple[str, ...] = ()) -> Iterator[tuple[str, str, str]]:
    """(path, kind, JSON) of everything a document says: an object's keys and a list's members (named by id, else by content) are steps."""
    if isinstance(value, dict):
        yield json.dumps(path), "object", ""
        for k, v in value.items():
            yield from _leaves(v, (*path, f".{k}"))
    elif isinstance(value, list):
        yield json.dumps(path), "list", ""
        for v in value:
            name = f"#{v['id']}" if isinstance(v, dict) and "id" in v else f"={json.dumps(v, sort_keys=True, ensure_ascii=False)}"
            yield from _leaves(v, (*path, name))
    else:
        kind = "number" if isinstance(value, (int, float)) and not isinstance(value, bool) else "empty" if value in (None, "") else "text"
        yield json.dumps(path), kind, json.dumps(value, ensure_ascii=False)


def _grown(leaves: list[tuple[tuple[str, ...], str, str]]) -> object:
    """The document of which these are the leaves, in the order given."""
    root: dict = {}
    for path, kind, text in leaves:
        node = root
        for step in path:
            node = node.setdefault(step, {})
        node[""] = (kind, text)

    def build(node: dict) -> object:
        kind, text = node.get("", ("object", ""))
        if kind == "object":
            return {k[1:]: build(v) for k, v in node.items() if k}
        if kind == "list":
            return [build(v) for k, v in node.items() if k]
        return json.loads(text)

    return build(root)


def merge_json(rows: DataFrame, key: str, document: str, order: str) -> DataFrame:
    """Documents of a key merged in order: objects by key, lists by id or content, the larger number, the later text that
    isn't empty. Where kinds differ, the later one stands.

    Documents are taken apart into paths, and each path merges by itself in Spark, with partial aggregates; one task only holds the
    merged leaves of a key, never all of its documents.
    """
    ship(rows.sparkSession)

    def apart(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = [(k, o, i, *leaf) for k, o, d in zip(frame["k"], frame["o"], frame["d"]) if d for i, leaf in enumerate(_leaves(json.loads(d)))]
            yield pd.DataFrame(out, columns=["k", "o", "i", "path", "kind", "text"])

    def together(k: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["o", "i"], kind="stable")
        leaves = [(tuple(json.loads(p)), kind, text) for p, kind, text in zip(frame["path"], frame["kind"], frame["text"])]
        return pd.DataFrame({"k": [k[0]], "d": [json.dumps(_grown(leaves), sort_keys=True, ensure_ascii=False)]})

    picked = rows.select(F.col(key).cast("string").alias("k"), F.col(order).cast("long").alias("o"), F.col(document).alias("d"))
    leaves = picked.mapInPandas(apart, "k string, o long, i long, path string, kind string, text string")
    last, filled, number = F.struct("o", "i", "kind", "text"), F.col("kind") != "empty", F.col("kind") == "number"
    merged = leaves.groupBy("k", "path").agg(
        F.min(F.struct("o", "i")).alias("first"), F.max(F.when(filled, last)).alias("value"), F.max(last).alias("any"),
        F.max(F.when(number, F.struct(F.col("text").cast("double").alias("n"), "text"))).alias("most"),
    )
    value = F.coalesce("value", "any")
    text = F.when(value["kind"] == "number", F.col("most.text")).otherwise(value["text"])
    parts = merged.select("k", "path", F.col("first.o").alias("o"), F.col("first.i").alias("i"), value["kind"].alias("kind"), text.alias("text"))
    grown = parts.groupBy("k").applyInPandas(together, "k string, d string")
    return grown.select(F.col("k").cast(rows.schema[key].dataType).alias(key), F.col("d").alias(document))


def longest_value(rows: DataFrame, by: list[str]) -> DataFrame:
    """Where headers collide, the longest value; the first of equally long ones."""
    return rows.groupBy(*by).agg(F.max_by("value", F.struct(F.length("value"), -F.col("ordinal"))).alias("value"))


def cell_diff(left: DataFrame, right: DataFrame, name: str, fields: list[str]) -> DataFrame:
    """(name, field, a, b) where both sides have a value and they differ; the last right row of a name counts."""
    last = right.groupBy(name).agg(*[F.max_by(f, "ordinal").alias(f) for f in fields])
    long = lambda df, v: df.select(name, F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias(v)) for f in fields])).alias("x")).select(name, "x.*")
    return long(left, "a").join(long(last, "b"), [name, "field"]).where(~is_missing(F.col("a")) & ~is_missing(F.col("b")) & (F.col("a") != F.col("b")))


def joined_values(rows: DataFrame, by: list[str], value: str, order: str) -> DataFrame:
    """G3 over rows."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct(order, value))), lambda x: x[value])
    return rows.groupBy(*by).agg(distinct_join(ordered).alias(value))


def unique_best(pairs: DataFrame, tolerance: float = 1e-12) -> DataFrame:
    """M3: each l's best r where no other comes within the tolerance."""
    w = Window.partitionBy("l")
    marked = pairs.withColumn("best", F.max("score").over(w))
    marked = marked.withColumn("ties", F.count_if(F.col("best") - F.col("score") <= tolerance).over(w))
    return marked.where((F.col("score") == F.col("best")) & (F.col("ties") == 1)).select("l", "r", "score")

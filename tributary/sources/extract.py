"""Extraction of records from nested JSON, positional tables, HTML and text."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tributary.functions.scalars import is_missing
from tributary.session import ship
from tributary.sources.commits import CommitLog


def read_json_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A1, A2: a JSON array of objects, or an object with items or data. A file of another shape, or with a member that is no object,
    raises with its name; an empty result raises when it is counted by a gate. A file without a single byte is none that Spark reads."""
    wrapped = f"items array<struct<{schema}>>, data array<struct<{schema}>>"
    text = spark.read.text(path, wholetext=True).select(F.regexp_replace("value", r"^\s+", "").alias("value"), F.col("_metadata.file_path").alias("file"))
    listed = F.startswith("value", F.lit("["))
    members = F.when(listed, F.col("value")).otherwise(F.coalesce(F.get_json_object("value", "$.items"), F.get_json_object("value", "$.data")))
    whole, inside = F.from_json("value", f"array<struct<{schema}>>"), F.from_json("value", f"struct<{wrapped}>")
    found = F.when(listed, whole).otherwise(F.coalesce(inside["items"], inside["data"]))
    # Members one by one: what is no object is told by its first character.
    said = F.from_json(members, "array<string>")
    wrong = found.isNull() | said.isNull() | F.exists(said, lambda m: F.coalesce(~F.startswith(F.ltrim(m), F.lit("{")), F.lit(True)))
    checked = F.when(F.coalesce(wrong, F.lit(True)), F.raise_error(F.concat(F.lit("not a list of objects: "), F.col("file")))).otherwise(found)
    return text.select(checked.alias("r")).select(F.inline("r"))


def newest(files: DataFrame, least_bytes: int = 1024, since: str | None = None) -> DataFrame:
    """A1, A3: files (path, modificationTime, length) that are large and new enough, the newest first."""
    ok = files.where(F.col("length") >= least_bytes)
    if since:
        ok = ok.where(F.col("modificationTime") >= F.lit(since).cast("timestamp"))
    return ok.orderBy(F.desc("modificationTime"), F.desc("path"))


def write_artifact(rows: DataFrame, path: str) -> None:
    """A3: rows as JSON lines."""
    rows.write.json(path)


def record_artifact(rows: DataFrame, root: str, name: str, created: str) -> None:
    """Rows as an artifact under root, with an entry (path, created, rows, bytes, valid) in its manifest, a commit log. Valid: some
    row has a name, a year and an id of digits, where it has these columns."""
    spark, path = rows.sparkSession, f"{root}/artifacts/{name}-{uuid.uuid4().hex}"
    write_artifact(rows, path)
    there = spark.read.schema(rows.schema).json(path)
    valid = F.count(F.lit(1)) > 0
    if {"name", "year", "id"} <= set(rows.columns):
        valid = F.coalesce(F.bool_or(valid_cache(F.array(F.struct("name", "year", F.col("id").cast("string").alias("id"))))), F.lit(False))
    n, good = there.agg(F.count(F.lit(1)), valid).first()
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    size = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()
    CommitLog(spark, f"{root}/manifest").append({"path": path, "created": created, "rows": n, "bytes": size, "valid": good})


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """The artifacts' entries, by number."""
    number = F.regexp_extract(F.col("_metadata.file_name"), r"^(\d+)", 1).cast("long")
    entries = spark.read.schema("path string, created timestamp, rows long, bytes long, valid boolean").json(f"{root}/manifest/*.json")
    return entries.where("path is not null").select(number.alias("number"), "*")


def newest_recorded(spark: SparkSession, root: str, schema: str, least_rows: int = 50, least_bytes: int = 1024, since: str | None = None) -> DataFrame:
    """A1, A3: the rows of the newest valid artifact that is large and new enough and has rows enough, chosen by the manifest alone: no other
    artifact is listed or read. Raises where there is none."""
    fit = manifest(spark, root).where((F.col("rows") >= least_rows) & (F.col("bytes") >= least_bytes) & F.col("valid"))
    if since:
        fit = fit.where(F.col("created") >= F.lit(since).cast("timestamp"))
    found = fit.orderBy(F.desc("created"), F.desc("number")).first()
    if found is None:
        raise ValueError(f"no valid artifact under {root}")
    return spark.read.schema(schema).json(found["path"])


def newest_valid(spark: SparkSession, root: str, schema: str, least_rows: int = 50, least_bytes: int = 1024, since: str | None = None, extension: str = "json") -> DataFrame:
    """A1, A3: the rows of the newest artifact (a folder under root) that is large and new enough and has rows enough.

    Artifacts are looked at one after another, the newest first: only their names, sizes and row counts reach the driver. Raises where none is valid.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*.{extension}").load(root).drop("content")
    folder = F.regexp_replace("path", "/[^/]*$", "")
    artifacts = files.groupBy(folder.alias("path")).agg(F.max("modificationTime").alias("modificationTime"), F.sum("length").alias("length"))
    for found in newest(artifacts, least_bytes, since).toLocalIterator():
        rows = spark.read.schema(schema).json(found["path"])
        if rows.limit(least_rows).count() >= least_rows:
            return rows
    raise ValueError(f"no valid artifact under {root}")


def properties(rows: DataFrame, key: str, payload: str, labels: DataFrame) -> DataFrame:
    """A4: properties[{key, text, sub_list[{key, text}]}] to (row, label, value); sub-items get their parent's label in front.

    Values of one label are joined by | in their order. labels: key, label.
    """
    schema = "array<struct<key: string, text: string, sub_list: array<struct<key: string, text: string>>>>"
    # parsed once: an entry and its sub-entries are one list
    entry = lambda p: F.array_prepend(
        F.transform(F.coalesce(p["sub_list"], F.array()), lambda s, i: F.struct((i + 1).alias("sub"), s["key"].alias("key"), p["key"].alias("parent"), s["text"].alias("value"))),
        F.struct(F.lit(0).alias("sub"), p["key"].alias("key"), F.lit(None).cast("string").alias("parent"), p["text"].alias("value")),
    )
    flat = rows.select(key, F.posexplode(F.transform(F.from_json(payload, schema), entry)).alias("pos", "entries"))
    both = flat.select(key, "pos", F.inline("entries")).where(~is_missing(F.col("value")))
    # a label table is a key's own list of names; it joins like any other side, broadcast only where it is small
    named = both.join(labels, "key", "left").join(labels.select(F.col("key").alias("parent"), F.col("label").alias("parent_label")), "parent", "left")
    label = F.concat_ws(" ", "parent_label", F.coalesce("label", "key"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("pos", "sub", "value"))), lambda x: x["value"])
    return named.groupBy(key, label.alias("label")).agg(F.array_join(F.array_distinct(ordered), "|").alias("value"))


def batched(ids: Column, size: int) -> Column:
    """A5: ordered distinct ids in batches."""
    d = F.array_distinct(ids)
    starts = F.when(F.size(d) > 0, F.sequence(F.lit(1), F.size(d), F.lit(size))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.slice(d, i, size))


def zip_titles(titles: Column, values: Column) -> Column:
    """Titles with values by position, as an array of (k, v); surplus of either side is left out."""
    return F.filter(F.arrays_zip(titles.alias("k"), values.alias("v")), lambda p: p["k"].isNotNull() & p["v"].isNotNull())


def transpose(columns: Column) -> Column:
    """A map of header to values as an array of one map per row, padded with '-'."""
    longest = F.aggregate(F.map_values(columns), F.lit(0), lambda n, v: F.greatest(n, F.size(v)))
    rows = F.when(longest > 0, F.sequence(F.lit(1), longest)).otherwise(F.array().cast("array<int>"))
    return F.transform(rows, lambda i: F.transform_values(columns, lambda _, v: F.coalesce(F.try_element_at(v, i), F.lit("-"))))


def restore_spans(text: Column, css: Column) -> Column:
    """<span class='x'></span> replaced by the content of rule .x in a map."""
    return F.aggregate(
        F.map_entries(css),
        text,
        lambda acc, e: F.replace(acc, F.concat(F.lit("<span class='"), e["key"], F.lit("'></span>")), e["value"]),
    )


# What a sale status says, and its codes.
UNAPPROVED = ("未上市", "即将上市", "即将", "预售", "预测", "概念", "未定名")
APPROVED = ("在售", "已上市")
STATUS_CODES = {
    **dict.fromkeys(("1", "2", "3", "sale", "onsale", "on_sale", "sell", "selling", "listed"), "approved"),
    **dict.fromkeys(("0", "-1", "8", "presale", "pre_sale", "coming"), "unapproved"),
}


VALUES = "struct<value: string, id: string, status: string, saleStatusName: string, baseInfo: string, subList: array<struct<value: string>>>"
POSITIONS = f"struct<data: array<struct<items: array<struct<name: string, paramValues: array<{VALUES}>>>>>>"
BASE = "struct<carName: string, carId: string, status: string, saleStatusName: string>"


def _value(v: Column) -> Column:
    """A value's text; the first sub-value stands in for none."""
    return F.coalesce(F.nullif(F.nullif(v["value"], F.lit("")), F.lit("-")), F.get(v["subList"], F.lit(0))["value"])


def _said(v: Column, base: Column) -> Column:
    """All that a value and its baseInfo say about its status."""
    return F.array_compact(F.array(base["saleStatusName"], base["status"], v["saleStatusName"], v["status"]))


def _status(said: Column) -> Column:
    text, codes = F.array_join(said, " "), F.transform(said, lambda x: F.lower(F.trim(x)))
    coded = lambda wanted: F.arrays_overlap(codes, F.array(*[F.lit(c) for c, s in STATUS_CODES.items() if s == wanted]))
    return (
        F.when(text.rlike("|".join(UNAPPROVED)), "unapproved").when(text.rlike("|".join(APPROVED)), "approved")
        .when(coded("approved"), "approved").when(coded("unapproved"), "unapproved").otherwise("unknown")
    )


def groups_by_position(rows: DataFrame, key: str, payload: str) -> DataFrame:
    """data[{items[{name, paramValues[{value, id, status, baseInfo, subList[{value}]}]}]}] to (row, position, name, value, status, order); the
    first sub-value stands in for no value. baseInfo is JSON inside JSON; its status and the value's own are read together."""
    items = rows.select(key, F.posexplode(F.expr(f"from_json({payload}, '{POSITIONS}').data")).alias("g", "group")).select(key, "g", F.posexplode("group.items").alias("i", "item"))
    cells = items.select(key, "g", "i", F.col("item.name").alias("name"), F.posexplode("item.paramValues").alias("position", "v"))
    v, base = F.col("v"), F.from_json("v.baseInfo", BASE)
    return cells.select(
        key, "position", "name", _value(v).alias("value"), _status(_said(v, base)).alias("status"),
        base["carName"].alias("model"), F.coalesce(base["carId"], F.col("v.id")).alias("model_id"), F.struct("g", "i").alias("order"),
    )


def records_by_position(rows: DataFrame, key: str, payload: str) -> DataFrame:
    """One record per row and position of such groups: its name and id (the last that are given), its status (the last that is known), and all
    values by name. A row's values meet inside the row, so nothing is shuffled or sorted."""
    groups = F.filter(F.expr(f"from_json({payload}, '{POSITIONS}').data"), lambda g: g["items"].isNotNull())
    items = F.filter(F.flatten(F.transform(groups, lambda g: g["items"])), lambda i: i["paramValues"].isNotNull())
    rows = rows.select(key, items.alias("items")).withColumn("most", F.array_max(F.transform("items", lambda i: F.size(i["paramValues"]))))
    here = lambda p: F.transform(
        F.filter("items", lambda i: F.size(i["paramValues"]) > p), lambda i: F.struct(i["name"].alias("name"), F.get(i["paramValues"], p).alias("v"))
    )
    # No filter on "most": it would be pushed below the parsing, which then ran twice.
    positions = F.when(F.col("most") > 0, F.sequence(F.lit(0), F.col("most") - 1))
    cells = rows.select(key, F.posexplode(F.transform(positions, here)).alias("position", "cells"))
    # Each step is a transform of its own, so that baseInfo is parsed once a value.
    based = F.transform("cells", lambda c: F.struct(c["name"].alias("name"), c["v"].alias("v"), F.from_json(c["v"]["baseInfo"], BASE).alias("base")))
    said = F.transform(based, lambda c: F.struct(
        c["name"].alias("name"), _value(c["v"]).alias("value"), _said(c["v"], c["base"]).alias("said"),
        c["base"]["carName"].alias("model"), F.coalesce(c["base"]["carId"], c["v"]["id"]).alias("model_id"),
    ))
    told = cells.select(key, "position", said.alias("cells"))
    last = lambda values, good: F.try_element_at(F.filter(values, good), F.lit(-1))
    named = F.transform(F.filter("cells", lambda c: c["value"].isNotNull()), lambda c: F.struct(c["name"], c["value"]))
    return told.select(
        key, "position", last("cells.model", F.isnotnull).alias("model"), last("cells.model_id", F.isnotnull).alias("model_id"),
        F.coalesce(last(F.transform("cells.said", _status), lambda s: s != "unknown"), F.lit("unknown")).alias("status"), F.map_from_entries(named).alias("attrs"),
    )


def walk_json(rows: DataFrame, key: str, payload: str) -> DataFrame:
    """A5, A10: every object inside a JSON text, depth first: row, number, path, id, name, and its plain values by name."""
    import json

    ship(rows.sparkSession)

    def text_of(v: object) -> str | None:
        return None if v is None else v if isinstance(v, str) else json.dumps(v)

    def objects(x: object, path: str) -> Iterator[tuple[str, str | None, str | None, dict]]:
        if isinstance(x, dict):
            plain = {k: text_of(v) for k, v in x.items() if not isinstance(v, (dict, list)) and v is not None}
            yield path, plain.get("id"), plain.get("name"), plain
            for k, v in x.items():
                yield from objects(v, f"{path}.{k}")
        elif isinstance(x, list):
            for i, v in enumerate(x):
                yield from objects(v, f"{path}[{i}]")

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for k, text in zip(frame["k"], frame["p"]):
                try:
                    value = json.loads(text) if text else None
                except ValueError:
                    continue
                out += [(k, n, *o) for n, o in enumerate(objects(value, "$"))]
            yield pd.DataFrame(out, columns=["k", "number", "path", "id", "name", "fields"])

    picked = rows.select(F.col(key).cast("string").alias("k"), F.col(payload).alias("p"))
    return picked.mapInPandas(work, "k string, number int, path string, id string, name string, fields map<string,string>").withColumnRenamed("k", key)


def entities(objects: DataFrame, key: str) -> DataFrame:
    """A10: objects with an id and a name by id: the first name, and each field's first value, in the order of the walk."""
    held = objects.where("id <> '' and name <> ''")
    fields = held.select(key, "id", "number", F.explode("fields").alias("field", "value")).where(~is_missing(F.col("value")))
    first = fields.groupBy(key, "id", "field").agg(F.min_by("value", "number").alias("value"))
    maps = first.groupBy(key, "id").agg(F.map_from_entries(F.collect_list(F.struct("field", "value"))).alias("fields"))
    names = held.groupBy(key, "id").agg(F.min_by("name", "number").alias("name"), F.count(F.lit(1)).alias("seen"))
    return names.join(maps, [key, "id"])


def ids_in(objects: DataFrame, key: str) -> DataFrame:
    """A5: the distinct ids of all objects of a payload, in the order of the walk; a payload without any is marked empty."""
    found = objects.groupBy(key, "id").agg(F.min("number").alias("number")).groupBy(key).agg(
        F.array_sort(F.collect_list(F.when(F.col("id").isNotNull(), F.struct("number", "id")))).alias("s")
    )
    ids = F.transform("s", lambda x: x["id"])
    return found.select(key, ids.alias("ids"), (F.size("s") == 0).alias("empty"))


class _Tables(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[tuple[int, list[str]]] = []
        self.table, self.cell = -1, None

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.table += 1
        elif tag == "tr":
            self.rows.append((max(self.table, 0), []))
        elif tag in ("td", "th"):
            self.cell = []

    def handle_data(self, data):
        if self.cell is not None:
            self.cell.append(data)

    def handle_endtag(self, tag):
        if tag in ("td", "th") and self.cell is not None and self.rows:
            self.rows[-1][1].append(" ".join("".join(self.cell).split()))
            self.cell = None


def html_rows(rows: DataFrame, key: str, html: str) -> DataFrame:
    """Cells of every table row: row key, table, line, cells."""
    ship(rows.sparkSession)

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for k, text in zip(frame["k"], frame["h"]):
                parser = _Tables()
                parser.feed(text or "")
                out += [(k, t, i, cells) for i, (t, cells) in enumerate(parser.rows)]
            yield pd.DataFrame(out, columns=["k", "table", "line", "cells"])

    picked = rows.select(F.col(key).cast("string").alias("k"), F.col(html).alias("h"))
    return picked.mapInPandas(work, "k string, table int, line int, cells array<string>").withColumnRenamed("k", key)


def title(html: Column) -> Column:
    """The page's title without markup, with the basic entities decoded."""
    x = F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)
    for entity, mark in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        x = F.replace(x, F.lit(entity), F.lit(mark))
    return F.trim(x)


def links(html: Column) -> Column:
    """Ordered distinct link targets, in double, single or no quotes, basic entities decoded."""
    found = F.regexp_extract_all(html, F.lit(r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""), 1)
    return F.array_distinct(F.transform(found, lambda x: F.replace(F.trim(F.regexp_replace(x, r"""^["']|["']$""", "")), F.lit("&amp;"), F.lit("&"))))


#: The parts of a reference: scheme, authority, path, query, fragment, each with its mark.
URL_PARTS = r"^([A-Za-z][A-Za-z0-9+.-]*:)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?(#.*)?$"


def url_parts(url: Column) -> dict[str, Column]:
    return {name: F.regexp_extract(url, URL_PARTS, i) for i, name in enumerate(("scheme", "authority", "path", "query", "fragment"), 1)}


def without_dots(segments: Column) -> Column:
    """A path's segments without . and .., as one path that begins with a slash."""
    last = F.element_at(segments, -1)
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda done, s: F.when(s == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))).when(s == ".", done).otherwise(F.array_append(done, s)),
    )
    path = F.array_join(F.when(last.isin(".", ".."), F.array_append(kept, F.lit(""))).otherwise(kept), "/")
    return F.when(F.startswith(path, F.lit("/")), path).otherwise(F.concat(F.lit("/"), path))


def absolute(base: Column, link: Column) -> Column:
    """A link resolved against its page (RFC 3986): other schemes and hosts stand, ?query and #fragment keep the page's path, other
    paths go from the root or from the page's folder, dots are folded, empty segments inside a path go."""
    b, r = url_parts(base), url_parts(link)
    folder = F.split(b["path"], "/")
    folder = F.when(F.element_at(folder, -1) == "", folder).otherwise(F.slice(folder, F.lit(1), F.greatest(F.size(folder) - 1, F.lit(0))))
    folder = F.when(F.size(folder) == 0, F.array(F.lit(""))).otherwise(folder)
    own = F.split(r["path"], "/")
    every = F.when(F.startswith(r["path"], F.lit("/")), own).otherwise(F.concat(folder, own))
    every = F.filter(every, lambda s, i: (s != "") | (i == 0) | (i == F.size(every) - 1))
    root = F.concat(b["scheme"], b["authority"])
    return (
        F.when(link == "", base)
        .when(r["scheme"] != "", link)
        .when(r["authority"] != "", F.concat(b["scheme"], link))
        .when(r["path"] == "", F.concat(root, b["path"], F.when(r["query"] != "", r["query"]).otherwise(b["query"]), r["fragment"]))
        .otherwise(F.concat(root, without_dots(every), r["query"], r["fragment"]))
    )


def listed_page(url: Column, host: str, excluded: list[str], suffix: str) -> Column:
    """A page of the wanted kind: on this host (or none), one path segment of letters, digits and dashes (a suffix segment
    aside) that is none of the excluded ones."""
    parts = url_parts(url)
    steps = F.filter(F.split(parts["path"], "/"), lambda s: s != "")
    steps = F.when(F.element_at(F.array_append(steps, F.lit("")), F.size(steps)) == suffix, F.slice(steps, F.lit(1), F.size(steps) - 1)).otherwise(steps)
    slug = F.lower(F.coalesce(F.get(steps, F.lit(0)), F.lit("")))
    wanted = parts["authority"].isin("", f"//{host}") & (F.size(steps) == 1) & slug.rlike("^[a-z][a-z0-9-]+$") & ~slug.isin(*excluded)
    return F.coalesce(wanted, F.lit(False))


def numeric_id(url: Column) -> Column:
    """The number that ends a page's first path segment, or an empty text."""
    return F.regexp_extract(url_parts(url)["path"], r"^/*[^/]*-(\d+)(?:/|$)", 1)


def before_marker(text: Column, markers: list[str]) -> Column:
    """The text up to the first of the markers."""
    for m in markers:
        text = F.split_part(text, F.lit(m), F.lit(1))
    return text


def first_per_year(rows: DataFrame, series: str, year: str, position: str, least: int, most: int) -> DataFrame:
    """The first entry of each series and year inside the years."""
    w = Window.partitionBy(series, year).orderBy(position)
    picked = rows.where(F.col(year).between(least, most)).select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"), F.row_number().over(w).alias("n"))
    return picked.where("n = 1").select("row.*")


def cells_to_record(cells: Column) -> Column:
    """The first percentage, the nearest 5-7 digit price before it, and the cells before that by position."""
    at = F.coalesce(F.array_min(F.filter(F.transform(cells, lambda c, i: F.when(c.rlike(r"^\d+(\.\d+)?%$"), i)), lambda i: i.isNotNull())), F.lit(-1))
    ahead = F.slice(cells, F.lit(1), F.greatest(at, F.lit(0)))
    price = F.filter(ahead, lambda c: F.replace(c, F.lit(","), F.lit("")).rlike(r"^\d{5,7}(\.\d+)?$"))
    names = F.filter(ahead, lambda c: ~F.replace(c, F.lit(","), F.lit("")).rlike(r"^\d+(\.\d+)?$"))
    return F.when(
        at >= 0,
        F.struct(
            F.get(names, F.lit(0)).alias("brand"), F.get(names, F.lit(1)).alias("series"), F.get(names, F.lit(2)).alias("model"),
            F.replace(F.try_element_at(price, F.lit(-1)), F.lit(","), F.lit("")).alias("price"), F.regexp_extract(F.get(cells, at), r"([\d.]+)", 1).alias("ratio"),
        ),
    )


def join_continuations(rows: DataFrame, doc: str, line: str, starts: Column, text: str) -> DataFrame:
    """Lines that don't start a record are appended to the one before."""
    number = F.sum(starts.cast("int")).over(Window.partitionBy(doc).orderBy(line).rowsBetween(Window.unboundedPreceding, 0))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct(line, text))), lambda x: x[text])
    return rows.withColumn("record", number).where("record > 0").groupBy(doc, "record").agg(F.array_join(ordered, " ").alias(text))


def kind_of(content: Column) -> Column:
    """Pdf, html or text by the first bytes; PDF tables need a PDF library, which is not there, so their text branch is used."""
    head = F.substring(content.cast("string"), 1, 256)
    return F.when(F.startswith(head, F.lit("%PDF")), "pdf").when(F.lower(head).rlike(r"<(!doctype|html|table)"), "html").otherwise("text")


def text_rows(text: Column, start: str = r"\d+[.、]") -> Column:
    """A document's text cut before every mark that begins a row; rows without content are left out."""
    return F.filter(F.transform(F.split(text, rf"(?={start})"), lambda x: F.trim(F.regexp_replace(x, r"\s+", " "))), lambda x: x != "")


def split_sources(text: Column) -> Column:
    """Ordered distinct entries of a JSON array, or separated by line ends, semicolons or pipes."""
    listed = F.from_json(text, "array<string>")
    parts = F.when(F.startswith(F.trim(text), F.lit("[")), listed).otherwise(F.split(text, r"[\r\n;|]+"))
    return F.array_distinct(F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != ""))


def first_field(*fields: Column) -> Column:
    """The first field that holds something."""
    return F.coalesce(*[F.when(~is_missing(f), F.trim(f)) for f in fields])


def refreshed(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """New values where there are any, old ones elsewhere."""
    n = new.select(key, F.col(value).alias("new"))
    return old.select(key, F.col(value).alias("old")).join(n, key, "full").select(
        key, F.coalesce("new", "old").alias(value), F.when(F.col("new").isNull(), "kept").when(F.col("old").isNull(), "added").otherwise("refreshed").alias("state")
    )


def valid_cache(rows: Column) -> Column:
    """A cached list is valid if some entry has a name, a year and an id of digits."""
    return F.coalesce(F.exists(rows, lambda r: ~is_missing(r["name"]) & r["year"].isNotNull() & r["id"].rlike(r"^\d+$")), F.lit(False))

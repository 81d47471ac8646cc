"""Queries of readers, extraction and writers: what they write or read comes from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.session import load, scratch
from tributary.sources import extract as X
from tributary.sources import sinks as W

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


@query("SELECT CAST(o_custkey AS VARCHAR) AS id, o_orderstatus AS name FROM orders")
def json_rows(spark, sf_dir):
    """A1, A2: an array of objects, or an object with items or data, a file each."""
    path = scratch(spark, "json")
    docs = load(spark, sf_dir, "orders").groupBy((F.col("o_custkey") % 48).alias("file")).agg(F.collect_list(F.struct(F.col("o_custkey").cast("string").alias("id"), F.col("o_orderstatus").alias("name"))).alias("r"))
    k = F.col("file") % 3
    text = F.when(k == 0, F.to_json("r")).when(k == 1, F.to_json(F.struct(F.col("r").alias("items")))).otherwise(F.to_json(F.struct(F.col("r").alias("data"))))
    docs.select(text.alias("value")).repartition(16).write.option("maxRecordsPerFile", 1).text(path)
    return X.read_json_rows(spark, path, "id string, name string")


@query("SELECT CAST((SELECT count(*) FROM orders WHERE o_orderkey % 2 = 0) AS BIGINT) AS n, 'even' AS kind")
def newest_artifact(spark, sf_dir):
    """A1, A3: of three artifacts the newest that is large enough and has rows enough; the last one written has too few."""
    root = scratch(spark, "artifacts")
    orders = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 2 == 0, "even").otherwise("odd").alias("name"))
    for name, part in (("a", orders.where("name = 'odd'")), ("b", orders.where("name = 'even'")), ("c", orders.orderBy("id").limit(5))):
        X.write_artifact(part, f"{root}/{name}")
    rows = X.newest_valid(spark, root, "id long, name string", least_rows=50)
    return rows.agg(F.count(F.lit(1)).alias("n"), F.max("name").alias("kind"))


@query("SELECT CAST(count(*) AS BIGINT) AS n, CAST(5 AS BIGINT) AS recorded, CAST(2 AS BIGINT) AS number FROM orders WHERE o_orderkey % 2 = 0")
def recorded_artifact(spark, sf_dir):
    """Of five recorded artifacts the newest one that is valid, new and large enough; it was written second."""
    root = scratch(spark, "recorded")
    orders = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("name"), F.year("o_orderdate").alias("year"))
    runs = [
        (orders, "2024-01-01"), (orders.where("id % 2 = 0"), "2024-05-03"), (orders.limit(5), "2024-05-06"), (orders.withColumn("name", F.lit("-")), "2024-05-05"), (orders.where("id % 2 = 1"), "2024-05-02")
    ]
    for i, (part, created) in enumerate(runs):
        X.record_artifact(part, root, f"run{i}", created)
    rows = X.newest_recorded(spark, root, "id long, name string, year int", least_rows=50, since="2024-02-01")
    counted = X.manifest(spark, root).agg(F.count(F.lit(1)).alias("recorded"), F.max(F.when(F.col("created") == F.lit("2024-05-03").cast("timestamp"), F.col("number"))).alias("number"))
    return rows.agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(counted), F.lit(True))  # single rows


@query("""WITH t AS (SELECT l_orderkey, list(CAST(l_linenumber AS VARCHAR) ORDER BY l_linenumber, l_partkey) AS a, list(l_returnflag ORDER BY l_linenumber, l_partkey, l_returnflag)[2:] AS b FROM lineitem GROUP BY 1), i AS (SELECT *, unnest(range(1, len(a) + 1)) AS i FROM t)
SELECT l_orderkey, a[i] AS line, coalesce(b[i], '-') AS flag FROM i""")
def transposed_columns(spark, sf_dir):
    """Columns of unequal length to rows."""
    sort = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", F.col(c).cast("string").alias("v")))), lambda x: x["v"])
    o = load(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(sort("l_linenumber").alias("a"), sort("l_returnflag").alias("b"))
    columns = F.create_map(F.lit("line"), F.col("a"), F.lit("flag"), F.slice("b", F.lit(2), F.greatest(F.size("b") - 1, F.lit(0))))
    return o.select("l_orderkey", F.explode(X.transpose(columns)).alias("r")).select("l_orderkey", F.col("r.line").alias("line"), F.col("r.flag").alias("flag"))


@query("SELECT p_partkey, concat(p_name, ': ', p_type, ' / ', p_brand) AS text FROM part")
def restored_spans(spark, sf_dir):
    """Placeholders replaced by a page's own rules."""
    text = F.concat("p_name", F.lit(": <span class='t'></span> / <span class='b'></span>"))
    return load(spark, sf_dir, "part").select("p_partkey", X.restore_spans(text, F.create_map(F.lit("t"), F.col("p_type"), F.lit("b"), F.col("p_brand"))).alias("text"))


@query("""SELECT CAST(o_custkey AS VARCHAR) AS page, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS INT) AS line, concat(o_orderkey, '|', o_orderstatus, '|', 'a < b') AS cells FROM orders""")
def html_tables(spark, sf_dir):
    """The cells of every row of a page's table, the header line first."""
    row = F.concat(F.lit("<tr><td> "), F.col("o_orderkey").cast("string"), F.lit("</td><TD>"), "o_orderstatus", F.lit("</TD><td>a &lt;\n b</td></tr>"))
    pages = load(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", row.alias("r")))).alias("rows"))
    html = F.concat(F.lit("<table><tr><th>h</th></tr>"), F.array_join(F.transform("rows", lambda x: x["r"]), ""), F.lit("</table>"))
    found = X.html_rows(pages.select(F.col("o_custkey").alias("page"), html.alias("html")), "page", "html")
    return found.where("line > 0").select("page", "line", F.array_join("cells", "|").alias("cells"))


@query("""SELECT page_id, contains(html, '</article>') AS cut, length(split_part(split_part(html, '</article>', 1), '<footer', 1)) AS n FROM pages""")
def before_markers(spark, sf_dir):
    """What stands before the first stop marker."""
    head = X.before_marker(F.col("html"), ["</article>", "<footer"])
    return load(spark, sf_dir, "pages").select("page_id", F.contains("html", F.lit("</article>")).alias("cut"), F.length(head).cast("long").alias("n"))


@query("""SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'html' WHEN 1 THEN 'pdf' ELSE 'text' END AS kind FROM pages""")
def content_kinds(spark, sf_dir):
    """A17."""
    k = F.col("page_id") % 3
    content = F.when(k == 0, F.col("html")).when(k == 1, F.concat(F.lit("%PDF-1.7 "), "html")).otherwise(F.concat(F.lit("plain "), "url"))
    return load(spark, sf_dir, "pages").select("page_id", X.kind_of(content.cast("binary")).alias("kind"))


@query("""SELECT o_custkey, CAST(count(*) AS BIGINT) AS n, min(concat(o_orderkey, '. ', o_orderstatus, ' x')) AS first FROM orders GROUP BY o_custkey""")
def text_table_rows(spark, sf_dir):
    """The rows of a document that is text only."""
    line = F.concat(F.col("o_orderkey").cast("string"), F.lit(".  "), "o_orderstatus", F.lit("\n x "))
    docs = load(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_join(F.collect_list(line), "").alias("t"))
    rows = docs.select("o_custkey", F.explode(X.text_rows(F.col("t"), r"(?<!\d)\d+[.、]")).alias("r"))
    return rows.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.min("r").alias("first"))


@query("""SELECT o_custkey, record, string_agg(CASE WHEN o_orderstatus = 'O' THEN concat('O', o_orderkey) ELSE CAST(o_orderkey AS VARCHAR) END, ' ' ORDER BY o_orderkey) AS text FROM
(SELECT *, CAST(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS BIGINT) AS record FROM orders) WHERE record > 0 GROUP BY ALL""")
def continued_lines(spark, sf_dir):
    """Lines that begin no record belong to the one before."""
    text = F.when(F.col("o_orderstatus") == "O", F.concat(F.lit("O"), F.col("o_orderkey").cast("string"))).otherwise(F.col("o_orderkey").cast("string"))
    lines = load(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", text.alias("text"))
    return X.join_continuations(lines, "o_custkey", "o_orderkey", F.startswith("text", F.lit("O")), "text")


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN concat(p_name, '+', p_type) WHEN 1 THEN p_name ELSE '' END AS entries, CASE WHEN p_partkey % 3 = 2 THEN p_brand ELSE p_name END AS name FROM part""")
def manual_sources(spark, sf_dir):
    """Entries in one text, as JSON or behind separators, once each; fields under one of two names."""
    k = F.col("p_partkey") % 3
    text = F.when(k == 0, F.concat("p_name", F.lit(" ;\r\n"), "p_type", F.lit("|"), "p_name")).when(k == 1, F.to_json(F.array("p_name", "p_name")))
    name = X.first_field(F.when(k == 2, " ").otherwise(F.col("p_name")), F.col("p_brand"))
    return load(spark, sf_dir, "part").select("p_partkey", F.array_join(F.coalesce(X.split_sources(text), F.array()), "+").alias("entries"), name.alias("name"))


@query("""SELECT CAST(p_partkey AS VARCHAR) AS id, CASE WHEN p_partkey % 4 = 0 THEN '-' ELSE concat(p_name, ', "', p_type, '"') END AS text FROM part""")
def csv_round_trip(spark, sf_dir):
    """Written as CSV with a mark in front, nothing as '-', quotes doubled; read again."""
    path = scratch(spark, "csv")
    value = F.when(F.col("p_partkey") % 4 != 0, F.concat("p_name", F.lit(', "'), "p_type", F.lit('"')))
    W.write_csv(load(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), value.alias("text")), path, ["id", "text"])
    got = spark.read.option("header", True).option("escape", '"').csv(path)
    return got.toDF("id", "text")


@query("""SELECT p_partkey AS row_id, p_name AS name, CASE WHEN p_partkey % 3 = 0 THEN p_brand ELSE '-' END AS brand FROM part""")
def wide_json(spark, sf_dir):
    """B1: attributes unfolded into columns; missing ones are '-'."""
    path = scratch(spark, "wide")
    pairs = F.when(F.col("p_partkey") % 3 == 0, F.create_map(F.lit("name"), F.col("p_name"), F.lit("brand"), F.col("p_brand"))).otherwise(F.create_map(F.lit("name"), F.col("p_name")))
    W.write_wide(load(spark, sf_dir, "part").select(F.col("p_partkey").alias("row_id"), pairs.alias("attrs")), path, ["name", "brand"])
    return spark.read.schema("row_id long, name string, brand string").json(path)


@query("""SELECT 'first' AS version, 'rows' AS dataset, CAST(count(*) AS BIGINT) AS n FROM part UNION ALL SELECT 'second', 'rows', CAST(count(*) AS BIGINT) FROM part WHERE p_size > 10 UNION ALL SELECT 'second', 'stats', CAST(1 AS BIGINT)""")
def published_assets(spark, sf_dir):
    """Two runs of several datasets; readers follow the newest complete version."""
    root, part = scratch(spark, "assets"), load(spark, sf_dir, "part")
    size = lambda version, name: W.read_asset(spark, root, name).agg(F.count(F.lit(1)).alias("n")).select(F.lit(version).alias("version"), F.lit(name).alias("dataset"), "n")
    W.write_assets({"rows": part, "stats": part.agg(F.count(F.lit(1)).alias("n"))}, root)
    first = size("first", "rows")
    W.write_assets({"rows": part.where("p_size > 10"), "stats": part.agg(F.max("p_size").alias("n"))}, root)
    return first.unionByName(size("second", "rows")).unionByName(size("second", "stats"))

"""Queries of the interactive path: predicates, search, sorting, groups and headers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.functions import scalars as S
from tributary.model import to_attrs
from tributary.operators import headers as H
from tributary.operators import query as Q
from tributary.plans.derived import SPREAD, build, text
from tributary.session import load

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
SPREAD_SQL = text(SPREAD)


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build(spark, sf_dir, SPREAD)


@query(f"""WITH s AS ({SPREAD_SQL}) SELECT row_id, sizes FROM s
WHERE len(list_filter(regexp_extract_all(sizes, '(\\d+(?:\\.\\d+)?)'), lambda x: CAST(x AS DOUBLE) >= 40)) > 0
AND len(list_filter(regexp_extract_all(sizes, '(\\d+(?:\\.\\d+)?)'), lambda x: CAST(x AS DOUBLE) <= 45)) > 0""")
def range_filter_any(spark, sf_dir):
    return spread(spark, sf_dir).where(Q.in_range(F.col("sizes"), 40, 45)).select("row_id", "sizes")


@query(f"""WITH s AS ({SPREAD_SQL}) SELECT row_id, width FROM s
WHERE CAST(nullif(regexp_extract(width, '(\\d+(?:\\.\\d+)?)', 1), '') AS DOUBLE) BETWEEN 10 AND 20""")
def range_filter_first(spark, sf_dir):
    return spread(spark, sf_dir).where(Q.in_range(F.col("width"), 10, 20, "first")).select("row_id", "width")


# Attributes by the row's number: what a name alone, a keyword alone, both or neither make of a row, with and without a positive value.
FITTED = [
    {"x": "激光雷达"}, {"雷达": "-", "y": "前激光"}, {"雷达": "有"}, {"前雷达": "无", "备注": "无"}, {"雷": "支持"}, {"其他": "无激光"}, {"雷达": "激光"}, {"雷达": "0", "z": "0.0"}, {"x": "-"},
]


def _fitting(number):
    return F.coalesce(*[F.when(number % len(FITTED) == i, F.create_map(*[F.lit(t) for kv in a.items() for t in kv])) for i, a in enumerate(FITTED)])


def _fitted(spark, sf_dir):
    return load(spark, sf_dir, "part").select(F.col("p_partkey").alias("row_id"), _fitting(F.col("p_partkey")).alias("attrs"))


@query("SELECT p_partkey AS row_id FROM part WHERE p_partkey % 9 IN (0, 1, 2, 4, 5, 6)")
def feature_filter(spark, sf_dir):
    """A positive value under a name like the field's, or with the keyword under any name."""
    return _fitted(spark, sf_dir).where(Q.has_feature(F.col("attrs"), Q.Feature(("雷达",), ("激光",)))).select("row_id")


@query(f"""WITH s AS ({SPREAD_SQL}) SELECT row_id FROM s WHERE row_id % 9 IN (0, 1, 5, 6) OR contains(width, '1') OR contains(width, 'ring') OR contains(model, '1') OR contains(model, 'ring')""")
def feature_filter_keyword(spark, sf_dir):
    """A required keyword counts alone, under any name; widths and names are those of the table."""
    df = spread(spark, sf_dir).withColumn("attrs", F.map_concat(_fitting(F.col("row_id")), F.create_map(F.lit("width"), "width", F.lit("model"), "model")))
    return Q.run(df, Q.QuerySpec(features=(Q.Feature(("雷达",), ("激光", "1", "ring"), True),))).select("row_id")


@query("SELECT p_partkey AS row_id FROM part WHERE contains(lower(p_name), 'ring') OR contains(lower(p_brand), 'ring') OR contains(lower(p_type), 'ring')")
def global_search(spark, sf_dir):
    df = to_attrs(load(spark, sf_dir, "part").select(F.col("p_partkey").alias("row_id"), "p_name", "p_brand", "p_type"), ["p_name", "p_brand", "p_type"])
    return Q.run(df, Q.QuerySpec(search="RING")).select("row_id")


@query(f"""WITH s AS ({SPREAD_SQL}), x AS (SELECT *, CAST(nullif(regexp_extract(width, '(\\d+(?:\\.\\d+)?)', 1), '') AS DOUBLE) AS w FROM s)
SELECT row_id FROM x WHERE contains(lower(model), 'bolt') AND w >= 5 AND w <= 30""")
def column_ops(spark, sf_dir):
    df = spread(spark, sf_dir).withColumn("attrs", F.create_map(F.lit("width"), F.col("width")))
    return Q.run(df, Q.QuerySpec(columns=(("model", "contains", "Bolt"), ("width", "gte", "5"), ("width", "lte", "30")))).select("row_id")


@query("SELECT p_partkey FROM part WHERE p_type IN ('SMALL', 'LARGE') AND NOT contains(p_brand, '#1')")
def default_row_type(spark, sf_dir):
    return load(spark, sf_dir, "part").where(Q.default_rows(F.col("p_type"), F.col("p_brand"), ["SMALL", "LARGE"], ["#1"])).select("p_partkey")


@query("""SELECT p_partkey, place FROM (SELECT p_partkey, row_number() OVER (ORDER BY p_size DESC, regexp_replace(p_name, '', ''), p_partkey) AS place FROM part) WHERE place BETWEEN 51 AND 100""")
def multi_level_sort_page(spark, sf_dir):
    df = load(spark, sf_dir, "part").select(F.col("p_partkey").alias("ordinal"), "p_partkey", "p_size", "p_name", F.create_map().cast("map<string,string>").alias("attrs"))
    spec = Q.QuerySpec(sort=(Q.SortLevel("p_size", True), Q.SortLevel("p_name")), page=2, page_size=50)
    return Q.page(df, spec).select("p_partkey", F.col("place").cast("long").alias("place"))


@query("""WITH n AS (SELECT l_orderkey, l_linenumber, row_number() OVER (ORDER BY l_quantity DESC, l_orderkey * 10 + l_linenumber) AS place, count(*) OVER () AS total FROM lineitem)
SELECT l_orderkey, l_linenumber, place FROM n WHERE place > (total - 1) // 37 * 37""")
def last_page(spark, sf_dir):
    """The last page of a long result, from the ranges that hold it."""
    df = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ordinal"), F.create_map().cast("map<string,string>").alias("attrs"))
    view = Q.SortedView(df, Q.QuerySpec(sort=(Q.SortLevel("l_quantity", True),), page_size=37))
    return view.page(view.pages).select("l_orderkey", "l_linenumber", F.col("place").cast("long").alias("place"))


@query("""SELECT p_partkey, CAST(CASE WHEN contains(p_type, 'PROMO') THEN 0 WHEN contains(p_type, 'LARGE') THEN 1 ELSE 2 END AS INT) AS keyword_rank FROM part""")
def custom_order_sort(spark, sf_dir):
    return load(spark, sf_dir, "part").select("p_partkey", Q.keyword_rank(F.col("p_type"), ("PROMO", "LARGE")).cast("int").alias("keyword_rank"))


@query("""SELECT source, CAST(row_number() OVER (ORDER BY CAST(regexp_extract(source, '(\\d+)', 1) AS INT)) AS BIGINT) AS place FROM (SELECT DISTINCT source FROM documents)""")
def natural_sort(spark, sf_dir):
    from pyspark.sql import Window

    values = Q.facet(load(spark, sf_dir, "documents"), "source")  # one row per facet value is ranked
    return values.select(F.col("value").alias("source"), F.row_number().over(Window.orderBy("sort_key")).cast("long").alias("place"))


@query("""SELECT p_brand, CAST(count(*) AS BIGINT) AS n, arg_min(p_partkey, (p_retailprice, p_partkey)) AS representative, min(p_retailprice) AS price FROM part GROUP BY p_brand""")
def series_groups_price_rep(spark, sf_dir):
    df = load(spark, sf_dir, "part").select("p_brand", F.col("p_partkey").alias("row_id"), F.col("p_partkey").alias("ordinal"), F.col("p_retailprice").cast("decimal(12,2)").cast("string").alias("price"))
    return Q.group_rows(df, ["p_brand"], "price")


@query(f"""WITH s AS ({SPREAD_SQL}), v AS (SELECT DISTINCT brand, n FROM s WHERE row_id % 5 <> 0), x AS (SELECT DISTINCT brand FROM s WHERE row_id % 5 = 0),
r AS (SELECT brand, count(*) AS c, min(n) AS lo, max(n) + 7 AS hi FROM v GROUP BY brand)
SELECT brand, CASE WHEN c = 1 AND brand NOT IN (SELECT brand FROM x) THEN concat(lo, '万|A:', lo + 7, '.5万') ELSE concat(lo, '-', hi, '.5万') END AS summary FROM r
UNION ALL SELECT brand, '999' FROM x WHERE brand NOT IN (SELECT brand FROM v)""")
def group_summary(spark, sf_dir):
    """Ranges of all parts with their unit; 999 stands for nothing, unless it is all there is."""
    x = F.when(F.col("row_id") % 5 == 0, "999").otherwise(F.concat("n", F.lit("万|A:"), F.col("n") + 7, F.lit(".5万")))
    return Q.summary(spread(spark, sf_dir).withColumn("x", x), ["brand"], "x")


@query(f"""WITH s AS ({SPREAD_SQL}) SELECT row_id, CASE row_id % 3 WHEN 0 THEN '纯电动/汽油' WHEN 1 THEN '插电式混合动力' ELSE '-5' END AS summary FROM s WHERE row_id % 3 < 2""")
def label_summary(spark, sf_dir):
    """Values that are no numbers, under their usual names."""
    k = F.col("row_id") % 3
    x = F.when(k == 0, F.array(F.lit("A:纯电/汽油"), F.lit("纯电动"))).when(k == 1, F.array(F.lit(" A:插电混合 "))).otherwise(F.array(F.lit("-")))
    rows = spread(spark, sf_dir).select("row_id", F.posexplode(x).alias("ordinal", "x"))
    return Q.summary(rows, ["row_id"], "x")


@query("SELECT p_brand AS value, CAST(count(*) AS BIGINT) AS n FROM part GROUP BY p_brand")
def facets(spark, sf_dir):
    return Q.facet(load(spark, sf_dir, "part"), "p_brand").select("value", "n")


@query("""SELECT CAST(sum(CASE WHEN p_size > 25 THEN 1 ELSE 0 END) AS BIGINT) AS visible, CAST(count(*) AS BIGINT) AS total,
CAST(sum(CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS verified, CAST(count(*) AS BIGINT) AS "from_A", CAST(sum(CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS "from_B" FROM part""")
def result_counters(spark, sf_dir):
    df = load(spark, sf_dir, "part")
    sources = F.when(F.col("p_partkey") % 3 == 0, F.array(F.lit("A"), F.lit("B"))).otherwise(F.array(F.lit("A")))
    return Q.counters(df, F.col("p_size") > 25, sources, ["A", "B"])


@query("""SELECT o_orderkey, CAST(row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS INT) AS turn FROM orders""")
def round_robin_rank(spark, sf_dir):
    return Q.round_robin(load(spark, sf_dir, "orders"), "o_orderpriority", [F.desc("o_totalprice"), F.col("o_orderkey")]).select("o_orderkey", "turn")


@query("""SELECT l_returnflag, l_linestatus, l_orderkey, l_linenumber, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS INT) AS rank FROM lineitem) WHERE rank <= 10""")
def top_k_quota(spark, sf_dir):
    order = [F.desc("l_extendedprice"), F.col("l_orderkey"), F.col("l_linenumber")]
    return Q.top_per_group(load(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], order, 10).select("l_returnflag", "l_linestatus", "l_orderkey", "l_linenumber", "rank")


@query("""WITH c AS (SELECT 'brand' AS key, p_brand AS value, count(*) AS n FROM part GROUP BY p_brand UNION ALL SELECT 'type', p_type, count(*) FROM part GROUP BY p_type
UNION ALL SELECT 'size', CAST(p_size AS VARCHAR), count(*) FROM part GROUP BY p_size)
SELECT key, value, CAST(n AS BIGINT) AS n, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY key ORDER BY n DESC, value) AS INT) AS rank FROM c) WHERE rank <= 5""")
def column_profile(spark, sf_dir):
    df = load(spark, sf_dir, "part").select(F.col("p_partkey").alias("row_id"), F.col("p_brand").alias("brand"), F.col("p_type").alias("type"), F.col("p_size").alias("size"))
    return H.profile(to_attrs(df, ["brand", "type", "size"]))


VARIANT = "CASE WHEN o_orderkey % 3 = 0 THEN lower(o_orderpriority) WHEN o_orderkey % 3 = 1 THEN concat(' ', o_orderpriority) ELSE o_orderpriority END"


@query(f"""WITH v AS (SELECT {VARIANT} AS value FROM orders), c AS (SELECT value, count(*) AS n FROM v GROUP BY value)
SELECT 'priority' AS key, lower(trim(value)) AS canonical, CAST(count(*) AS BIGINT) AS spellings, CAST(sum(n) AS BIGINT) AS n FROM c GROUP BY 2 HAVING count(*) > 1""")
def enum_variants(spark, sf_dir):
    df = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("row_id"), F.expr(VARIANT).alias("priority"))
    return H.value_variants(to_attrs(df, ["priority"]))


@query(f"""WITH s AS ({SPREAD_SQL}) SELECT row_id, 'width(mm)' AS name, width AS value FROM s WHERE width NOT IN ('-', '无')
UNION ALL SELECT row_id, 'model', model FROM s""")
def header_alias(spark, sf_dir):
    df = spread(spark, sf_dir).select("row_id", F.col("width").alias("宽度_mm_"), F.col("model").alias("title"))
    return H.rename_headers(to_attrs(df, ["宽度_mm_", "title"], drop_missing=False), {"宽度(mm)": "width(mm)", "title": "model"})


HEADERS = "CASE p_partkey % 10 WHEN 0 THEN ' w[mm]' WHEN 1 THEN 'w_mm_' WHEN 2 THEN 'w（mm）' WHEN 3 THEN 'x_v4_a b' WHEN 4 THEN '油耗_L_100km_' WHEN 5 THEN '加速[s]' WHEN 6 THEN 'a—b' WHEN 7 THEN '转矩[N·m]' WHEN 8 THEN 'w_mm' ELSE 'v_kWh_100km_' END"


@query("""SELECT p_partkey AS row_id, CASE p_partkey % 10 WHEN 3 THEN 'X' WHEN 4 THEN '油耗(L/100km)' WHEN 5 THEN '零到百(s)' WHEN 6 THEN 'a-b' WHEN 7 THEN '转矩(N·m)' WHEN 8 THEN 'w_mm' WHEN 9 THEN 'v(kWh/100km)' ELSE 'w(mm)' END AS name FROM part""")
def unit_header(spark, sf_dir):
    return load(spark, sf_dir, "part").select(F.col("p_partkey").alias("row_id"), H.header(F.expr(HEADERS), {"加速(s)": "零到百(s)", "x_v4": "X"}).alias("name"))


@query("""SELECT p_partkey AS row_id, CASE p_partkey % 10 WHEN 3 THEN 'X' WHEN 4 THEN '油耗(L/100km)' WHEN 5 THEN '零到百(s)' WHEN 6 THEN 'a-b' WHEN 7 THEN 'torque' WHEN 8 THEN 'W' WHEN 9 THEN 'v(kWh/100km)' ELSE 'w(mm)' END AS name FROM part""")
def audited_header(spark, sf_dir):
    """Only headers that needed care, or are audited, use the alias table."""
    name = H.audited_header(F.expr(HEADERS), {"加速(s)": "零到百(s)", "x_v4": "X", "w_mm": "W"}, ("w_mm",), {"转矩[N·m]": "torque"})
    return load(spark, sf_dir, "part").select(F.col("p_partkey").alias("row_id"), name.alias("name"))


@query("""SELECT p_partkey AS row_id, 'X' AS source, CASE WHEN p_partkey % 3 = 0 THEN '比亚迪' ELSE p_brand END AS brand, CASE WHEN p_partkey % 2 = 0 THEN '2021' ELSE '2024' END AS year, CASE p_partkey % 4 WHEN 0 THEN '9万' WHEN 1 THEN concat(p_size, '万') ELSE '-' END AS price,
CASE WHEN p_partkey % 5 = 0 THEN p_name WHEN p_name = p_type THEN p_name ELSE concat(p_name, '|', p_type) END AS width FROM part""")
def source_rules(spark, sf_dir):
    """One source's own rules for years, prices, brands and headers."""
    k = F.col("p_partkey")
    attrs = F.create_map(F.lit("宽[mm]"), F.col("p_name"), F.lit("宽_mm_"), F.when(k % 5 == 0, "-").otherwise(F.col("p_type")), F.lit("厂商指导价_元_"), F.when(k % 4 == 0, "9万").otherwise("暂无"))
    rows = load(spark, sf_dir, "part").select(
        k.alias("row_id"), F.when(k % 3 == 0, "-").otherwise(F.col("p_brand")).alias("brand"), F.when(k % 3 == 0, F.concat(F.lit("新比亚迪"), "p_type")).otherwise(F.col("p_type")).alias("series"),
        F.when(k % 2 == 0, "").otherwise("2024").alias("year"), F.concat("p_name", F.lit(" 2021款")).alias("model"), F.when(k % 4 == 1, F.concat("p_size", F.lit("万"))).otherwise("暂无报价").alias("price"), attrs.alias("attrs"),
    )
    out = H.normalise_source(rows, H.SourceRules("X", "厂商指导价_元_", ("比亚迪",), {"宽(mm)": "width"}))
    return out.select("row_id", "source", "brand", "year", "price", F.col("attrs")["width"].alias("width"))


@query("""SELECT p_partkey AS row_id, 'type' AS name, p_type AS value FROM part WHERE p_type IN ('ECONOMY', 'PROMO')
UNION ALL SELECT p_partkey, 'brand', p_brand FROM part""")
def onehot_fold(spark, sf_dir):
    flag = lambda v: F.when(F.col("p_type") == v, "支持").otherwise("无").alias(f"type - {v}")
    df = load(spark, sf_dir, "part").select(F.col("p_partkey").alias("row_id"), flag("ECONOMY"), flag("PROMO"), F.col("p_brand").alias("brand"))
    return H.fold_one_hot(to_attrs(df, ["type - ECONOMY", "type - PROMO", "brand"], drop_missing=False))


@query("""SELECT p_partkey AS row_id, 'pack' AS key, concat('{"1":"', p_name, '","2":"', p_type, '"}') AS value FROM part
UNION ALL SELECT p_partkey, 'same_1', p_brand FROM part UNION ALL SELECT p_partkey, 'same_2', p_brand FROM part""")
def package_fold(spark, sf_dir):
    df = load(spark, sf_dir, "part").select(F.col("p_partkey").alias("row_id"), F.col("p_name").alias("pack_1"), F.col("p_type").alias("pack_2"), F.col("p_brand").alias("same_1"), F.col("p_brand").alias("same_2"))
    return H.fold_packages(to_attrs(df, ["pack_1", "pack_2", "same_1", "same_2"]))


@query("""SELECT p_partkey, CAST(p_size AS DOUBLE) AS length, CAST(p_size + 1 AS DOUBLE) AS width, CAST(p_size * 2 AS DOUBLE) AS height FROM part""")
def derived_dimensions(spark, sf_dir):
    x = F.concat_ws("*", F.col("p_size").cast("string"), (F.col("p_size") + 1).cast("string"), (F.col("p_size") * 2).cast("string"))
    d = H.dimensions(x)
    return load(spark, sf_dir, "part").select("p_partkey", d[0].alias("length"), d[1].alias("width"), d[2].alias("height"))


@query("SELECT 'size(mm)' AS key, 'size' AS base")
def fold_duplicate_columns(spark, sf_dir):
    df = load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("row_id"), F.col("p_size").alias("size"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_size")).alias("size(mm)"),
        F.col("p_brand").alias("brand"), F.col("p_name").alias("brand(name)"),
    )
    return H.foldable_columns(to_attrs(df, ["size", "size(mm)", "brand", "brand(name)"]))


DIAGNOSED = {
    "brand": "p_brand", "type - ECONOMY": "p_type", "laser_radar_v4_有": "p_name", "battery_brand_v4": "p_name", "seat_v2": "p_name", "seat_v2_Nappa Leather": "p_name",
    "座椅(真皮)": "p_name", "宽度(mm)": "p_size", "专属套装(甲)": "p_name", "易车状态": "p_type", "运动套件": "p_type", "NOMI Mate 3.0_1": "p_name", "NOMI Mate 3.0_2": "p_type",
    "包_1": "p_name", "包_2": "p_type", "灯_3": "p_name", "X_v4": "p_name", "DRIVE Orin": "p_brand", "a_灯_b": "p_name",
}
DIAGNOSES = """(VALUES ('type - ECONOMY', 'attribute_value_header', 0.99, 'type', 'ECONOMY'), ('laser_radar_v4_有', 'attribute_value_header', 0.99, '激光雷达', '有'),
('battery_brand_v4', 'noncanonical_attribute_header', 0.9, '电池品牌', NULL), ('seat_v2_Nappa Leather', 'v2v3_value_header', 0.8, 'seat_v2', 'Nappa Leather'), ('seat_v2', 'value_only_header', 0.95, NULL, NULL),
('座椅(真皮)', 'attribute_value_header', 0.95, '座椅', '真皮'), ('专属套装(甲)', 'value_only_header', 0.9, NULL, NULL), ('易车状态', 'value_only_header', 0.98, NULL, NULL), ('运动套件', 'value_only_header', 0.92, NULL, NULL),
('NOMI Mate 3.0_1 / NOMI Mate 3.0_2', 'package_value_header', 0.9, '选装包列表', '_1=描述, _2=状态'), ('包_1 / 包_2', 'package_pair_header', 0.96, '选装包列表', '_1=描述, _2=状态'), ('灯_3', 'numeric_suffix_header', 0.72, '灯', '3'),
('X_v4', 'unmapped_v4_header', 0.55, NULL, NULL), ('DRIVE Orin', 'bare_value_header', 0.45, NULL, NULL), ('a_灯_b', 'attribute_value_header', 0.85, 'a/灯/b', NULL)) AS k(column_name, kind, confidence, attribute, value)"""


def _diagnosed(spark, sf_dir):
    df = load(spark, sf_dir, "part").select(F.col("p_partkey").alias("row_id"), *[F.col(c).alias(k) for k, c in DIAGNOSED.items()])
    return to_attrs(df, list(DIAGNOSED))


@query(f"""SELECT column_name, kind, CAST(confidence AS DOUBLE) AS confidence, attribute, value, CAST((SELECT count(*) FROM part) AS BIGINT) AS occurrences FROM {DIAGNOSES}""")
def diagnose_columns(spark, sf_dir):
    """Every kind of header that holds a value; the quota of a kind is 15 here."""
    found = H.diagnose(_diagnosed(spark, sf_dir), 120)
    return found.select(F.col("column").alias("column_name"), "kind", F.col("confidence").cast("double").alias("confidence"), "attribute", "value", "occurrences")


@query("""SELECT key, CAST((SELECT count(*) FROM part) AS BIGINT) AS n FROM (VALUES ('brand')) AS k(key)""")
def target_attributes(spark, sf_dir):
    return H.target_attributes(_diagnosed(spark, sf_dir))


@query(f"""WITH s AS ({SPREAD_SQL}) SELECT 'sizes' AS key, CAST(count(*) AS BIGINT) AS n FROM s""")
def pipe_columns(spark, sf_dir):
    """C14."""
    return H.pipe_columns(to_attrs(spread(spark, sf_dir), ["sizes", "width", "brand"]))


@query("""SELECT p_partkey, p_partkey % 3 = 0 AS twice FROM part""")
def year_twice(spark, sf_dir):
    """C14: some names have their own year, some another, some none."""
    k, year = F.col("p_partkey"), (2015 + F.col("p_partkey") % 10).cast("string")
    name = F.when(k % 3 == 0, F.concat("p_name", F.lit(" "), year, F.lit("款"))).when(k % 3 == 1, F.concat(F.lit("1999款 "), "p_name")).otherwise(F.col("p_name"))
    return load(spark, sf_dir, "part").select("p_partkey", H.year_twice(name, year).alias("twice"))


@query("""SELECT key, CAST(CASE key WHEN 'width' THEN (SELECT count(*) FROM part WHERE p_partkey % 9 <> 0 AND p_partkey % 4 <> 0) ELSE (SELECT count(*) FROM part) END AS BIGINT) AS positive, CAST(place AS BIGINT) AS place
FROM (VALUES ('brand', 1), ('width', 2), ('same', 2), ('选装包列表', 2)) AS k(key, place)""")
def visible_columns(spark, sf_dir):
    df = spread(spark, sf_dir).select(
        "row_id", "width", F.lit("x").alias("same"), "brand", F.lit("x").alias("gone"), F.col("model").alias("dull"), F.col("brand").alias("包_1"), F.col("model").alias("包_2"),
        F.lit('{"甲": "1"}').alias("选装包列表"), F.lit("x").alias("甲_1"),
    )
    columns = [c for c in df.columns if c != "row_id"]
    return H.visible_columns(to_attrs(df, columns, drop_missing=False), ["brand"], ("gone", "brand"), ("dull", "width"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN CAST(p_size AS VARCHAR) END AS length, CASE WHEN p_partkey % 3 = 0 THEN CAST(p_size + 1 AS VARCHAR) WHEN p_partkey % 3 = 2 THEN '7' END AS width, CASE WHEN p_partkey % 3 = 0 THEN '5.5' END AS height FROM part""")
def dimension_columns(spark, sf_dir):
    """C11: three attributes of one, where they lack."""
    k, n = F.col("p_partkey") % 3, F.col("p_size")
    size = F.concat_ws("*", n.cast("string"), (n + 1).cast("string"), F.lit("5.5mm"))
    attrs = F.when(k == 0, F.create_map(F.lit("长*宽*高 (mm)"), size)).when(k == 1, F.create_map(F.lit("尺寸"), size)).otherwise(F.create_map(F.lit("车身尺寸"), F.lit("1*2"), F.lit("宽度(mm)"), F.lit("7")))
    df = load(spark, sf_dir, "part").select("p_partkey", H.with_dimensions(attrs).alias("a"))
    return df.select("p_partkey", *[F.col("a")[c].alias(x) for c, x in (("长度(mm)", "length"), ("宽度(mm)", "width"), ("高度(mm)", "height"))])


CANON = "CASE p_partkey % 9 WHEN 0 THEN '标 配' WHEN 1 THEN ' 有 ' WHEN 2 THEN '无' WHEN 3 THEN '--' WHEN 4 THEN concat(' ', p_name, ' ') WHEN 5 THEN '选配' WHEN 6 THEN '不支持' WHEN 7 THEN '否' ELSE '' END"


@query("""SELECT p_partkey, CASE p_partkey % 9 WHEN 0 THEN '支持' WHEN 1 THEN '支持' WHEN 4 THEN p_name WHEN 5 THEN '选装' WHEN 7 THEN '否' ELSE '-' END AS canonical FROM part""")
def canonical_value(spark, sf_dir):
    return load(spark, sf_dir, "part").select("p_partkey", S.canonical_value(F.expr(CANON)).alias("canonical"))


COMPARED = """CASE p_partkey % 12 WHEN 0 THEN concat(CAST(p_size AS STRING), '.80 mm') WHEN 1 THEN '2020-5-1' WHEN 2 THEN concat(CAST(p_size AS STRING), '*2×3') WHEN 3 THEN p_name WHEN 4 THEN '2020.05' WHEN 5 THEN ' 电子 换挡'
WHEN 6 THEN '7挡双离合变速箱' WHEN 7 THEN concat(CAST(p_size AS STRING), '万元') WHEN 8 THEN concat(CAST(p_size AS STRING), ' L x') WHEN 9 THEN '' WHEN 10 THEN concat('x', CAST(p_size AS STRING), '公里') ELSE '标配' END"""
FIELD = "CASE WHEN p_partkey % 12 IN (1, 4) THEN '上市时间' WHEN p_partkey % 12 IN (5, 6) THEN '换挡形式' ELSE '其他' END"


@query("""SELECT p_partkey, CASE p_partkey % 12 WHEN 0 THEN concat('num:', p_size, '.80') WHEN 1 THEN 'date:2020-05-01' WHEN 2 THEN concat('dims:', p_size, 'x2x3') WHEN 3 THEN p_name WHEN 4 THEN 'date:2020-05' WHEN 5 THEN 'shift:电子'
WHEN 6 THEN 'shift:7挡双离合' WHEN 7 THEN concat('num:', p_size) WHEN 8 THEN concat(p_size, ' L x') WHEN 9 THEN '' WHEN 10 THEN concat('x', p_size, '公里') ELSE '支持' END AS compare FROM part""")
def canonical_compare(spark, sf_dir):
    return load(spark, sf_dir, "part").select("p_partkey", S.canonical_compare(F.expr(COMPARED), F.expr(FIELD)).alias("compare"))


@query("""SELECT o_orderkey, (o_orderkey % 3 <> 2) AND month(o_orderdate) = month(o_orderdate + INTERVAL 5 DAY) AND year(o_orderdate) = year(o_orderdate + INTERVAL 5 DAY) AS folds FROM orders""")
def date_fold(spark, sf_dir):
    a = F.date_format("o_orderdate", "yyyy-MM-dd")
    later = F.date_add(F.col("o_orderdate").cast("date"), 5)
    b = F.when(F.col("o_orderkey") % 3 == 2, F.date_format(later, "yyyy.MM.dd")).otherwise(F.date_format(later, "yyyy.MM"))
    return load(spark, sf_dir, "orders").select("o_orderkey", S.dates_fold(a, b).alias("folds"))


@query("""SELECT o_orderkey, make_date(CAST(year(o_orderdate) AS BIGINT), CAST(month(o_orderdate) AS BIGINT), least(28, CAST(day(o_orderdate) AS BIGINT))) <= DATE '1996-06-15' AS listed FROM orders""")
def listing_date_valid(spark, sf_dir):
    x = F.concat(F.lit("上市 "), F.date_format("o_orderdate", "yyyy年M月d日"))
    return load(spark, sf_dir, "orders").select("o_orderkey", S.listed_by(x, F.lit("1996-06-15").cast("date")).alias("listed"))


@query("""SELECT p_partkey, upper(p_brand) AS prefix, CASE WHEN p_brand LIKE 'Brand#1%' AND length(p_brand) > 7 THEN 'Brand#1' ELSE 'Brand' END AS derived FROM part""")
def derive_brand(spark, sf_dir):
    name = F.concat("p_brand", F.lit(" "), "p_name")
    long = F.when(F.length("p_brand") > 7, F.regexp_replace(name, "^Brand#1(?=\\d)", "Brand#1 ")).otherwise(F.regexp_replace(name, "#", " "))
    return load(spark, sf_dir, "part").select("p_partkey", F.upper("p_brand").alias("prefix"), S.longest_prefix(long, ["Brand", "Brand#1"]).alias("derived"))


CONDITIONS = [
    {"id": "n", "type": "range", "field": "sizes", "defaultMin": 10, "defaultMax": 30},
    {"id": "width", "type": "feature", "fields": ["width"], "defaultEnabled": True},
    {"id": "model", "type": "feature", "fields": ["model"], "keywords": ["ring"], "requireKeyword": True, "defaultEnabled": False},
]


@query(f"WITH s AS ({SPREAD_SQL}) SELECT row_id FROM s WHERE n BETWEEN 10 AND 30 AND width NOT IN ('-', '无')")
def default_view(spark, sf_dir):
    df = to_attrs(spread(spark, sf_dir), ["sizes", "width", "model"], drop_missing=False)
    return Q.run(df, Q.restore(Q.snapshot(Q.default_spec(CONDITIONS))[0])).select("row_id")


@query(f"WITH s AS ({SPREAD_SQL}) SELECT row_id FROM s WHERE n + 7 >= 20 AND width NOT IN ('-', '无')")
def batch_view(spark, sf_dir):
    """The batch filter takes any number and bounds that are no defaults, and nothing that is meant for pages."""
    conditions = [
        {"type": "range", "field": "sizes", "min": 20, "defaultMax": 25}, {"type": "range", "field": "width", "defaultMin": "900"},
        {"type": "feature", "fields": ["width"], "defaultEnabled": False}, {"type": "pagesFeature", "fields": ["nothing"]},
    ]
    df = to_attrs(spread(spark, sf_dir), ["sizes", "width", "model"], drop_missing=False)
    return Q.run(df, Q.batch_spec(conditions), mode="batch").select("row_id")


@query("""SELECT p_partkey FROM part ORDER BY p_size DESC, p_partkey LIMIT 48""")
def more_groups(spark, sf_dir):
    """The same view asked for again shows 24 more; another one begins again."""
    df = load(spark, sf_dir, "part").select(F.col("p_partkey").alias("ordinal"), "p_partkey", "p_size", F.create_map().cast("map<string,string>").alias("attrs"))
    spec = Q.QuerySpec(sort=(Q.SortLevel("p_size", True),))
    _, other = Q.first_groups(df, Q.QuerySpec())
    _, state = Q.first_groups(df, spec, other)
    return Q.first_groups(df, spec, state)[0].select("p_partkey")


@query("""SELECT p_partkey AS row_id, 'class' AS key, 'cheap' AS value FROM part WHERE p_type = 'ECONOMY' UNION ALL SELECT p_partkey, 'brand', p_brand FROM part""")
def alias_injection(spark, sf_dir):
    df = load(spark, sf_dir, "part").select(F.col("p_partkey").alias("row_id"), F.when(F.col("p_type") == "ECONOMY", "有").otherwise("无").alias("eco"), F.col("p_brand").alias("brand"))
    return H.inject(to_attrs(df, ["eco", "brand"], drop_missing=False), {"eco": ("class", "cheap")})


@query(f"""SELECT column_name, 'hide' AS action, CAST(NULL AS VARCHAR) AS target, CAST((SELECT count(*) FROM part) AS BIGINT) AS occurrences FROM {DIAGNOSES} WHERE kind = 'value_only_header'
UNION ALL SELECT column_name, 'alias', attribute, CAST((SELECT count(*) FROM part) AS BIGINT) FROM {DIAGNOSES} WHERE kind = 'attribute_value_header' AND confidence >= 0.9 AND attribute IN ('type', '座椅')""")
def apply_diagnosis(spark, sf_dir):
    targets = load(spark, sf_dir, "region").where("r_regionkey < 2").select(F.when(F.col("r_regionkey") == 0, "type").otherwise("座椅").alias("key"))
    return H.apply_diagnosis(H.suspects(_diagnosed(spark, sf_dir)), targets).withColumnRenamed("column", "column_name")

"""Queries of text, number and identity scalars, and of small rules on rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.functions import features as E
from tributary.functions import scalars as S
from tributary.operators import fuse as U
from tributary.operators import headers as H
from tributary.operators import quality as G
from tributary.operators import query as Q
from tributary.operators import resolve as R
from tributary.session import load

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


NAMES = """CASE p_partkey % 6 WHEN 0 THEN concat('2024款 ', upper(p_name), '（运动版）') WHEN 1 THEN concat(p_name, '·A.b\\\\c') WHEN 2 THEN concat(p_name, ' 豪华型') WHEN 3 THEN concat('2023', p_name)
WHEN 4 THEN '小鹏汽车|高德' END"""


@query("""WITH n AS (SELECT p_partkey, replace(p_name, ' ', '') AS w, p_partkey % 6 AS k FROM part)
SELECT p_partkey, CASE k WHEN 0 THEN concat(w, '运动版') WHEN 1 THEN concat(w, 'abc') WHEN 2 THEN concat(w, '豪华型') WHEN 3 THEN w WHEN 4 THEN '小鹏汽车|高德' ELSE '' END AS plain,
CASE k WHEN 0 THEN w WHEN 1 THEN concat(w, 'a.bc') WHEN 2 THEN w WHEN 3 THEN concat('2023', w) WHEN 4 THEN '小鹏汽车|高德' ELSE '' END AS aggressive,
CASE k WHEN 0 THEN concat(w, '运动版') WHEN 1 THEN concat(w, 'abc') WHEN 2 THEN concat(w, '豪华型') WHEN 3 THEN w WHEN 4 THEN '小鹏' ELSE '' END AS brand FROM n""")
def match_texts(spark, sf_dir):
    """D1, D2, D3."""
    x = F.expr(NAMES)
    return load(spark, sf_dir, "part").select("p_partkey", S.match_text(x).alias("plain"), S.aggressive_text(x).alias("aggressive"), S.brand_text(x).alias("brand"))


@query("""SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN concat('比亚迪|', p_name, '|2023') WHEN 1 THEN concat('小鹏|', replace(p_name, ' ', ''), '|2021') WHEN 2 THEN concat('飞凡|r7|') WHEN 3 THEN NULL ELSE concat('bmw|', replace(p_name, ' ', ''), '|2020') END AS key
FROM (SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN concat('比亚迪', replace(p_name, ' ', '')) ELSE p_name END AS p_name FROM part)""")
def bucket_keys(spark, sf_dir):
    """Brands from the series where there is none, corrections of certain series, years from the field or the name."""
    k = F.col("p_partkey") % 5
    brand = F.when(k == 0, "").when(k == 1, "小鹏汽车").when(k == 2, "荣威").when(k == 3, "x").otherwise("B-MW")
    series = F.when(k == 0, F.concat(F.lit("比亚迪 "), "p_name")).when(k == 2, "R7").when(k == 3, "").otherwise(F.col("p_name"))
    year = F.when(k == 0, "2023款").when(k == 1, "-").when(k == 2, "").otherwise("2020")
    model = F.when(k == 1, F.concat(F.lit("P7 2021款 "), "p_name")).otherwise(F.col("p_name"))
    key = S.series_year_key(brand, series, year, model, prefixes=["吉利", "比亚迪"], corrections=(("荣威", "r7", "飞凡"),))
    return load(spark, sf_dir, "part").select("p_partkey", key.alias("key"))


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'Brand' WHEN 1 THEN '比亚迪' WHEN 2 THEN '' ELSE 'known' END AS longest, CASE p_partkey % 4 WHEN 0 THEN 'Brand#' WHEN 1 THEN '比亚' END AS first FROM part""")
def brand_prefixes(spark, sf_dir):
    """The longest prefix anywhere inside, or the list's first in front."""
    k = F.col("p_partkey") % 4
    series = F.when(k == 0, F.concat(F.lit("Brand#"), "p_name")).when(k == 1, F.concat(F.lit("比亚迪"), "p_name")).when(k == 2, F.col("p_name")).otherwise("Galaxy")
    longest = S.brand_of(series, ["比亚", "Brand", "比亚迪"], {"Galaxy": "known"})
    return load(spark, sf_dir, "part").select("p_partkey", longest.alias("longest"), S.first_prefix(series, ["比亚", "Brand#", "Brand"]).alias("first"))


@query("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN CAST(year(o_orderdate) AS INT) WHEN 1 THEN 2022 WHEN 2 THEN CAST(year(o_orderdate) AS INT) END AS year FROM orders""")
def first_years(spark, sf_dir):
    """D10."""
    k, y = F.col("o_orderkey") % 4, F.year("o_orderdate").cast("string")
    field = F.when(k == 0, F.concat(y, F.lit("款"))).when(k == 1, "-").when(k == 3, "1850")
    return load(spark, sf_dir, "orders").select("o_orderkey", S.year_of(field, F.when(k == 1, F.lit("X 2022款 2023")).when(k == 2, F.concat(F.lit("a"), y))).alias("year"))


@query("""SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN '12.34万' WHEN 1 THEN '9.9万' WHEN 2 THEN '8万' END AS price FROM orders""")
def official_prices(spark, sf_dir):
    """The price, or the field that the row's source has it in."""
    k = F.col("o_orderkey") % 5
    df = load(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(k == 1, "汽车之家").when(k == 2, "懂车帝+易车").otherwise("懂车帝").alias("source"),
        F.when(k == 0, " 12.34万 ").when(k == 3, "暂无报价 1").otherwise("-").alias("price"), F.lit("9.9万").alias("maker"), F.lit("8万").alias("other"),
    )
    out = S.with_price(df, "source", "price", {"汽车之家": "maker", "易车": "other"})
    return out.select("o_orderkey", F.when(F.col("priced"), F.col("price")).alias("price"))


@query("""SELECT p_partkey, p_partkey % 3 = 0 AS han, p_partkey % 3 = 1 AS slug FROM part""")
def script_tests(spark, sf_dir):
    """D15."""
    k = F.col("p_partkey") % 3
    x = F.when(k == 0, F.concat("p_name", F.lit("车"))).when(k == 1, F.concat(F.regexp_replace("p_name", " ", "-"), F.lit("-12"))).otherwise(F.concat("p_name", F.lit("-12")))
    return load(spark, sf_dir, "part").select("p_partkey", S.has_han(x).alias("han"), S.is_slug(x).alias("slug"))


@query("""SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'unapproved' WHEN 'O' THEN 'approved' ELSE 'unknown' END AS status FROM orders""")
def sale_status(spark, sf_dir):
    """Tokens inside the text come before codes."""
    x = F.when(F.col("o_orderstatus") == "F", F.concat("o_orderpriority", F.lit(" 停售 8"))).when(F.col("o_orderstatus") == "O", " 8 ")
    return load(spark, sf_dir, "orders").select("o_orderkey", S.status_of(x, [("停售", "unapproved"), ("在售", "approved")], {"8": "approved", "9": "unapproved"}).alias("status"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN '999' ELSE '100' END AS "range", CASE WHEN p_partkey % 4 = 0 THEN '是' ELSE '-' END AS pump, p_partkey % 4 = 0 AS fuel FROM part""")
def fuel_defaults(spark, sf_dir):
    """The first fuel attribute that says something decides."""
    k = F.col("p_partkey") % 4
    attrs = F.create_map(
        F.lit("燃料形式"), F.when(k == 0, "汽油").when(k == 1, "插电混动").when(k == 2, "氢").otherwise("-"),
        F.lit("能源类型"), F.when(k == 2, "纯电").when(k == 3, "氢").otherwise("柴油"), F.lit("CLTC纯电续航(km)"), F.lit("100"), F.lit("热泵管理"), F.lit("-"),
    )
    df = load(spark, sf_dir, "part").select("p_partkey", attrs.alias("a")).select("p_partkey", S.fuel_defaults(F.col("a")).alias("b"), S.burns_fuel_only(F.col("a")).alias("fuel"))
    return df.select("p_partkey", F.col("b")["CLTC纯电续航(km)"].alias("range"), F.col("b")["热泵管理"].alias("pump"), "fuel")


@query("""SELECT p_partkey, p_type = 'SMALL' OR p_type = 'LARGE' OR p_partkey % 7 = 0 AS ok FROM part""")
def supported_levels(spark, sf_dir):
    """Denied levels first, then allowed ones; no level is allowed."""
    level = F.when(F.col("p_partkey") % 7 == 0, "-").when(F.col("p_type") == "SMALL", "小型车").when(F.col("p_type") == "LARGE", "中大型车").when(F.col("p_type") == "PROMO", "微型车 皮卡").otherwise("客车")
    return load(spark, sf_dir, "part").select("p_partkey", S.allowed(level, "皮卡|货车", "型车").alias("ok"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'a b+c' ELSE 'c' END AS sources FROM part""")
def source_lists(spark, sf_dir):
    """D19."""
    x = F.when(F.col("p_partkey") % 2 == 0, "Ａ　 b + C/a  B").otherwise(" c , C")
    return load(spark, sf_dir, "part").select("p_partkey", F.array_join(S.source_tokens(x), "+").alias("sources"))


# Texts and what folding makes of them: compatibility characters, composed and decomposed ones, white space, case.
FOLDED = {
    "ﬁne Ⅻ ①": "fine xii 1", "Ｈｉ　　ｔｈｅｒｅ": "hi there", "Straße": "strasse", "e\u0301A\u030a": "éå", "㎞ ½": "km 1⁄2", " \u2003x\t\ny\u00a0z ": "x y z",
    "ΣΑΣ": "σασ", "ｶﾞ": "ガ", "İ": "i̇", "": "", "ﷺ": "صلى الله عليه وسلم",
}


@query("SELECT p_partkey, CASE p_partkey % 12 " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(FOLDED.values())) + " ELSE '' END AS folded FROM part")
def folded_texts(spark, sf_dir):
    """NFKC and full case folding."""
    x = F.coalesce(*[F.when(F.col("p_partkey") % 12 == i, F.lit(k)) for i, k in enumerate(FOLDED)])
    return load(spark, sf_dir, "part").select("p_partkey", S.folded(x).alias("folded"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN CAST(p_size AS DOUBLE) + 0.13 END AS ratio FROM part""")
def ratios(spark, sf_dir):
    """D20."""
    x = F.when(F.col("p_partkey") % 3 == 0, F.concat("p_size", F.lit(".126 %"))).otherwise(F.col("p_size").cast("string"))
    return load(spark, sf_dir, "part").select("p_partkey", S.ratio(x).alias("ratio"))


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN concat('audited|c', p_partkey) WHEN 1 THEN concat('model|', lower(p_brand), '2021款', replace(p_name, ' ', '')) WHEN 2 THEN concat('model|', lower(p_brand), '2020款', replace(p_name, ' ', '')) ELSE concat('fallback|', lower(p_brand), '|||') END AS key,
CASE p_partkey % 4 WHEN 0 THEN concat('audited|c', p_partkey) WHEN 1 THEN concat('strict-model|', lower(p_brand), '2021款', replace(p_name, ' ', ''), '+改款') WHEN 2 THEN concat('strict-model|', lower(p_brand), '2020款', replace(p_name, ' ', '')) ELSE concat('fallback|', lower(p_brand), '|||') END AS strict FROM part""")
def display_keys(spark, sf_dir):
    """D21."""
    k = F.col("p_partkey") % 4
    component = F.when(k == 0, F.concat(F.lit("c"), F.col("p_partkey").cast("string")))
    brand = F.col("p_brand")
    series = F.when(k != 3, brand)
    year = F.when(k == 1, "2021")
    name = F.when(k == 1, F.concat("p_name", F.lit(" + 改款"))).when(k == 2, F.concat(brand, F.lit(" 2020款 "), "p_name")).when(k == 0, F.col("p_name"))
    key = lambda strict: S.display_key(component, brand, series, year, name, strict)
    return load(spark, sf_dir, "part").select("p_partkey", key(False).alias("key"), key(True).alias("strict"))


@query("""SELECT p_partkey, concat(CASE p_partkey % 3 WHEN 0 THEN '2024' WHEN 1 THEN '1999' ELSE 'new' END, '|', replace(p_name, ' ', '')) AS key FROM part""")
def overlay_keys(spark, sf_dir):
    """D22."""
    k = F.col("p_partkey") % 3
    year = F.when(k == 0, "x2024款").when(k == 1, "1999").otherwise(" new ")
    return load(spark, sf_dir, "part").select("p_partkey", F.concat_ws("|", S.overlay_year(year), S.overlay_name(F.concat(F.lit(" 24款 "), "p_name"))).alias("key"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE p_type END AS label FROM part""")
def source_free_values(spark, sf_dir):
    """D23."""
    x = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("懂车帝:"), "p_name")).otherwise(F.col("p_type"))
    return load(spark, sf_dir, "part").select("p_partkey", S.without_source(x).alias("label"))


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN '宋' WHEN 1 THEN 'phev' ELSE replace(p_name, ' ', '') END AS series FROM part""")
def canonical_series(spark, sf_dir):
    """D24."""
    k = F.col("p_partkey") % 3
    series = F.when(k == 0, "比亚迪 宋 插电混动").when(k == 1, "PHEV").otherwise(F.concat("p_name", F.lit("-PHEV")))
    return load(spark, sf_dir, "part").select("p_partkey", S.canonical_series(F.lit("比亚迪"), series).alias("series"))


@query("""SELECT p_partkey, p_partkey % 4 < 2 AND NOT starts_with(p_name, lower(p_type)) AS same FROM part""")
def vehicle_names(spark, sf_dir):
    """Brackets that offer options, years, marks and the brand and series in front don't matter; a series is taken off once, also from the shorter name."""
    k = F.col("p_partkey") % 4
    a = S.vehicle_name(F.col("p_brand"), F.col("p_type"), F.col("p_name"))
    other = F.when(k == 0, F.concat("p_brand", F.lit(" "), "p_type", F.lit(" 2024款 "), F.upper("p_name"), F.lit("（可选装 顶篷）"))).when(k == 1, F.concat("p_type", F.lit("-"), "p_name", F.lit(" 改款"))).when(k == 2, F.concat("p_name", F.lit("(顶篷)")))
    return load(spark, sf_dir, "part").select("p_partkey", S.same_vehicle(a, S.vehicle_name(F.col("p_brand"), F.col("p_type"), other)).alias("same"))


@query("""SELECT p_partkey, CASE WHEN p_partkey >= 100 THEN CAST(p_partkey AS VARCHAR) ELSE '' END AS ids FROM part""")
def model_ids(spark, sf_dir):
    """E11."""
    attrs = F.create_map(F.lit("车款id"), F.concat(F.lit("a"), F.col("p_partkey").cast("string"), F.lit(" b")), F.lit("size"), F.lit("12345"))
    return load(spark, sf_dir, "part").select("p_partkey", F.array_join(E.ids_of(attrs), "+").alias("ids"))


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'absent' WHEN 1 THEN 'present' WHEN 2 THEN 'present' ELSE '' END AS lidar, CASE p_partkey % 4 WHEN 0 THEN '2' WHEN 1 THEN '3' ELSE '' END AS motors,
CASE p_partkey % 4 WHEN 0 THEN 'plug_in_hybrid' WHEN 1 THEN 'range_extender' WHEN 2 THEN '48v_mild_hybrid' ELSE 'gasoline' END AS energy, CASE p_partkey % 4 WHEN 0 THEN '中大型|suv' WHEN 1 THEN '|sedan' WHEN 2 THEN '紧凑型|' ELSE '' END AS level FROM part""")
def further_signatures(spark, sf_dir):
    """E6, E7, E8."""
    k = F.col("p_partkey") % 4
    attrs = F.create_map(
        F.lit("前激光雷达"), F.when(k == 0, "无").when(k == 1, "3个"), F.lit("电机总数"), F.when(k == 0, "双电机").when(k == 1, "电机个数: 3"), F.lit("size"), F.lit("激光雷达")
    )
    attrs = F.map_filter(attrs, lambda _, v: v.isNotNull())
    name = F.when(k == 2, F.concat("p_name", F.lit(" 激光雷达版 48V轻混"))).when(k == 0, F.concat("p_name", F.lit(" DM-i"))).otherwise(F.col("p_name"))
    energy = F.when(k == 1, "增程式 纯电").otherwise("汽油")
    level = F.when(k == 0, "中大型SUV").when(k == 1, "轿车").when(k == 2, "紧凑型")
    rows = load(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("series"), name.alias("model"), energy.alias("energy"), level.alias("level"), attrs.alias("attrs"))
    said = ("series", "model", "energy", "level", "attrs")
    df = R.judged_once(rows, said, lambda d: d.withColumn("s", E.component_signature(F.lit("x"), *[F.col(c) for c in said])))
    return df.select("p_partkey", *[F.array_join(F.col("s")[c], "+").alias(a) for c, a in (("lidar_presence", "lidar"), ("motors", "motors"), ("energy", "energy"), ("level", "level"))])


@query("""SELECT p_partkey, replace(p_name, ' ', '_') AS header FROM part""")
def clean_headers(spark, sf_dir):
    """C17."""
    return load(spark, sf_dir, "part").select("p_partkey", H.clean_header(F.concat(F.lit("<b>"), F.regexp_replace("p_name", " ", "/"), F.lit("</b>"))).alias("header"))


@query("""SELECT p_brand, p_type, arg_max(p_name, (length(p_name), -p_partkey)) AS value FROM part GROUP BY ALL""")
def longest_values(spark, sf_dir):
    """B5."""
    rows = load(spark, sf_dir, "part").select("p_brand", "p_type", F.col("p_name").alias("value"), F.col("p_partkey").alias("ordinal"))
    return U.longest_value(rows, ["p_brand", "p_type"])


@query("""WITH d AS (SELECT p_brand, p_type, p_name, min(p_partkey) AS o FROM part WHERE p_partkey % 5 <> 0 GROUP BY ALL) SELECT b.p_brand, b.p_type, coalesce(string_agg(p_name, '|' ORDER BY o), '') AS value
FROM (SELECT DISTINCT p_brand, p_type FROM part) b LEFT JOIN d ON d.p_brand = b.p_brand AND d.p_type = b.p_type GROUP BY ALL""")
def joined_values(spark, sf_dir):
    """G3."""
    value = F.when(F.col("p_partkey") % 5 == 0, "无").otherwise(F.col("p_name"))
    return U.joined_values(load(spark, sf_dir, "part").withColumn("value", value), ["p_brand", "p_type"], "value", "p_partkey")


@query("""WITH p AS (SELECT x.p_partkey AS l, y.p_partkey AS r, abs(x.p_size - y.p_size) AS gap FROM part x JOIN part y ON x.p_brand = y.p_brand AND x.p_type = y.p_type AND x.p_name = y.p_name AND x.p_partkey <> y.p_partkey),
m AS (SELECT *, min(gap) OVER (PARTITION BY l) AS best FROM p), t AS (SELECT *, sum(CASE WHEN gap = best THEN 1 ELSE 0 END) OVER (PARTITION BY l) AS ties FROM m) SELECT l, r, CAST(-gap AS DOUBLE) AS score FROM t WHERE gap = best AND ties = 1""")
def unique_bests(spark, sf_dir):
    """M3."""
    p = load(spark, sf_dir, "part").select(F.col("p_partkey").alias("row_id"), "p_brand", "p_type", "p_name", "p_size")
    return U.unique_best(R.best_pairs(p, p, ["p_brand", "p_type", "p_name"], ("p_size",), (-F.abs(F.col("a_p_size") - F.col("b_p_size"))).cast("double")))


@query("""SELECT o_orderkey FROM orders WHERE (o_orderkey % 4 <> 0 AND year(o_orderdate) >= 1995) OR (o_orderkey % 4 = 0 AND o_orderkey % 8 = 0)""")
def recent_rows(spark, sf_dir):
    """Years from the least on; rows without a year only of lenient sources."""
    k = F.col("o_orderkey")
    o = load(spark, sf_dir, "orders").withColumn("y", F.when(k % 4 != 0, F.year("o_orderdate"))).withColumn("s", F.when(k % 8 == 0, "C").otherwise("A"))
    return o.where(Q.recent(F.col("y"), F.col("s"), 1995, ("C",))).select("o_orderkey")


@query("""SELECT p_partkey, CAST(row_number() OVER (ORDER BY p_size DESC, p_name, p_partkey) AS BIGINT) AS place FROM part""")
def priority_order(spark, sf_dir):
    """L5: "field:asc,field:desc"; places by ranges of the order."""
    part = load(spark, sf_dir, "part")
    return Q.placed(part, [*Q.priority_sort("p_size:desc,p_name:asc"), F.col("p_partkey").asc()]).select("p_partkey", "place")


BOUNDARY = """CASE WHEN p_partkey % 8 = 0 THEN p_partkey % 3 <> 0 WHEN p_partkey % 8 = 7 THEN p_partkey % 3 <> 0 WHEN p_partkey % 8 IN (1, 2) THEN p_partkey % 3 <> 0 WHEN p_partkey % 8 IN (3, 4, 6) THEN false ELSE true END"""


def _boundary(spark, sf_dir):
    k = F.col("p_partkey")
    m = k % 8
    rows = load(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(m.isin(0, 6), "易车").when(m.isin(1, 3), "仅汽车之家").when(m.isin(2, 4), "懂车帝").when(m == 7, "汽车之家+易车").alias("source"),
        F.when(m == 3, "brand").otherwise("品牌").alias("brand"), F.when(m == 4, "song-12").otherwise("系列").alias("series"), F.col("p_name").alias("model"), F.lit("2024").alias("year"),
        F.when(m == 5, "").otherwise(k.cast("string")).alias("car_id"), F.when(m == 6, "unknown").otherwise("approved").alias("status"),
        F.when(k % 3 == 0, "暂无").otherwise("9万").alias("price"), F.lit("2024年3月").alias("listed"), F.lit("-").alias("other"),
    )
    return G.boundary_valid(rows, F.lit("2025-01-01").cast("date"), {"易车": "other"})


@query(f"SELECT p_partkey, {BOUNDARY} AS valid FROM part")
def boundary_checks(spark, sf_dir):
    """Every source's own identity, a price and a listing date."""
    return _boundary(spark, sf_dir).select("p_partkey", "valid")


@query(f"SELECT CASE WHEN {BOUNDARY} THEN 'valid' ELSE 'boundary' END AS side, CAST(count(*) AS BIGINT) AS n FROM part GROUP BY 1")
def split_rows(spark, sf_dir):
    """N3."""
    good, bad = G.split(_boundary(spark, sf_dir), F.when(~F.col("valid"), "boundary"))
    return good.select(F.lit("valid").alias("side")).unionByName(bad.select(F.col("reason").alias("side"))).groupBy("side").agg(F.count(F.lit(1)).alias("n"))

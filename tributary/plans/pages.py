"""Queries of whole pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.session import load
from tributary.sources import config_pages as P

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


# A payload of five cars, and pages that hold it or its like in another form; # is the page's number in letters (digits in names would be years).
CARS = """{"car_info":[
{"car_name":"2021款 A#","car_year":"","official_price":"9.9万","brand_name":"maker","info":{"range":{"value":"5#"},"range_b":{"value":"x"},"range_c":{"value":"5#"},"heat":"有",
 "laser_radar_v4_2":{"value":"1"},"pack_1":{"value":"顶篷"},"pack_2":{"value":"选装"},"mode_1":{"value":"a"},"mode_2":{"value":"a"},"three_1":{"value":"u"},"three_2":{"value":"v"},"three_3":{"value":"w"},"none":{"value":""}}},
{"car_name":"B#","car_year":"2018","info":{"range":{"value":"1"}}},
{"car_name":"C#","car_year":2023,"info":{"lv":{"value":"皮卡"}}},
{"car_name":"D#","car_year":"2024款","info":{"fuel":{"value":"汽油"},"electric":{"value":"100"},"pack_1":{"value":"顶篷"}}},
{"car_name":"E#","car_year":null,"brand_name":"maker e","info":null}],
"properties":[{"key":"range","text":"旧","type":1},{"key":"range","text":"续航 ","type":1},{"key":"range_b","text":"续航"},{"key":"range_c","text":"续航","type":2},{"key":"seat","text":"座椅","type":3,"sub_list":[{"key":"heat","text":"加热"},{"key":"cold","text":""}]},
{"key":"x","text":"x","type":1,"sub_list":[{"key":"mode_1","text":"not read"}]},{"key":"lv","text":"级别"},{"key":"fuel","text":"燃料形式"},{"key":"electric","text":"纯电续航"},{"key":"three_3","text":null}]}""".replace("\n", "")
TABLE = "<table><tr><th>车型名称</th><td>T#</td><td>U# <b>2022</b></td></tr><tr><td>厂商<td>maker t</td><td></td></tr><tr><td>alone</td></tr><tr><td>续航</td><td>7&amp;8</td></tr><tr><td>续航</td><td>later</td></tr></table>"
DIVS = '<div class="param-row"><div class="col"><label class="cell_label">车型名称</label></div><div class="col">V#</div><div class="col">W#</div></div><div class="x_row_y"><span class="label">续航</span><p class="cell_normal">9<br>1</p><p class="cell_normal">8</p></div>'
KINDS = {
    0: '{"source":"entity_api","series_info":{"name":"own","brand":"own brand"},"data":' + CARS + "}",
    1: '<html><script id="__NEXT_DATA__" type="x">{"page":"/auto","props":{"pageProps":{"rawData":' + CARS + "}}}</script>" + TABLE,
    2: '<html><script id="__NEXT_DATA__">{"page":"/login-required","props":{"pageProps":{"rawData":' + CARS + "}}}</script>" + TABLE,
    3: "<html><table><tr><td>one cell</td></tr></table>" + DIVS,
    4: '<html><script id="__NEXT_DATA__">{broken</script><p>nothing</p>',
    5: '{"source":"other","data":' + CARS + "}",
    6: "",
}
# What the rules make of them: kind, position, brand by itself, model, year, attributes (sorted, joined).
SAID = [
    ("p", 0, "maker", "2021款 A#", "2021", "three_1=u;three_2=v;three_3=w;mode_1=a;mode_2=a;官方指导价=9.9万;厂商=maker;续航=5#|x|5#;激光雷达=1;年款=2021;座椅 - 加热=有;车型名称=2021款 A#;选装包列表={\"pack\":{\"描述\":\"顶篷\",\"状态\":\"选装\"}}"),
    ("p", 3, "", "D#", "2024款", "年款=2024款;燃料形式=汽油;纯电续航=999;车型名称=D#;选装包列表={\"pack\":{\"描述\":\"顶篷\",\"状态\":\"\"}}"),
    ("p", 4, "maker e", "E#", "", "厂商=maker e;车型名称=E#"),
    ("t", 0, "maker t", "T#", "", "厂商=maker t;续航=7&8;车型名称=T#"),
    ("t", 1, "", "U#2022", "2022", "续航=-;车型名称=U#2022"),
    ("d", 0, "", "V#", "", "续航=91;车型名称=V#"),
    ("d", 1, "", "W#", "", "续航=8;车型名称=W#"),
]
SAID = [(k, p, b, m, y, ";".join(sorted(a.split(";")))) for k, p, b, m, y, a in SAID]
HELD = "CASE page_id % 7 WHEN 0 THEN 'p' WHEN 1 THEN 'p' WHEN 2 THEN 't' WHEN 3 THEN 'd' END"
LISTED = "page_id % 5"  # 0: not in the list; 1: no brand told; 2: an empty one; 3: a prefix inside the name


@query(f"""WITH s(kind, position, brand, model, year, attrs) AS (VALUES {", ".join(f"('{k}', {p}, '{b}', '{m}', '{y}', '{a}')" for k, p, b, m, y, a in SAID)}), p AS (SELECT page_id, {HELD} AS kind, page_id % 7 = 0 AS api, {LISTED} AS l FROM pages)
SELECT page_id, CAST(position AS INTEGER) AS position, CASE WHEN l = 4 THEN 'listed' WHEN l IN (0, 1) AND api THEN 'own brand' WHEN brand <> '' THEN brand WHEN l = 3 THEN '吉利银河' ELSE '' END AS brand,
CASE WHEN l = 0 AND api THEN 'own' WHEN l = 0 THEN '' WHEN l = 3 THEN '吉利银河 E5' ELSE concat('series ', page_id) END AS series,
replace(model, '#', translate(CAST(page_id AS VARCHAR), '0123456789', 'abcdefghij')) AS model, year, replace(attrs, '#', translate(CAST(page_id AS VARCHAR), '0123456789', 'abcdefghij')) AS attrs FROM p JOIN s USING (kind)""")
def config_cars(spark, sf_dir):
    """A4: the whole chain. Brands: the list's, the answer's own, the maker's, the first prefix of the series; years before 2020 and pick-ups go."""
    k = F.col("page_id")
    pages = load(spark, sf_dir, "pages")
    form = F.coalesce(*[F.when(k % 7 == n, F.lit(x)) for n, x in KINDS.items()])
    made = pages.select("page_id", k.alias("series_id"), F.replace(form, F.lit("#"), F.translate(k.cast("string"), "0123456789", "abcdefghij")).alias("content"))
    series = pages.where(k % 5 != 0).select(
        k.alias("series_id"), F.when(k % 5 == 3, "吉利银河 E5").otherwise(F.concat(F.lit("series "), k.cast("string"))).alias("name"),
        F.when(k % 5 == 4, "listed").when(k % 5 != 1, "").alias("brand"),
    )
    rows = P.config_cars(made, "page_id", "content", series, 2020, ("吉利银河", "吉利"), "皮卡", "")
    attrs = F.array_join(F.array_sort(F.transform(F.map_entries("attrs"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ";")
    return rows.select("page_id", "position", "brand", "series", "model", "year", attrs.alias("attrs"))

"""A4: records of cars from saved pages: API answers, JSON embedded in a page, tables, labelled divs, in that order."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions import scalars as S
from tributary.session import ship
from tributary.sources.extract import transpose

PAYLOAD = """struct<car_info: array<struct<car_name: string, car_year: string, official_price: string, brand_name: string, info: map<string, string>>>,
properties: array<struct<key: string, text: string, type: string, sub_list: array<struct<key: string, text: string>>>>>"""

# Names of coded attributes that no property list names.
CODED = {
    "laser_radar_v4": "激光雷达",
    "driving_assist_chip_computing_v4": "辅助驾驶芯片算力",
    "car_intelligent_system_v4": "车载智能系统",
    "driving_assist_chip_v4": "辅助驾驶芯片",
    "car_intelligent_chip_v4": "车载智能芯片",
    "driving_assist_op_system_v4": "辅助驾驶操作系统",
    "ultrasonic_radar_v4": "超声波雷达",
    "battery_brand_v4": "电池品牌",
    "millimeter_wave_radar_v4": "毫米波雷达",
    "camera_count_v4": "摄像头数量",
    "v2x_communication_v4": "V2X通信",
    "heat_pump_management_system_v4": "热泵管理系统",
    "mobile_remote_control_v4": "手机远程控制",
    "high_precision_map_v4": "高精度地图",
}
# Parts of the class names of a row of parameters.
ROW_CLASSES = ("table_row", "row_", "cell_row", "param-row", "config-row")
NAME, YEAR, PRICE, MAKER, LEVEL, PACKAGES = "车型名称", "年款", "官方指导价", "厂商", "级别", "选装包列表"


def filled(x: Column) -> Column:
    """The text, or null where it is empty."""
    return F.nullif(x, F.lit(""))


def payload(content: Column, api: str, element: str) -> Column:
    """The JSON of a page's cars: an API answer's data, or what the page's script element holds; none where the page only asks to log in."""
    answer = F.startswith(F.ltrim(content), F.lit("{"))
    own = F.when(answer & (F.get_json_object(content, "$.source") == api), F.get_json_object(content, "$.data"))
    script = F.when(~answer, F.regexp_extract(content, rf'(?s)<script id="{element}"[^>]*>(.*?)</script>', 1))
    at = lambda path: F.coalesce(F.get_json_object(script, path), F.lit(""))
    shell = (at("$.page") == "/login-required") | F.contains(at("$.props.pageProps.redirect"), F.lit("/login-required"))
    return F.coalesce(own, F.when(~shell, F.get_json_object(script, "$.props.pageProps.rawData")))


def value_of(raw: Column) -> Column:
    """An attribute's value: of an object its member value, else the text itself."""
    return filled(F.when(F.startswith(raw, F.lit("{")), F.get_json_object(raw, "$.value")).otherwise(raw))


def labels_of(properties: Column) -> Column:
    """Keys with their labels, sorted; sub-properties of the third type bear their parent's label in front. Repeated keys are still there."""
    named = lambda k, text: F.struct(k.alias("key"), text.alias("label"))
    subs = lambda p: F.transform(
        F.filter(F.coalesce(p["sub_list"], F.array()), lambda s: (p["type"] == "3") & (F.trim(s["text"]) != "")),
        lambda s: named(s["key"], F.concat(F.coalesce(F.trim(p["text"]), F.lit("")), F.lit(" - "), F.trim(s["text"]))),
    )
    every = F.flatten(F.transform(F.coalesce(properties, F.array()), lambda p: F.array_prepend(subs(p), named(p["key"], filled(F.trim(p["text"]))))))
    told = F.filter(every, lambda e: e["key"].isNotNull() & e["label"].isNotNull())
    return F.array_sort(F.transform(told, lambda e, i: F.struct(e["key"].alias("key"), i.alias("at"), e["label"].alias("label"))))


def joined(entries: Column) -> Column:
    """A map of labels to values from entries (label, order, value): values of one label in their order, joined by | unless the new one is the whole old one."""
    def step(done: Column, e: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        more = F.when(last["value"] == e["value"], last["value"]).otherwise(F.concat(last["value"], F.lit("|"), e["value"]))
        both = F.array_append(F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))), F.struct(e["label"].alias("label"), more.alias("value")))
        return F.when(F.coalesce(last["label"] == e["label"], F.lit(False)), both).otherwise(F.array_append(done, F.struct(e["label"].alias("label"), e["value"].alias("value"))))

    told = F.filter(F.array_sort(entries), lambda e: e["value"].isNotNull())
    return F.map_from_entries(F.aggregate(told, F.array().cast("array<struct<label: string, value: string>>"), step))


def payload_cars(pages: DataFrame, carried: list[str], parsed: str) -> DataFrame:
    """Rows (carried columns, position, attrs) of parsed payloads. No shuffle: a payload is read inside its row."""
    p = F.col(parsed)
    keys = F.array_distinct(F.flatten(F.transform(p["car_info"], lambda c: F.map_keys(F.coalesce(c["info"], F.create_map().cast("map<string, string>"))))))
    base, number = (lambda k: F.regexp_extract(k, r"^(.+)_(\d+)$", 1)), (lambda k: F.regexp_extract(k, r"^(.+)_(\d+)$", 2))
    # an offered package: described by x_1, offered or not by x_2; told by one car in which both differ, and by there being no x_3
    pair = lambda c, b: (value_of(F.element_at(c["info"], F.concat(b, F.lit("_1")))), value_of(F.element_at(c["info"], F.concat(b, F.lit("_2")))))
    read = pages.select(*carried, parsed, labels_of(p["properties"]).alias("sorted"), keys.alias("keys"))
    bases = F.array_distinct(F.transform(F.filter("keys", lambda k: number(k).isin("1", "2")), base))
    others = F.transform(F.filter("keys", lambda k: (number(k) != "") & ~number(k).isin("1", "2")), base)
    offered = F.filter(F.array_except(bases, others), lambda b: F.exists(p["car_info"], lambda c: F.coalesce(pair(c, b)[0] != pair(c, b)[1], F.lit(False))))
    last = F.filter("sorted", lambda e, i: F.coalesce(F.get(F.col("sorted"), i + 1)["key"] != e["key"], F.lit(True)))
    read = read.select(*carried, parsed, offered.alias("offered"), F.map_from_entries(F.transform(last, lambda e: F.struct(e["key"], e["label"]))).alias("labels"))
    cars = read.select(*carried, "offered", "labels", F.posexplode(f"{parsed}.car_info").alias("position", "car"))
    coded = F.create_map(*[F.lit(x) for kv in CODED.items() for x in kv])
    label = lambda k: F.coalesce(F.element_at("labels", k), F.element_at(coded, F.regexp_replace(k, r"^(.+_v4)_\d+$", "$1")), k)
    c = F.col("car")
    entry = lambda name, order, value: F.struct(name.alias("label"), order.alias("order"), value.alias("value"))
    plain = F.filter(F.map_entries(c["info"]), lambda e: ~(F.array_contains("offered", base(e["key"])) & number(e["key"]).isin("1", "2")))
    told = F.transform(plain, lambda e: entry(label(e["key"]), e["key"], value_of(e["value"])))
    year = F.when(S.year_of(c["car_year"]).isNotNull(), F.trim(c["car_year"])).otherwise(S.year_of(c["car_name"]).cast("string"))
    first = [(NAME, c["car_name"]), (YEAR, year), (PRICE, c["official_price"]), (MAKER, c["brand_name"])]
    packages = F.filter(
        F.transform("offered", lambda b: F.struct(b.alias("name"), F.coalesce(pair(c, b)[0], F.lit("")).alias("描述"), F.coalesce(pair(c, b)[1], F.lit("")).alias("状态"))),
        lambda s: (s["描述"] != "") | (s["状态"] != ""),
    )
    listed = F.to_json(F.map_from_entries(F.transform(packages, lambda s: F.struct(F.trim(s["name"]), F.struct(s["描述"], s["状态"])))))
    every = F.concat(
        F.array(*[entry(F.lit(n), F.lit(""), filled(v)) for n, v in first], entry(F.lit(PACKAGES), F.lit(""), F.when(F.size(packages) > 0, listed))), F.coalesce(told, F.array())
    )
    return cars.select(*carried, "position", joined(every).alias("attrs"))


class _Page(HTMLParser):
    """Columns (header to values) of a page: lines of its tables; if there are none, elements whose class tells a row of parameters."""

    EMPTY = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[dict] = []
        self.lines: list[list[dict]] = []
        self.rows: list[dict] = []

    def handle_starttag(self, tag, attrs):
        if tag in ("td", "th", "tr"):  # ends a cell of the same table that was left open
            depth = max((i for i, n in enumerate(self.open) if n["tag"] == "table"), default=-1)
            cell = next((i for i, n in enumerate(self.open) if i > depth and n["tag"] in ("td", "th")), len(self.open))
            del self.open[cell:]
        name = dict(attrs).get("class") or ""
        node = {"tag": tag, "class": name, "text": [], "children": 0, "nth": self.open[-1]["children"] if self.open else 0, "inside": []}
        if self.open:
            self.open[-1]["children"] += 1
        for outer in self.open:
            if "row" in outer:
                outer["inside"].append(node)
        if tag == "tr":
            self.lines.append([])
        elif tag in ("td", "th") and self.lines:
            self.lines[-1].append(node)
        if any(part in name for part in ROW_CLASSES):
            node["row"] = True
            self.rows.append(node)
        if tag not in self.EMPTY:
            self.open.append(node)

    def handle_data(self, data):
        for node in self.open:
            node["text"].append(data.strip())

    def handle_endtag(self, tag):
        if any(n["tag"] == tag for n in self.open):
            while self.open.pop()["tag"] != tag:
                pass

    def columns(self) -> dict[str, list[str]]:
        said = lambda node: "".join(node["text"])
        found: dict[str, list[str]] = {}
        for cells in self.lines:
            if len(cells) > 1 and said(cells[0]):
                found.setdefault(said(cells[0]), [said(c) for c in cells[1:]])
        if found:
            return found
        for row in self.rows:
            label = next((n for n in row["inside"] if "label" in n["class"]), None)
            values = [n for n in row["inside"] if ("col" in n["class"] and n["nth"] > 0) or "cell_normal" in n["class"]]
            values = values or [n for n in row["inside"] if "cell" in n["class"] or "item" in n["class"]]
            if label and values and said(label):
                found.setdefault(said(label), [said(n) for n in values])
        return found


def markup_cars(pages: DataFrame, carried: list[str], html: str) -> DataFrame:
    """Rows (carried columns, position, attrs) of pages whose tables or divs list a parameter a line and a car a column. Carried columns pass as text."""
    ship(pages.sparkSession)

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = []
            for text in frame[html]:
                page = _Page()
                page.feed(text or "")
                found.append(page.columns())
            yield frame[carried].assign(found=found)

    picked = pages.select(*[F.col(c).cast("string").alias(c) for c in carried], html)
    read = picked.mapInPandas(work, ", ".join(f"`{c}` string" for c in carried) + ", found map<string, array<string>>")
    back = [F.col(c).cast(pages.schema[c].dataType).alias(c) for c in carried]
    rows = read.select(*back, F.posexplode(transpose(F.col("found"))).alias("position", "attrs"))
    return rows.withColumn("attrs", F.map_filter("attrs", lambda _, v: v != ""))


def config_cars(
    pages: DataFrame, key: str, content: str, series: DataFrame, least_year: int = 0, prefixes: tuple[str, ...] = (), deny: str = "^$", allow: str = "",
    always: tuple[str, ...] = (), api: str = "entity_api", element: str = "__NEXT_DATA__",
) -> DataFrame:
    """A4: (key, series_id, position, brand, series, model, year, attrs) of every car on the pages (key, series_id, content).

    A page is read as an API answer, by its embedded JSON, by its tables or by its divs; the first that lists a car counts. Cars of a year
    before the least go (unknown years stay), and levels that are denied or not allowed. The brand is the series list's (series_id, name,
    brand; null: the answer's own), else the maker's, else the first prefix of the series' name. Labels of ``always`` are '-' where nothing is
    said, before defaults of cars that burn fuel only. Null and empty contents, broken JSON and pages without cars give no row.
    """
    raw = payload(F.col(content), api, element)
    info = F.when(F.startswith(F.ltrim(F.col(content)), F.lit("{")), F.from_json(content, "struct<series_info: struct<name: string, brand: string>>")["series_info"])
    read = pages.select(key, "series_id", content, F.from_json(raw, PAYLOAD).alias("parsed"), info.alias("own"))
    listed = F.coalesce(F.size("parsed.car_info"), F.lit(0)) > 0
    answer = F.coalesce(F.startswith(F.ltrim(F.col(content)), F.lit("{")), F.lit(True))
    read = read.withColumns({"own_name": F.col("own.name"), "own_brand": F.col("own.brand")})
    carried = [key, "series_id", "own_name", "own_brand"]
    cars = payload_cars(read.where(listed), carried, "parsed").unionByName(markup_cars(read.where(~listed & ~answer), carried, content))
    rows = cars.join(series.select("series_id", F.col("name").alias("listed_name"), F.col("brand").alias("listed_brand")), "series_id", "left")
    a = lambda name: F.element_at("attrs", name)
    name = F.coalesce("listed_name", "own_name", F.lit(""))
    brand = F.coalesce(filled(F.coalesce("listed_brand", "own_brand")), filled(a(MAKER)), S.first_prefix(name, list(prefixes)), F.lit(""))
    year = F.coalesce(F.when(S.year_of(a(YEAR)).isNotNull(), a(YEAR)), S.year_of(a(NAME)).cast("string"), F.lit(""))
    whole = F.map_concat("attrs", F.map_filter(F.create_map(*[F.lit(x) for n in always for x in (n, "-")]), lambda k, _: ~F.map_contains_key("attrs", k))) if always else F.col("attrs")
    kept = rows.where(F.coalesce(F.nullif(F.regexp_extract(year, r"(\d{4})", 1), F.lit("")).cast("int") >= least_year, F.lit(True)) & S.allowed(a(LEVEL), deny, allow))
    return kept.select(
        key, "series_id", "position", brand.alias("brand"), name.alias("series"), F.coalesce(a(NAME), F.lit("")).alias("model"), year.alias("year"), S.fuel_defaults(whole).alias("attrs")
    )

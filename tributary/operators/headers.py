"""Headers as data: aliases, units, one-hot and option columns, profiles and diagnosis."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.functions.scalars import (
    DIAGNOSIS_MISSING,
    NUMBER,
    brand_of,
    canonical_value,
    is_missing,
    is_positive,
    mapped,
    mapped_or_null,
    trimmed,
    valid_price,
    year_of,
)
from tributary.model import cells
from tributary.session import materialise


# Units that a header may end with, and how some of them are written between underscores.
UNITS = (
    "L/100km", "kWh/100km", "Wh/kg", "万/秒", "km/h", "N·m", "英寸", "rpm", "kWh", "mL", "km", "mm", "kg", "kW", "GB", "Ps", "Cd",
    "个", "座", "门", "秒", "°", "%", "L", "m", "W", "s",
)
CODED_UNITS = {"L_100km": "L/100km", "kWh_100km": "kWh/100km", "Wh_kg": "Wh/kg", "万_秒": "万/秒", "km_h": "km/h"}


def _longest_first(words) -> list[str]:
    return sorted(words, key=lambda u: -len(u))


def unit_header(x: Column, units: tuple[str, ...] = UNITS, coded: dict[str, str] = CODED_UNITS) -> Column:
    """Full-width brackets and long dashes, then X[unit] and X_unit_ to X(unit); the longest unit first."""
    any_unit = "|".join(re.escape(u) for u in _longest_first(units))
    x = F.translate(trimmed(x), "（）—–", "()--")
    x = F.regexp_replace(x, rf"\[({any_unit})\]$", "($1)")
    spelt = coded | {u: u for u in units if "/" not in u}
    pattern = "_(" + "|".join(re.escape(code) for code in _longest_first(spelt)) + ")_$"
    unit = mapped_or_null(F.nullif(F.regexp_extract(x, pattern, 1), F.lit("")), spelt)
    return F.coalesce(F.concat(F.regexp_replace(x, pattern, ""), F.lit("("), unit, F.lit(")")), x)


def coded_header(x: Column, coded: dict[str, str]) -> Column:
    """X_v4_value is the attribute that X_v4 stands for, where that is known."""
    return F.coalesce(mapped_or_null(F.nullif(F.regexp_extract(x, "^(.+_v4)_.+$", 1), F.lit("")), coded), x)


def header(x: Column, aliases: dict[str, str]) -> Column:
    """Alias, unit, alias again, then coded headers."""
    return coded_header(mapped(unit_header(mapped(trimmed(x), aliases)), aliases), aliases)


def audited_header(x: Column, aliases: dict[str, str], audited: tuple[str, ...], external: dict[str, str] | None = None) -> Column:
    """An external alias, else coded headers, else the alias table, but the latter only for headers that were not clean, end with
    a unit, or are audited; all others stay."""
    plain = trimmed(x)
    unit = unit_header(plain)
    ends = plain.rlike(r"\((" + "|".join(re.escape(u) for u in UNITS) + r")\)$")
    known = (x != plain) | (unit != plain) | ends | plain.isin(*audited)
    coded = coded_header(plain, aliases)
    return F.coalesce(mapped_or_null(plain, external or {}), F.when(coded != plain, coded), F.when(known, mapped(unit, aliases)), plain)


def clean_header(x: Column) -> Column:
    """C17."""
    return F.regexp_replace(F.regexp_replace(x, "<[^>]*>", ""), r"[/()]", "_")


def distinct_join(values: Column) -> Column:
    """Ordered distinct positive values joined by |."""
    return F.array_join(F.array_distinct(F.filter(values, is_positive)), "|")


def _regroup(rows: DataFrame, key: str) -> DataFrame:
    """(key, name, pos, value) to one value per name: ordered distinct positive values."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", "value")))
    return rows.groupBy(key, "name").agg(distinct_join(F.transform(ordered, lambda p: p["value"])).alias("value"))


def rename_headers(df: DataFrame, aliases: dict[str, str], key: str = "row_id") -> DataFrame:
    """Cells under canonical headers; collisions in a row are merged."""
    return _regroup(cells(df, key).withColumn("name", header(F.col("key"), aliases)), key).where("value <> ''")


@dataclass(frozen=True)
class SourceRules:
    """What one source's rows need: the attribute that holds its price, brand names to find in series, aliases of its headers."""

    source: str
    price: str | None = None
    prefixes: tuple[str, ...] = ()
    aliases: dict[str, str] = field(default_factory=dict)


def normalise_source(rows: DataFrame, rules: SourceRules, key: str = "row_id") -> DataFrame:
    """A source's rows with their year from the name where they have none, their price from its own attribute where it isn't valid, their brand
    from the series where it is empty, and attributes under canonical headers (collisions merged).

    rows: row_id, brand, series, year, model, price, attrs.
    """
    c = F.col
    own = F.element_at("attrs", F.lit(rules.price)) if rules.price else F.lit(None).cast("string")
    brand = F.when(is_missing(c("brand")), brand_of(c("series"), list(rules.prefixes))).otherwise(c("brand")) if rules.prefixes else c("brand")
    fixed = rows.select(
        key, F.lit(rules.source).alias("source"), brand.alias("brand"), "series", "model",
        F.when(is_missing(c("year")), year_of(c("model")).cast("string")).otherwise(c("year").cast("string")).alias("year"),
        F.coalesce(valid_price(c("price"), own), F.lit("-")).alias("price"),
    )
    named = rename_headers(rows.select(key, "attrs"), rules.aliases, key)
    attrs = named.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "value")))).alias("attrs"))
    return fixed.join(attrs, key, "left").withColumn("attrs", F.coalesce("attrs", F.create_map().cast("map<string,string>")))


def fold_one_hot(df: DataFrame, key: str = "row_id") -> DataFrame:
    """C4: a positive cell under "attribute - value" is that value of the attribute."""
    parts = F.split("key", " - ", 2)
    folded = cells(df, key).withColumn("two", F.size(parts) == 2).where(~F.col("two") | is_positive(F.col("value")))
    return _regroup(
        folded.select(
            key, "pos", F.element_at(parts, 1).alias("name"), F.when(F.col("two"), F.element_at(parts, 2)).otherwise(F.col("value")).alias("value")
        ),
        key,
    ).where("value <> ''")


def fold_packages(df: DataFrame, key: str = "row_id") -> DataFrame:
    """A base is a package if some row has exactly _1 and _2, both positive and different; its cells become JSON in every row."""
    parts = cells(df, key).withColumn("base", F.regexp_extract("key", r"^(.*)_(\d+)$", 1)).withColumn(
        "n", F.regexp_extract("key", r"^(.*)_(\d+)$", 2)
    )
    numbered = parts.where("base <> ''")
    one = lambda n: F.max(F.when(F.col("n") == n, F.col("value")))
    bases = (
        numbered.groupBy(key, "base")
        .agg(F.count(F.lit(1)).alias("c"), one("1").alias("a"), one("2").alias("b"))
        .where((F.col("c") == 2) & is_positive(F.col("a")) & is_positive(F.col("b")) & (F.col("a") != F.col("b")))
        .select("base")
        .distinct()
    )
    packed = (
        numbered.join(bases, "base", "left_semi")
        .groupBy(key, F.col("base").alias("key"))
        .agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("n", "value"))))).alias("value"))
    )
    rest = parts.join(bases, "base", "left_anti").select(key, "key", "value")
    return rest.unionByName(packed)


def without_hidden(df: DataFrame, hidden: DataFrame, key: str = "row_id") -> DataFrame:
    """Cells of which the header is not hidden."""
    return cells(df, key).join(hidden, "key", "left_anti").select(key, "key", "value")


def inject(df: DataFrame, rules: dict[str, tuple[str, str]], key: str = "row_id") -> DataFrame:
    """A positive cell under a rule's header becomes the rule's (name, constant); other cells under it go."""
    rows = cells(df, key)
    name = mapped(F.col("key"), {k: n for k, (n, _) in rules.items()})
    value = F.when(F.col("key").isin(*rules), mapped(F.col("key"), {k: v for k, (_, v) in rules.items()})).otherwise(F.col("value"))
    return rows.where(~F.col("key").isin(*rules) | is_positive(F.col("value"))).select(key, name.alias("key"), value.alias("value"))


def option_columns(df: DataFrame, key: str = "row_id") -> DataFrame:
    """Headers of option packages: X, X_1 and X_2 of every X that a row's package list names, or of which some row has just
    _1 and _2, both positive and different."""
    rows = cells(df, key)
    listed = rows.where(F.col("key") == PACKAGE).select(F.explode(F.map_keys(F.from_json("value", "map<string,string>"))).alias("base"))
    one = lambda n: F.max(F.when(F.col("n") == n, trimmed(F.col("value"))))
    numbered = rows.select(key, F.regexp_extract("key", r"^(.+?)_(\d+)$", 1).alias("base"), F.regexp_extract("key", r"^(.+?)_(\d+)$", 2).alias("n"), "value").where("base <> ''")
    pairs = numbered.groupBy(key, "base").agg(F.count(F.lit(1)).alias("c"), one("1").alias("a"), one("2").alias("b"))
    proven = pairs.where((F.col("c") == 2) & is_positive(F.col("a")) & is_positive(F.col("b")) & (F.col("a") != F.col("b"))).select("base")
    return listed.unionByName(proven).where("base <> ''").distinct().select(F.explode(F.array("base", F.concat("base", F.lit("_1")), F.concat("base", F.lit("_2")))).alias("key"))


def visible_columns(df: DataFrame, configured: list[str], hidden: tuple[str, ...] = (), uniform: tuple[str, ...] = (), key: str = "row_id") -> DataFrame:
    """Attributes to show, configured ones first and always: without those of the hide list, those of option packages, and those of the
    uniform list of which every value is positive."""
    rows = cells(df, key)
    seen = rows.where("value <> ''").groupBy("key").agg(F.count_if(is_positive(F.col("value"))).alias("positive"), F.count(F.lit(1)).alias("n"))
    place = F.array_position(F.array(*[F.lit(c) for c in configured]).cast("array<string>"), F.col("key"))
    dull = F.col("key").isin(*uniform) & (F.col("positive") == F.col("n")) if uniform else F.lit(False)
    off = F.col("key").isin(*hidden) if hidden else F.lit(False)
    packed = option_columns(df, key).select("key", F.lit(True).alias("packed"))
    shown = seen.join(packed, "key", "left").where((place > 0) | ~(off | dull | F.coalesce("packed", F.lit(False))))
    return shown.select("key", "positive", F.when(place > 0, place).otherwise(len(configured) + 1).cast("long").alias("place"))


def with_dimensions(attrs: Column) -> Column:
    """C11: length, width and height of the first attribute that is named like all three and holds three numbers, where the row lacks them."""
    bare = lambda k: F.regexp_replace(k, r"\s", "")
    like = lambda k: bare(k).rlike(r"长宽高|长\*宽\*高|长×宽×高|长x宽x高|车身尺寸") | (F.contains(bare(k), F.lit("长度")) & F.contains(bare(k), F.lit("宽度")) & F.contains(bare(k), F.lit("高度")))
    first = F.get(F.filter(F.map_entries(attrs), lambda e: like(e["key"])), F.lit(0))["value"]
    n = F.regexp_extract_all(first, F.lit(NUMBER), 1)
    names = F.array(*[F.lit(x) for x in ("长度(mm)", "宽度(mm)", "高度(mm)")])
    lacking = F.filter(names, lambda x: F.coalesce(F.element_at(attrs, x), F.lit("")) == "")
    filled = F.map_from_entries(F.transform(lacking, lambda x: F.struct(x, F.element_at(n, F.array_position(names, x).cast("int")))))
    rest = F.map_filter(attrs, lambda k, _: ~F.array_contains(lacking, k))
    return F.when(F.coalesce(F.size(n) >= 3, F.lit(False)), F.map_concat(rest, filled)).otherwise(attrs)


def dimensions(x: Column) -> list[Column]:
    """C11: length, width and height of L x W x H text."""
    n = F.regexp_extract_all(x, F.lit(NUMBER), 1)
    there = x.rlike(r"\d+(\.\d+)?\s*[x*×X/]\s*\d+(\.\d+)?\s*[x*×X/]\s*\d+")
    return [F.when(there, F.element_at(n, i).cast("double")) for i in (1, 2, 3)]


def profile(df: DataFrame, top: int = 5, key: str = "row_id") -> DataFrame:
    """Per attribute and value: count and rank of its most frequent values (ties by value)."""
    counts = cells(df, key).where(~is_missing(F.col("value"))).groupBy("key", "value").agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("n"), "value"))
    return counts.withColumn("rank", rank).where(F.col("rank") <= top)


def value_variants(df: DataFrame, key: str = "row_id") -> DataFrame:
    """C14: values of one attribute that canonicalise alike but are spelt differently."""
    counts = cells(df, key).groupBy("key", "value").agg(F.count(F.lit(1)).alias("n"))
    return (
        counts.withColumn("canonical", F.lower(canonical_value(F.col("value"))))
        .groupBy("key", "canonical")
        .agg(F.count(F.lit(1)).alias("spellings"), F.sum("n").alias("n"))
        .where("spellings > 1")
    )


def pipe_columns(df: DataFrame, top: int = 20, key: str = "row_id") -> DataFrame:
    """C14: attributes of which values hold several parts, the most frequent first."""
    many = cells(df, key).where(F.contains("value", F.lit("|"))).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    return many.orderBy(F.desc("n"), "key").limit(top)


def year_twice(name: Column, year: Column) -> Column:
    """C14: whether a name already has the year that its own field has."""
    return F.coalesce((year.cast("string") != "") & name.rlike(r"\d{4}款") & F.contains(name, year.cast("string")), F.lit(False))


# Coded attributes, attributes that look like values but are none, those that never change, and words and units by which
# headers that hold values are told.
V4_ATTRIBUTES = {
    "laser_radar_v4": "激光雷达", "driving_assist_chip_computing_v4": "辅助驾驶芯片算力", "car_intelligent_system_v4": "车载智能系统",
    "driving_assist_chip_v4": "辅助驾驶芯片", "car_intelligent_chip_v4": "车载智能芯片", "driving_assist_op_system_v4": "辅助驾驶操作系统",
    "ultrasonic_radar_v4": "超声波雷达", "battery_brand_v4": "电池品牌", "millimeter_wave_radar_v4": "毫米波雷达", "camera_count_v4": "摄像头数量",
    "v2x_communication_v4": "V2X通信", "heat_pump_management_system_v4": "热泵管理系统", "mobile_remote_control_v4": "手机远程控制",
    "high_precision_map_v4": "高精度地图",
}
KNOWN_ATTRIBUTES = (
    "filter_group_car_year", "filter_group_capacity_l", "filter_group_driver_form", "departure_angle", "approach_angle", "engine_max_torque",
    "engine_max_power", "engine_description", "electric_max_torque", "electric_max_power", "total_electric_power", "total_electric_torque",
    "front_electric_max_horsepower", "fuel_consumption", "max_grade", "traction_weight", "cylinder_material", "inductive_back_door",
    "electric_back_door", "electric_back_door_memory_v2", "engine_anti_theft", "electric_layout", "ota_version", "low_speed_driving_warning_v3",
)
PROTECTED = (
    "数据来源", "品牌", "车系", "车型名称", "年款", "厂商", "官方指导价", "经销商参考价", "级别", "上市时间", "车系ID", "车款ID", "跨源归并ID",
    "跨源归并证据", "易车匹配方式",
)
HEADER_UNITS = (
    "s", "km", "km/h", "mm", "kg", "kW", "kWh", "N·m", "L", "mL", "°", "°C", "rpm", "Ps", "TOPS", "Wh/kg", "L/100km", "个", "万元", "元", "min",
    "h", "万色", "nit", "Hz", "PPI", "px", "线", "m", "cm", "V", "W", "A", "%", "K", "英寸", "吋", "寸", "GB", "万/秒", "ms", "kPa",
)
VALUE_WORD = (
    "套装|套件|轮毂|轮圈|轮辋|轮胎|车漆|拉花|限定|订阅|选装包|升级包|装备包|礼包|改装|特别版|专属|豪华包|舒适包|科技包|安全包|娱乐包|音响包|性能包|卡钳|刹车盘|"
    "饰板|饰条|徽标|迎宾|贴膜|改色|装饰膜|遮阳帘|桌板|香氛|吧台|投影|行李架|踏板|车衣|脚垫|冰箱|权益|车轮包|外饰|套餐|配色|专属设计"
)
ATTRIBUTE_ENDING = "(类型|材质|工艺|数量|规格|形式|方式|功能|系统|结构|布局|尺寸|颜色|材料|品牌|型号|版本|级别|样式)$"
PACKAGE, PACKAGE_VALUE = "选装包列表", "_1=描述, _2=状态"


def suspects(df: DataFrame, known: dict[str, str] | None = None, key: str = "row_id") -> DataFrame:
    """Headers that hold a value: column, kind, occurrences, confidence, suggested attribute and value.

    The first rule that fits decides: an explicit value behind a dash or a coded base; a coded base itself; an older code; brackets that
    hold no unit; underscores around a short token; internal names; words of values; other numbers at the end; unknown codes; bare latin
    words in three rows or more. Pairs X_1, X_2 that some row has both of, positive and different, are suspects of their own, and
    the last three rules pass them over. known: headers that have an alias already, which only the first rules look at.
    """
    rows = cells(df, key)
    counts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("occurrences"))
    part = lambda pattern, i: F.regexp_extract(k, pattern, i)
    k = F.col("key")
    dash, v4, older = r"^(.+?)\s+-\s+(\S.*)$", r"^(.+_v4)_(.+)$", r"^(.+_v[123])_(.+)$"
    bracket, number = r"^(.+?)[(（]([^()（）]+)[)）]$", r"^(.+)_(\d+)$"
    snake, latin = k.rlike("^[a-z0-9_]+$"), k.rlike("^[a-z_][a-z0-9_]*$")
    mixed = k.rlike(r"^[a-z_]+[a-z0-9_]*\d[a-z0-9_\u4e00-\u9fff]*$")
    # pairs, by the rows that prove them
    numbered = rows.select(key, part(number, 1).alias("base"), part(number, 2).alias("n"), trimmed(F.col("value")).alias("value")).where("n in ('1', '2')")
    one = lambda n: F.max(F.when(F.col("n") == n, F.when(~is_missing(F.lower("value"), DIAGNOSIS_MISSING), F.col("value"))))
    proof = numbered.groupBy(key, "base").agg(one("1").alias("first"), one("2").alias("second")).where("first <> second")
    pairs = proof.groupBy("base").agg(F.count(F.lit(1)).alias("pair_rows"))
    bases = counts.where(k.rlike("_v[123]$")).select(k.alias("older_base"))
    marked = counts.withColumn("base", F.when(k.rlike(r"_[12]$"), part(number, 1))).join(pairs, "base", "left")
    marked = marked.withColumn("older_base", F.nullif(part(older, 1), F.lit(""))).join(bases.withColumn("has_base", F.lit(True)), "older_base", "left")
    coded = mapped_or_null(F.nullif(part(v4, 1), F.lit("")), V4_ATTRIBUTES)
    inner, outer = trimmed(part(bracket, 2)), trimmed(part(bracket, 1))
    unit = inner.isin(*HEADER_UNITS) | inner.rlike(r"^[A-Za-z0-9/·.°℃%\s-]+等?$")
    plausible = outer.rlike("[\u4e00-\u9fff]") & ~outer.rlike(VALUE_WORD) & ~F.contains(outer, F.lit("+"))
    has_alias = k.isin(*(known or {})) if known else F.lit(False)
    value_of_older = trimmed(part(older, 2))
    text = lambda x: F.lit(x).cast("string")
    none = text(None)
    rules = [
        (part(dash, 1) != "", "attribute_value_header", F.lit(0.99), trimmed(part(dash, 1)), trimmed(part(dash, 2))),
        (coded.isNotNull(), "attribute_value_header", F.lit(0.99), coded, trimmed(part(v4, 2))),
        (k.isin(*V4_ATTRIBUTES), "noncanonical_attribute_header", F.lit(0.9), mapped(k, V4_ATTRIBUTES), none),
        ((part(older, 1) != "") & ~snake & ~is_missing(F.lower(value_of_older), DIAGNOSIS_MISSING), "v2v3_value_header",
         F.when(F.col("has_base"), 0.8).otherwise(0.72), part(older, 1), value_of_older),
        (~has_alias & (inner != "") & ~unit & plausible, "attribute_value_header", F.lit(0.95), outer, inner),
        (~has_alias & (inner != "") & ~unit, "value_only_header", F.lit(0.9), none, none),
        (~has_alias & (inner == "") & k.rlike("_[^_]{1,6}_") & ~latin & ~mixed, "attribute_value_header", F.lit(0.85), F.replace(k, F.lit("_"), F.lit("/")), none),
        (~has_alias & (inner == "") & k.rlike("^(易车|跨源归并|核验来源|匹配方式|上市状态|分组)"), "value_only_header", F.lit(0.98), none, none),
        (~has_alias & (inner == "") & mixed, "value_only_header", F.lit(0.95), none, none),
        (~has_alias & (inner == "") & k.rlike(VALUE_WORD) & ~k.rlike(ATTRIBUTE_ENDING), "value_only_header", F.lit(0.92), none, none),
    ]
    late = [
        (part(number, 1) != "", "numeric_suffix_header", F.lit(0.72), part(number, 1), part(number, 2)),
        (k.rlike("^.+_v4(?:_|$)"), "unmapped_v4_header", F.lit(0.55), none, F.nullif(part("^.+_v4_(.*)$", 1), F.lit(""))),
        ((F.col("occurrences") >= 3) & ~k.isin(*KNOWN_ATTRIBUTES) & k.rlike(r"^[A-Za-z0-9][A-Za-z0-9 ._\-+/]*$") & ~snake, "bare_value_header", F.lit(0.45), none, none),
    ]
    pick = lambda tests: F.coalesce(*[F.when(t, F.struct(F.lit(kind).alias("kind"), c.alias("confidence"), a.alias("attribute"), v.alias("value"))) for t, kind, c, a, v in tests])
    found = F.coalesce(pick(rules), F.when(F.col("pair_rows").isNull(), pick(late)))
    # a row per header: written, so that the rules run once, whatever is asked of them
    told = materialise(marked.withColumn("found", found), "headers").where("found is not null").select(k.alias("column"), "found.kind", "occurrences", "found.confidence", "found.attribute", "found.value")
    worded = F.col("base").rlike(r"(?U)\s|(?<=[a-z])(?=[A-Z])")
    packages = pairs.select(
        F.concat("base", F.lit("_1 / "), "base", F.lit("_2")).alias("column"),
        F.when(worded, "package_value_header").otherwise("package_pair_header").alias("kind"),
        F.col("pair_rows").alias("occurrences"),
        F.when(worded, 0.9).otherwise(0.96).alias("confidence"),
        text(PACKAGE).alias("attribute"),
        text(PACKAGE_VALUE).alias("value"),
    )
    return materialise(told.unionByName(packages), "suspects")


def diagnose(df: DataFrame, limit: int = 120, known: dict[str, str] | None = None, key: str = "row_id") -> DataFrame:
    """At most max(4, limit / kinds) suspects of each kind, by confidence and occurrences."""
    found = suspects(df, known, key)
    kinds = found.agg(F.count_distinct("kind").alias("kinds"))  # one row
    rank = F.row_number().over(Window.partitionBy("kind").orderBy(F.desc("confidence"), F.desc("occurrences"), "column"))
    quota = F.greatest(F.lit(4), F.floor(F.lit(limit) / F.greatest("kinds", F.lit(1))))
    return found.withColumn("rank", rank).join(F.broadcast(kinds), F.lit(True)).where(F.col("rank") <= quota).drop("kinds")


def target_attributes(df: DataFrame, known: dict[str, str] | None = None, key: str = "row_id") -> DataFrame:
    """Headers that are no suspects, not protected and without brackets: what an alias may point to."""
    held = suspects(df, known, key).select(F.explode(F.split("column", " / ")).alias("key"))
    names = cells(df, key).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    return names.join(held, "key", "left_anti").where(~F.col("key").isin(*PROTECTED) & ~F.col("key").rlike("[(（]"))


def foldable_columns(df: DataFrame, key: str = "row_id") -> DataFrame:
    """Pairs X(Y), X of which no row holds different values."""
    rows = cells(df, key).select(key, "key", F.lower(canonical_value(F.col("value"))).alias("value"))
    long = rows.withColumn("base", F.regexp_extract("key", r"^(.+)\(.+\)$", 1)).where("base <> ''")
    names = rows.select(F.col("key").alias("base")).distinct()
    pairs = long.select("key", "base").distinct().join(names, "base")
    both = long.join(rows.select(key, F.col("key").alias("base"), F.col("value").alias("other")), [key, "base"])
    clash = both.where("value <> other").select("key").distinct()
    return pairs.join(clash, "key", "left_anti").select("key", "base")


def apply_diagnosis(found: DataFrame, targets: DataFrame, most_hidden: int = 200, most_aliases: int = 100) -> DataFrame:
    """What to hide (value-only headers) and what to alias (values of an attribute that is a target), at confidence 0.9 or more
    and under the caps of the configuration file, the most frequent first. targets: key."""
    sure = found.where("confidence >= 0.9")
    known = targets.select(F.col("key").alias("attribute"))
    out = sure.where("kind = 'value_only_header'").select("column", "occurrences", F.lit("hide").alias("action"), F.lit(None).cast("string").alias("target")).unionByName(
        sure.where("kind = 'attribute_value_header'").join(known, "attribute", "left_semi").select("column", "occurrences", F.lit("alias").alias("action"), F.col("attribute").alias("target"))
    )
    rank = F.row_number().over(Window.partitionBy("action").orderBy(F.desc("occurrences"), "column"))
    cap = F.when(F.col("action") == "hide", most_hidden).otherwise(most_aliases)
    return out.withColumn("rank", rank).where(F.col("rank") <= cap).drop("rank")

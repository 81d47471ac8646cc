"""Set-valued features of records, tokens, and how sets compare."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tributary.functions.scalars import NUMBER, is_missing, is_positive, match_text, number_set, number_text, series_text, year_of

# What tells variants of one model apart, and the attributes that say so.
SEAT_DIGITS = {"二": "2", "三": "3", "四": "4", "五": "5", "六": "6", "七": "7", "八": "8", "九": "9"}
TIERS = r"(?i)(?<![a-z0-9])(ultra\+|pro\+|max\+|ultra|elite|pro|max|gt)(?![a-z])"
GRADES = r"(?<![\u4e00-\u9fff])(闪充\s*)?(尊荣|尊越|旗舰|基本)\s*(?=[型版])"
GRADE_NAMES = {"尊荣": "honor", "尊越": "premier", "旗舰": "flagship", "基本": "basic"}
BATTERY_NAME = r"(?i)(?<!\d)(\d{2,3}(?:\.\d+)?)\s*kwh"
RANGE_NAME = r"(?i)(?<!\d)(\d{3,4}(?:\.\d+)?)\s*(?:km|公里)"
SEAT_FIELDS = ("座位数(个)", "座位数", "座位数_个_")
DRIVE_FIELDS = ("驱动形式", "驱动方式", "驱动形式分组", "电机布局", "四驱形式", "四驱类型")
BATTERY_FIELDS = ("电池能量(kWh)", "电池能量_kWh_", "电池容量(kWh)", "电池容量_kWh_", "电池能量", "电池容量", "动力电池容量")
RANGE_FIELDS = (
    "纯电续航(km)", "纯电续航_km_", "纯电续航里程(km)", "纯电续航里程_km_", "CLTC纯电续航(km)", "CLTC纯电续航_km_",
    "CLTC纯电续航里程(km)", "CLTC纯电续航里程_km_", "工信部纯电续航里程(km)", "工信部纯电续航里程_km_",
)
STOP_WORDS = ("款", "版", "型", "汽车", "自动", "手动", "座")
MODEL_TERMS = (
    "标准续航", "长续航", "超长续航", "高性能", "皇家剧院", "暗夜骑士", "四驱", "后驱", "前驱", "纯电", "增程", "插混", "混动", "改款",
    "旗舰", "尊享", "豪华", "智驾", "运动", "行政", "冠军", "ultra", "elite", "premium", "performance", "luxury", "sport",
    "pro+", "max+", "pro", "max", "plus", "air", "gt", "rs",
)
TERM_STOP_WORDS = ("款", "版", "型", "汽车", "自动", "手动", "km", "公里")
WORDS = "([a-z]+|\\d+(?:\\.\\d+)?|[\u4e00-\u9fff]+)"
#: The dimensions of a variant, in the order in which a conflict is looked for.
DIMENSIONS = ("tier", "seat", "lidar", "drive")


def _text(x: Column) -> Column:
    return F.coalesce(x.cast("string"), F.lit(""))


def _fields(attrs: Column | None, names: tuple[str, ...]) -> Column:
    """The values of the named attributes, those there are."""
    if attrs is None:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.element_at(attrs, F.lit(n)) for n in names]))


def _plain(x: Column) -> Column:
    """Lower case, + as one mark, seats in digits."""
    x = F.replace(F.lower(_text(x)), F.lit("＋"), F.lit("+"))
    for word, digit in SEAT_DIGITS.items():
        x = F.regexp_replace(x, rf"{word}\s*座", f"{digit}座")
    return x


def _marked(tests: dict[str, Column]) -> Column:
    """The names of which the test holds."""
    return F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in tests.items()]))


def variant_signature(name: Column, attrs: Column | None = None) -> Column:
    """Tiers, seats, lidar lines and drives that a model's name, and its attributes, tell."""
    x = _plain(name)
    grade = F.zip_with(
        F.regexp_extract_all(x, F.lit(GRADES), 1),
        F.regexp_extract_all(x, F.lit(GRADES), 2),
        lambda flash, g: F.concat(F.when(flash != "", F.lit("flash_")).otherwise(""), F.element_at(F.create_map(*[F.lit(v) for kv in GRADE_NAMES.items() for v in kv]), g)),
    )
    tiers = F.array_union(F.regexp_extract_all(x, F.lit(TIERS), 1), grade)
    own_seats = F.transform(_fields(attrs, SEAT_FIELDS), lambda v: F.regexp_extract(v, r"^\s*([2-9])\s*(?:座)?\s*$", 1))
    seats = F.array_union(F.regexp_extract_all(x, F.lit(r"([2-9])\s*座"), 1), F.filter(own_seats, lambda v: v != ""))
    lidar = F.regexp_extract_all(x, F.lit(r"(\d{2,4})\s*线\s*激光雷达"), 1)
    if attrs is not None:
        lines = F.transform(named_like(attrs, "激光雷达"), lambda v: F.regexp_extract(v, r"(\d{2,4})\s*线", 1))
        lidar = F.array_union(lidar, F.filter(lines, lambda v: v != ""))
    drive = F.array_join(F.array_prepend(_fields(attrs, DRIVE_FIELDS), x), " ")
    drives = _marked({"awd": drive.rlike("(?i)四驱|4wd|awd"), "rwd": drive.rlike("(?i)后驱|rwd"), "fwd": drive.rlike("(?i)前驱|fwd")})
    return F.struct(
        F.array_distinct(tiers).alias("tier"), F.array_distinct(seats).alias("seat"), F.array_distinct(lidar).alias("lidar"), drives.alias("drive")
    )


def positive_evidence(name: Column, attrs: Column | None = None) -> Column:
    """Battery sizes, ranges and classes of range; they can only speak for a pair, never against it."""
    x = F.lower(_text(name))
    measured = lambda pattern, names: F.array_union(
        F.array_distinct(F.transform(F.regexp_extract_all(x, F.lit(pattern), 1), number_text)), number_set(_fields(attrs, names))
    )
    longest, long = F.contains(x, F.lit("超长续航")), F.contains(x, F.lit("长续航"))
    kinds = {"extra_long_range": longest, "long_range": ~longest & long, "standard_range": x.rlike("标准续航|标准版")}
    return F.struct(measured(BATTERY_NAME, BATTERY_FIELDS).alias("battery"), measured(RANGE_NAME, RANGE_FIELDS).alias("range"), _marked(kinds).alias("range_class"))


def model_tokens(series: Column, name: Column, energy: Column) -> Column:
    """Kind:value for what the name's signature tells, and the words of series, name and energy without years, tiers,
    seats, drives and measures."""
    own = variant_signature(name)
    def kind(d: str) -> Column:
        return F.transform(own[d], lambda v: F.concat(F.lit(f"{d}:"), v))

    kinds = F.flatten(F.array(*[kind(d) for d in DIMENSIONS]))

    def rest(x: Column) -> Column:
        x = _plain(x)
        for pattern in (
            r"(?:19|20)\d{2}款?", TIERS, GRADES, r"[2-9]\s*座", r"\d{2,4}\s*线\s*激光雷达", r"(?i)四驱|后驱|前驱|4wd|awd|rwd|fwd",
            BATTERY_NAME, RANGE_NAME, "超长续航|长续航|标准续航|标准版",
        ):
            x = F.regexp_replace(x, pattern, " ")
        return F.regexp_extract_all(x, F.lit(WORDS), 1)

    words = F.array_distinct(F.concat(rest(series_text(series)), rest(name), rest(energy)))
    return F.array_union(kinds, F.array_except(words, F.array(*[F.lit(w) for w in STOP_WORDS])))


def term_tokens(series: Column, name: Column) -> Column:
    """A name cut by a dictionary of terms, and the words between them, without its series, years and ranges."""
    x, s = F.lower(_text(name)), F.lower(_text(series))
    for part in (s, F.regexp_replace(s, r"(?U)\s+", "")):
        x = F.when(part != "", F.replace(x, part, F.lit(" "))).otherwise(x)
    x = F.regexp_replace(F.regexp_replace(x, r"(?:19|20)?\d{2}\s*款", " "), r"(?i)\d+(?:\.\d+)?\s*(?:km|公里)", " ")
    terms = "|".join(t.replace("+", r"\+") for t in sorted(MODEL_TERMS, key=lambda t: -len(t)))
    rest = F.regexp_extract_all(F.regexp_replace(x, f"({terms})", " "), F.lit("([a-z]+\\+?|\\d+(?:\\.\\d+)?|[\u4e00-\u9fff]+)"), 1)
    return F.array_except(F.array_union(F.regexp_extract_all(x, F.lit(f"({terms})"), 1), rest), F.array(*[F.lit(w) for w in TERM_STOP_WORDS]))


def explicit_energies(x: Column) -> Column:
    """E5: the energies that a text names."""
    t, raw = match_text(x), F.lower(_text(x))
    plug = t.rlike("插电|插混|phev")
    return _marked(
        {
            "增程": F.contains(t, F.lit("增程")), "插混": plug, "纯电": F.contains(t, F.lit("纯电")) | raw.rlike("(^|[^a-z])ev($|[^a-z])"),
            "油混": ~plug & t.rlike("油混|油电|混动|混合动力"), "汽油": F.contains(t, F.lit("汽油")), "柴油": F.contains(t, F.lit("柴油")),
        }
    )


def energies(field: Column, name: Column) -> Column:
    """E5: the canonical energies of a row: those of each part of the field (sources in front left out), and those its name spells out."""
    def atom(p: Column) -> Column:
        value = F.regexp_replace(p, "^[^:：]*[:：]", "")
        told = explicit_energies(value)
        plain = match_text(value)
        return F.when(F.size(told) > 0, told).when(plain != "", F.array(F.when(plain == "ev", F.lit("纯电")).otherwise(plain))).otherwise(F.array().cast("array<string>"))

    parts = F.flatten(F.transform(F.split(_text(field), "[|｜]"), atom))
    return F.array_sort(F.array_union(F.array_distinct(parts), explicit_energies(name)))


def model_years(year: Column, name: Column) -> Column:
    """E5: all years in the year's field and all before 款 in the name."""
    field = F.regexp_extract_all(_text(year), F.lit(r"((?:19|20)\d{2})"), 1)
    return F.array_sort(F.array_union(field, F.regexp_extract_all(_text(name), F.lit(r"((?:19|20)\d{2})\s*款"), 1)))


# Further rules that tell variants apart.
EXTRA_TIERS = r"(?i)(?<![a-z0-9])(ultra\+|pro\+|max\+|ultra|pro|max|plus|core|air)(?![a-z])"
GRADE_WORDS = {
    "标准版": "standard", "豪华版": "luxury", "纵野版": "wilderness", "享境版": "enjoy", "智境乾崑版": "smart_qiankun", "性能版": "performance",
    "智选版": "smart_choice",
}
BODY_FIELDS = ("车体结构", "车身结构", "车身型式", "车身形式")
BODY_SHAPES = {
    "敞篷": "convertible", "旅行车": "wagon", "两厢": "hatchback", "三厢": "sedan", "掀背": "liftback", "suv": "suv", "mpv": "mpv",
    "皮卡": "pickup", "跑车": "coupe",
}
LEVEL_SIZES = ("中大型", "紧凑型", "微型", "小型", "中型", "大型")
LEVEL_BODIES = {"suv": "suv", "mpv": "mpv", "轿车": "sedan", "跑车": "coupe", "皮卡": "pickup"}
MOTOR_COUNTS = {"单电机": "1", "双电机": "2", "两电机": "2", "三电机": "3", "四电机": "4"}
ENGINE_COUNTS = {"单发动机": "1", "双发动机": "2", "两发动机": "2"}


def _has(text: Column, words: dict[str, str]) -> Column:
    return F.array_distinct(F.array_compact(F.array(*[F.when(F.contains(text, F.lit(w)), F.lit(v)) for w, v in words.items()])))


def component_signature(brand: Column, series: Column, name: Column, energy: Column, level: Column, attrs: Column) -> Column:
    """All further sets by which two records of one model can conflict."""
    n = _text(name)
    both = F.concat_ws(" ", _text(energy), n)
    compact, lower = match_text(both), F.lower(both)
    extender, plug = F.contains(compact, F.lit("增程")), compact.rlike("插电|插混|phev|dmi|dmp")
    electric = ~extender & ~plug & (F.contains(compact, F.lit("纯电")) | lower.rlike("(^|[^a-z])ev($|[^a-z])"))
    mild = F.contains(compact, F.lit("48v轻混"))
    hybrid = ~mild & compact.rlike("油混|油电|混合动力|混动|hev")
    none = ~(extender | plug | electric | mild | hybrid)
    petrol = none & F.contains(compact, F.lit("汽油"))
    energies_ = {
        "range_extender": extender, "plug_in_hybrid": plug, "battery_electric": electric, "48v_mild_hybrid": mild, "oil_hybrid": hybrid,
        "gasoline": petrol, "diesel": none & ~petrol & F.contains(compact, F.lit("柴油")),
    }
    with_named = lambda token: F.array_join(F.array_prepend(named_like(attrs, token), n), " ")
    drive = F.array_join(F.array_prepend(_fields(attrs, DRIVE_FIELDS), n), " ")
    lidar_values = named_like(attrs, "激光雷达")
    absent = F.contains(n, F.lit("无激光雷达"))
    positive = F.exists(lidar_values, is_positive)
    lidar = {
        "absent": absent | F.exists(lidar_values, lambda v: ~is_positive(v)),
        "present": (~absent & F.contains(n, F.lit("激光雷达"))) | positive,
    }
    motors, engines = with_named("电机"), with_named("发动机")
    counted = lambda text, words, what: F.array_union(_has(text, words), F.regexp_extract_all(text, F.lit(what + r"(?:数量|数|个数)\D{0,3}([1-4])"), 1))
    body = match_text(F.array_join(_fields(attrs, BODY_FIELDS), " "))
    free = F.contains(body, F.lit("非承载式"))
    lv = match_text(level)
    size = F.coalesce(*[F.when(F.contains(lv, F.lit(w)), F.lit(w)) for w in LEVEL_SIZES], F.lit(""))
    shape = F.coalesce(*[F.when(F.contains(lv, F.lit(w)), F.lit(v)) for w, v in LEVEL_BODIES.items()], F.lit(""))
    lower_name = F.lower(n)
    badge = F.contains(match_text(F.concat_ws(" ", _text(brand), _text(series))), F.lit("保时捷")) & F.contains(lower_name, F.lit("carrera"))
    four = lower_name.rlike(r"\bcarrera\s+4(?:\s|$)")
    return F.struct(
        F.array_distinct(F.regexp_extract_all(F.replace(lower_name, F.lit("＋"), F.lit("+")), F.lit(EXTRA_TIERS), 1)).alias("extra_tier"),
        _marked({"4wd": drive.rlike("(?i)四驱|4wd|awd"), "2wd": drive.rlike("(?i)两驱|2wd")}).alias("generic_drive"),
        F.array_distinct(F.regexp_extract_all(with_named("激光雷达"), F.lit(r"(\d{2,4})\s*线[^|，,；;()（）]{0,20}激光雷达"), 1)).alias("lidar_lines"),
        _marked(lidar).alias("lidar_presence"),
        _marked(energies_).alias("energy"),
        _marked({"dm_i": F.contains(compact, F.lit("dmi")), "dm_p": F.contains(compact, F.lit("dmp"))}).alias("powertrain"),
        counted(motors, MOTOR_COUNTS, "(?:驱动)?电机").alias("motors"),
        counted(engines, ENGINE_COUNTS, "发动机").alias("engines"),
        _marked({"4": badge & four, "base": badge & ~four}).alias("badge"),
        _has(match_text(name), GRADE_WORDS).alias("grade"),
        _marked({"non_load_bearing": free, "load_bearing": ~free & F.contains(body, F.lit("承载式"))}).alias("structure"),
        _has(body, BODY_SHAPES).alias("shape"),
        F.when((size != "") | (shape != ""), F.array(F.concat(size, F.lit("|"), shape))).otherwise(F.array().cast("array<string>")).alias("level"),
    )


def optional_measures(attrs: Column) -> Column:
    """Batteries and ranges that attributes offer as options."""
    texts = F.filter(F.transform(F.map_entries(attrs), lambda e: F.concat_ws(" ", e["key"], e["value"])), lambda t: t.rlike("选装|选配"))
    taken = lambda pattern: F.array_distinct(F.flatten(F.transform(texts, lambda t: F.transform(F.regexp_extract_all(t, F.lit(pattern), 1), number_text))))
    return F.struct(taken(BATTERY_NAME).alias("battery"), taken(RANGE_NAME).alias("range"))


def near_sets(a: Column, b: Column, tolerance: float) -> Column:
    """Whether two sets of number texts have members within the tolerance, or one percent of the larger."""
    doubles = lambda x: F.transform(x, lambda v: v.cast("double"))
    return overlap_within(doubles(a), doubles(b), tolerance)


def found(x: Column, pattern: str, group: int = 0) -> Column:
    """Ordered distinct matches."""
    return F.array_distinct(F.regexp_extract_all(x, F.lit(pattern), group))


def signature(x: Column, rules: dict[str, list[str]]) -> Column:
    """A struct of sets; each rule's words that x contains."""
    return F.struct(
        *[
            F.array_compact(F.array(*[F.when(F.contains(F.lower(x), F.lit(w)), F.lit(w)) for w in words])).alias(name)
            for name, words in rules.items()
        ]
    )


def measures(x: Column, unit: str) -> Column:
    """Numbers followed by the unit."""
    return F.array_distinct(F.transform(F.regexp_extract_all(x, F.lit(NUMBER + r"\s*" + unit), 1), lambda v: v.cast("double")))


def tokens(x: Column, stop: tuple[str, ...] = ()) -> Column:
    """Latin, number and Han runs, without stop words."""
    out = F.array_distinct(F.regexp_extract_all(F.lower(x), F.lit("([a-z]+|\\d+(?:\\.\\d+)?|[\\u4e00-\\u9fff]+)"), 1))
    return F.array_except(out, F.array(*[F.lit(s) for s in stop])) if stop else out


def dictionary_tokens(x: Column, terms: tuple[str, ...]) -> Column:
    """Terms of a dictionary that x holds, then the tokens of what remains."""
    x = F.lower(x)
    pattern = "|".join(sorted(terms, key=lambda t: (-len(t), t)))
    return F.array_union(F.regexp_extract_all(x, F.lit(f"({pattern})"), 1), tokens(F.regexp_replace(x, f"({pattern})", " ")))


def canonical_set(x: Column, table: dict[str, str]) -> Column:
    """E5: the canonical entries of a | separated value, sources in front removed."""
    whole = F.create_map(*[F.lit(v) for kv in table.items() for v in kv])
    atoms = F.transform(F.split(x, r"\|"), lambda v: F.element_at(whole, F.lower(F.regexp_replace(v, "^[^:]+:", ""))))
    return F.array_sort(F.array_distinct(F.array_compact(atoms)))


def named_like(attrs: Column, token: str) -> Column:
    """Values of all attributes of which the name holds the token."""
    return F.map_values(F.map_filter(attrs, lambda k, _: F.contains(k, F.lit(token))))


def overlap_within(a: Column, b: Column, tolerance: float, share: float = 0.01) -> Column:
    """Whether some number of each lies within max(tolerance, share of the larger)."""
    return F.exists(
        a, lambda x: F.exists(b, lambda y: F.abs(x - y) <= F.greatest(F.lit(tolerance), share * F.greatest(F.abs(x), F.abs(y))))
    )


def ids_of(attrs: Column, token: str = "id") -> Column:
    """Runs of three digits or more in attributes named like an id."""
    return F.array_distinct(F.flatten(F.transform(named_like(attrs, token), lambda v: F.regexp_extract_all(v, F.lit(r"(\d{3,})"), 1))))


def jaccard(a: Column, b: Column) -> Column:
    """Share of common members; 0 where both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(0.0)


def conflict(left: Column, right: Column, dimensions: list[str]) -> Column:
    """the first dimension in which both sides have members and share none; null if there is none."""
    out = F.lit(None).cast("string")
    for d in reversed(dimensions):
        a, b = left[d], right[d]
        out = F.when((F.size(a) > 0) & (F.size(b) > 0) & ~F.arrays_overlap(a, b), F.lit(f"{d}_mismatch")).otherwise(out)
    return out

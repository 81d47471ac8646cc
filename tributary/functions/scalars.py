"""Text, number, date and identity scalars as Column expressions; only ``folded`` (NFKC) runs Python on the executors."""

from __future__ import annotations

import re
import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Spellings of "nothing here", by purpose. The families differ on purpose.
MISSING = ("", "-")
NON_POSITIVE = ("", "-", "无", "不支持", "否", "没有", "未配备", "不提供", "0", "0.0")
IDENTITY_MISSING = ("", "-", "None", "null")
DIAGNOSIS_MISSING = ("", "-", "--", "none", "null", "未知", "无")
# Spellings of one cell value.
SYNONYMS = {
    "标配": "支持", "有": "支持", "●": "支持", "是": "支持", "选配": "选装", "无": "-", "不支持": "-", "—": "-", "--": "-",
}
# Unit endings that a comparison leaves out.
VALUE_UNITS = (
    "英寸", "吋", "喇叭", "个", "秒", "s", "km", "公里", "kg", "毫米", "mm", "kW", "马力", "万元", "元", "%", "L", "m", "W", "度", "°",
    "门", "座", "速",
)
# Attributes that hold dates, those that hold kinds of gear box, and what the latter's values may end with.
DATE_FIELDS = ("上市时间", "上市日期", "上市年份", "上市月份")
SHIFT_FIELDS = ("换挡形式", "变速箱类型")
# Spellings of "no price".
NO_PRICE = ("", "-", "--", "None", "null", "暂无", "暂无报价")
SHIFT_ENDINGS = ("换挡", "变速箱", "变速", "挡", "档")
# Words that a name is compared without.
TRIM_WORDS = (
    "运动版", "运动系列", "豪华版", "精英版", "舒适版", "领先版", "旗舰版", "智享版", "尊享版", "进取版", "时尚版", "经典版",
    "豪华型", "舒适型", "时尚型", "领先型", "精英型", "旗舰型", "进取型", "尊贵型", "智享型",
)
# Names under which brands are compared.
BRANDS = {
    "北京": "北京越野", "广汽": "广汽传祺", "北汽": "北京汽车", "aito": "问界", "问界": "问界", "奥迪audi": "奥迪", "埃尚": "埃安",
    "小鹏汽车": "小鹏", "小鹏": "小鹏", "腾势汽车": "腾势", "腾势": "腾势",
}
SERIES = {"腾势n9dm": "腾势n9"}
# Which attributes name the fuel, and which are filled for cars that burn fuel only.
FUEL_FIELDS = ("燃油类型", "燃料类型", "燃料形式", "能源类型")
ELECTRIC_RANGE_FIELDS = ("纯电续航", "CLTC纯电续航", "NEDC纯电续航")
HEAT_PUMP_FIELDS = ("热泵",)
NUMBER = r"(\d+(?:\.\d+)?)"
FULL_WIDTH = "（）【】，：；＋　\xa0" + "".join(chr(c) for r in ((65296, 65306), (65313, 65339), (65345, 65371)) for c in range(*r)), (
    "()[],:;+  " + "".join(chr(c - 65248) for r in ((65296, 65306), (65313, 65339), (65345, 65371)) for c in range(*r))
)


def trimmed(x: Column) -> Column:
    """Without white space (Unicode's) at both ends."""
    return F.regexp_replace(x, r"(?U)^\s+|\s+$", "")


def is_missing(x: Column, family: tuple[str, ...] = MISSING) -> Column:
    """Null, or one of the family's spellings after trimming."""
    return F.coalesce(trimmed(x.cast("string")).isin(*family), F.lit(True))


def is_positive(x: Column) -> Column:
    return ~is_missing(x, NON_POSITIVE)


def half_width(x: Column) -> Column:
    return F.translate(x, *FULL_WIDTH)


def match_text(x: Column) -> Column:
    """Lower case, no white space, no punctuation, no leading year; null is empty."""
    x = F.regexp_replace(F.lower(F.coalesce(x.cast("string"), F.lit(""))), r"(?U)\s+", "")
    x = F.regexp_replace(x, r"[·・\-_()（）\[\]【】/\\.,，。:：;；]", "")
    return F.regexp_replace(x, r"^(19|20)\d{2}款?", "")


def aggressive_text(x: Column, words: tuple[str, ...] = TRIM_WORDS) -> Column:
    """Lower case without white space, a leading model year and the words, one after another in their order; then without marks."""
    x = F.lower(F.regexp_replace(F.coalesce(x.cast("string"), F.lit("")), r"(?U)\s+", ""))
    x = reduce(lambda c, w: F.replace(c, F.lit(w), F.lit("")), words, F.regexp_replace(x, r"^(19|20)\d{2}款", ""))
    return F.regexp_replace(x, r"[·・\-_/()（）【】\[\]\\]", "")


def brand_text(x: Column, aliases: dict[str, str] | None = None) -> Column:
    """D3: the brand's comparison name, without a source mark behind a pipe."""
    return mapped(F.regexp_replace(match_text(x), r"\|[^|]+$", ""), BRANDS | (aliases or {}))


def series_text(x: Column, aliases: dict[str, str] | None = None) -> Column:
    """D3: the series' comparison name."""
    return mapped(match_text(x), SERIES | (aliases or {}))


def scoped_brand(brand: Column, series: Column, corrections: tuple[tuple[str, str, str], ...] = ()) -> Column:
    """D3: another brand for certain series of a brand. corrections: (brand, series, other brand) in comparison form."""
    out = brand
    for b, s, other in reversed(corrections):
        out = F.when((brand == b) & (series == s), F.lit(other)).otherwise(out)
    return out


def mapped(x: Column, table: dict[str, str]) -> Column:
    """The table's entry, else the value itself."""
    if not table:
        return x
    entries = F.create_map(*[F.lit(v) for kv in table.items() for v in kv])
    return F.coalesce(F.element_at(entries, x), x)


def longest_prefix(x: Column, names: list[str], contained: bool = False) -> Column:
    """The longest of the names that starts (or is inside) x; the first of equally long ones."""
    out = F.lit(None).cast("string")
    for name in sorted(names, key=len):  # stable; checked from the shortest, so that longer ones win
        hit = F.contains(x, F.lit(name)) if contained else F.startswith(x, F.lit(name))
        out = F.when(hit & (F.coalesce(F.length(out), F.lit(-1)) < len(name)), F.lit(name)).otherwise(out)
    return out


def first_prefix(x: Column, names: list[str]) -> Column:
    """The first name of the list that starts x, in the list's own order."""
    return F.coalesce(*[F.when(F.startswith(x, F.lit(n)), F.lit(n)) for n in names], F.lit(None).cast("string"))


def brand_of(series: Column, prefixes: list[str], known: dict[str, str] | None = None) -> Column:
    """The longest prefix inside the series, else the series' entry among the known ones, else empty."""
    return F.coalesce(longest_prefix(series, prefixes, contained=True), mapped_or_null(series, known or {}), F.lit(""))


def mapped_or_null(x: Column, table: dict[str, str]) -> Column:
    return F.element_at(F.create_map(*[F.lit(v) for kv in table.items() for v in kv]), x) if table else F.lit(None).cast("string")


def bucket_key(*parts: Column) -> Column:
    """Parts joined by |, null where any is missing."""
    whole = reduce(lambda a, b: a & b, [~is_missing(p) for p in parts])
    return F.when(whole, F.concat_ws("|", *[trimmed(p.cast("string")) for p in parts]))


def series_key(brand: Column, series: Column, prefixes: list[str] | None = None, corrections: tuple[tuple[str, str, str], ...] = ()) -> Column:
    """brand|series in comparison form, the brand derived from the series where it is empty; null where either is empty."""
    s = series_text(series)
    b = scoped_brand(brand_text(brand), s, corrections)
    if prefixes:
        b = F.when((b == "") & (s != ""), brand_text(brand_of(series, prefixes))).otherwise(b)
    return F.when((b != "") & (s != ""), F.concat_ws("|", b, s))


def series_year_key(brand: Column, series: Column, year: Column, model: Column, **more) -> Column:
    """The series' key and the year: four digits of the year's field, else the 20xx before 款 in the name, else nothing."""
    field = F.regexp_extract(F.coalesce(year.cast("string"), F.lit("")), r"(\d{4})", 1)
    named = F.regexp_extract(F.coalesce(model, F.lit("")), r"(20\d{2})款", 1)
    return F.concat(series_key(brand, series, **more), F.lit("|"), F.when(field != "", field).otherwise(named))


def canonical_value(x: Column) -> Column:
    """A synonym's value, looked up without white space, else the trimmed text; nothing is '-'."""
    text = trimmed(F.coalesce(x.cast("string"), F.lit("")))
    found = F.coalesce(mapped_or_null(F.regexp_replace(text, r"(?U)\s+", ""), SYNONYMS), text)
    return F.when(text == "", F.lit("-")).otherwise(found)


DATE = r"^(\d{4})[-.](\d{1,2})(?:[-.](\d{1,2}))?$"


def canonical_compare(x: Column, field: Column | str | None = None, dates: tuple[str, ...] = DATE_FIELDS, shifts: tuple[str, ...] = SHIFT_FIELDS) -> Column:
    """What a value is compared by: date:, shift:, num: (one unit left out) or dims:, else the canonical value; nothing is ''.

    field: the attribute's name, which tells dates and gear boxes.
    """
    field = F.coalesce(field if isinstance(field, Column) else F.lit(field).cast("string"), F.lit(""))
    text = trimmed(F.coalesce(x.cast("string"), F.lit("")))
    v = F.regexp_replace(text, r"(?U)\s+", "")
    is_date, is_shift = field.isin(*dates), field.isin(*shifts)
    part = [F.regexp_extract(v, DATE, i) for i in (1, 2, 3)]
    day = F.when(part[2] != "", F.concat(F.lit("-"), F.lpad(part[2], 2, "0"))).otherwise("")
    date = F.concat(F.lit("date:"), part[0], F.lit("-"), F.lpad(part[1], 2, "0"), day)
    box = v
    for ending in SHIFT_ENDINGS:
        box = F.regexp_replace(box, f"{ending}$", "")
    bare = F.regexp_replace(v, f"({'|'.join(VALUE_UNITS)})$", "")
    sides = F.filter(F.split(v, r"[*×xX]"), lambda d: d != "")
    flat = (F.size(sides) > 0) & F.forall(sides, lambda d: d.rlike(r"^\d+(\.\d+)?$"))
    return (
        F.when(text == "", F.lit(""))
        .when(~is_date & ~is_shift & ~v.rlike(r"[\d.*×xX]"), canonical_value(text))
        .when(is_date & (part[0] != ""), date)
        .when(is_shift & (box != ""), F.concat(F.lit("shift:"), box))
        .when(bare.rlike(r"^\d+(\.\d+)?$"), F.concat(F.lit("num:"), bare))
        .when(v.rlike(r"[*×xX]") & flat, F.concat(F.lit("dims:"), F.array_join(sides, "x")))
        .otherwise(canonical_value(text))
    )


def number_text(x: Column) -> Column:
    """A decimal number without trailing zeros."""
    x = F.regexp_replace(x, r"^0+(?=\d)", "")
    x = F.when(F.contains(x, F.lit(".")), F.regexp_replace(x, r"0+$", "")).otherwise(x)
    return F.regexp_replace(x, r"\.$", "")


def date_parts(x: Column) -> Column:
    """(year, month, day) as year text, month number and day text of a date-like value, null for others; the day may be null."""
    v = F.regexp_replace(F.coalesce(x.cast("string"), F.lit("")), r"(?U)\s+", "")
    part = [F.regexp_extract(v, DATE, i) for i in (1, 2, 3)]
    return F.when(
        part[0] != "",
        F.struct(part[0].alias("year"), part[1].try_cast("int").alias("month"), F.nullif(part[2], F.lit("")).alias("day")),
    )


def dates_fold(a: Column, b: Column) -> Column:
    """The same year and month, and at least one side without a day."""
    x, y = date_parts(a), date_parts(b)
    same = (x["year"] == y["year"]) & (x["month"] == y["month"]) & (x["day"].isNull() | y["day"].isNull())
    return F.coalesce(same, F.lit(False))


def numbers(x: Column) -> Column:
    """All numbers, as doubles."""
    return F.transform(F.regexp_extract_all(x.cast("string"), F.lit(NUMBER), 1), lambda v: v.cast("double"))


def first_number(x: Column) -> Column:
    return F.nullif(F.regexp_extract(x.cast("string"), NUMBER, 1), F.lit("")).cast("double")


def number_set(values: Column) -> Column:
    """The distinct numbers in an array of texts, in their shortest form."""
    found = F.flatten(F.transform(values, lambda v: F.regexp_extract_all(F.coalesce(v.cast("string"), F.lit("")), F.lit(NUMBER), 1)))
    return F.array_distinct(F.transform(found, number_text))


def year_of(*fields: Column) -> Column:
    """The first year in the first field that has one."""
    return F.coalesce(*[F.nullif(F.regexp_extract(f.cast("string"), r"((?:19|20)\d{2})", 1), F.lit("")) for f in fields]).cast("int")


def model_year(x: Column, bare: bool = False) -> Column:
    """The year before 款 (two digits: 80-99 are 19xx), or a bare year if those are trusted."""
    four = F.regexp_extract(x, r"((?:19|20)\d{2})\s*款", 1)
    two = F.regexp_extract(x, r"(?:^|\D)(\d{2})\s*款", 1)
    alone = F.regexp_extract(x, r"^((?:19|20)\d{2})$", 1)
    pivot = F.when(two.cast("int") >= 80, F.concat(F.lit("19"), two)).otherwise(F.concat(F.lit("20"), two))
    found = F.when(four != "", four).when(two != "", pivot)
    return (found.when(alone != "", alone) if bare else found).cast("int")


def valid_price(x: Column, *fallbacks: Column) -> Column:
    """The first field with a digit that is none of the spellings of "no price" and doesn't say so; null where there is none."""
    def ok(c: Column) -> Column:
        c = trimmed(c.cast("string"))
        return F.when(c.rlike(r"\d") & ~c.isin(*NO_PRICE) & ~F.contains(c, F.lit("暂无")), c)

    return F.coalesce(ok(x), *[ok(f) for f in fallbacks])


def official_price(source: Column, price: Column, fields: dict[str, Column]) -> Column:
    """The price, else that of the field which the row's source has it in. fields: source name to column, in order of rank."""
    out = valid_price(price)
    other = F.lit(None).cast("string")
    for name, field in reversed(fields.items()):
        other = F.when(F.contains(source, F.lit(name)), valid_price(field)).otherwise(other)
    return F.coalesce(out, other)


def with_price(df: DataFrame, source: str, price: str, fields: dict[str, str]) -> DataFrame:
    """The price column set to the valid price where there is one, and ``priced``, whether there is."""
    found = official_price(F.col(source), F.col(price), {k: F.col(c) for k, c in fields.items()})
    return df.withColumn("priced", found.isNotNull()).withColumn(price, F.coalesce(found, price))


def listed_by(x: Column, as_of: Column) -> Column:
    """Whether any date of 19xx or 20xx inside the text is on or before as_of; days over 28 count as 28, impossible ones are passed over."""
    pattern = r"((?:19|20)\d{2})[年./-]([01]?\d)(?:[月./-]([0-3]?\d))?"
    parts = [F.regexp_extract_all(x, F.lit(pattern), i) for i in (1, 2, 3)]
    def date(p: Column) -> Column:
        y, m, d = p["0"].cast("int"), p["1"].cast("int"), F.coalesce(F.nullif(p["2"], F.lit("")).cast("int"), F.lit(1))
        return F.when(m.between(1, 12) & d.between(1, 31), F.make_date(y, m, F.least(d, F.lit(28))))

    found = F.transform(F.arrays_zip(*[a.alias(str(i)) for i, a in enumerate(parts)]), date)
    return F.coalesce(F.exists(found, lambda d: F.coalesce(d <= as_of, F.lit(False))), F.lit(False))


def first_id(*fields: Column) -> Column:
    """The first id field that holds one; '' where none does."""
    return F.coalesce(*[F.when(~is_missing(f, IDENTITY_MISSING), trimmed(f.cast("string"))) for f in fields], F.lit(""))


def identity(series_id: Column, brand: Column, series: Column, year: Column, model: Column) -> tuple[Column, Column]:
    """The identity key and, where there is none, the reason."""
    gone = lambda c: is_missing(c, IDENTITY_MISSING)
    model_ok = ~gone(model)
    key = F.when(
        model_ok & ~gone(series_id), F.concat_ws("|", F.lit("series_id"), trimmed(series_id.cast("string")), trimmed(model), F.coalesce(year.cast("string"), F.lit("")))
    ).when(
        model_ok & ~gone(brand) & ~gone(series) & year.isNotNull(),
        F.concat_ws("|", F.lit("fallback"), trimmed(brand), trimmed(series), trimmed(model), year.cast("string")),
    )
    reason = F.when(key.isNotNull(), None).when(~model_ok, "missing_model").when(gone(brand), "missing_brand").when(
        gone(series), "missing_series"
    ).otherwise("missing_year")
    return key, reason


def has_han(x: Column) -> Column:
    """D15."""
    return F.coalesce(x.rlike("[\\u4e00-\\u9fff]"), F.lit(False))


def is_slug(x: Column) -> Column:
    """A latin name and a number, as addresses have them."""
    return F.coalesce(x.rlike(r"^[a-z][a-z0-9-]*-\d+$"), F.lit(False))


def status_of(x: Column, tokens: list[tuple[str, str]], codes: dict[str, str], other: str = "unknown") -> Column:
    """The first token inside the text decides, then the whole text as a code."""
    out = F.when(x.isNull(), F.lit(other))
    for token, status in tokens:
        out = out.when(F.contains(F.lower(x), F.lit(token)), F.lit(status))
    for code, status in codes.items():
        out = out.when(trimmed(x) == code, F.lit(status))
    return out.otherwise(other)


def allowed(x: Column, deny: str, allow: str) -> Column:
    """Denied first, then allowed; an empty value is allowed."""
    return F.when(is_missing(x), True).when(x.rlike(deny), False).otherwise(x.rlike(allow))


def burns_fuel_only(attrs: Column) -> Column:
    """Whether the first attribute that names a fuel says petrol or diesel and nothing electric. Values that say neither are passed over."""
    named = F.filter(F.map_entries(attrs), lambda e: e["key"].rlike("|".join(FUEL_FIELDS)) & ~is_missing(e["value"]))
    told = F.transform(named, lambda e: F.when(e["value"].rlike("电|插|增程"), F.lit(False)).when(e["value"].rlike("汽油|柴油"), F.lit(True)))
    return F.coalesce(F.get(F.filter(told, lambda t: t.isNotNull()), F.lit(0)), F.lit(False))


def fuel_defaults(attrs: Column) -> Column:
    """For cars that burn fuel only, electric ranges are 999 and heat pumps 是, whatever they were."""
    def filled(k: Column, v: Column) -> Column:
        return F.when(k.rlike("|".join(HEAT_PUMP_FIELDS)), "是").when(k.rlike("|".join(ELECTRIC_RANGE_FIELDS)), "999").otherwise(v)

    return F.when(burns_fuel_only(attrs), F.transform_values(attrs, filled)).otherwise(attrs)


def overlay_year(x: Column) -> Column:
    """The first 20xx or other four digits, else the trimmed text."""
    found = F.regexp_extract(x, r"(20\d{2}|\d{4})", 1)
    return F.when(found != "", found).otherwise(trimmed(x))


def overlay_name(x: Column) -> Column:
    """Without a model year in front and without white space."""
    return F.regexp_replace(F.regexp_replace(trimmed(x), r"(?U)^\d{2,4}款\s*", ""), r"(?U)\s+", "")


def _folded(values: pd.Series) -> pd.Series:
    """NFKC, white space joined, full case folding; each different value once."""
    known: dict[str, str] = {}
    for v in values.dropna().unique():
        known[v] = re.sub(r"\s+", " ", unicodedata.normalize("NFKC", v)).strip().casefold()
    return values.map(lambda v: known.get(v, ""))


def folded(x: Column) -> Column:
    """A text in compatibility form (NFKC), its white space joined to single spaces, its case folded in full (ß as ss); null is empty.

    Spark has neither NFKC nor case folding among its functions: this is a pandas UDF over Arrow batches.
    """
    return F.pandas_udf(_folded, "string")(x.cast("string"))


def source_tokens(x: Column, separators: str = r"[+,/|]") -> Column:
    """Ordered distinct tokens of a source string, each folded."""
    return F.array_distinct(F.filter(F.transform(F.split(folded(x), separators), lambda v: F.trim(v)), lambda v: v != ""))


def ratio(x: Column) -> Column:
    """A percentage as a number with two decimals."""
    return F.round(F.nullif(F.regexp_extract(x, NUMBER + r"\s*%", 1), F.lit("")).cast("decimal(18,4)"), 2).cast("double")


def clean_name(x: Column, strict: bool = False) -> Column:
    """Lower case without white space and marks; strictly, + and the word 改款 stay."""
    x = F.lower(F.regexp_replace(F.coalesce(x.cast("string"), F.lit("")), r"(?U)\s+", ""))
    return F.regexp_replace(x if strict else F.replace(x, F.lit("改款"), F.lit("")), r"[·・,，.。/／\\()（）\-_" + ("]" if strict else "+]"), "")


def display_key(component: Column, brand: Column, series: Column, year: Column, name: Column, strict: bool = False) -> Column:
    """audited|component; else model|series, year and name, the first two only where the name lacks them; else fallback|all four."""
    text = lambda c: trimmed(F.coalesce(c.cast("string"), F.lit("")))
    clean = lambda c: clean_name(c, strict)
    series, name = text(series), text(name)
    found = F.coalesce(year_of(year, name).cast("string"), F.lit(""))
    own = clean(name)
    lead = F.when((series != "") & ~F.contains(own, clean(series)), clean(series)).otherwise("")
    dated = F.when((found != "") & ~F.contains(own, found), F.concat(found, F.lit("款"))).otherwise("")
    model = F.concat(lead, dated, own)
    plain = lambda c: F.lower(F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"(?U)\s+", ""))
    rest = F.concat_ws("|", F.lit("fallback"), plain(brand), plain(series), plain(name), plain(year))
    kind = "strict-model|" if strict else "model|"
    return F.when(text(component) != "", F.concat(F.lit("audited|"), text(component))).when(model != "", F.concat(F.lit(kind), model)).otherwise(rest)


def vehicle_name(brand: Column, series: Column, name: Column) -> Column:
    """A name without optional equipment in brackets, years, marks, and the brand and series in front."""
    marks = r"(?U)[\s·・,，.。/／\\()（）\-_+]"
    bare = lambda c: F.regexp_replace(F.lower(F.coalesce(c.cast("string"), F.lit(""))), marks, "")
    x = F.lower(F.coalesce(name.cast("string"), F.lit("")))
    x = F.regexp_replace(x, r"[（(][^）)]*(?:选装|可选装)[^）)]*[）)]", "")
    x = F.regexp_replace(F.regexp_replace(F.replace(x, F.lit("改款"), F.lit("")), r"(?:19|20)\d{2}款?", ""), marks, "")
    for lead in (bare(brand), bare(series)):
        x = F.when((lead != "") & F.startswith(x, lead), F.substr(x, F.length(lead) + 1)).otherwise(x)
    return x


def same_vehicle(a: Column, b: Column) -> Column:
    """Whether two such names are one, and not empty."""
    return (a != "") & (a == b)


def without_source(x: Column) -> Column:
    """The value behind a source: prefix."""
    return F.regexp_replace(x, r"^[^:|]+:", "")


def canonical_series(brand: Column, series: Column, suffixes: tuple[str, ...] = ("插电式混合动力", "插电式混动", "插电混动", "phev")) -> Column:
    """The series in comparison form without its brand in front and without the first of the suffixes that ends it."""
    b = mapped(match_text(brand), BRANDS)
    s = match_text(series)
    s = F.when((b != "") & F.startswith(s, b), F.substr(s, F.length(b) + 1)).otherwise(s)
    out = s
    for x in reversed(suffixes):
        out = F.when(F.endswith(s, F.lit(x)) & (F.length(s) > len(x)), F.regexp_replace(s, f"{x}$", "")).otherwise(out)
    return out


def stripped_series(brand: Column, series: Column, suffixes: tuple[str, ...]) -> Column:
    """The series without its brand in front and without one suffix of the list."""
    x = F.when(F.startswith(series, brand) & (F.length(series) > F.length(brand)), F.substr(series, F.length(brand) + 1)).otherwise(series)
    x = trimmed(x)
    out = x
    for s in reversed(suffixes):
        out = F.when(F.endswith(x, F.lit(s)) & (F.length(x) > len(s)), F.substring(x, 1, F.length(x) - len(s))).otherwise(out)
    return trimmed(out)


def natural_key(x: Column, width: int = 12) -> Column:
    """Text whose runs of digits are padded, so that binary order counts them as numbers."""
    x = F.regexp_replace(F.lower(x), r"(\d+)", "0" * width + "$1")
    return F.regexp_replace(x, rf"0+(\d{{{width}}})(?!\d)", "$1")

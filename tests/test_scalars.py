"""Edge values of scalars and features: nothing, white space, full width, years, ties."""

import datetime

import pytest
from pyspark.sql import functions as F

from tributary.functions import features as E
from tributary.functions import scalars as S
from tributary.operators import headers as H
from tributary.operators import query as Q


def value(spark, column, **inputs):
    row = spark.range(1).select(*[F.lit(v).cast("string").alias(k) for k, v in inputs.items()])
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("text,missing,positive", [(None, True, False), ("", True, False), ("-", True, False), ("无", False, False), ("0", False, False), ("0.0", False, False), (" - ", True, False), ("12", False, True)])
def test_families_of_nothing(spark, text, missing, positive):
    assert value(spark, S.is_missing(F.col("v")), v=text) is missing
    assert value(spark, S.is_positive(F.col("v")), v=text) is positive


@pytest.mark.parametrize("text,want", [("2023款 Model（Pro）", "modelpro"), ("A　B", "ab"), ("x-Y_z", "xyz")])
def test_match_text(spark, text, want):
    assert value(spark, S.match_text(F.col("v")), v=text) == want


@pytest.mark.parametrize("text,want", [("标配", "支持"), ("标 配", "支持"), ("YES", "YES"), ("—", "-"), ("不支持", "-"), ("选配", "选装"), ("否", "否"), (None, "-"), (" a b ", "a b")])
def test_canonical(spark, text, want):
    assert value(spark, S.canonical_value(F.col("v")), v=text) == want


@pytest.mark.parametrize("text,want", [("12.50km", "num:12.50"), ("0.80", "num:0.80"), ("10 0", "num:100"), ("4500*1800×1500", "dims:4500x1800x1500"), ("4500*1800*1500mm", "4500*1800*1500mm"), ("abc", "abc"), ("x", "x"), (None, ""), ("7座", "num:7")])
def test_compare(spark, text, want):
    assert value(spark, S.canonical_compare(F.col("v")), v=text) == want


@pytest.mark.parametrize("text,field,want", [("2024.3.1", "上市时间", "date:2024-03-01"), ("2024-3", "上市日期", "date:2024-03"), ("2024.3", "长度", "num:2024.3"), ("8挡手自一体变速箱", "变速箱类型", "shift:8挡手自一体"), ("手动换挡", "换挡形式", "shift:手动"), ("有", "上市时间", "支持")])
def test_compare_by_field(spark, text, field, want):
    assert value(spark, S.canonical_compare(F.col("v"), field), v=text) == want


@pytest.mark.parametrize("a,b,want", [("2020-05", "2020.05.07", True), ("2020-05-01", "2020-05-07", False), ("2020-05", "2020-06", False), ("x", "2020-05", False)])
def test_dates_fold(spark, a, b, want):
    assert value(spark, S.dates_fold(F.col("a"), F.col("b")), a=a, b=b) is want


@pytest.mark.parametrize("text,want", [("上市 2020年2月31日", True), ("2031.01", False), ("2020-13-01", False), ("none", False), (None, False)])
def test_listing_date(spark, text, want):
    assert value(spark, S.listed_by(F.col("v"), F.lit(datetime.date(2024, 1, 1))), v=text) is want


@pytest.mark.parametrize("text,want", [("2023款", 2023), ("98款", 1998), ("07款 x", 2007), ("x", None)])
def test_model_year(spark, text, want):
    assert value(spark, S.model_year(F.col("v")), v=text) == want


def test_longest_prefix(spark):
    names = ["ab", "abc", "xyz"]
    assert value(spark, S.longest_prefix(F.col("v"), names), v="abcd") == "abc"
    assert value(spark, S.longest_prefix(F.col("v"), names), v="__ab") is None
    assert value(spark, S.longest_prefix(F.col("v"), names, True), v="__ab") == "ab"


def test_price_and_ratio(spark):
    assert value(spark, S.valid_price(F.col("a"), F.col("b")), a="暂无 1", b="12.3万") == "12.3万"
    assert value(spark, S.ratio(F.col("v")), v="330.50%") == 330.5


def test_natural_key_orders_numbers(spark):
    rows = spark.createDataFrame([("a10",), ("a2",), ("a1b3",)], "v string").orderBy(S.natural_key(F.col("v")))
    assert [r.v for r in rows.collect()] == ["a1b3", "a2", "a10"]


def test_ranges_differ_by_mode(spark):
    assert value(spark, Q.in_range(F.col("v"), 15, None), v="10|20") is True
    assert value(spark, Q.in_range(F.col("v"), 15, None, "first"), v="10|20") is False
    assert value(spark, Q.in_range(F.col("v"), None, None), v="none") is True
    assert value(spark, Q.in_range(F.col("v"), None, None, "first"), v="none") is False


def test_conflict_needs_members_on_both_sides(spark):
    rules = {"tier": ["pro", "max"], "drive": ["4wd", "2wd"]}
    c = E.conflict(E.signature(F.col("a"), rules), E.signature(F.col("b"), rules), list(rules))
    assert value(spark, c, a="pro 4wd", b="max 4wd") == "tier_mismatch"
    assert value(spark, c, a="pro", b="4wd") is None
    assert value(spark, c, a="pro 4wd", b="pro 2wd") == "drive_mismatch"


def test_tolerance(spark):
    x = E.overlap_within(S.numbers(F.col("a")), S.numbers(F.col("b")), 1.0)
    assert value(spark, x, a="1000", b="1009") is True
    assert value(spark, x, a="10", b="12") is False
    assert value(spark, x, a="", b="12") is False


@pytest.mark.parametrize("text,want", [("续航[km]", "续航(km)"), ("续航_km_", "续航(km)"), ("续航（km）", "续航(km)"), ("x_v4_value", "x_v4_value"), ("y_v4_a b", "Y"), ("油耗_L_100km_", "油耗(L/100km)"), ("  title ", "model")])
def test_headers(spark, text, want):
    assert value(spark, H.header(F.col("v"), {"title": "model", "y_v4": "Y"}), v=text) == want


def test_tokens_and_dictionary(spark):
    assert value(spark, E.tokens(F.col("v"), ("the",)), v="The Pro 2.0T 豪华") == ["pro", "2.0", "t", "豪华"]
    assert value(spark, E.dictionary_tokens(F.col("v"), ("long range", "pro")), v="Long range x pro") == ["long range", "pro", "x"]


@pytest.mark.parametrize("name,want", [
    ("2024款 Pro+ 五座四驱版", {"tier": ["pro+"], "seat": ["5"], "lidar": [], "drive": ["awd"]}), ("闪充 旗舰型 128线激光雷达", {"tier": ["flash_flagship"], "seat": [], "lidar": ["128"], "drive": []}),
    ("Promax 后驱", {"tier": [], "seat": [], "lidar": [], "drive": ["rwd"]}), ("MAX＋ 6 座", {"tier": ["max+"], "seat": ["6"], "lidar": [], "drive": []}),
])
def test_variant_signature(spark, name, want):
    assert value(spark, E.variant_signature(F.col("v")), v=name).asDict() == want


def test_evidence_and_tokens(spark):
    got = value(spark, E.positive_evidence(F.col("v")), v="X 75.0kWh 600km 超长续航版")
    assert got.asDict() == {"battery": ["75"], "range": ["600"], "range_class": ["extra_long_range"]}
    got = value(spark, E.model_tokens(F.col("s"), F.col("v"), F.col("e")), s="腾势N9DM", v="2024款 Max 七座 尊享版 1.5T 自动", e="插混")
    assert sorted(got) == sorted(["tier:max", "seat:7", "腾势", "n", "9", "尊享版", "1.5", "t", "插混"])
    assert sorted(value(spark, E.term_tokens(F.col("s"), F.col("v")), s="Song", v="Song 24款 超长续航Pro尊享版 600km")) == sorted(["超长续航", "pro", "尊享"])


@pytest.mark.parametrize("field,name,want", [("易车:插电混动|纯电", "", ["插混", "纯电"]), ("EV", "x", ["纯电"]), ("氢", "柴油版", ["柴油", "氢"]), ("", "", [])])
def test_energies(spark, field, name, want):
    assert value(spark, E.energies(F.col("f"), F.col("n")), f=field, n=name) == sorted(want)

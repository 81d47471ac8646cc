"""Operators against brute force on small inputs, and plans."""

import itertools
import random

from pyspark.sql import functions as F

from tributary.operators import cluster, fuse, quality, resolve
from tributary.operators import query as Q
from tributary.session import load
from tributary.sources import extract, sinks
from tributary.streaming import incremental


def brute_pairs(pairs, degree_one):
    by_a, by_b = {}, {}
    for a, b, s in pairs:
        by_a.setdefault(a, []).append((b, s))
        by_b.setdefault(b, []).append((a, s))
    top = lambda xs: max(s for _, s in xs)
    ties = lambda xs: sum(s == top(xs) for _, s in xs)
    bad_a, bad_b = set(), set()
    for a, b, s in pairs:
        hit = ties(by_a[a]) > 1 or ties(by_b[b]) > 1
        if hit or (degree_one and (len(by_a[a]) > 1 or len(by_b[b]) > 1)):
            bad_a.add(a), bad_b.add(b)
    return {(a, b) for a, b, s in pairs if s == top(by_a[a]) == top(by_b[b]) and a not in bad_a and b not in bad_b}


def test_mutual_best(spark):
    rng = random.Random(5)
    graphs = []
    for g in range(40):
        n = rng.randint(1, 5)
        edges = [(a, b, rng.choice([0.6, 0.7, 0.8])) for a, b in itertools.product(range(n), repeat=2) if rng.random() < 0.5]
        graphs.append([(g * 100 + a, g * 100 + b, s) for a, b, s in edges])
    rows = [r for g in graphs for r in g]
    df = spark.createDataFrame(rows, "a_id long, b_id long, score double")
    for degree_one in (False, True):
        got = {(r.a_id, r.b_id) for r in resolve.mutual_best(df, degree_one).where("accepted").collect()}
        assert got == set().union(*[brute_pairs(g, degree_one) for g in graphs])


def test_candidates_of_large_buckets_are_whole(spark):
    """A bucket of 160 x 160 rows: every pair that scores, as a walk over all pairs finds them."""
    rng = random.Random(8)
    words = [f"w{chr(97 + i)}" for i in range(26)]
    level = resolve.Level("series", ("series_key",), 0.45)

    def rows(start):
        picked = lambda: " ".join(rng.sample([*words, "Pro", "Max"], rng.randint(0, 7)))
        return [("b", "s", start + i, start + i, rng.choice([None, 2020, 2021]), picked(), rng.choice("xy"), rng.choice("pq"), {}) for i in range(160)]

    left, right = rows(0), rows(1000)
    schema = "brand string, series string, row_id long, ordinal long, year int, model string, energy string, level string, attrs map<string,string>"
    frame = lambda x: resolve.features_of(spark.createDataFrame(x, schema))
    tiers = {"Pro", "Max"}
    expected = {}
    for x in left:
        for y in right:
            s, t = ({f"tier:{w.lower()}" if w in tiers else w for w in z[5].split()} | {"s", z[6]} for z in (x, y))
            held = [set(z[5].split()) & tiers for z in (x, y)]
            j = len(s & t) / len(s | t)
            years = x[4] and y[4]
            value = 0.0 if years and x[4] != y[4] else j * 0.7 if j < 0.35 else j * 0.7 + (0.15 if years else 0) + 0.08 * (x[6] == y[6]) + 0.07 * (x[7] == y[7])
            if value >= 0.45 and not (held[0] and held[1] and not held[0] & held[1]):
                expected[x[2], y[2]] = round(value, 9)
    got = [((r.a_id, r.b_id), round(r.score, 9)) for r in resolve.candidates(frame(left), frame(right), level).collect()]
    assert len(got) == len(expected) > 100 and dict(got) == expected


def test_greedy_disjoint_goes_on_until_no_pair_is_left(spark):
    """A path of falling scores takes one pair a round: 52 rounds."""
    rows = [(i, i + 1, float(-i)) for i in range(104)]
    pairs = spark.createDataFrame(rows, "l long, r long, score double").coalesce(1)
    assert sorted(r.l for r in resolve.greedy_disjoint(pairs).collect()) == list(range(0, 104, 2))


def test_greedy_disjoint_is_the_sequential_walk(spark):
    rng = random.Random(7)
    rows = [(a, b, round(rng.random(), 1)) for a, b in itertools.combinations(range(14), 2) if rng.random() < 0.4]
    got = {(r.l, r.r) for r in resolve.greedy_disjoint(spark.createDataFrame(rows, "l long, r long, score double")).collect()}
    used, want = set(), set()
    for a, b, _ in sorted(rows, key=lambda x: (-x[2], x[0], x[1])):
        if a not in used and b not in used:
            used |= {a, b}
            want.add((a, b))
    assert got == want


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 101)]
    nodes = [(i,) for i in [*range(31), 100, 101, 200]]
    got = dict(cluster.components(spark.createDataFrame(edges, "l long, r long"), spark.createDataFrame(nodes, "node long")).collect())
    assert got == {i: 0 for i in range(31)} | {100: 100, 101: 100, 200: 200}


def test_components_of_text_and_long_chains(spark):
    edges = [(f"n{i:04}", f"n{i + 1:04}") for i in range(250)]
    nodes = [(f"n{i:04}",) for i in range(251)] + [("z",)]
    got = dict(cluster.components(spark.createDataFrame(edges, "l string, r string"), spark.createDataFrame(nodes, "node string")).collect())
    assert got == {f"n{i:04}": "n0000" for i in range(251)} | {"z": "z"}


def test_fuse_values(spark):
    rows = [
        (1, "date", 0, "A", "2020-05"), (1, "date", 1, "B", "2020.05.07"), (1, "yes", 0, "A", "标配"), (1, "yes", 1, "B", "有"),
        (1, "gone", 0, "A", "-"), (1, "num", 0, "A", "12.50km"), (1, "num", 1, "B", "12.50"), (1, "clash", 0, "A", "x"), (1, "clash", 1, "B", "y"),
    ]
    df = spark.createDataFrame(rows, "entity long, key string, src_ord int, source string, value string")
    got = {r.key: r.value for r in fuse.fuse_values(df, date_keys=("date",)).collect()}
    assert got == {"date": "2020.05.07", "yes": "支持", "gone": "-", "num": "12.50km", "clash": "A:x|B:y"}


def test_merge_json(spark):
    docs = [("k", '{"n": 3, "l": [{"id": 1, "v": "a"}], "t": "x"}', 0), ("k", '{"n": 2, "l": [{"id": 1, "v": "b"}, {"id": 2}], "t": ""}', 1)]
    got = fuse.merge_json(spark.createDataFrame(docs, "k string, d string, o int"), "k", "d", "o").first().d
    assert got == '{"l": [{"id": 1, "v": "b"}, {"id": 2}], "n": 3, "t": "x"}'


def test_keep_first_keeps_rows_without_a_key(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 4)], "k string, ordinal int")
    assert sorted(r.ordinal for r in Q.keep_first(df, F.col("k")).collect()) == [1, 3, 4]


def test_gate_raises(spark):
    import pytest

    with pytest.raises(Exception, match="gate"):
        quality.require_rows(spark.range(3), 5).collect()


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "a_id long, b_id long, score double")
    assert resolve.mutual_best(empty).count() == 0
    assert cluster.components(spark.createDataFrame([], "l long, r long"), spark.createDataFrame([], "node long")).count() == 0


def test_extraction(spark, tmp_path):
    html = "<table><tr><th>a</th><th>b</th></tr><tr><td>1</td><td> x <b>y</b> </td></tr></table>"
    rows = extract.html_rows(spark.createDataFrame([(1, html)], "k int, h string"), "k", "h").collect()
    assert [r.cells for r in rows] == [["a", "b"], ["1", "x y"]]
    one = spark.range(1).select(
        extract.transpose(F.create_map(F.lit("h"), F.array(F.lit("1"), F.lit("2")), F.lit("g"), F.array(F.lit("3")))).alias("t"),
        extract.restore_spans(F.lit("a<span class='x'></span>c"), F.create_map(F.lit("x"), F.lit("b"))).alias("s"),
        extract.split_sources(F.lit("u;v|u\n w ")).alias("l"),
        extract.kind_of(F.lit("%PDF-1.4")).alias("k"),
    ).first()
    assert [dict(x) for x in one.t] == [{"h": "1", "g": "3"}, {"h": "2", "g": "-"}] and one.s == "abc" and one.l == ["u", "v", "w"] and one.k == "pdf"
    lines = spark.createDataFrame([(1, 1, "A 1"), (1, 2, "more"), (1, 3, "B 2")], "d int, n int, t string")
    joined = extract.join_continuations(lines, "d", "n", F.col("t").rlike(r"\d"), "t").orderBy("record").collect()
    assert [r.t for r in joined] == ["A 1 more", "B 2"]
    path = tmp_path / "in"
    path.mkdir()
    (path / "a.json").write_text('[{"a": 1}, {"a": 2}]')
    (path / "b.json").write_text('{"items": [{"a": 3}]}')
    assert sorted(r.a for r in extract.read_json_rows(spark, str(path), "a: int").collect()) == [1, 2, 3]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("x", None), ('q"', "2")], "a string, b string")
    sinks.write_csv(df, str(tmp_path / "csv"), ["a", "b"])
    text = "".join(p.read_text() for p in (tmp_path / "csv").glob("part*"))
    assert text.startswith("﻿a,b") and "x,-" in text
    root = str(tmp_path / "assets")
    sinks.write_assets({"rows": df}, root)
    sinks.write_assets({"rows": df.limit(1)}, root)
    assert sinks.read_asset(spark, root, "rows").count() == 1


def test_stream_is_incremental(spark, sf_dir, tmp_path):
    events = load(spark, sf_dir, "events")
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    events.where("event_id < 500").repartition(2).write.parquet(source)
    run = lambda: incremental.run_available(spark, source, events.schema, target, state, lambda x: x)
    run()
    assert spark.read.parquet(target).count() == 500
    events.where("event_id >= 500").repartition(2).write.mode("append").parquet(source)
    run()
    assert spark.read.parquet(target).count() == events.count()


def test_filters_reach_the_scan(spark, sf_dir):
    plan = load(spark, sf_dir, "part").where(Q.default_rows(F.col("p_type"), F.col("p_brand"), ["SMALL"], ["#1"])).select("p_partkey")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<p_partkey:bigint,p_brand:string,p_type:string>" in text and "WholeStageCodegen" in text or "*(1)" in text

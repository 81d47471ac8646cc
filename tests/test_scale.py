"""Containment by an index of pieces, and pages of a sorted view, against walks over everything."""

import random
import re

from pyspark.sql import functions as F

from tributary.operators import publish
from tributary.operators import query as Q


def test_containment_equals_all_pairs(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abC") for _ in range(rng.choice([0, 1, 2, 3, 4, 6, 9])))
    # one block has nothing in common with its references
    rows = [(1000 + i, "m", f"zz{i}") for i in range(3)] + [(2000, "n", "ab"), (2001, "n", "Xaby")] + [(i, rng.choice("gh"), word() if rng.random() < 0.95 else None) for i in range(300)]
    refs = [(rng.choice("ghk"), word(), rng.randint(1, 9)) for _ in range(60)] + [("m", "q", 2), ("m", "qq", 2), ("m", "r", 5), ("n", "xaby", 3)]
    got = publish.contained(spark.createDataFrame(rows, "row_id long, g string, name string"), spark.createDataFrame(refs, "g string, name string, ratio int"), ["g"])
    want = {}
    for i, g, n in rows:
        kinds = {}
        for h, ref, ratio in refs:
            if g == h:
                a, b = n.lower() if n is not None else None, ref.lower()
                kind = 4 if a is None else 1 if a == b else 2 if b in a else 3 if a in b else 4
                kinds.setdefault(kind, {}).setdefault(ratio, set()).add(b)
        if kinds:
            told = kinds[min(kinds)]
            want[i] = (min(kinds), round(sum(told) / len(told), 2), len(told), ";".join(sorted(f"{min(r)}={x}.00" for x, r in told.items())))
    assert {r.row_id: (r.best, round(r.ratio, 2), r.n, r.detail) for r in got.collect()} == want
    assert {v[0] for v in want.values()} == {1, 2, 3, 4}


def test_a_hot_block_makes_no_product(spark):
    """2,000 names and 2,000 references of one block, each name holding one reference: about as many pairs as names are looked at."""
    names = spark.range(2000).select(F.lit("g").alias("g"), F.concat(F.lit("model "), F.sha2(F.col("id").cast("string"), 256)).alias("s"))
    refs = spark.range(2000).select(F.lit("g").alias("g"), F.substring(F.sha2(F.col("id").cast("string"), 256), 1, 12).alias("s"))
    pairs = publish.containing(names, refs, ["g"])
    assert pairs.count() == 2000


def test_pages_of_a_sorted_view(spark):
    rng = random.Random(5)
    rows = [(i, str(rng.randint(0, 9)), {}) for i in range(503)]
    df = spark.createDataFrame(rows, "ordinal long, v string, attrs map<string,string>")
    view = Q.SortedView(df, Q.QuerySpec(sort=(Q.SortLevel("v", True),), page_size=50))
    want = [i for i, v, _ in sorted(rows, key=lambda r: (-int(r[1]), r[0]))]
    assert view.pages == 11 and view.total == 503
    for k in (1, 2, 7, 11):
        got = sorted((r.place, r.ordinal) for r in view.page(k).collect())
        assert got == [(p + 1, want[p]) for p in range((k - 1) * 50, min(k * 50, 503))]
    assert view.page(99).count() == 3 and view.page(0).count() == 50
    plan = view.page(11)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*range_", plan)
    assert Q.SortedView(df.limit(0), Q.QuerySpec(page_size=5)).page(3).count() == 0


def test_json_of_another_shape_is_refused(spark, tmp_path):
    import pytest

    from tributary.sources import extract as X

    good = ['[{"id": "1", "name": "a"}, {"id": "2"}]', ' {"items": [{"id": "3"}]}', '{"data": []}', "[]"]
    for i, text in enumerate(good):
        (tmp_path / f"{i}.json").write_text(text)
    assert sorted(r.id for r in X.read_json_rows(spark, str(tmp_path), "id string, name string").collect()) == ["1", "2", "3"]
    for i, text in enumerate(('{"rows": [{"id": "1"}]}', '[{"id": "1"}, 7]', "[null]", '["x"]', '{"items": {"id": "1"}}', "not json", '[{"id": "1"}', "3", "  ")):
        folder = tmp_path / f"bad{i}"
        folder.mkdir()
        (folder / "x.json").write_text(text)
        with pytest.raises(Exception, match="not a list of objects.*x.json"):
            X.read_json_rows(spark, str(folder), "id string, name string").collect()

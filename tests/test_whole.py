"""Results on tables in which orders leave ties, and jobs that return every pair of rows."""

import random

import duckdb
import pytest

from tests.test_oracles import normal
from tributary.operators import resolve as R
from tributary.plans import catalog


def same(name, spark, folder, *tables):
    c = duckdb.connect(config={"threads": 1})
    for t in tables:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    got, want = (normal(df) for df in (catalog.queries()[name](spark, str(folder)).toPandas(), c.execute(catalog.oracle_sql()[name]).df()))
    assert len(got) == len(want) and (got.fillna("") == want.fillna("")).all().all()
    return got


def test_of_lines_with_one_number_the_first_counts(spark, tmp_path):
    """F8 overlay_lookup: lines that tie in order and number have other prices, or none."""
    rng = random.Random(8)
    rows = ", ".join(f"({rng.randint(1, 6)}, {rng.randint(0, 39)}, {rng.randint(1, 2)}, {rng.choice([f'{n}.5::DOUBLE', f'{n}.5::DOUBLE', 'NULL'])})" for n in range(4000))
    duckdb.sql(f"COPY (SELECT * FROM (VALUES {rows}) t(l_orderkey, l_partkey, l_linenumber, l_extendedprice)) TO '{tmp_path}/lineitem.parquet' (ROW_GROUP_SIZE 2048)")
    duckdb.sql(f"COPY (SELECT i AS p_partkey FROM range(45) t(i)) TO '{tmp_path}/part.parquet'")
    assert len(same("overlay_lookup", spark, tmp_path, "lineitem", "part")) == 45


@pytest.fixture(scope="module")
def twice(tmp_path_factory, sf_dir):
    """A few parts, and the same with as many copies: keys are shifted by a number that all rules on keys divide."""
    shift = 8 * 9 * 5 * 7 * 11 * 13 * 17 * 19 * 23 * 29
    folders = []
    for n in (1, 2):
        folders.append(tmp_path_factory.mktemp(f"times{n}"))
        few = f"FROM '{sf_dir}/part.parquet' WHERE p_brand IN (SELECT p_brand FROM '{sf_dir}/part.parquet' ORDER BY p_partkey LIMIT 3)"
        duckdb.sql(f"COPY (SELECT * REPLACE (p_partkey + i * {shift} AS p_partkey) FROM (SELECT * {few}), (SELECT unnest(range({n})) AS i)) TO '{folders[-1]}/part.parquet'")
    return shift, folders


def pairs_of_copies(name, spark, twice):
    """The pairs of all rows: with each row twice each pair comes four times, with what it says."""
    shift, folders = twice
    once, all_rows = (same(name, spark, folder, "part") for folder in folders)
    assert set(once.columns) - {"score", "reason"} == {"a_id", "b_id"} and len(once)
    for c in ("a_id", "b_id"):
        all_rows[c] = all_rows[c].round().astype(int) % shift
    counts = all_rows.fillna("").groupby(list(all_rows.columns)).size()
    assert len(counts) == len(once) and set(counts) == {4}


def test_low_scores_of_all_rows(spark, twice):
    """F14 low_scores: copies have pairs of their own."""
    pairs_of_copies("low_scores", spark, twice)


def test_dispatched_scores_of_all_rows(spark, twice):
    """F15 dispatched_scores: copies have pairs of their own."""
    pairs_of_copies("dispatched_scores", spark, twice)


def test_candidate_pairs_of_all_rows(spark, twice):
    """F16 candidate_pairs: all pairs of rows with a common key, copies' too, each once."""
    shift, folders = twice
    got = same("candidate_pairs", spark, folders[1], "part")
    rows = duckdb.sql(f"SELECT p_partkey, concat(p_brand, p_type, p_size), concat(p_name, p_brand) FROM '{folders[1]}/part.parquet'").fetchall()
    want = {(x[0], y[0]) for x in rows for y in rows if x[0] < y[0] and (x[1] == y[1] or x[2] == y[2])}
    pairs = [(round(r.l), round(r.r)) for r in got.itertuples() if r.part != "member"]
    assert len(pairs) == len(want) and set(pairs) == want and any(a % shift == b % shift for a, b in pairs)


def test_lists_of_a_hot_class_meet(spark):
    """F16 candidate_pairs: a class of several lists, keys that are missing, and classes that share both keys' values crosswise."""
    rows = [(i, "a", "x") for i in range(40)] + [(100 + i, None, "x") for i in range(5)] + [(200 + i, "a", None) for i in range(5)] + [(300, None, None), (301, None, None), (400, "x", "a")]
    before, R.LISTED = R.LISTED, 4
    try:
        found = R.blocking_classes(spark.createDataFrame(rows, "row_id long, k1 string, k2 string"), ["k1", "k2"]).collect()
    finally:
        R.LISTED = before
    want = {(x[0], y[0]) for x in rows for y in rows if x[0] < y[0] and ((x[1] is not None and x[1] == y[1]) or (x[2] is not None and x[2] == y[2]))}
    pairs = [(r.l, r.r) for r in found if r.part != "member"]
    assert len(pairs) == len(want) and set(pairs) == want and sum(r.part == "member" for r in found) == len(rows)


def test_conflict_reasons_of_all_rows(spark, twice):
    """F13 conflict_reasons: pairs of copies are not judged again, all of them are there."""
    pairs_of_copies("conflict_reasons", spark, twice)
    plan = catalog.queries()["conflict_reasons"](spark, str(twice[1][1]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("explode(b_ids") < plan.index("explode(a_ids") < plan.index("AS reason") < plan.index("Join Inner")


def test_buckets_that_meet_whole_have_the_pairs_of_rare_tokens(spark, sf_dir):
    """F6 visible_components, F10-F12: the same pairs and scores either way, and some of each way."""
    from tributary.plans import entities as X

    a, b = (R.features_of(X.records(spark, sf_dir, sql)) for sql in (X.SOURCE_A, X.SOURCE_B))
    before, found = R.WHOLE, []
    try:
        for R.WHOLE in (0, 40, before):
            pairs = R.candidates(a, b, R.Level("brand", ("brand_text",), 0.5))
            found.append(sorted((r.a_id, r.b_id, round(r.score, 9)) for r in pairs.collect()))
    finally:
        R.WHOLE = before
    assert found[0] == found[1] == found[2] and len(found[0]) > 20

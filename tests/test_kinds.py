"""Copies: queries on tables of which every row comes several times, and jobs that must look at the whole table."""

import duckdb
import pytest

from tributary.plans import catalog


def test_keywords_are_looked_for_in_the_tables_texts(spark, tmp_path):
    """names and widths count, not a row's number alone."""
    rows = "SELECT * FROM (VALUES (2, 'old ring', 'Brand#1', 'SMALL', 5, 1.0), (3, 'old bolt', 'Brand#1', 'SMALL', 12, 1.0), (7, 'old bolt', 'Brand#1', 'SMALL', 33, 1.0)) t(p_partkey, p_name, p_brand, p_type, p_size, p_retailprice)"
    duckdb.sql(f"COPY ({rows}) TO '{tmp_path}/part.parquet'")
    got = catalog.queries()["feature_filter_keyword"](spark, str(tmp_path)).collect()
    assert sorted(r.row_id for r in got) == [2, 3]


COPIED = (
    "absorption absorptions alias_matches candidate_pairs discover_candidates dispatched_scores greedy_disjoint low_scores resolve_all ledger third_source third_source_hard_block unique_bests visible_components"
).split()


@pytest.fixture(scope="module")
def copies(tmp_path_factory, sf_dir):
    """Each part once, and seven more times under other keys."""
    folder = tmp_path_factory.mktemp("copies")
    duckdb.sql(f"COPY (SELECT * REPLACE (p_partkey + i * 1000 AS p_partkey) FROM (FROM '{sf_dir}/part.parquet' ORDER BY p_partkey LIMIT 12), (SELECT unnest(range(8)) AS i)) TO '{folder}/part.parquet'")
    return str(folder)


@pytest.mark.parametrize("name", COPIED)
def test_copies_have_the_results_of_all_pairs(name, spark, copies):
    """Kinds count as often as they have rows, copies tie, members share what their representative has."""
    from tests.test_oracles import normal

    c = duckdb.connect()
    c.execute(f"CREATE VIEW part AS SELECT * FROM read_parquet('{copies}/part.parquet')")
    got, want = (normal(df) for df in (catalog.queries()[name](spark, copies).toPandas(), c.execute(catalog.oracle_sql()[name]).df()))
    assert len(got) == len(want) and (got.fillna("") == want.fillna("")).all().all()


def test_pairs_do_not_grow_with_copies(spark, copies):
    """F8: twelve parts have at most 66 pairs, however often each comes."""
    found = catalog.queries()["candidate_pairs"](spark, copies)
    assert found.where("part = 'pair'").count() <= 66 and found.where("part = 'member'").count() == 96

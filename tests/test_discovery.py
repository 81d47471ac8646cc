"""discovery on copies, and which of several rows of one card a candidate follows."""

import duckdb
import pytest
from pyspark.sql import functions as F

from tributary.operators import cluster as C
from tributary.operators import discover as D
from tributary.operators import resolve as R
from tributary.plans import catalog


def test_a_candidate_follows_the_last_row_of_its_card(spark):
    """Rows 1 and 10 are copies, row 5 has their card and another level: the last of the three is 10."""
    rows = [(f"A:{i:02d}", i, "m", "s", "2020", "red ring", "汽油", level, {}, ["A"], 1) for i, level in ((1, "p"), (5, "q"), (10, "p"))]
    rows += [("B:07", 7, "m", "s", "2020", "red ring", "汽油", "p", {}, ["B"], 2)]
    schema = "row_id string, ordinal long, brand string, series string, year string, model string, energy string, level string, attrs map<string,string>, sources array<string>, n_rows int"
    nodes = R.aliased(C.conflict_features(R.features_of(spark.createDataFrame(rows, schema))))
    found, _ = D.discover(nodes, F.lit(False))
    assert [(r.score, r.alternatives) for r in found.collect()] == [(1.0, 1)]


@pytest.mark.parametrize("name", ["discovered_candidates", "discovery_counters"])
def test_copies(name, spark, sf_dir, tmp_path):
    """Each part once, and three more times under other keys."""
    from tests.test_oracles import normal

    duckdb.sql(f"COPY (SELECT * REPLACE (p_partkey + i * 1000 AS p_partkey) FROM (FROM '{sf_dir}/part.parquet' ORDER BY p_partkey LIMIT 24), (SELECT unnest(range(4)) AS i)) TO '{tmp_path}/part.parquet'")
    c = duckdb.connect()
    c.execute(f"CREATE VIEW part AS SELECT * FROM read_parquet('{tmp_path}/part.parquet')")
    got, want = (normal(df) for df in (catalog.queries()[name](spark, str(tmp_path)).toPandas(), c.execute(catalog.oracle_sql()[name]).df()))
    assert len(got) == len(want) and (got.fillna("") == want.fillna("")).all().all()

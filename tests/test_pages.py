"""a page of a sorted view reads its own rows, not its whole range."""

from tributary.operators import query as Q


def test_a_page_skips_the_rest_of_its_range(spark):
    df = spark.createDataFrame([(i, str(i % 7), {}) for i in range(300)], "ordinal long, v string, attrs map<string,string>")
    view = Q.SortedView(df, Q.QuerySpec(sort=(Q.SortLevel("v"),), page_size=9))
    want = [i for i, _ in sorted(((i, i % 7) for i in range(300)), key=lambda r: (r[1], r[0]))]
    for k in range(1, view.pages + 1):
        assert [(r.place, r.ordinal) for r in view.page(k).collect()] == [(p + 1, want[p]) for p in range((k - 1) * 9, min(k * 9, 300))]
    plan = view.page(view.pages)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(at_" in plan
    whole = Q.SortedView(df, Q.QuerySpec(sort=(Q.SortLevel("v"),), page_size=290))
    assert [r.ordinal for r in whole.page(1).collect()] == want[:290]

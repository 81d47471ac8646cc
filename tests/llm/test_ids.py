"""Ids beyond 2^53 beside null ones, in one batch, come back as they are from every operator."""

import pytest
from pyspark.sql import functions as F

from tributary.llm import catalog

BIG = [(1 << 60) + 1, (1 << 60) + 3, None, 5]


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_big_ids_beside_nulls(spark, tmp_path, name):
    texts = ["one two three four five", "six seven eight nine ten", "eleven twelve", None]
    one = lambda rows, schema: spark.createDataFrame(rows, schema).coalesce(1)
    docs = one([(i, t, "en", "s", 1) for i, t in zip(BIG, texts)], "doc_id long, text string, lang string, source string, n_chars long")
    pages = one([(i, f"http://a.org/{k}", t) for k, (i, t) in enumerate(zip(BIG, texts))], "page_id long, url string, html string")
    vectors = one([(i, [float(k), float(k * k), 1.0 / (k + 1)]) for k, i in enumerate(BIG)], "vec_id long, embedding array<float>")
    labels = one([(BIG[0], 1, 0), (5, 0, 0)], "doc_id long, quality int, toxic int")
    for table, df in {"documents": docs, "pages": pages, "embeddings": vectors, "labels": labels}.items():
        df.write.parquet(f"{tmp_path}/{table}.parquet")
    got = catalog.queries()[name](spark, str(tmp_path))
    ids = next((c for c in ("doc_id", "page_id", "vec_id") if c in got.columns), None)
    if ids is None:
        assert got.agg(F.sum("kept")).first()[0] is not None  # a report by part
        return
    assert {r[ids] for r in got.select(ids).collect()} == set(BIG)


def test_many_rows_of_one_labelled_id_do_not_reach_the_driver(spark, monkeypatch):
    """5,000 rows repeat one labelled id: one of them is learned from."""
    from tributary.llm import quality

    rows = [(1, f"good words {i}") for i in range(5000)] + [(2, "bad text"), (3, "other bad text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, label int")
    seen = []
    plain = type(docs).toPandas
    monkeypatch.setattr(type(docs), "toPandas", lambda self: seen.append(plain(self)) or seen[-1])
    quality.fit(docs, labels)
    assert [len(x) for x in seen] == [len({r.doc_id for r in labels.where(~quality.in_fold(F.col("doc_id"))).collect()})]

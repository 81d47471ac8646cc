"""The pipeline's stages on small inputs: each decision takes effect, clean documents stay."""

import collections
import importlib.util
import sys
from pathlib import Path

import numpy as np
import pytest

ROOT = Path(__file__).resolve().parents[2]


@pytest.fixture(scope="module")
def pipeline():
    sys.path.insert(0, str(ROOT))
    spec = importlib.util.spec_from_file_location("corpus_pipeline", ROOT / "corpus_pipeline.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """A folder of tables with planted cases."""
    import random

    rng = random.Random(9)
    words = ["stone", "river", "light", "slowly", "walks", "green", "under", "seven", "houses", "quiet"] + [f"x{i}" for i in range(200)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = [(i, prose(90)) for i in range(60)]
    rows += [(100 + i, " ".join(rng.choice(["BUY!!", "NOW!!", "CLICK%%"]) for _ in range(50))) for i in range(40)]
    rows += [(200, rows[0][1]), (201, rows[0][1])]  # exact copies: the last one stays
    near = rows[1][1].split()
    near[40] = "changed"
    rows.append((202, " ".join(near)))  # a near copy: the first one stays
    rows.append((203, prose(20) + " " + " ".join(rows[2][1].split()[:70]) + " " + prose(20)))  # a passage of 70 words
    rows += [(204, None), (205, "")]
    folder = tmp_path_factory.mktemp("tables")
    df = spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, label int")
    df.write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, 0) for i in range(60)] + [(100 + i, 0, 0) for i in range(40)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder), dict(rows)


def test_stages(spark, small, pipeline):
    folder, texts = small
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(pipeline.STAGES)
    assert [n for n, _ in pipeline.STAGES] == ["quality classifier", "exact dedup", "n-gram Jaccard join", "substring dedup", "packing"]
    good = stages["quality classifier"](spark, docs, folder)
    kept = {r.doc_id for r in good.collect()}
    assert good.columns == list(pipeline.COLUMNS) and {i for i in range(60)} <= kept and not kept & set(range(100, 140))
    once = stages["exact dedup"](spark, docs, folder)
    ids = {r.doc_id for r in once.collect()}
    assert once.columns == list(pipeline.COLUMNS) and not ids & {0, 200, 204} and {201, 205} <= ids
    apart = {r.doc_id for r in stages["n-gram Jaccard join"](spark, docs, folder).collect()}
    assert not apart & {200, 201, 202} and {0, 1, 203, 204, 205} <= apart
    cut = {r.doc_id: r for r in stages["substring dedup"](spark, docs, folder).collect()}
    assert cut[2].text == texts[2] and len(cut[203].text.split()) == 40 and cut[203].n_chars == len(cut[203].text) and 200 not in cut and 204 in cut
    pieces = stages["packing"](spark, docs, folder).toPandas()
    assert set(pieces.doc_id) == set(texts) and pieces.groupby("sequence_id").length.sum().max() <= 1024


def test_run_is_the_stages_one_after_another(spark, small, pipeline):
    folder, texts = small
    got = pipeline.run(spark, folder).toPandas()
    assert not set(got.doc_id) & {0, 200, 202, *range(100, 140)}
    assert {1, 2, 201, 203} <= set(got.doc_id)
    from tributary.llm.common import library_encoder, vocabulary

    tokenizer = library_encoder(vocabulary("byte_bpe_50k.json")).tokenizer
    tokens = collections.Counter({d: n for d, n in zip(got.doc_id, got.doc_tokens)})
    assert tokens[5] == len(tokenizer.encode(texts[5], add_special_tokens=False).ids) + 1
    assert np.all(got.groupby("doc_id").length.sum() == got.groupby("doc_id").doc_tokens.first())


def test_empty_tables(spark, small, pipeline):
    folder, _ = small
    empty = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, stage in pipeline.STAGES:
        assert stage(spark, empty, folder).count() == 0, name


def test_null_and_repeated_ids(spark, small, pipeline):
    """Rows without an id, or with an id that another text has too, are decided each by itself."""
    folder, texts = small
    words = ["stone", "river", "light", "slowly", "walks", "green", "under", "seven", "houses", "quiet"] + [f"x{i}" for i in range(200)]
    rng = np.random.default_rng(4)
    prose = lambda n: " ".join(rng.choice(words, n))
    alone, twice, junk, clean, shared = prose(90), prose(90), " ".join(rng.choice(["BUY!!", "NOW!!", "CLICK%%"], 50)), prose(90), prose(70)
    near = lambda t: " ".join("changed" if i == 40 else w for i, w in enumerate(t.split()))
    rows = [(None, alone), (None, twice), (None, twice), (None, junk), (150, junk), (150, clean), (None, near(clean)), (None, near(texts[3]))]
    rows += [(160, prose(20) + " " + shared + " " + prose(20)), (170, prose(20) + " " + shared + " " + prose(20)), (170, prose(90))]
    rows += [(180, near(texts[4])), (180, prose(90))]
    docs = spark.read.parquet(f"{folder}/documents.parquet").select(*pipeline.COLUMNS).where("doc_id < 60")
    more = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], docs.schema)
    stages = dict(pipeline.STAGES)
    run = lambda name, df: collections.Counter((r.doc_id, r.text) for r in stages[name](spark, df, folder).collect())
    docs = docs.unionByName(more)
    base = collections.Counter({(i, texts[i]): 1 for i in range(60)})
    planted = collections.Counter(rows)
    assert run("quality classifier", docs.unionByName(spark.read.parquet(f"{folder}/documents.parquet").select(*docs.columns).where("doc_id between 100 and 139"))) == base + planted - collections.Counter([(None, junk), (150, junk)])
    assert run("exact dedup", docs) == base + planted - collections.Counter([(None, twice), (None, junk)])
    gone = [(None, twice), (None, junk), (None, near(clean)), (None, near(texts[3])), (180, near(texts[4]))]
    assert run("n-gram Jaccard join", docs) == base + planted - collections.Counter(gone)
    few = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in [rows[0], *rows[8:11]]], docs.schema)
    cut = run("substring dedup", few)
    whole = collections.Counter([rows[0], rows[8], rows[10]])
    assert cut - whole == collections.Counter([(170, " ".join(rows[9][1].split()[:20] + rows[9][1].split()[-20:]))]) and not whole - cut

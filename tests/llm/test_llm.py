"""Each operator on cases planted by hand (nulls, empty and very long texts, ties, repeats, clashing columns) and against brute force."""

import base64
import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tributary.llm import (
    components,
    exact_dedup,
    fingerprint_index,
    jaccard_join,
    packing,
    progressive_jpeg,
    quality,
    repair,
    tree_bpe,
    url_reputation,
    warc,
)
from tributary.llm import common as K
from tributary.session import scratch

RNG = random.Random(11)
WORDS = [f"w{i}" for i in range(400)]


def prose(n, rng=RNG):
    return " ".join(rng.choice(WORDS) for _ in range(n))


BASE = prose(120)
EDITED = BASE.split()
EDITED[60] = "other"
TEXTS = [
    None, "", "  \n\t ", "one", "one two three", BASE, BASE, " ".join(EDITED), prose(40) + "\n" + " ".join(BASE.split()[20:90]) + "\n" + prose(30),
    "né\u3000ü x\xa0y  z\r\n\n don't 12.5!? <|endoftext|>", "a" * 3000, "the " * 2000, prose(5000), BASE.upper(), "日本語 テキスト", "\x01 odd \x1c",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", 0, "clash") for i, t in enumerate(TEXTS)] + [(6, BASE, "en", "s", 0, "repeat"), (None, "no id " + BASE, "en", "s", 0, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, ids string")


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def tokenizer():
    """The library as it comes."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(K.vocabulary("byte_bpe_50k.json"))


def rows_of(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


def encoded(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")


# 1
def test_repair_round_trip(spark, docs, empty, tokenizer):
    path = scratch(spark, "t")
    repair.write(docs, path, K.vocabulary("byte_bpe_50k.json"))
    got = sorted(((r.start, r.doc_id, bytes(r.ids)) for r in repair.read(spark, path).collect()))
    assert [g[1] is None for g in got][:1] == [True]  # a null id comes first
    assert [g[1] for g in got[1:]] == sorted(d for d, _ in rows_of(docs) if d is not None)
    want = collections.Counter((d, encoded(tokenizer, t).tobytes()) for d, t in rows_of(docs))
    assert collections.Counter((d, b) for _, d, b in got) == want
    assert [g[0] for g in got] == np.cumsum([0, *[len(g[2]) // 4 for g in got]])[:-1].tolist()
    path = scratch(spark, "t")
    repair.write(empty, path, K.vocabulary("byte_bpe_50k.json"))
    assert repair.read(spark, path).count() == 0


def test_repair_random_access():
    rng = np.random.default_rng(3)
    counts = np.array([1, 500, 3, 4000, 1, 2000])
    ids = rng.integers(0, 12, counts.sum()).astype("<u4")
    ids[900:3000] = 5  # overlapping equal pairs
    shard = repair.Shard(repair.pack(list(range(6)), counts, ids, 100))
    assert len(shard.symbols) < len(ids) and len(shard.left)
    edge = np.concatenate([[0], np.cumsum(counts)])
    for i in range(6):
        assert (shard.document(i) == ids[edge[i] : edge[i + 1]]).all()
    assert (shard.span(3, 17, 1999) == ids[edge[3] + 17 : edge[3] + 1999]).all()
    assert (shard.lengths == [len(repair.expansions(shard.left, shard.right, shard.waves, shard.sizes, 100)[0][s : s + n]) for s, n in zip(shard.starts[100:], shard.sizes[100:])]).all()


def frequent_pairs(symbols, ends, least):
    """Pairs of neighbours, inside documents, that occur so often without overlapping themselves."""
    counts = collections.Counter()
    for a, b in zip([0, *ends[:-1]], ends):
        i, before = a, None
        while i + 1 < b:
            pair = (int(symbols[i]), int(symbols[i + 1]))
            if pair[0] == pair[1] and before == (pair, i - 1):
                before = None
            else:
                counts[pair] += 1
                before = (pair, i)
            i += 1
    return {p for p, n in counts.items() if n >= least}


@pytest.mark.parametrize("bits", [2, 19])
def test_repair_goes_on_until_no_pair_is_frequent(bits, monkeypatch):
    """Also where all pairs share a few slots."""
    monkeypatch.setattr(repair, "SLOT_BITS", bits)
    monkeypatch.setattr(repair, "SLOTS", 1 << bits)
    rng = np.random.default_rng(3)
    passage = rng.integers(0, 5000, 600)
    parts = [np.concatenate([rng.integers(0, 5000, 20), passage, np.full(int(n), 7)]) for n in rng.integers(1, 90, 40)]
    counts = np.array([len(x) for x in parts])
    ids = np.concatenate(parts)
    symbols, ends, left, right, waves = repair.compress(ids, np.cumsum(counts), 5000)
    assert not frequent_pairs(symbols, ends, repair.MIN_COUNT)
    lengths = repair.expansion_lengths(left, right, waves, 5000)
    assert lengths.max() >= 500 and len(symbols) < 40 * 40
    shard = repair.Shard(repair.pack(list(range(40)), counts, ids, 5000))
    assert all((shard.document(i) == parts[i]).all() for i in range(40))
    for least in (2, 3):
        out = repair.compress(ids, np.cumsum(counts), 5000, least)
        assert not frequent_pairs(out[0], out[1], least)


def test_encoder_is_the_library(tokenizer):
    parts = ["a", " ", "  ", "\n", "\n\n", "\t", "don't", "!", "é", "\xa0", "\u3000", "12", "日本", "\x01", "\x1c", ".", ",", "\r\n", "'s", "the", "<|endoftext|>"]
    encoder = K.LibraryEncoder(K.vocabulary("byte_bpe_50k.json"), 200)  # forgets again and again
    assert encoder.encode(["hello <|endoftext|> world"])[0].tolist() == [31373, 220, 50256, 995]
    rng = random.Random(4)
    for _ in range(60):
        texts = ["".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randint(0, 30))) for _ in range(15)]
        ids, counts = encoder.encode(texts)
        assert ids.tolist() == [i for t in texts for i in tokenizer.encode(t, add_special_tokens=False).ids]
        assert counts.tolist() == [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]


def test_table_encoder_is_the_library(tokenizer):
    """Also where it forgets, its table grows, and chunks stand around the size of a key."""
    rng = random.Random(5)
    parts = ["a", "the", "é" * 7, "é" * 7 + "x", "é" * 8, "x" * 14, "x" * 15, "x" * 16, "x" * 40, "\x00", "a\x00", "日本", "<|endoftext|>", "”", "\x01", "\t", "", "\n"]
    for most in (4, 300, 2_000_000):
        encoder = K.TableEncoder(K.vocabulary("byte_bpe_50k.json"), most)
        for _ in range(20):
            texts = [rng.choice([" ", "\n"]).join(rng.choice(parts[: rng.choice([12, 12, 18])]) + str(rng.choice(["", rng.randrange(300)])) for _ in range(rng.randint(1, 30))) for _ in range(12)]
            texts += ["", " ", "a"]
            ids, counts = encoder.encode(texts)
            want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
            assert ids.tolist() == [i for w in want for i in w]
            assert counts.tolist() == [len(w) for w in want]
        assert encoder.kept > 0 and encoder.kept < 1 << encoder.bits


def test_repair_encodes_no_known_chunk_again(tokenizer, monkeypatch):
    """900,000 different chunks, twice: the second time all of them are known (500,000 were before)."""
    made = K.library_encoder(K.vocabulary("byte_bpe_50k.json"), K.TableEncoder)
    seen = []
    monkeypatch.setattr(made, "encode_chunks", lambda chunks, plain: (seen.append(len(chunks)), (np.zeros(len(chunks), np.uint32), np.ones(len(chunks), np.int64)))[1])
    texts = [" ".join(f"{a}w{b}" for b in range(900)) for a in range(1000)]
    for _ in range(2):
        for a in range(0, 1000, 50):
            made.encode(texts[a : a + 50])
    assert sum(seen) == 900_000
    K.give_back()
    K._encoders.clear()  # its ids were made up


def test_repair_looks_only_at_pairs_that_can_be_frequent(monkeypatch):
    """Rounds after the first look at few places, and the grammar is that of looking at all."""
    rng = np.random.default_rng(8)
    ids = np.minimum(rng.zipf(1.3, 60_000), 3000)
    ids[5000:9000] = np.repeat(rng.integers(0, 4, 800), 5)
    ends = np.append(np.arange(700, 60_000, 700), 60_000)
    looked, whole = [], repair.frequent

    def counted(a, last, least, fresh=None):
        looked.append(int(len(a) if fresh is None else fresh.sum()))
        return whole(a, last, least, fresh)

    monkeypatch.setattr(repair, "RULES_A_ROUND", 100)
    monkeypatch.setattr(repair, "frequent", lambda a, last, least, fresh=None: whole(a, last, least))
    want = repair.compress(ids, ends, 5000)
    monkeypatch.setattr(repair, "frequent", counted)
    got = repair.compress(ids, ends, 5000)
    assert all(np.array_equal(x, y) for x, y in zip(got, want))
    assert len(looked) >= 5 and looked[-1] < len(got[0]) / 2


# 2
def brute_passages(rows, window):
    first = {}
    for d, t in rows:
        w = K.split_words(t)
        for j in range(len(w) - window + 1):
            k = b" ".join(w[j : j + window])
            first[k] = min(first.get(k, 1 << 63), 1 << 62 if d is None else d)
    out = []
    for d, t in rows:
        w, gone = K.split_words(t), set()
        for j in range(len(w) - window + 1):
            if first[b" ".join(w[j : j + window])] < (1 << 62 if d is None else d):
                gone.update(range(j, j + window))
        out.append((d, len(w), len(gone), b" ".join(x for j, x in enumerate(w) if j not in gone).decode()))
    return out


@pytest.mark.parametrize("batches,window,gram", [(1, 50, 8), (3, 50, 8), (5, 12, 3)])
def test_fingerprint_index(spark, docs, batches, window, gram):
    rng = random.Random(batches)
    passages = [prose(70, rng) for _ in range(4)]
    rows = rows_of(docs)
    for i in range(100, 130):
        rows.append((i, prose(rng.randint(0, 60), rng) + " " + " ".join(rng.choice(passages).split()[rng.randint(0, 30) :]) + " " + prose(rng.randint(0, 60), rng)))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("digest", F.lit(1))
    got = fingerprint_index.dedup(df, window, batches, gram).collect()
    assert collections.Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == collections.Counter(brute_passages(rows, window))


def test_fingerprint_index_empty_and_compaction(spark, empty):
    assert fingerprint_index.dedup(empty).count() == 0
    index = fingerprint_index.FingerprintIndex(spark, fanout=2)
    for i in range(4):
        index.add(spark.createDataFrame([(i, prose(80))], "doc_id long, text string"))
    assert [level for level, _ in index.runs] == [2]


# 3
def test_jpeg(docs, empty):
    got = progressive_jpeg.load_media(progressive_jpeg.store(docs)).collect()
    want = collections.Counter((d, progressive_jpeg.padded(t)) for d, t in rows_of(docs))
    assert collections.Counter((r.doc_id, bytes(r.payload)) for r in got) == want
    assert all(len(r.rgb) == r.height * r.width * 3 and len(r.payload) % 576 == 0 and len(r.payload) for r in got)
    assert len({bytes(r.media) for r in got if r.doc_id in (5, 6)}) == 1
    assert progressive_jpeg.load_media(progressive_jpeg.store(empty)).count() == 0


def scalar_decode(data):
    """A plain decoder, one bit at a time, for one component without restarts."""
    image = progressive_jpeg.Image(data)
    blocks = image.across * image.down
    coefficient = np.zeros((blocks, 64), int)
    for s in image.scans:
        raw = s["data"].replace(b"\xff\x00", b"\xff")
        bits = iter("".join(f"{b:08b}" for b in raw) + "1" * 64)
        read = lambda n: int("".join(next(bits) for _ in range(n)) or "0", 2)
        counts, symbols = s["codes"][0]
        codes, code, at = {}, 0, 0
        for length, n in enumerate(counts, 1):
            for x in symbols[at : at + n]:
                codes[length, code] = x
                code += 1
            at += n
            code <<= 1

        def symbol():
            v = n = 0
            while True:
                v, n = v << 1 | read(1), n + 1
                if (n, v) in codes:
                    return codes[n, v]

        extend = lambda v, n: v if not n or v >> (n - 1) else v - (1 << n) + 1
        low, high, al, run, last = s["low"], s["high"], s["al"], 0, 0
        for b in coefficient:
            if low == 0:
                if s["ah"]:
                    b[0] |= read(1) << al
                else:
                    n = symbol()
                    last += extend(read(n), n)
                    b[0] = last << al
                continue
            k = low
            fix = lambda i: read(1) and not abs(b[i]) & (1 << al) and b.__setitem__(i, b[i] + (1 << al) * (1 if b[i] > 0 else -1))
            while k <= high and not run:
                x = symbol()
                r, n = x >> 4, x & 15
                if n == 0 and r < 15:
                    run = (1 << r) + read(r)
                    break
                if not s["ah"]:
                    k += r
                    if n:
                        b[k] = extend(read(n), n) * (1 << al)
                    k += 1
                    continue
                value = (1 if read(1) else -1) << al if n else 0
                while k <= high:
                    if b[k]:
                        fix(k)
                    elif r == 0:
                        if value:
                            b[k] = value
                        k += 1
                        break
                    else:
                        r -= 1
                    k += 1
            if run:
                if s["ah"]:
                    for i in range(k, high + 1):
                        if b[i]:
                            fix(i)
                run -= 1
    return coefficient


def test_jpeg_refinements_that_bring_new_coefficients():
    """A hand-made file: one component, a first scan of few coefficients, refinements with new ones, runs and bands."""
    fields = []
    h = progressive_jpeg._made([(s, 4) for s in (0x00, 0x01, 0x02, 0x11, 0x21, 0x10)], [0xF0, 0x31])
    dc = progressive_jpeg.DC_CODE
    put = lambda code, s: fields.append((int(code.code[s]), int(code.length[s])))
    scans = []

    def flush(low, high, ah, al):
        values, lengths = np.array([f for f, _ in fields]), np.array([n for _, n in fields])
        raw, _ = progressive_jpeg.pack_fields(values, lengths, np.array([len(values)]))
        scans.append(progressive_jpeg._segment(0xFFDA, bytes([1, 1, 0, low, high, ah << 4 | al])) + raw.tobytes().replace(b"\xff", b"\xff\x00"))
        fields.clear()

    for d in (3, -2, 0, 5):  # DC of four blocks
        n = abs(d).bit_length()
        put(dc, n), fields.append((d if d > 0 else d + (1 << n) - 1, n))
    flush(0, 0, 0, 1)
    put(h, 0x02), fields.append((2, 2)), put(h, 0x11), fields.append((1, 1)), put(h, 0xF0), put(h, 0x01), fields.append((0, 1)), put(h, 0x00)
    put(h, 0x10), fields.append((1, 1))  # three blocks without coefficients
    flush(1, 63, 0, 1)
    # block 0: known at 1, 3, 20; a new one at 2 and at 5, a run of sixteen zeros, then the end with corrections
    put(h, 0x01), fields.append((1, 1)), fields.append((1, 1)), put(h, 0x11), fields.append((0, 1)), fields.append((1, 1)), put(h, 0x00), fields.append((1, 1))
    put(h, 0x21), fields.append((1, 1)), put(h, 0x00)
    put(h, 0xF0), put(h, 0x01), fields.append((0, 1)), put(h, 0x10), fields.append((0, 1))
    flush(1, 63, 1, 0)
    for bit in (1, 0, 1, 1):
        fields.append((bit, 1))
    flush(0, 0, 1, 0)
    frame = progressive_jpeg._segment(0xFFC2, bytes([8, 0, 16, 0, 16, 1, 1, 0x11, 0]))
    data = b"\xff\xd8" + progressive_jpeg._segment(0xFFDB, b"\x00" + bytes([1] * 64)) + frame + dc.segment(0) + h.segment(0x10) + b"".join(scans) + b"\xff\xd9"
    want = scalar_decode(data)
    got = progressive_jpeg.coefficients([progressive_jpeg.Image(data)])[0][0]
    assert want[0, 2] and want[0, 5] and (got == want).all()


def test_idct_is_the_formula():
    rng = np.random.default_rng(1)
    block = rng.integers(-50, 50, 64)
    grid = np.zeros(64)
    grid[progressive_jpeg.ZIGZAG] = block
    f = grid.reshape(8, 8)
    c = [1 / np.sqrt(2)] + [1] * 7
    x = [[sum(c[u] * c[v] * f[v, u] * np.cos((2 * i + 1) * u * np.pi / 16) * np.cos((2 * j + 1) * v * np.pi / 16) for u in range(8) for v in range(8)) / 4 for i in range(8)] for j in range(8)]
    assert np.allclose(progressive_jpeg.IDCT.T @ f @ progressive_jpeg.IDCT, x, atol=1e-2)


# 4
def test_exact_dedup(spark, docs, empty, monkeypatch):
    monkeypatch.setattr(exact_dedup, "HOT_MOST", 6)  # some digests are salted
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.groups_of_copies(docs).collect()}
    groups = collections.defaultdict(list)
    for d, t in rows_of(docs):
        groups[t or ""].append(d)
    want = {(d, max((x for x in g if x is not None), default=None), len(g), d is not None and d == max(x for x in g if x is not None)) for g in groups.values() for d in g}
    assert got == want
    assert exact_dedup.groups_of_copies(empty).count() == 0 and exact_dedup.keep(empty).count() == 0
    kept = exact_dedup.keep(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted({w[0] for w in want if w[3]})


def test_exact_dedup_is_native(docs):
    plan = exact_dedup.groups_of_copies(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian"))


# 5
def test_quality(spark, empty):
    rng = random.Random(2)
    good = [" ".join(rng.choice(["river", "stone", "walks", "light", "slowly"]) for _ in range(40)) for _ in range(120)]
    bad = [" ".join(rng.choice(["BUY!!", "click$$", "win%%"]) for _ in range(30)) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(good + bad)] + [(900, None), (901, ""), (902, "BUY!! win%% " * 5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("label", F.lit(5))
    labels = spark.createDataFrame([(i, 1) for i in range(120)] + [(i, 0) for i in range(120, 180)] + [(None, 1), (3, None), (3, 1)], "doc_id long, label int")
    got = {r.doc_id: r for r in quality.classify(df, labels).collect()}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got.values())
    held = [r for i, r in got.items() if r.held_out and i < 180]
    assert held and all(r.predicted == (1 if r.doc_id < 120 else 0) for r in held)
    assert got[902].predicted == 0 and all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert quality.classify(empty, labels.limit(0)).count() == 0
    assert {r.score for r in quality.classify(df, labels.limit(0)).collect()} == {0.5}


def test_quality_scores_are_those_of_averaged_vectors(spark, docs):
    """The summed shares against an average over every word's and every n-gram's own vector."""
    rng = np.random.default_rng(4)
    vectors, output, bias = rng.normal(0, 1, (quality.BUCKETS, quality.DIMENSIONS)), rng.normal(0, 1, (2, quality.DIMENSIONS)), np.array([0.2, -0.1])
    model = quality.Model((vectors @ (output[1] - output[0])).astype(np.float32), float(bias[1] - bias[0]))
    got = collections.Counter((r.doc_id, round(r.score, 4)) for r in quality.score(docs, model).collect())
    want = collections.Counter()
    for d, t in rows_of(docs):
        words = K.split_words(t)
        mean = vectors[quality.buckets_of(words)[0]].mean(0) if words else np.zeros(quality.DIMENSIONS)
        p = np.exp(output @ mean + bias)
        want[d, round(float(p[1] / p.sum()), 4)] += 1
    assert got == want


def test_quality_of_one_class_and_long_ids(spark):
    """Labels of one class teach nothing: 0.5 everywhere; ids of more than 53 bits stay as they are beside null ones."""
    long = (1 << 60) + 1
    df = spark.createDataFrame([(long, "good text"), (None, "other"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(9)], "doc_id long, label int")
    got = quality.classify(df, labels, carry=("text",)).collect()
    assert {(r.doc_id, r.text) for r in got} == {(long, "good text"), (None, "other"), (2, "")} and {r.score for r in got} == {0.5}


def test_quality_finds_held_out_labels(spark):
    """Held-out rows of the given tables: the area under the curve."""
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    scored = quality.classify(spark.read.parquet(f"{folder}/documents.parquet"), labels).where("held_out")
    rows = [(r.score, r.label) for r in scored.join(labels.where("label is not null"), "doc_id").collect()]
    good, bad = [s for s, y in rows if y == 1], [s for s, y in rows if y == 0]
    assert good and bad
    assert sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad)) > 0.8


# 6
def test_null_and_repeated_pages(spark):
    pages = spark.createDataFrame([(None, "x://a.net"), (None, "x://a.net"), (7, "x://a.net"), (7, "x://b.co.uk/p")], "page_id long, url string")
    labels = spark.createDataFrame([(7, 1)] * 60 + [(None, 0)], "page_id long, good int")
    got = url_reputation.judge(pages, labels).collect()
    assert len(got) == 4 and sorted(r.host for r in got) == ["a.net", "a.net", "a.net", "b.co.uk"] and {r.verdict for r in got} == {"allow"}


def test_url_rules(spark):
    rows = [(1, "HTTP://Sub.Example.ORG/es/x?q"), (2, "https://example.org/en/12#f"), (3, "x://a.com/fr/"), (4, "x://a.com/de/1"), (5, None), (6, "no scheme"), (7, "x://notexample.org/es/"), (8, "x://q.net"), (8, "x://q.net")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("clash"))
    labels = spark.createDataFrame([(8, 0)] * 40 + [(99, 1)], "page_id long, good int")
    got = {r.page_id: r for r in url_reputation.judge(pages.select("page_id", "url", "host"), labels).collect()}
    assert [(got[i].host, got[i].path, got[i].rule) for i in range(1, 8)] == [
        ("sub.example.org", "/es/x", "example.org/es/"), ("example.org", "/en/12", "example.org/en/1"), ("a.com", "/fr/", "com/fr/"),
        ("a.com", "/de/1", "com/de/"), ("", "", None), ("", "", None), ("notexample.org", "/es/", "org/"),
    ]
    assert [got[i].verdict for i in (1, 2, 3, 4, 7, 8)] == ["block", "block", "allow", "block", "allow", "block"]
    assert url_reputation.judge(pages.limit(0), labels.limit(0)).count() == 0


def test_reputation_shrinks(spark):
    pages = spark.createDataFrame([(i, "big.a.x") for i in range(200)] + [(1000, "small.a.x"), (1001, "bad.b.x")] + [(2000 + i, "bad.b.x") for i in range(50)], "page_id long, host string")
    labels = spark.createDataFrame([(i, 1) for i in range(200)] + [(2000 + i, 0) for i in range(50)], "page_id long, good int")
    got = {r.host: r for r in url_reputation.reputation(pages, labels).collect()}
    assert got["big.a.x"].mean > got["small.a.x"].mean > got["bad.b.x"].mean and all(r.bound < r.mean for r in got.values())


# 7
def test_packing(docs, empty, tokenizer):
    got = packing.pack(docs, K.vocabulary("byte_bpe_50k.json")).toPandas()
    want = collections.Counter((-1 if d is None else d, encoded(tokenizer, t).tobytes()) for d, t in rows_of(docs))
    got["doc_id"] = got["doc_id"].fillna(-1).astype(int)
    assert (got["ids"].map(len) == 4 * got["length"]).all() and got["length"].between(1, 1024).all()
    for d, size in {(d, len(b) // 4) for d, b in want}:
        n = sum(c for (x, b), c in want.items() if x == d and len(b) // 4 == size)
        part = got[(got.doc_id == d) & (got.doc_tokens == size)]
        assert part["length"].sum() == n * size
        if n == 1:
            assert b"".join(part.sort_values("start")["ids"]) in {b for (x, b) in want if x == d}
    s = got.sort_values(["sequence_id", "offset"])
    assert (s["offset"] == s.groupby("sequence_id")["length"].cumsum() - s["length"]).all()
    full = got.groupby("sequence_id")["length"].sum()
    assert (full <= 1024).all() and (full < 1024).sum() <= 1 and full.index.max() + 1 == len(full)
    assert packing.pack(empty, K.vocabulary("byte_bpe_50k.json")).count() == 0


def test_packing_plan_fills_windows():
    rng = np.random.default_rng(2)
    histogram = np.bincount(rng.integers(1, 1024, 5000), minlength=1024)
    histogram[700] += 900
    chosen, taken = packing.plan(histogram)
    assert (taken <= histogram).all() and all(sum(c) == 1024 and n > 0 for c, n in chosen)
    assert taken.sum() > 0.6 * (histogram.sum() - 900)
    used = np.zeros(1024, int)
    for c, n in chosen:
        for length in c:
            used[length] += n
    assert (used == taken).all()


# 8
def test_tree_bpe(docs, empty):
    import public_tokenizers as P
    import tiktoken

    path = P.path("byte_bpe_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=tree_bpe.read_ranks(path), special_tokens={})
    got = tree_bpe.decode(tree_bpe.encode(docs, path, P.PATTERN), path).collect()
    want = collections.Counter((d, np.array(library.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for d, t in rows_of(docs))
    assert collections.Counter((r.doc_id, bytes(r.ids), bytes(r.data)) for r in got) == want
    assert tree_bpe.encode(empty, path, P.PATTERN).count() == 0


def test_tree_join_is_direct_encoding():
    import public_tokenizers as P

    bpe = tree_bpe.TreeBpe(tree_bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")), leaf=3)
    rng = random.Random(8)
    for _ in range(300):
        data = "".join(rng.choice(["the", "in", "g", "ation", "é", "0", "xx", "aaaa", "-"]) for _ in range(rng.randint(1, 60))).encode()
        tree = bpe._tree(data)
        assert tree == bpe.merge(data) and bpe.decode(tree) == data


# 9
def brute_classes(rows, n, percent):
    def grams(t):
        w = (t or "").encode().translate(jaccard_join.LOWER).split()
        return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()

    sets = [grams(t) for _, t in rows]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
                links[i] += 1
                links[j] += 1
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), 1 << 62), 1 << 62 if d is None else d)
    return collections.Counter((d, len(sets[i]), None if least[root(i)] == 1 << 62 else least[root(i)], links[i]) for i, (d, _) in enumerate(rows))


def family(rng, size, n):
    base = prose(n, rng).split()
    out = []
    for _ in range(size):
        w = list(base)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = rng.choice(WORDS)
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("tile", [150, 400_000])
def test_jaccard_join(spark, docs, tile, monkeypatch):
    monkeypatch.setattr(jaccard_join, "TILE", tile)
    rng = random.Random(tile)
    rows = rows_of(docs)
    for f in range(6):
        rows += [(1000 * (f + 1) + i, t) for i, t in enumerate(family(rng, 12, rng.choice([6, 9, 30, 66, 130])))]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("block", F.lit("clash"))
    got = jaccard_join.classes(df, 4, 0.85).collect()
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in got) == brute_classes(rows, 4, 85)


def test_sets_with_one_name(spark, monkeypatch):
    """Sets of which the first half of the digest is the same stay apart."""
    real = jaccard_join.digests
    monkeypatch.setattr(jaccard_join, "digests", lambda grams: (real(grams)[0] % 3, real(grams)[1]))
    rng = random.Random(5)
    rows = [(i, t) for f in range(3) for i, t in enumerate(family(rng, 5, 60), 100 * f)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    marked = jaccard_join.sizes_and_nodes(df, 4).collect()
    assert len({r.node for r in marked}) <= 3 < len({r.check for r in marked})
    got = jaccard_join.classes(df, 4, 0.85).collect()
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in got) == brute_classes(rows, 4, 85)


def test_jaccard_empty_table(empty):
    assert jaccard_join.classes(empty).count() == 0


def test_linked_sets_share_a_key():
    rng = np.random.default_rng(6)
    for threshold in (0.8, 0.85):
        for _ in range(400):
            n = int(rng.integers(1, 300))
            a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            b = np.setdiff1d(a, rng.choice(a, int(rng.integers(0, len(a) // 5 + 1)), False))
            b = np.unique(np.concatenate([b, rng.integers(0, 1 << 63, int(rng.integers(0, n // 8 + 1))).astype(np.uint64)]))
            if len(a) != len(b) or (a != b).any():
                if len(np.intersect1d(a, b)) >= threshold * len(np.union1d(a, b)):
                    assert len(np.intersect1d(jaccard_join.keys(a, threshold), jaccard_join.keys(b, threshold)))


def test_join_by_key_is_a_join(spark):
    rng = random.Random(3)
    rows = [(rng.choice([1] * 2000 + list(range(2, 900))), i) for i in range(5000)]
    left = spark.createDataFrame(rows, "k long, v long")
    right = left.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("v").alias("m")).where("k % 3 <> 0")
    got = {(r.k, r.v, r.m) for r in K.join_by_key(left, right, ["k"], "n").collect()}
    top = {}
    for k, v in rows:
        top[k] = max(v, top.get(k, 0))
    assert got == {(k, v, top[k]) for k, v in rows if k % 3}


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1040)]
    parent = {x: x for e in links for x in e}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    got = dict(components.connected(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {x: root(x) for a, b in links if a != b for x in (a, b)}


# 10
def test_warc(spark):
    big = "<p>" + "x\r\n\r\n" * 30000
    rows = [(1, "u", "same"), (2, "u", "same"), (3, None, None), (4, "u", ""), (5, "u\r\nv", big), (6, "u", big), (None, "u", "lost id"), (7, "u", "日本")]
    captures = spark.createDataFrame(rows, "id long, url string, payload string").withColumn("keeper", F.lit(9))
    path = scratch(spark, "warc")
    warc.write(captures, path)
    got = {r.id: r for r in warc.read(spark, path).collect()}
    sha = lambda b: base64.b32encode(hashlib.sha1(b).digest()).decode()
    assert len(got) == len(rows)
    for i, _, payload in rows:
        r, data = got[i], (payload or "").encode()
        assert (r.payload_bytes, r.payload_digest) == (len(data), sha(data))
        if r.record_type == "response":
            assert bytes(r.payload) == data
    assert {i: r.refers_to for i, r in got.items() if r.record_type == "revisit"} == {1: 2, 3: 4, 5: 6}
    path = scratch(spark, "warc")
    warc.write(captures.limit(0), path)
    assert warc.read(spark, path).count() == 0


def test_warc_files_are_bounded(spark, monkeypatch):
    """Records of any number and length go to files of a bounded size, and come back."""
    monkeypatch.setattr(warc, "ROW_BYTES", 40_000)
    monkeypatch.setattr(warc, "ROWS", 3)
    rows = [(i, "u", f"{i} " + "é" * (i * 997 % 30_000)) for i in range(60)]
    path = scratch(spark, "warc")
    warc.write(spark.createDataFrame(rows, "id long, url string, payload string").coalesce(1), path)
    got = {r.id: bytes(r.payload).decode() for r in warc.read(spark, path).collect()}
    assert got == {i: p for i, _, p in rows}
    sizes = [r.length for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("length").collect()]
    assert len(sizes) > 5


def test_warc_null_and_repeated_ids(spark):
    """Each row is a record of its own, above SEGMENT too; a revisit has the payload of what it refers to."""
    a, b, c, d = ("<p>" + x * 50_000 for x in "abcd")
    rows = [(None, "u1", a), (None, "u2", b), (None, "u3", "alone"), (None, "u4", c), (None, "u5", c), (9, "u6", a)]  # one null id has a keeper
    rows += [(None, "u7", "shared"), (8, "u8", "shared"), (7, "u9", "other"), (None, "u10", "other")]  # two keepers of null ids
    rows += [(1, "v1", b + "1"), (1, "v2", b + "2"), (2, "v3", d), (2, "v4", d), (1, "v5", d)]  # repeated ids, unequal and equal
    rows += [((1 << 60) + 1, "w1", "long id"), (None, "w2", "long id")]
    path = scratch(spark, "warc")
    warc.write(spark.createDataFrame(rows, "id long, url string, payload string").repartition(3), path)
    got = {r.url: r for r in warc.read(spark, path).collect()}
    assert len(got) == len(rows) == warc.read(spark, path).count()
    refers = {"u1": 9, "u7": 8, "u10": 7, "v5": 2, "w2": (1 << 60) + 1}
    for i, url, payload in rows:
        r = got[url]
        assert (r.id, r.refers_to, r.payload_bytes) == (i, refers.get(url), len(payload)), url
        assert r.payload_digest == warc.payload_digest(payload.encode())
        assert r.payload is None if url in refers else bytes(r.payload) == payload.encode()


def test_warc_reassembly_checks(spark):
    parts = warc.records("7", "u", b"y" * 100_000, None, segment=30_000)
    assert len(parts) == 4 and b"WARC-Segment-Total-Length" in parts[-1]
    assert warc.dechunked(warc.chunked(b"abc" * 9999)) == b"abc" * 9999
    assert warc.dechunked(b"3;x=y\r\nabc\r\n0\r\nT: 1\r\n\r\n") == b"abc"

    def stored(records):
        path = scratch(spark, "warc")
        text = spark.createDataFrame([(warc.END.join(r.decode() for r in records),)], "value string")
        text.write.option("lineSep", warc.END).option("compression", "gzip").text(path)
        return warc.read(spark, path)

    assert len(stored(parts[::-1]).collect()) == 1  # any order
    with pytest.raises(Exception, match="segments"):
        stored(parts[:2] + parts[3:]).collect()

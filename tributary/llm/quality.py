"""Quality classifier: supervised subword embeddings.

Each word has a hashed vector and so has each of its character n-grams (with word-boundary marks); a
document is the average of all of them; a softmax layer over two classes is learned together with the
vectors by stochastic gradient descent in numpy, on the driver, over a bounded sample of labelled rows
(``most_labelled``, half from each class where there are enough, chosen by a hash of the id). Scoring
covers every whole text: as the output layer is linear before the softmax, a word's share of the logit
is summed once and remembered, which equals averaging its vectors.

Cases: null and empty texts have no features and get the score of the bias alone; labels that are null are
left out; repeated label rows of one document count once (the larger label), so do rows that repeat its id (one of its texts is learned from); with no labels at all every
score is 0.5; further columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import give_back, mix, split_words, text_batches
from tributary.session import ship

BUCKETS = 1 << 17
DIMENSIONS = 8
NGRAMS = (2, 3, 4)
EPOCHS = 6
RATE = 20.0
BATCH = 16
#: Bound on the labelled rows that are fitted.
MOST_LABELLED = 4000
FOLDS = 5
THRESHOLD = 0.3


class Features:
    """Words by number, with one value for each: what ``learn`` makes of a word's buckets. Remembers about ``most`` words."""

    def __init__(self, most: int = 300_000):
        self.most = most
        self.index: dict[bytes, int] = {}
        self.new: list[bytes] = []

    def numbers(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all words of all texts, and how many each text has. New words are left in ``new``."""
        found = [split_words(t) for t in texts]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        index, new = self.index, self.new

        def number(word: bytes) -> int:
            n = index.get(word)
            if n is None:
                index[word] = n = len(index)
                new.append(word)
            return n

        return np.fromiter(map(number, chain.from_iterable(found)), np.int64, int(counts.sum())), counts

    def forget(self) -> int:
        """Forget all but the words seen first, which are the frequent ones; their number."""
        keep = self.most // 2
        self.index = dict(islice(self.index.items(), keep))
        return min(keep, len(self.index))


def buckets_of(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and of their character n-grams (inside < and >), and the word that each belongs to."""
    marked = [f"<{w.decode('utf-8', 'replace')}>" for w in words]
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    word = np.repeat(np.arange(len(words)), sizes)
    hashes = [np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))]
    owners = [np.arange(len(words))]
    for n in NGRAMS:
        if len(codes) < n:
            continue
        h = np.full(len(codes) - n + 1, n, np.uint64)
        for i in range(n):
            h = h * np.uint64(0x9E3779B97F4A7C15) + codes[i : len(codes) - n + 1 + i]
        inside = word[: len(h)] == word[n - 1 :]
        hashes.append(mix(h[inside]))
        owners.append(word[: len(h)][inside])
    return (np.concatenate(hashes) & np.uint64(BUCKETS - 1)).astype(np.int64), np.concatenate(owners)


def _examples(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """doc_id, label, buckets and their weights in the average (summing to 1)."""
    for frame in text_batches(frames):
        rows = []
        for doc, label, text in zip(frame["doc_id"], frame["label"], frame["text"]):
            times = Counter(split_words(text))
            if times:
                found, owner = buckets_of(list(times))
                weight = np.bincount(found, np.fromiter(times.values(), np.float64, len(times))[owner], BUCKETS)
                b = np.flatnonzero(weight)
                rows.append((doc, label, b.astype("<i4").tobytes(), (weight[b] / weight.sum()).astype("<f4").tobytes()))
            else:
                rows.append((doc, label, b"", b""))
        yield pd.DataFrame(rows, columns=["doc_id", "label", "buckets", "weights"])


def in_fold(doc_id):
    """Whether the row is held out: crc32 of the id as text, modulo FOLDS, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> DataFrame:
    """Up to ``most`` labelled rows outside the held-out fold: doc_id, label, text."""
    one = (
        labels.where("doc_id is not null and label is not null")
        .groupBy("doc_id")
        .agg(F.max("label").cast("int").alias("label"))
        .where(~in_fold(F.col("doc_id")))
    )
    order = [F.xxhash64(F.col("doc_id"), F.lit(7)), F.col("doc_id")]
    picked = None
    for value in (0, 1):
        part = one.where(F.col("label") == value).orderBy(*order).limit(most // 2)
        picked = part if picked is None else picked.unionByName(part)
    # ``most`` rows at most: bounded, so that the texts of the corpus need not move
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("doc_id", "label", "text")


class Model:
    """Each bucket's share of the logit of label 1 against label 0, and the bias."""

    def __init__(self, shares: np.ndarray, bias: float):
        self.shares, self.bias = shares, bias


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED, seed: int = 1) -> Model:
    """labels: doc_id, label (0 or 1). Prior shares of the classes come from all labelled rows outside the fold."""
    ship(docs.sparkSession)
    found = labelled_sample(docs, labels, most).mapInPandas(_examples, "doc_id long, label int, buckets binary, weights binary")
    # One row a document, however often its id is repeated: ``most`` rows at most reach the driver.
    one = found.groupBy("doc_id").agg(F.min(F.struct("label", "buckets", "weights")).alias("r"))
    rows = one.select("doc_id", "r.*").toPandas()
    prior = labels.where("label is not null").where(~in_fold(F.col("doc_id"))).agg(F.avg(F.col("label").cast("double"))).first()[0]
    rows = rows.sort_values("doc_id")
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    output = np.zeros((2, DIMENSIONS), np.float32)
    bias = np.zeros(2, np.float32)
    y = rows["label"].to_numpy(np.int64)
    if not len(y) or len(set(y)) < 2:
        return Model(np.zeros(BUCKETS, np.float32), 0.0)
    b = [np.frombuffer(x, "<i4") for x in rows["buckets"]]
    w = [np.frombuffer(x, "<f4") for x in rows["weights"]]
    # Rows of the rarer class weigh as much as the labelled corpus has of it.
    share = np.array([np.mean(y == 0), np.mean(y == 1)])
    weight = (np.array([1 - prior, prior]) / share).astype(np.float32)
    steps, done = EPOCHS * len(y), 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for start in range(0, len(order), BATCH):
            pick = order[start : start + BATCH]
            means = np.stack([w[i] @ vectors[b[i]] for i in pick])
            logits = means @ output.T + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(pick)), y[pick]] -= 1
            p *= weight[y[pick]][:, None] / len(pick)
            rate = np.float32(RATE * (1 - done / steps))
            back = p @ output
            output -= np.float32(0.05) * rate * (p.T @ means)
            bias -= np.float32(0.01) * rate * p.sum(0)
            for row, i in enumerate(pick):
                vectors[b[i]] -= rate * len(pick) * w[i][:, None] * back[row]
            done += len(pick)
    direction = output[1] - output[0]
    return Model(vectors @ direction, float(bias[1] - bias[0]))


def score(docs: DataFrame, model: Model, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns to carry and score (0 to 1) of every document. Carried columns pass as text, so that no number changes;
    a carried text is empty where it is null."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast((model.shares, model.bias))  # BUCKETS floats, whatever the corpus

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shares, bias = sent.value
        known = Features()
        sums, sizes = np.empty(0), np.empty(0)  # each known word's summed share and number of features
        for frame in text_batches(frames):
            numbers, counts = known.numbers(list(frame["text"]))
            if known.new:
                found, owner = buckets_of(known.new)
                sums = np.concatenate([sums, np.bincount(owner, shares[found], len(known.new))])
                sizes = np.concatenate([sizes, np.bincount(owner, minlength=len(known.new))])
                known.new.clear()
            doc = np.repeat(np.arange(len(counts)), counts)
            total = np.bincount(doc, sums[numbers], len(counts))
            logit = bias + total / np.maximum(np.bincount(doc, sizes[numbers], len(counts)), 1)
            yield pd.DataFrame({c: frame[c] for c in ("doc_id", *carry)} | {"score": 1 / (1 + np.exp(-np.clip(logit, -500, 500)))})
            if len(known.index) > known.most:
                n = known.forget()
                sums, sizes = sums[:n], sizes[:n]
        del known, sums, sizes
        give_back()

    others = [c for c in ("doc_id", *carry) if c != "text"]
    sent_on = docs.select(*[F.col(c).cast("string") for c in others], "text")
    carried = "".join(f"{c} string, " for c in ("doc_id", *carry))
    scored = sent_on.mapInPandas(work, f"{carried}score double")
    return scored.select(*[F.col(c).cast(docs.schema[c].dataType) for c in ("doc_id", *carry)], "score")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, most: int = MOST_LABELLED, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns to carry, held_out, score, predicted of every document."""
    return score(docs, fit(docs, labels, most), carry).select(
        "doc_id",
        *carry,
        in_fold(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )

"""The filter audit against a game played document by document."""

from itertools import permutations

import pytest

from tributary.llm import filter_audit as A

LONG = " ".join(f"w{i}" for i in range(250))
SHOUT = LONG.upper().replace("W", "W W")
TEXTS = [LONG, LONG, LONG + " #", "short", None, "", "the " * 300, SHOUT, SHOUT, "SHORT $", LONG + " é" * 400 + " A", "x" * 200_000, "\x1cone\x0btwo " * 99]


def brute(rows, labels):
    """Every document runs through every order."""
    parts = {}
    for i, (doc, lang, text) in enumerate(rows):
        text = text or ""
        words = text.encode().split()
        caps = sum("A" <= c <= "Z" for c in text)
        failed = {n for n, hit in zip("ABCDE", (
            len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * caps > 3 * len(text), any(c in "#$%&*|" for c in text),
            doc is not None and any((t or "") == text and d is not None and d < doc for d, _, t in rows),
        )) if hit}
        good, toxic = labels.get(doc, (0, 0)) if doc is not None else (0, 0)
        parts.setdefault(lang or "", []).append((failed, good, toxic))
    out = {}
    for part, docs in parts.items():
        for order in map("".join, permutations("ABCDE")):
            left = docs
            for step, name in enumerate(order, 1):
                gone = [d for d in left if name in d[0]]
                left = [d for d in left if name not in d[0]]
                fails = sum(name in d[0] for d in docs)
                out[part, order, step] = [len(left), len(gone), fails - len(gone), sum(d[0] == {name} for d in docs), sum(d[1] for d in gone), sum(d[2] for d in gone)]
        total = {n: sum(v[1] for (p, o, s), v in out.items() if p == part and o[s - 1] == n) for n in "ABCDE"}
        for (p, o, s), v in out.items():
            if p == part:
                v.append(total[o[s - 1]])
    return {k: tuple(v) for k, v in out.items()}


def test_audit_equals_brute_force(spark):
    rows = [(i, ("en", "de", None)[i % 3], t) for i, t in enumerate(TEXTS)]
    rows += [(3, "en", "short"), (None, "en", LONG), (None, "fr", LONG), ((1 << 60) + 1, "de", LONG), ((1 << 60) + 3, "", None)]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, lang string, text string, mask string, part int")
    marks = [(0, 1, 0), (1, 1, 1), (1, 0, 0), (2, None, 1), (3, 1, None), (None, 1, 1), (9, 0, 1), ((1 << 60) + 1, 1, 0)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    by_doc = {}
    for d, q, t in marks:
        a, b = by_doc.get(d, (0, 0))
        by_doc[d] = (max(a, q or 0), max(b, t or 0))
    got = A.audit(docs, labels).collect()
    want = brute(rows, by_doc)
    assert {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in got} == want
    assert len(got) == len(want) == 600 * 4


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, lang string, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert A.audit(docs, labels).count() == 0
    one = spark.createDataFrame([(1, None, None)], "doc_id long, lang string, text string")
    got = A.audit(one, labels).collect()
    assert len(got) == 600 and {r.part for r in got} == {""} and all(r.shapley == (120 if r.filter_order[r.step - 1] == "A" else 0) for r in got)


@pytest.mark.parametrize("seed", range(3))
def test_potential_gives_the_mean_over_orders(seed):
    import random

    rng = random.Random(seed)
    counts = [rng.randrange(1000) for _ in range(32)]
    worth = A.worths(counts)
    potential = A.potentials(worth)
    for i in range(5):
        total = 0
        for order in permutations(range(5)):
            before = sum(1 << j for j in order[: order.index(i)])
            total += worth[before | 1 << i] - worth[before]
        assert potential[31] - potential[31 ^ 1 << i] == total

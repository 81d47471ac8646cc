"""The retry frontier over batches, against a walk over all attempts."""

import inspect
import random

from pyspark.sql import functions as F

from tributary.session import scratch
from tributary.streaming import frontier as N


def test_states_go_from_batch_to_batch(spark):
    """random attempts in five batches, late ones and a null item among them; no item is a Python call of its own."""
    rng, most, backoff, late = random.Random(7), 3, 40, 30
    batches, rows, edge = [], [], 0
    for b in range(5):
        batch = [(rng.choice([None, *range(40)]), rng.randint(b * 100 - 60, b * 100 + 99), 1000 * b + i, rng.random() < 0.7) for i in range(120)]
        batches.append([(k, max(at, 0), n, bad) for k, at, n, bad in batch])
    root, table_root = scratch(spark, "attempts"), scratch(spark, "frontier-test")
    for batch in batches:
        df = spark.createDataFrame(batch, "item long, at long, n long, failed boolean").select("item", F.timestamp_millis("at").alias("ts"), "n", "failed")
        df.coalesce(1).write.mode("append").parquet(root)
    stream = lambda: spark.readStream.schema("item long, ts timestamp, n long, failed boolean").option("maxFilesPerTrigger", 1).parquet(root)
    me = N.Producer("me", "1")
    for _ in range(2):  # the second run has lost its notes, and brings all batches again
        N.run_frontier(stream(), N.Frontier("item", "ts", "n", "failed", most, backoff, late), N.BatchTable(spark, table_root, me), scratch(spark, "notes"))
    want, states, latest = set(), {}, None
    for b, batch in enumerate(batches):
        was, passed = dict(states), latest
        latest = max([r[1] for r in batch] + ([latest] if latest is not None else []))
        for k, at, _, bad in sorted(batch, key=lambda r: (r[1], r[2])):
            if passed is None or at > passed - late:
                now = states.get(k, (0, 0, 0, 0, "waiting"))
                states[k] = N.advance((*now[:4], "retry") if now[4] == "ready" else now, at, bad, most, backoff)
        for k, s in states.items():
            if s[4] == "retry" and s[3] < latest - late:
                states[k] = (*s[:4], "ready")
        want |= {(b, k, *s) for k, s in states.items() if s != was.get(k)}
    table = N.BatchTable(spark, table_root, me)
    table.verify()
    rows = table.read().select("batch", "item", "attempts", "early", "repeats", "ready_at", "reason").collect()
    assert {tuple(r) for r in rows} == want and len(rows) == len(want)
    assert {r.reason for r in rows} == {"done", "exhausted", "retry", "ready"}
    assert "InPandasWithState" not in inspect.getsource(N)

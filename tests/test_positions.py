"""Records by position against their cells."""

import json
import random

from tributary.plans import catalog
from tributary.sources import extract as X


def test_records_of_odd_rows(spark):
    """ragged, null and empty groups give the records that their cells give."""
    rng = random.Random(11)
    value = lambda: rng.choice([None, *[
        {"value": rng.choice(["", "-", "a", "b", None]), "status": rng.choice([None, "0", "停产 预售"]), "id": rng.choice([None, "7"]),
         "baseInfo": rng.choice([None, "no json", '{"carName": "m", "status": "已上市"}', '{"carId": "c"}']), "subList": rng.choice([None, [], [{"value": "s"}]])}
        for _ in range(9)
    ]])
    item = lambda n: rng.choice([None, {"name": f"n{n}", "paramValues": rng.choice([None, [], *[[value() for _ in range(rng.randint(1, 4))] for _ in range(4)]])}])
    group = lambda g: rng.choice([None, {"items": None}, *[{"items": [item(10 * g + i) for i in range(3)]} for _ in range(3)]])
    docs = [(i, json.dumps({"data": [group(g) for g in range(3)]})) for i in range(60)] + [(100, None), (101, "{}"), (102, '{"data": null}'), (103, "no json"), (None, '{"data": [{"items": [{"name": "x", "paramValues": [{"value": "1"}]}]}]}')]
    rows = spark.createDataFrame(docs, "k long, payload string")
    want = {}
    for c in sorted(X.groups_by_position(rows, "k", "payload").collect(), key=lambda c: c.order):
        r = want.setdefault((c.k, c.position), {"model": None, "model_id": None, "status": "unknown", "attrs": {}})
        r["model"], r["model_id"] = c.model if c.model is not None else r["model"], c.model_id if c.model_id is not None else r["model_id"]
        r["status"] = c.status if c.status != "unknown" else r["status"]
        if c.value is not None:
            r["attrs"][c.name] = c.value
    found = X.records_by_position(rows, "k", "payload")
    got = found.collect()
    assert {(r.k, r.position): {c: r[c] for c in ("model", "model_id", "status", "attrs")} for r in got} == want and len(got) == len(want) > 60


def test_records_are_made_inside_their_rows(spark, sf_dir):
    """only the lines are grouped; before, all cells were sorted once more."""
    plan = catalog.queries()["position_records"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and plan.count("Filter") == 0

"""Commit logs, tables of batches and the retry frontier: races, repeats, foreign manifests."""

import json
import random
import threading

import pytest
from pyspark.sql import functions as F

from tributary.session import scratch
from tributary.sources import sinks
from tributary.sources.commits import CommitLog
from tributary.streaming import frontier


def test_two_writers_never_take_one_number(spark):
    root, got, lock = scratch(spark, "log"), [], threading.Lock()

    def write(who):
        log = CommitLog(spark, root)
        for i in range(12):
            number = log.append({"who": who, "i": i})
            with lock:
                got.append((number, who, i))

    threads = [threading.Thread(target=write, args=(w,)) for w in range(4)]
    [t.start() for t in threads], [t.join() for t in threads]
    assert sorted(n for n, _, _ in got) == list(range(1, 49))
    assert {(n, e["who"], e["i"]) for n, e in CommitLog(spark, root).entries()} == set(got)
    assert not CommitLog(spark, root).put(48, {}) and CommitLog(spark, root).put(49, {})


def test_an_incomplete_entry_is_not_current(spark):
    log = CommitLog(spark, scratch(spark, "log"))
    assert log.current() is None and log.append({"a": 1}) == 1
    log._write(log._path("000000000002.json"), bytearray(b'{"a":'))
    assert log.current() == {"a": 1} and log.append({"a": 3}) == 3 and log.current() == {"a": 3}


def test_assets_are_current_all_or_none(spark):
    root = scratch(spark, "assets")
    with pytest.raises(FileNotFoundError):
        sinks.read_asset(spark, root, "x")
    first = sinks.write_assets({"x": spark.range(3), "y": spark.range(1)}, root)
    with pytest.raises(Exception, match="broken"):
        sinks.write_assets({"x": spark.range(9), "y": spark.range(1).select(F.raise_error(F.lit("broken")).cast("long").alias("id"))}, root)
    assert sinks.read_asset(spark, root, "x").count() == 3
    threads = [threading.Thread(target=sinks.write_assets, args=({"x": spark.range(n), "y": spark.range(n)}, root)) for n in (5, 6, 7)]
    [t.start() for t in threads], [t.join() for t in threads]
    assert sinks.read_asset(spark, root, "x").count() == sinks.read_asset(spark, root, "y").count() in (5, 6, 7)
    assert sinks.read_asset(spark, root, "x", first).count() == 3
    assert CommitLog(spark, f"{root}/log").numbers() == [1, 2, 3, 4]


def test_batches_count_once(spark):
    root, me = scratch(spark, "batches"), frontier.Producer("me", "1")
    table = frontier.BatchTable(spark, root, me)
    with pytest.raises(FileNotFoundError):
        table.read()
    rows = spark.createDataFrame([(1, "a"), (2, None)], "k long, v string")
    assert table.add(rows, 0) and not table.add(rows.repartition(3), 0) and table.add(rows.limit(0), 1)
    with pytest.raises(ValueError, match="other rows"):
        table.add(rows.limit(1), 0)
    assert sorted(tuple(r) for r in table.read().select("k", "batch").collect()) == [(1, 0), (2, 0)]
    rows.limit(1).write.mode("overwrite").parquet(f"{root}/batches/000000000000")
    with pytest.raises(ValueError, match="not what its manifest says"):
        table.verify()


def test_a_try_that_left_data_is_made_anew(spark):
    root = scratch(spark, "batches")
    spark.range(9).write.parquet(f"{root}/batches/000000000000")
    table = frontier.BatchTable(spark, root, frontier.Producer("me", "1"))
    assert table.add(spark.range(2), 0) and table.read().count() == 2


def test_foreign_manifests_are_refused(spark):
    root = scratch(spark, "batches")
    table = frontier.BatchTable(spark, root, frontier.Producer("me", "1"))
    table.add(spark.range(2), 0), table.add(spark.range(3), 1)
    with pytest.raises(ValueError, match="another producer"):
        frontier.BatchTable(spark, root, frontier.Producer("me", "2"))
    told = table.log.get(2)
    for change, match in (({"schema_version": 9}, "schema version 9"), ({"before": "x"}, "do not follow"), ({}, "do not follow")):
        other = scratch(spark, "batches")
        log = CommitLog(spark, f"{other}/manifests")
        log.put(1, table.log.get(1) | ({"rows": 99} if not change else {}))
        log.put(2, told | change)
        with pytest.raises(ValueError, match=match):
            frontier.BatchTable(spark, other, frontier.Producer("me", "1"))
    assert json.dumps(told)


@pytest.mark.parametrize("seed", range(3))
def test_advance_keeps_its_rules(seed):
    rng = random.Random(seed)
    for _ in range(200):
        state, at, log = (0, 0, 0, 0, "waiting"), 0, []
        for _ in range(rng.randint(1, 8)):
            at += rng.randint(0, 50)
            failed = rng.random() < 0.7
            log.append((at, failed))
            state = frontier.advance(state, at, failed, 4, 10)
        ends = [i for i, (_, f) in enumerate(log) if not f or sum(x for _, x in log[: i + 1]) >= 4]
        used = log[: ends[0] + 1] if ends else log
        assert state[0] == len(used) and state[2] == len(log) - len(used)
        assert state[1] == sum(used[i][0] < used[i - 1][0] + 10 * 2 ** (i - 1) for i in range(1, len(used)))
        assert state[4] == ("retry" if not ends else "exhausted" if used[-1][1] else "done")

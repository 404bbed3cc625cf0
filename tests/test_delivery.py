"""Greedy batches against a plain loop, and delivery outcomes."""

import random

import pytest
from pyspark.sql import functions as F

from feedloom.operators import delivery


def greedy(rows, max_rows, max_bytes, window_ms):
    """(batch number per row, trigger per batch) of one pass in order."""
    numbers, triggers = [], []
    batch, count, total, first = -1, 0, 0, None
    for size, at in rows:
        fresh = batch < 0 or count >= max_rows or at >= first + window_ms or total + size > max_bytes
        if fresh:
            if batch >= 0:
                triggers.append(
                    "rows" if count >= max_rows else "window" if at >= first + window_ms else "bytes"
                )
            batch, count, total, first = batch + 1, 0, 0, at
        count, total = count + 1, total + size
        numbers.append(batch)
    triggers.append("rows" if count >= max_rows else "end")
    return numbers, triggers


@pytest.mark.parametrize("seed,n,span,compose", [(1, 700, 40, 3), (2, 999, 25, 2), (3, 61, 1000, 5), (4, 300, 20, 1)])
def test_batches_equal_one_greedy_pass(spark, seed, n, span, compose):
    dice = random.Random(seed)
    units, expected = [], {}
    for unit in ("a", "b"):
        at, rows = 0, []
        for _ in range(n if unit == "a" else n // 3):
            at += dice.choice([0, 0, 1, 5, 40])
            rows.append((dice.choice([1, 10, 30, 99, 250]), at))
        expected[unit] = greedy(rows, 20, 200, 60)
        units += [(unit, i * 2, size, ms) for i, (size, ms) in enumerate(rows)]
    df = spark.createDataFrame(units, "unit string, pos long, size long, ms long").repartition(7)
    out = delivery.assign_batches(
        df, ["unit"], "pos", "size", "ms", 20, 200, 60, span=span, compose_pieces=compose
    )
    table = delivery.batch_table(out, ["unit"], "size", "ms", 20, 60)
    got = {u: [] for u in expected}
    for row in out.orderBy("unit", "pos").collect():
        got[row["unit"]].append(row["batch_no"])
    assert got == {u: e[0] for u, e in expected.items()}
    triggers = {u: [] for u in expected}
    for row in table.orderBy("unit", "batch_no").collect():
        triggers[row["unit"]].append(row["trigger"])
    assert triggers == {u: e[1] for u, e in expected.items()}


def test_dead_letter_copy_is_cut_by_bytes(spark):
    df = spark.createDataFrame([("äöü",)], "payload string")
    row = delivery.dead_letters(df, F.lit("d"), F.lit("too_large"), limit=3).first()
    assert bytes(row["copy"]) == "äöü".encode()[:3]
    assert row["original_bytes"] == 6


def test_topic_sink_writes_each_topic_apart(spark, tmp_path):
    df = spark.createDataFrame([("a", "1"), ("b", "2"), ("a", "3")], "topic string, payload string")
    delivery.write_topics(df, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert {(r["topic"], r["payload"]) for r in back.collect()} == {("a", "1"), ("b", "2"), ("a", "3")}

"""Key and change tails in batches: restarts, replays, idle batches, pushed filters."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from feedloom.sources.keys import change_stream, keyset_stream

SCHEMA = "day int, id string, body string"


def put(spark, folder, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).write.mode("append").parquet(folder)


def took(follower, name):
    """Values of each batch until idle."""
    out = []
    follower.drain(lambda rows, number: out.append(sorted(r[name] for r in rows.collect())))
    return out


def test_keyset_stream_restarts_without_loss_or_repeat(spark, tmp_path):
    folder, state = str(tmp_path / "in"), str(tmp_path / "state")
    rows = [(d, f"k{i}", f"{d}-{i}") for d in range(4) for i in range(5)]
    put(spark, folder, rows[::-1])
    source = lambda: spark.read.parquet(folder)
    follower = keyset_stream(spark, source, ["day", "id"], state, limit=7)
    number, first = follower.next()
    assert sorted(r["body"] for r in first.collect()) == sorted(b for _, _, b in rows[:7])
    # it fails before the commit: the same range again, whoever reads
    again = keyset_stream(spark, source, ["day", "id"], state, limit=3)
    number, same = again.next()
    assert number == 0 and sorted(r["body"] for r in same.collect()) == sorted(b for _, _, b in rows[:7])
    again.commit(0)
    assert again.offset() == [1, "k1"]
    rest = took(keyset_stream(spark, source, ["day", "id"], state, limit=7), "body")
    assert rest == [sorted(b for _, _, b in rows[7:14]), sorted(b for _, _, b in rows[14:])]
    idle = keyset_stream(spark, source, ["day", "id"], state)
    assert idle.next() is None and idle.committed() == 2
    put(spark, folder, [(3, "k9", "late"), (4, "a", "later")])
    assert took(idle, "body") == [["late", "later"]]


def test_the_range_reaches_the_scan(spark, tmp_path, capsys):
    folder, state = str(tmp_path / "in"), str(tmp_path / "state")
    put(spark, folder, [(d, f"k{i}", "x") for d in range(9) for i in range(3)])
    follower = keyset_stream(spark, lambda: spark.read.parquet(folder), ["day", "id"], state, limit=6)
    follower.commit(follower.next()[0])
    _, rows = follower.next()
    capsys.readouterr()
    rows.explain("formatted")
    plan = capsys.readouterr().out
    pushed = plan[plan.index("PushedFilters") :]
    assert "GreaterThanOrEqual(day,1)" in pushed and "LessThanOrEqual(day,3)" in pushed
    assert "Exchange" not in plan and "Sort" not in plan
    assert rows.count() == 6


def test_change_stream_moves_over_events_without_a_payload(spark, tmp_path):
    folder, state = str(tmp_path / "in"), str(tmp_path / "state")
    schema = "token string, payload string"
    put(spark, folder, [(f"t{i:02d}", None if i % 3 else f"p{i}") for i in range(10)], schema)
    source = lambda: spark.read.parquet(folder)
    follower = change_stream(spark, source, "token", state, limit=2)
    assert took(follower, "payload") == [["p0", "p3"], ["p6", "p9"]]
    assert follower.offset() == ["t09"]
    put(spark, folder, [("t10", None), ("t11", None)], schema)
    # an idle batch hands nothing over and moves the token
    assert took(follower, "payload") == [[]] and follower.offset() == ["t11"]
    put(spark, folder, [("t12", "p12")], schema)
    assert took(change_stream(spark, source, "token", state, limit=2), "payload") == [["p12"]]


def test_keys_of_any_plain_type_and_a_given_start(spark, tmp_path):
    folder, state = str(tmp_path / "in"), str(tmp_path / "state")
    rows = [(datetime(2024, 1, 1, 0, 0, 0, n), Decimal(f"{n}.50"), n) for n in range(6)]
    put(spark, folder, rows, "at timestamp, amount decimal(9,2), n int")
    source = lambda: spark.read.parquet(folder)
    follower = keyset_stream(spark, source, ["at", "amount"], state, limit=2, first=rows[1][:2])
    assert took(follower, "n") == [[2, 3], [4, 5]]
    assert follower.offset() == list(rows[5][:2])


def test_null_keys_containers_and_empty_tables(spark, tmp_path):
    state = str(tmp_path / "state")
    empty = keyset_stream(spark, lambda: spark.createDataFrame([], SCHEMA), ["day"], state)
    assert empty.next() is None
    holed = keyset_stream(spark, lambda: spark.createDataFrame([(None, "a", "b")], SCHEMA), ["day"], state)
    with pytest.raises(ValueError, match="NULL"):
        holed.next()
    boxed = keyset_stream(spark, lambda: spark.range(3).select(F.array("id").alias("day")), ["day"], state)
    with pytest.raises(ValueError, match="container"):
        boxed.next()

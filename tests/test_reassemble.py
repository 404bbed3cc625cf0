"""State of streamed snapshots: runs of numbers, their size, and what expires."""

import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from feedloom.operators import snapshot
from feedloom.streaming import reassemble

FRAME = "snapshot_id string, kind string, seq long, row_count long"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 63), min_size=1), min_size=1, max_size=5))
def test_runs_hold_what_a_set_holds(batches):
    runs, seen = np.zeros((0, 2), dtype=np.int64), set()
    for batch in batches:
        runs = reassemble.merged_runs(runs, np.array(batch, dtype=np.int64))
        seen |= set(batch)
        assert {n for a, b in runs for n in range(a, b)} == seen
        assert all(a < b for a, b in runs) and all(x[1] < y[0] for x, y in zip(runs, runs[1:]))
        for span in (64, 4096):
            assert np.array_equal(reassemble.unpacked(*reassemble.packed(runs, span)), runs)


def test_state_grows_with_the_holes_and_is_bounded_by_bits():
    span = reassemble.LANE_SPAN
    size = lambda runs: len(next(p for p in reassemble.packed(runs, span) if p is not None))
    none = np.zeros((0, 2), dtype=np.int64)
    assert size(reassemble.merged_runs(none, np.arange(10))) == 8
    assert size(reassemble.merged_runs(none, np.arange(span))) == 8
    assert size(reassemble.merged_runs(none, np.delete(np.arange(span), [5, 700, 900_000]))) == 32
    assert size(reassemble.merged_runs(none, np.arange(0, span, 2))) == span // 8


def run(spark, source, out, state, expire_ms):
    frames = spark.readStream.schema(FRAME).parquet(source)
    step = reassemble.lane_progress(frames, span=4, expire_ms=expire_ms).writeStream.outputMode("update")

    def save(df, batch_id):
        df.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    query = step.foreachBatch(save).option("checkpointLocation", state).trigger(availableNow=True).start()
    try:
        assert query.awaitTermination(120)
    finally:
        query.stop()
    folded = reassemble.fold_progress(spark.read.parquet(out))
    return {r["snapshot_id"]: (r["status"], r["expected"], r["seen"]) for r in folded.collect()}


def put(spark, source, rows):
    spark.createDataFrame(rows, FRAME).coalesce(1).write.mode("append").parquet(source)


@pytest.fixture
def shuffles(spark):
    """Few tasks, and no batch without data: an available-now stream with timeouts would go on for ever."""
    names = {"spark.sql.shuffle.partitions": "2", "spark.sql.streaming.noDataMicroBatches.enabled": "false"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def test_a_stalled_snapshot_expires_as_truncated(spark, tmp_path, shuffles):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    rows = [("stalled", "row", n, None) for n in range(6)]
    rows += [("whole", "oversize" if n == 3 else "row", n, None) for n in (9, 3, 1, 0, 2, 4, 8, 7, 6, 5, 5)]
    rows += [("whole", "end", None, 10), ("holed", "row", 0, None), ("holed", "end", None, 2)]
    put(spark, source, rows)
    first = run(spark, source, out, state, expire_ms=500)
    batch = {r["snapshot_id"]: (r["status"], r["expected"], r["seen"]) for r in snapshot.snapshot_status(spark.read.parquet(source)).collect()}
    assert first == batch
    assert first == {"stalled": ("open", None, 6), "whole": ("complete", 10, 10), "holed": ("truncated", 2, 1)}
    time.sleep(2)
    put(spark, source, [("new", "row", 0, None)])
    second = run(spark, source, out, state, expire_ms=500)
    assert second["stalled"] == ("truncated", None, 6)
    assert second["whole"] == ("complete", 10, 10) and second["new"][0] == "open"


def test_a_lane_that_waits_does_not_expire_a_snapshot_that_goes_on(spark):
    rows = [
        ("s", 0, 4, 3, None, False, 10), ("s", 0, 4, 3, None, True, 90), ("s", 1, 1, 4, None, False, 80),
        ("t", 0, 4, 3, None, True, 90), ("t", 1, 1, 4, None, False, 20), ("t", 1, 1, 4, None, True, 99),
        ("u", 0, 2, 1, None, True, 50), ("u", 0, 2, 1, None, False, 50),
    ]
    folded = reassemble.fold_progress(spark.createDataFrame(rows, reassemble.PROGRESS))
    assert {r["snapshot_id"]: r["status"] for r in folded.collect()} == {"s": "open", "t": "truncated", "u": "open"}

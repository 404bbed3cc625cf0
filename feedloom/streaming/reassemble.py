"""Completeness of snapshots while their frames stream in."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

LANE_SPAN = 1_000_000

PROGRESS = "snapshot_id string, lane long, seen long, high long, expected long, expired boolean, at long"
# Numbers seen, as runs or bits, and what the end frame expects.
STATE = "runs binary, bits binary, seen long, high long, expected long"


def merged_runs(runs: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Half-open runs, an (n, 2) array in order without gaps of zero, of the runs and further numbers."""
    numbers = np.unique(numbers)
    cuts = np.flatnonzero(np.diff(numbers) > 1) + 1
    first = np.concatenate([numbers[:1], numbers[cuts]])
    last = np.concatenate([numbers[cuts - 1], numbers[-1:]])
    every = np.concatenate([runs.reshape(-1, 2), np.stack([first, last + 1], axis=1)])
    every = every[np.argsort(every[:, 0], kind="stable")]
    reach = np.maximum.accumulate(every[:, 1])
    begins = np.concatenate([[True], every[1:, 0] > reach[:-1]])[: len(every)]
    ends = np.concatenate([np.flatnonzero(begins)[1:] - 1, [len(every) - 1]]) if len(every) else []
    return np.stack([every[begins, 0], reach[ends]], axis=1) if len(every) else every


def runs_of_bits(bits: bytes) -> np.ndarray:
    """Runs of the set bits, the lowest of each byte first."""
    held = np.unpackbits(np.frombuffer(bits, dtype=np.uint8), bitorder="little").astype(np.int8)
    edges = np.diff(np.concatenate([[0], held, [0]]).astype(np.int8))
    return np.stack([np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)], axis=1).astype(np.int64)


def packed(runs: np.ndarray, span: int) -> tuple[bytes | None, bytes | None]:
    """(runs, bits) of a lane of `span` numbers, one of them: bits where there are so many holes that they are smaller."""
    if runs.size * 4 <= (span + 7) // 8:
        return runs.astype(np.uint32).tobytes(), None
    edges = np.zeros(span + 1, dtype=np.int8)
    edges[runs[:, 0]] += 1
    edges[runs[:, 1]] -= 1
    return None, np.packbits(np.cumsum(edges[:-1], dtype=np.int8).astype(np.uint8), bitorder="little").tobytes()


def unpacked(runs: bytes | None, bits: bytes | None) -> np.ndarray:
    if bits is not None:
        return runs_of_bits(bits)
    return np.frombuffer(runs or b"", dtype=np.uint32).astype(np.int64).reshape(-1, 2)


def lane_progress(frames: DataFrame, span: int = LANE_SPAN, expire_ms: int | None = None) -> DataFrame:
    """Progress of each snapshot in lanes of `span` numbers; write it in update mode.

    State is the runs of the numbers that were seen, 8 bytes a run, or one bit per number of the lane where
    that is less; so it grows with the holes, a snapshot of any size is spread over tasks, and repeated
    frames change nothing. Lane -1 holds the row count of the end frame. A lane without a frame for `expire_ms`
    of processing time says so in a last row, and its state is dropped; without it state stays for good. Spark
    runs batches without data for such timeouts, without end under an available-now trigger: there, set
    `spark.sql.streaming.noDataMicroBatches.enabled` to false, and lanes expire in the next batch with data.
    """
    if span >= 1 << 31:
        raise ValueError("a lane holds fewer than 2^31 numbers")
    lane = F.when(F.col("kind") == "end", F.lit(-1)).otherwise(F.floor(F.col("seq") / span))
    slim = frames.filter(F.col("kind").isin("row", "oversize", "end")).select(
        "snapshot_id", lane.cast("bigint").alias("lane"), "seq", "row_count"
    )

    def step(
        key: tuple[str, int], batches: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        snapshot_id, lane_no = key
        runs, bits, seen, high, expected = state.get if state.exists else (None, None, 0, None, None)
        now = state.getCurrentProcessingTimeMs() if expire_ms is not None else 0
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame([[snapshot_id, lane_no, seen, high, expected, True, now]], columns=_NAMES)
            return
        if lane_no < 0:
            for batch in batches:
                most = int(batch["row_count"].max())
                expected = most if expected is None else max(expected, most)
        else:
            here = unpacked(runs, bits)
            for batch in batches:
                here = merged_runs(here, batch["seq"].to_numpy(dtype=np.int64) - lane_no * span)
            runs, bits = packed(here, span)
            seen = int((here[:, 1] - here[:, 0]).sum())
            high = int(here[-1, 1]) - 1 + lane_no * span
        state.update((runs, bits, seen, high, expected))
        if expire_ms is not None:
            state.setTimeoutDuration(expire_ms)
        yield pd.DataFrame([[snapshot_id, lane_no, seen, high, expected, False, now]], columns=_NAMES)

    timeout = GroupStateTimeout.NoTimeout if expire_ms is None else GroupStateTimeout.ProcessingTimeTimeout
    return slim.groupBy("snapshot_id", "lane").applyInPandasWithState(step, PROGRESS, STATE, "update", timeout)


_NAMES = ["snapshot_id", "lane", "seen", "high", "expected", "expired", "at"]


def fold_progress(progress: DataFrame) -> DataFrame:
    """Status per snapshot from all progress rows written so far.

    A snapshot that is not complete and all of whose lanes have expired is truncated, with or without an end
    frame. Frames that come after that begin its lanes anew, so it stays truncated unless one lane sees all.
    """
    lanes = progress.groupBy("snapshot_id", "lane").agg(
        F.max("seen").alias("seen"),
        F.max("high").alias("high"),
        F.max("expected").alias("expected"),
        # a lane's last row tells; of rows at one time the one that is alive
        F.max_by("expired", F.struct("at", ~F.col("expired"))).alias("expired"),
    )
    out = lanes.groupBy("snapshot_id").agg(
        F.sum("seen").alias("seen"),
        F.max("high").alias("_high"),
        F.max("expected").alias("expected"),
        F.bool_and("expired").alias("_expired"),
    )
    # `seen` counts distinct numbers, so seeing as many as the highest allows leaves no hole.
    whole = (F.col("seen") == F.col("expected")) & (
        (F.col("seen") == 0) | (F.col("_high") == F.col("expected") - 1)
    )
    return out.select(
        "snapshot_id",
        F.when(F.coalesce(whole, F.lit(False)), F.lit("complete"))
        .when(F.col("_expired") | F.col("expected").isNotNull(), F.lit("truncated"))
        .otherwise(F.lit("open"))
        .alias("status"),
        "expected",
        "seen",
    )

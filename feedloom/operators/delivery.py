"""Batches, outcomes per destination, dead letters, drops and the topic sink."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.keys import join_same
from feedloom.functions.numbering import number_rows, previous, span_bucket

# Batch bounds and the size of a dead-lettered oversize copy.
MAX_ROWS = 1000
MAX_BYTES = 8 * 1024 * 1024
WINDOW_MS = 1000
DEAD_LETTER_BYTES = 64 * 1024

# Rows handled together by one task of the batcher, and pieces composed together above it.
BATCH_SPAN = 100_000
COMPOSE = 1_000


# --- greedy batches -------------------------------------------------------------------------
#
# A batch starts where the one before it was flushed, so batches depend on everything before
# them. A piece of the sequence is still a function: the batch that is open where the piece
# begins decides the batch that is open where it ends. A batch holds at most `max_rows` rows,
# so there are at most `max_rows` possible open batches at a border. Each piece computes its
# function on its own, the functions are chained, and each piece then numbers its rows.


def _breaks(
    sizes: np.ndarray, at: np.ndarray, max_rows: int, max_bytes: int, window_ms: int
) -> np.ndarray:
    """For a batch that starts at each row, the row at which the next batch starts."""
    n = len(sizes)
    here = np.arange(n)
    total = np.concatenate([[0], np.cumsum(sizes)])
    full = np.searchsorted(total, total[:-1] + max_bytes, side="right") - 1
    late = np.searchsorted(at, at + window_ms, side="left")
    following = np.minimum(np.minimum(here + max_rows, full), late)
    return np.minimum(np.maximum(following, here + 1), n)


def _piece(pdf: pd.DataFrame, bounds: tuple[int, int, int]) -> tuple[pd.DataFrame, np.ndarray, int]:
    """Rows of a piece in order, the breaks, and how many rows belong to the piece before."""
    pdf = pdf.sort_values("_n", ignore_index=True)
    following = _breaks(pdf["_size"].to_numpy(), pdf["_at"].to_numpy(), *bounds)
    return pdf, following, int(pdf["_halo"].sum())


Tables = list[tuple[int, dict[int, tuple[int, int]]]]


def _tables(maps: pd.DataFrame) -> Tables:
    """Per piece in order: entry -> (exit, batch starts)."""
    tables: Tables = []
    for piece, group in maps.groupby("_piece", sort=True):
        pairs = zip(group["_exit"].tolist(), group["_starts"].tolist())
        tables.append((int(piece), dict(zip(group["_entry"].tolist(), pairs))))
    return tables


def _chain(tables: Tables, entry: int) -> tuple[int, int, list[tuple[int, int, int]]]:
    """Follow one entry through consecutive pieces: (exit, batch starts, entry per piece)."""
    starts, visited = 0, []
    for piece, table in tables:
        visited.append((piece, entry, starts))
        entry, more = table[entry]
        starts += more
    return entry, starts, visited


def assign_batches(
    df: DataFrame,
    by: Sequence[str],
    position: str,
    size: str,
    arrival_ms: str,
    max_rows: int = MAX_ROWS,
    max_bytes: int = MAX_BYTES,
    window_ms: int = WINDOW_MS,
    span: int = BATCH_SPAN,
    compose_pieces: int = COMPOSE,
) -> DataFrame:
    """Add `batch_no` per unit: exactly the batches one greedy pass in order would make.

    A batch is flushed before a row that would take it over `max_bytes`, when it holds
    `max_rows`, and once `window_ms` have passed since its first row; an empty batch takes
    any row. `position` is a whole number, unique per unit, and arrival grows with it. Work
    is cut into pieces of `span` rows, so a unit of any size is spread over tasks.
    """
    span = max(span, max_rows)
    bounds = (max_rows, max_bytes, window_ms)
    by = list(by)
    numbered = number_rows(df, [position], by, span_bucket(position, span), out="_n")
    slim = numbered.select(
        *by,
        F.col("_n").cast("bigint").alias("_n"),
        F.col(size).cast("bigint").alias("_size"),
        F.col(arrival_ms).cast("bigint").alias("_at"),
    )
    own = F.floor(F.col("_n") / span).cast("bigint")
    near_end = F.col("_n") % span >= span - max_rows
    # The last rows of a piece are seen by the next one as well: a batch may cross over.
    shared = slim.select(
        "*",
        F.explode(
            F.when(near_end, F.array(own, own + 1)).otherwise(F.array(own))
        ).alias("_piece"),
    ).withColumn("_halo", own < F.col("_piece"))
    fields = {f.name: f.dataType for f in slim.schema.fields}
    keys = [T.StructField(b, fields[b]) for b in by]
    long = T.LongType()
    map_schema = T.StructType(
        [*keys, *[T.StructField(c, long) for c in ("_piece", "_entry", "_exit", "_starts")]]
    )

    def to_map(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, following, halo = _piece(pdf, bounds)
        n, number = len(pdf), pdf["_n"].to_numpy()
        if n == halo:  # behind the last piece there are no rows to number
            return pd.DataFrame(columns=map_schema.names, dtype=object)
        exits, starts = np.arange(n), np.zeros(n, dtype=np.int64)
        for i in range(n - 1, -1, -1):
            j = following[i]
            if j < n:
                exits[i] = exits[j]
                starts[i] = starts[j] + 1
        if key[-1] == 0:
            entries, counts = np.array([0]), starts[:1] + 1
        else:
            entries = np.flatnonzero(following[:halo] >= halo)
            counts = starts[entries]
        out = {b: [key[i]] * len(entries) for i, b in enumerate(by)}
        return pd.DataFrame(
            {
                **out,
                "_piece": key[-1],
                "_entry": number[entries],
                "_exit": number[exits[entries]],
                "_starts": counts,
            }
        )

    maps = shared.groupBy(*by, "_piece").applyInPandas(to_map, map_schema)
    maps = maps.withColumn("_block", F.floor(F.col("_piece") / compose_pieces).cast("bigint"))

    block_schema = T.StructType(
        [*keys, *[T.StructField(c, long) for c in ("_block", "_entry", "_exit", "_starts")]]
    )

    def compose(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        tables = _tables(pdf)
        rows = [(entry, *_chain(tables, entry)[:2]) for entry in tables[0][1]]
        out = pd.DataFrame(rows, columns=["_entry", "_exit", "_starts"])
        for i, name in enumerate([*by, "_block"]):
            out[name] = key[i]
        return out[[f.name for f in block_schema.fields]]

    blocks = maps.groupBy(*by, "_block").applyInPandas(compose, block_schema)

    entry_schema = T.StructType(
        [*keys, *[T.StructField(c, long) for c in ("_block", "_block_entry", "_block_starts")]]
    )

    def walk(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        _, _, visited = _chain(_tables(pdf.rename(columns={"_block": "_piece"})), 0)
        out = pd.DataFrame(visited, columns=["_block", "_block_entry", "_block_starts"])
        for i, name in enumerate(by):
            out[name] = key[i]
        return out[[f.name for f in entry_schema.fields]]

    # One row per block and possible entry: a thousandth of a thousandth of the rows.
    block_entries = blocks.groupBy(*by).applyInPandas(walk, entry_schema)

    piece_schema = T.StructType(
        [*keys, *[T.StructField(c, long) for c in ("_piece", "_entry", "_before")]]
    )

    def descend(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        entry, before = int(pdf["_block_entry"].iloc[0]), int(pdf["_block_starts"].iloc[0])
        _, _, visited = _chain(_tables(pdf), entry)
        out = pd.DataFrame(visited, columns=["_piece", "_entry", "_before"])
        out["_before"] += before
        for i, name in enumerate(by):
            out[name] = key[i]
        return out[[f.name for f in piece_schema.fields]]

    entries = (
        join_same(maps, block_entries, [*by, "_block"])
        .groupBy(*by, "_block")
        .applyInPandas(descend, piece_schema)
    )

    number_schema = T.StructType(
        [*keys, T.StructField("_n", long), T.StructField("batch_no", long)]
    )

    def number(key: tuple, pdf: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        pdf, following, halo = _piece(pdf, bounds)
        n = len(pdf)
        if n == halo or entry.empty:
            return pd.DataFrame(columns=number_schema.names, dtype=object)
        at = int(entry["_entry"].iloc[0] - pdf["_n"].iloc[0])
        begins = np.zeros(n, dtype=np.int64)
        if key[-1] == 0:
            begins[at] = 1
        while following[at] < n:
            at = following[at]
            begins[at] = 1
        batch = int(entry["_before"].iloc[0]) - 1 + np.cumsum(begins[halo:])
        out = pd.DataFrame({"_n": pdf["_n"].to_numpy()[halo:], "batch_no": batch})
        for i, name in enumerate(by):
            out[name] = key[i]
        return out[[f.name for f in number_schema.fields]]

    batches = (
        shared.groupBy(*by, "_piece")
        .cogroup(entries.groupBy(*by, "_piece"))
        .applyInPandas(number, number_schema)
    )
    return join_same(numbered, batches, [*by, "_n"]).drop("_n")


def batch_table(
    batched: DataFrame,
    by: Sequence[str],
    size: str,
    arrival_ms: str,
    max_rows: int = MAX_ROWS,
    window_ms: int = WINDOW_MS,
) -> DataFrame:
    """One row per batch with its `trigger`: rows, window, bytes or end."""
    batches = batched.groupBy(*by, "batch_no").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.col(size).cast("bigint")).alias("bytes"),
        F.min(arrival_ms).alias("first_ms"),
    )
    backwards = batches.withColumn("_back", -F.col("batch_no"))
    linked = previous(
        backwards, "first_ms", "_back", list(by), span_bucket("_back", 100_000), "_next_ms"
    )
    trigger = (
        F.when(F.col("rows") >= max_rows, F.lit("rows"))
        .when(F.col("_next_ms").isNull(), F.lit("end"))
        .when(F.col("_next_ms") >= F.col("first_ms") + window_ms, F.lit("window"))
        .otherwise(F.lit("bytes"))
    )
    return linked.withColumn("trigger", trigger).drop("_back", "_next_ms")


# --- outcomes -------------------------------------------------------------------------------

# Outcomes of a record from best to worst.
OUTCOMES = ("sent", "dead_lettered", "dropped", "held")


def outcome_of(fault: Column, has_dlq: Column) -> Column:
    """Outcome at one destination: no fault, a record fault, or a transport fault.

    A record the transport refuses for good goes to the dead letters, or is dropped when
    there are none. While the transport itself fails the record is held.
    """
    return (
        F.when(fault.isNull(), F.lit("sent"))
        .when(fault == "transport", F.lit("held"))
        .when(has_dlq, F.lit("dead_lettered"))
        .otherwise(F.lit("dropped"))
    )


def classify(outcomes: DataFrame, record: Sequence[str], outcome: str = "outcome") -> DataFrame:
    """Worst outcome of each record over its destinations."""
    ranks = F.array_position(F.array(*[F.lit(o) for o in OUTCOMES]), F.col(outcome))
    return (
        outcomes.groupBy(*record)
        .agg(F.max(ranks).cast("int").alias("_worst"), F.count(F.lit(1)).alias("destinations"))
        .select(
            *record,
            "destinations",
            F.element_at(F.array(*[F.lit(o) for o in OUTCOMES]), F.col("_worst")).alias("outcome"),
        )
    )


def resend(plan: DataFrame, taken: DataFrame, on: Sequence[str]) -> DataFrame:
    """Deliveries still to make: a destination that took a record does not get it again."""
    return plan.join(taken.select(*on).distinct(), list(on), "left_anti")


def dead_letters(
    df: DataFrame, topic: Column, reason: Column, payload: str = "payload", limit: int | None = None
) -> DataFrame:
    """Rows for the dead-letter table; the copy is cut by bytes at `limit`.

    The cut may fall inside a character, so the copy is binary.
    """
    whole = F.col(payload).cast("binary")
    copy = whole if limit is None else F.substring(whole, 1, limit)
    return df.select(
        "*",
        topic.alias("dead_topic"),
        reason.alias("reason"),
        copy.alias("copy"),
        F.octet_length(whole).cast("bigint").alias("original_bytes"),
    )


def dropped(df: DataFrame, by: Sequence[str] = (), reason: str = "reason") -> DataFrame:
    """Rows that could go nowhere, by reason: transport_refused, too_large or unstampable."""
    return df.groupBy(*by, reason).agg(F.count(F.lit(1)).alias("rows"))


def apart_oversize(
    df: DataFrame, max_bytes: int, payload: str = "payload"
) -> tuple[DataFrame, DataFrame]:
    """(rows to send, rows too large for an incremental feed).

    The second go to the dead letters; both count for the checkpoint.
    """
    long = F.octet_length(payload) > max_bytes
    return df.filter(~long), df.filter(long)


def write_topics(df: DataFrame, path: str, topic: str = "topic", mode: str = "append") -> None:
    """Write each record under its topic."""
    df.write.mode(mode).partitionBy(topic).parquet(path)


def write_kafka(df: DataFrame, servers: str, topic: str = "topic", payload: str = "payload") -> None:
    """Write each record to its topic; needs the Kafka connector on the classpath."""
    df.select(F.col(topic).alias("topic"), F.col(payload).cast("string").alias("value")).write.format(
        "kafka"
    ).option("kafka.bootstrap.servers", servers).save()

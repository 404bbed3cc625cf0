"""Requests fanned out over keys, and the joins that bring contents back to a listing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.functions.json import array_items, as_column, at_pointer, put_fields, scalar_text
from feedloom.functions.keys import join_same
from feedloom.functions.numbering import number_rows
from feedloom.operators.windows import window_steps


def keys_at(df: DataFrame, body: str, pointer: str, out: str = "key") -> DataFrame:
    """Keys listed in an array at a pointer of a first response."""
    value = at_pointer(F.try_parse_json(body), pointer)
    listed = F.transform(array_items(value), scalar_text)
    return df.select("*", F.explode(listed).alias(out))


def fan_out(keys: DataFrame, start: Any, end: Any, step_secs: int) -> DataFrame:
    """One request per key and window step."""
    windowed = keys.withColumn("window_start", as_column(start).cast("timestamp")).withColumn(
        "window_end", as_column(end).cast("timestamp")
    )
    return window_steps(windowed, step_secs)


def lookup(
    ids: DataFrame,
    entities: DataFrame,
    on: str,
    order: Sequence[str],
    batch: int = 1000,
    by: Sequence[str] = (),
    bucket: Column | None = None,
) -> DataFrame:
    """Entities of each batch of ids, with `batch_no`; `by` starts new batches per key.

    An id that comes twice in one batch is asked for once.
    """
    numbered = number_rows(ids, order, by, bucket, out="_n")
    asked = numbered.select(
        *by, on, F.floor(F.col("_n") / batch).cast("bigint").alias("batch_no")
    ).distinct()
    return asked.join(entities, on)


def manifest(
    items: DataFrame,
    contents: DataFrame,
    on: str,
    add: Mapping[str, Any],
    position: str,
    payload: str = "payload",
) -> DataFrame:
    """Rows of the listed items: item fields added to each record, a mark on each row.

    The mark is the item's `(key, position)`, so a resumed read starts past whole items.
    """
    joined = contents.join(items, on)
    out = put_fields(joined, payload, add)
    return out.withColumn(
        "mark",
        F.struct(
            F.lit("item").alias("kind"),
            F.col(on).alias("item_key"),
            F.col(position).alias("item_position"),
        ),
    )


def cap_items(
    items: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    max_items: int,
    mode: str = "cut",
    named: int = 5,
) -> tuple[DataFrame, DataFrame]:
    """(items to read, one report per key that has more than `max_items`).

    defer: a marked listing reads the rest next time. fail: a windowed or dump unit reads
    nothing of that key. cut: the rest is skipped. The report counts every item that is
    left out and names the first few. The ranking is limited before it is shuffled.
    """
    if mode not in ("defer", "fail", "cut"):
        raise ValueError("mode is 'defer', 'fail' or 'cut'")
    ranked = items.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    ).filter(F.col("_rank") <= max_items + named)
    totals = items.groupBy(*by).agg(F.count(F.lit(1)).alias("_total"))
    beyond = (
        ranked.filter(F.col("_rank") > max_items)
        .groupBy(*by)
        .agg(F.array_sort(F.collect_list(F.struct("_rank", order[-1]))).alias("_next"))
    )
    beyond = join_same(beyond, totals, by)
    first = F.transform("_next", lambda e: e[order[-1]].cast("string"))
    left_out = F.col("_total") - (F.lit(0) if mode == "fail" else F.lit(max_items))
    report = beyond.select(
        *by,
        F.lit({"defer": "deferred", "fail": "failed", "cut": "cut"}[mode]).alias("status"),
        left_out.alias("skipped"),
        first.alias("first_skipped"),
    )
    kept = ranked.filter(F.col("_rank") <= max_items).drop("_rank")
    if mode == "fail":
        kept = join_same(kept, beyond.select(*by), by, "left_anti")
    return kept, report


def pull_messages(
    df: DataFrame, rows: Column, ack_id: str = "ack_id", out: str = "payload"
) -> DataFrame:
    """Messages expanded to rows; the acknowledgement rides on the last row of each.

    `rows` is an array of record texts. A message that expands to nothing still gives one
    row without a payload, so that it is acknowledged.
    """
    listed = df.withColumn("_rows", F.coalesce(rows, F.array().cast("array<string>")))
    opened = listed.select("*", F.posexplode_outer("_rows").alias("_pos", out))
    last = F.col("_pos").isNull() | (F.col("_pos") == F.size("_rows") - 1)
    return opened.withColumn(ack_id, F.when(last, F.col(ack_id))).drop("_rows", "_pos")

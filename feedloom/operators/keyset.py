"""Tails that resume after a key: keyset pages, documents, change events."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Default page size and pages per tick of a database tail.
DEFAULT_LIMIT = 5000
DEFAULT_MAX_PAGES = 10


def after_tuple(keys: Sequence[str], after: Sequence[Any]) -> Column:
    """`keys > after`, spelled out so the file scan can use it; the leading range prunes."""
    cases = []
    for i, key in enumerate(keys):
        same = [F.col(k) == F.lit(v) for k, v in zip(keys[:i], after[:i])]
        cases.append(reduce(lambda a, b: a & b, [*same, F.col(key) > F.lit(after[i])]))
    return (F.col(keys[0]) >= F.lit(after[0])) & reduce(lambda a, b: a | b, cases)


def check_columns(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise on a key column that is missing or holds containers."""
    absent = [k for k in keys if k not in df.columns]
    if absent:
        raise ValueError(f"key columns not in the result: {absent}")
    for key in keys:
        if df.schema[key].dataType.typeName() in ("array", "map", "struct", "variant"):
            raise ValueError(f"key column {key!r} is a container")


def refuse_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Raise on a NULL key value: a tail could not resume behind such a row."""
    for key in keys:
        if df.schema[key].nullable:
            df = df.withColumn(
                key,
                F.when(
                    F.col(key).isNull(), F.raise_error(F.lit(f"NULL in key column {key}"))
                ).otherwise(F.col(key)),
            )
    return df


def keyset_tail(
    df: DataFrame,
    keys: Sequence[str],
    after: Sequence[Any] | None = None,
    limit: int = DEFAULT_LIMIT,
    max_pages: int = DEFAULT_MAX_PAGES,
) -> DataFrame:
    """Rows past `after` in key order, at most `limit * max_pages` in one top-k.

    Keys must be unique; the resume point is strictly past the last tuple.
    """
    check_columns(df, keys)
    picked = df if after is None else df.filter(after_tuple(keys, after) | _any_null(keys))
    return refuse_null_keys(picked.orderBy(*keys).limit(limit * max_pages), keys)


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def tail_pages(tail: DataFrame, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """How many full pages a tail filled (a sign that more is waiting)."""
    return tail.agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "full_pages", F.floor(F.col("rows") / limit).cast("bigint")
    )


def doc_tail(
    df: DataFrame,
    condition: Column | None,
    after: Any | None,
    limit: int,
    key: str = "_id",
) -> DataFrame:
    """Documents past the last id that satisfy the store's filter."""
    picked = df if condition is None else df.filter(condition)
    return keyset_tail(picked, [key], None if after is None else [after], limit, 1)


def change_tail(
    df: DataFrame, token: str, after: Any | None, limit: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """(events past the resume token, one row with the token to commit).

    An idle tick still advances: events that passed by without a payload move the token. With a
    `limit` the events are a top-k; without one they stay spread, and the token is one aggregate.
    """
    feed = df if after is None else df.filter(F.col(token) > F.lit(after))
    resumed = F.lit(after).cast(df.schema[token].dataType)
    if limit is None:
        whole = feed.agg(F.max(token).alias("_high"), F.count("payload").alias("events"))
        advance = whole.select(F.coalesce("_high", resumed).alias("token"), "events")
        return feed.filter(F.col("payload").isNotNull()), advance
    events = feed.filter(F.col("payload").isNotNull()).orderBy(token).limit(limit)
    picked = events.select(F.col(token).alias("_picked"), F.lit(None).alias("_seen"))
    passed = feed.select(F.lit(None).alias("_picked"), F.col(token).alias("_seen"))
    advance = (
        picked.unionByName(passed)
        .agg(
            F.max("_picked").alias("_last"),
            F.count("_picked").alias("events"),
            F.max("_seen").alias("_high"),
        )
        .select(
            F.when(F.col("events") >= limit, F.col("_last"))
            .otherwise(F.coalesce("_high", resumed))
            .alias("token"),
            "events",
        )
    )
    return events, advance

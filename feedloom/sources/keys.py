"""Tails by key as batches: rows past a key tuple, or events past a resume token (S21, S23, S24).

The rows come from any Spark source. A batch is a range of key tuples, `after < keys <= upto`, written out so
that Spark hands it to the source: a database answers it from its index, a Parquet scan skips row groups, and
a source partitioned by key range reads its parts in parallel. Finding `upto` is one map-side top-k over the
key columns; the rows themselves are read without a sort, and only by the plan's range.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.keyset import DEFAULT_LIMIT, DEFAULT_MAX_PAGES, after_tuple, check_columns
from feedloom.sources.planned import PlannedBatches


def up_to_tuple(keys: Sequence[str], upto: Sequence[Any]) -> Column:
    """`keys <= upto`, spelled out so the scan can use it; the leading range prunes."""
    cases = []
    for i, key in enumerate(keys):
        same = [F.col(k) == F.lit(v) for k, v in zip(keys[:i], upto[:i])]
        last = i == len(keys) - 1
        cases.append(reduce(lambda a, b: a & b, [*same, F.col(key) <= F.lit(upto[i]) if last else F.col(key) < F.lit(upto[i])]))
    return (F.col(keys[0]) <= F.lit(upto[0])) & reduce(lambda a, b: a | b, cases)


class KeyFollower(PlannedBatches):
    """Batches of `source()` in key order, at most `limit` rows each.

    `source` gives the rows anew for each batch. `event` tells the rows to hand over; the others only move the
    offset, so that a batch may be empty and is committed all the same: a change feed's token goes on past
    events without a payload. Keys must be unique and may only grow: a row that turns up behind a committed
    key is not seen, one that turns up within a planned range is read by it. A NULL key is refused, because
    a tail cannot resume behind it; rows whose event is NULL are none. `first` is where the first batch starts
    after (None: with the smallest key).
    """

    def __init__(
        self,
        spark: SparkSession,
        source: Callable[[], DataFrame],
        keys: Sequence[str],
        state: str,
        limit: int = DEFAULT_LIMIT * DEFAULT_MAX_PAGES,
        event: Column | None = None,
        first: Sequence[Any] | None = None,
    ) -> None:
        super().__init__(spark, state)
        if limit < 1:
            raise ValueError("limit must be positive")
        if first is not None and len(first) != len(keys):
            raise ValueError("first needs a value for each key")
        self.source, self.keys, self.limit, self.event = source, list(keys), limit, event
        self.first = None if first is None else list(first)

    def _bounds(self, number: int) -> tuple[list[Any] | None, list[Any]]:
        """(after, upto) of a published plan, a row of key values."""
        row = self.spark.read.parquet(self._folder(number)).first()
        after = None if row["after"] is None else list(row["after"])
        return after, list(row["upto"])

    def offset(self) -> list[Any] | None:
        """Key tuple behind which the next batch begins."""
        done = self.committed()
        return self.first if done < 0 else self._bounds(done)[1]

    def _plan(self, number: int) -> bool:
        rows = self.source()
        check_columns(rows, self.keys)
        nulls = [F.col(k).isNull() for k in self.keys if rows.schema[k].nullable]
        if nulls and not rows.filter(reduce(lambda a, b: a | b, nulls)).isEmpty():
            raise ValueError(f"NULL in key columns {self.keys}")
        after = self.offset()
        past = rows if after is None else rows.filter(after_tuple(self.keys, after))
        whole = F.struct(*self.keys)
        events = past if self.event is None else past.filter(self.event)
        page = events.select(*self.keys).orderBy(*self.keys).limit(self.limit)
        found = page.agg(F.max(whole).alias("upto"), F.count(F.lit(1)).alias("n")).first()
        upto = found["upto"]
        if found["n"] < self.limit and self.event is not None:
            upto = past.agg(F.max(whole).alias("upto")).first()["upto"]
        if upto is None:
            return False
        kind = rows.select(whole.alias("k")).schema["k"].dataType.simpleString()
        plan = self.spark.createDataFrame([(after and tuple(after), tuple(upto))], f"after {kind}, upto {kind}")
        return self._publish(plan.coalesce(1), number)

    def _rows(self, number: int) -> DataFrame:
        after, upto = self._bounds(number)
        rows = self.source().filter(up_to_tuple(self.keys, upto))
        if after is not None:
            rows = rows.filter(after_tuple(self.keys, after))
        return rows if self.event is None else rows.filter(self.event)


def keyset_stream(spark: SparkSession, source: Callable[[], DataFrame], keys: Sequence[str], state: str, **options: Any) -> KeyFollower:
    """Rows of a table past a key tuple."""
    return KeyFollower(spark, source, keys, state, **options)


def change_stream(
    spark: SparkSession, source: Callable[[], DataFrame], token: str, state: str, payload: str = "payload", **options: Any
) -> KeyFollower:
    """Change events past a resume token; events without a payload move the token and are not handed over."""
    return KeyFollower(spark, source, [token], state, event=F.col(payload).isNotNull(), **options)

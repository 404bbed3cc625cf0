"""Joins on keys that may be NULL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_same(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join in which NULL keys meet like any other value; the left side's key columns are kept.

    The keys are compared as one struct, which is none even where its fields are NULL, so that
    the join is still one on equal keys. For inner, left, semi and anti joins.
    """
    key = F.struct(*[F.col(f"`{c}`") for c in on]).alias("_same")
    rest = [F.col(f"`{c}`") for c in right.columns if c not in on]
    return left.select("*", key).join(right.select(key, *rest), "_same", how).drop("_same")

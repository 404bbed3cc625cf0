"""Contiguous numbering and running sums that never put one whole group in one task.

Rows are split into buckets inside their group. Each bucket is numbered on its own and
shifted by the number of rows in the buckets before it. When the bucket expression grows
with the order, the numbers follow the order across the whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.session import cut_lineage


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def hash_bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets))


def span_bucket(position: str | Column, span: int) -> Column:
    """Bucket of at most `span` distinct whole positions, growing with the position."""
    column = F.col(position) if isinstance(position, str) else position
    return F.floor(column / F.lit(span)).cast("bigint")


def even_bucket(df: DataFrame, position: str, rows: int = 100_000) -> Column:
    """Bucket growing with a whole-number position, of about `rows` rows where it is evenly spread.

    For positions that are sparse (times, ids with gaps), where a span of fixed width would give
    nearly every row a bucket of its own and the totals of all buckets would meet in one task. Costs
    one aggregate over the position; the number of buckets is that of the rows by `rows`, whatever the
    gaps. NULL positions have a NULL bucket.
    """
    at = F.col(position).cast("decimal(20,0)")
    found = df.agg(F.min(at).alias("low"), F.max(at).alias("high"), F.count(position).alias("n")).first()
    if not found["n"]:
        return F.lit(0).cast("bigint")
    buckets = max(1, -(-found["n"] // rows))
    width = max(1, -(-(int(found["high"]) - int(found["low"]) + 1) // buckets))
    return F.floor((at - F.lit(int(found["low"])).cast("decimal(20,0)")) / F.lit(width)).cast("bigint")


def depth_bucket(df: DataFrame, position: str, rows: int = 100_000, most: int = 512) -> Column:
    """Bucket growing with a whole-number position, of about `rows` rows wherever the positions cluster.

    The borders are quantiles of the position over all rows, from a sketch of bounded size; there are
    at most `most` buckets, and their borders are constants, so a task that runs again sees the same ones.
    NULL positions are in the first bucket.
    """
    found = df.agg(F.count(position).alias("n")).first()["n"]
    buckets = min(most, max(1, -(-found // rows)))
    if buckets == 1:
        return F.lit(0).cast("bigint")
    at = F.col(position).cast("bigint")
    shares = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    borders = df.agg(F.percentile_approx(at, shares, 20 * buckets).alias("b")).first()["b"]
    return _above(at, sorted(set(borders)), 0)


def _above(at: Column, borders: Sequence[int], first: int) -> Column:
    """How many borders a position is over, halving the borders."""
    if not borders:
        return F.lit(first).cast("bigint")
    half = len(borders) // 2
    upper = _above(at, borders[half + 1 :], first + half + 1)
    return F.when(at > F.lit(borders[half]), upper).otherwise(_above(at, borders[:half], first))


def _marked(df: DataFrame, group: Sequence[str], bucket: Column) -> DataFrame:
    """Add `_part`, group and bucket as one value.

    Joins drop NULL keys, but a struct that holds NULLs is none: its rows meet like any other,
    and the windows that follow reuse the join's shuffle.
    """
    return df.withColumn("_part", F.struct(*[F.col(g) for g in group], bucket.alias("_bucket")))


def _parted(group: Sequence[str]) -> list[Column]:
    return [F.col(f"_part.`{g}`") for g in group]


def _before(df: DataFrame, group: Sequence[str], amount: Column, out: str) -> DataFrame:
    """Total of `amount` in the earlier buckets of each group; one row per (group, bucket)."""
    totals = df.groupBy("_part").agg(amount.alias("_amount"))
    earlier = Window.partitionBy(*_parted(group)).orderBy("_part._bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return totals.select("_part", F.coalesce(F.sum("_amount").over(earlier), F.lit(0)).alias(out))


def number_rows(
    df: DataFrame,
    order: Sequence[str],
    group: Sequence[str] = (),
    bucket: Column | None = None,
    out: str = "seq",
    buckets: int | None = None,
) -> DataFrame:
    """Add `out` = 0..n-1 per group. `order` must be unique inside a group.

    Without `bucket` the rows are spread by hash (an arbitrary but repeatable order).
    NULL group values make a group, and rows with a NULL bucket one bucket, the first.
    """
    if bucket is None:
        bucket = hash_bucket(order, buckets or shuffle_partitions(df))
    marked = _marked(df, group, bucket)
    offsets = _before(marked, group, F.count(F.lit(1)), "_offset")
    inside = Window.partitionBy("_part").orderBy(*order)
    return (
        marked.join(offsets, "_part")
        .withColumn(out, F.row_number().over(inside) - 1 + F.col("_offset"))
        .drop("_part", "_offset")
    )


def running_sum(
    df: DataFrame,
    amount: str,
    order: Sequence[str],
    group: Sequence[str],
    bucket: Column,
    out: str,
) -> DataFrame:
    """Sum of `amount` over the rows strictly before each row of its group.

    `bucket` must grow with `order`.
    """
    marked = _marked(df, group, bucket)
    offsets = _before(marked, group, F.sum(amount), "_offset")
    earlier = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        marked.join(offsets, "_part")
        .withColumn(out, F.coalesce(F.sum(amount).over(earlier), F.lit(0)) + F.col("_offset"))
        .drop("_part", "_offset")
    )


def previous(
    df: DataFrame,
    value: str,
    order: str,
    group: Sequence[str],
    bucket: Column,
    out: str,
) -> DataFrame:
    """Value of the row before, across bucket borders."""
    marked = _marked(df, group, bucket)
    tails = marked.groupBy("_part").agg(F.max_by(value, order).alias("_last"))
    by_bucket = Window.partitionBy(*_parted(group)).orderBy("_part._bucket")
    carried = tails.select("_part", F.lag("_last").over(by_bucket).alias("_carry"))
    inside = Window.partitionBy("_part").orderBy(order)
    return (
        marked.join(carried, "_part")
        .withColumn("_first", F.row_number().over(inside) == 1)
        .withColumn(
            out,
            F.when(F.col("_first"), F.col("_carry")).otherwise(F.lag(value).over(inside)),
        )
        .drop("_part", "_carry", "_first")
    )


def index_in_order(
    df: DataFrame, order: Sequence[str], out: str = "position", partitions: int | None = None
) -> DataFrame:
    """Add `out` = 0..n-1 over the whole table in `order`, for keys with no usable bucket.

    One range shuffle. The sorted rows are written to the checkpoint folder first: range
    borders come from sampling and could differ if a lost task were computed again.
    """
    n = partitions or shuffle_partitions(df)
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    fixed = cut_lineage(ranged.withColumn("_at", F.monotonically_increasing_id()))
    shift = F.lit(1 << 33)
    parted = fixed.withColumn("_part", F.floor(F.col("_at") / shift).cast("bigint"))
    sizes = parted.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # One row per shuffle partition: bounded by `n`, so it is safe to broadcast.
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_o"))
    return (
        parted.join(F.broadcast(offsets), "_part")
        .withColumn(out, F.col("_at") % shift + F.col("_o"))
        .drop("_part", "_at", "_o")
    )

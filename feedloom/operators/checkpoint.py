"""Marks folded into checkpoints, acknowledgements, and the checkpoint table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.keys import join_same
from feedloom.functions.numbering import number_rows, previous, running_sum, span_bucket

# Acknowledgement batch size and the checkpoint version that can be read.
ACK_BATCH = 500
CHECKPOINT_VERSION = 2

CHECKPOINT_SCHEMA = T.StructType(
    [
        T.StructField("cursor_key", T.StringType()),
        T.StructField("last_fetch_end", T.TimestampType()),
        T.StructField("last_fetch_records", T.LongType()),
        T.StructField("updated_at", T.TimestampType()),
        T.StructField("api_cursor", T.StringType()),
        T.StructField("version", T.IntegerType()),
    ]
)


def cursor_key(instance: Column, connection: Column, unit: Column) -> Column:
    return F.lower(F.concat_ws(".", instance, connection, unit))


def keyset_fold(df: DataFrame, by: Sequence[str], keys: Sequence[str], arrival: str) -> DataFrame:
    """Key tuple of the last row of each unit in arrival order."""
    return (
        df.groupBy(*by)
        .agg(F.max_by(F.struct(*keys), arrival).alias("_k"))
        .select(*by, *[F.col(f"_k.{k}").alias(k) for k in keys])
    )


def item_fold(df: DataFrame, by: Sequence[str], position: str, key: str) -> DataFrame:
    """Greatest `(position, key)` of each unit."""
    return (
        df.groupBy(*by)
        .agg(F.max(F.struct(position, key)).alias("_i"))
        .select(*by, F.col(f"_i.{position}").alias(position), F.col(f"_i.{key}").alias(key))
    )


def line_fold(
    df: DataFrame, by: Sequence[str], file_id: str, end_offset: str, arrival: str
) -> DataFrame:
    """Furthest offset per file, with `first_seen` to list files in arrival order."""
    return df.groupBy(*by, file_id).agg(
        F.max(end_offset).alias(end_offset), F.min(arrival).alias("first_seen")
    )


def fold_marks(df: DataFrame, by: Sequence[str] = ("unit",), arrival: str = "arrival") -> DataFrame:
    """One checkpoint per unit from rows with a `mark` struct; NULL marks do not count.

    All input rows count, delivered, filtered or oversize. A unit with two of the kinds keyset,
    item and line is `inconsistent` and must not commit; acknowledgements go beside any kind.
    Lines fold per file (`fold_lines`), ids of acknowledgements are batched (`ack_batches`).
    """
    mark = F.col("mark")
    kind = mark["kind"]
    valued = F.when(kind.isin("keyset", "item", "line"), kind)
    out = df.groupBy(*by).agg(
        F.count_distinct(valued).alias("_kinds"),
        F.coalesce(F.min(valued), F.min(kind)).alias("kind"),
        F.max_by(mark["keyset"], F.when(kind == "keyset", F.col(arrival))).alias("keyset"),
        F.max(
            F.when(kind == "item", F.struct(mark["item_position"].alias("position"), mark["item_key"].alias("key")))
        ).alias("item"),
        F.count(kind).alias("marks"),
    )
    single = F.col("_kinds") <= 1
    return out.select(
        *by,
        F.when(single, F.col("kind")).alias("kind"),
        F.when(single, F.col("keyset")).alias("keyset"),
        F.when(single, F.col("item")).alias("item"),
        "marks",
        (~single).alias("inconsistent"),
    )


def fold_lines(
    df: DataFrame, by: Sequence[str] = ("unit",), arrival: str = "arrival"
) -> DataFrame:
    """Line marks of each unit as `lines`, (file_id, end_offset) in the order the files were met."""
    mark = F.col("mark")
    marked = df.filter(mark["kind"] == "line").select(
        *by, arrival, mark["file_id"].alias("file_id"), mark["end_offset"].alias("end_offset")
    )
    files = line_fold(marked, by, "file_id", "end_offset", arrival)
    listed = F.array_sort(F.collect_list(F.struct("first_seen", "file_id", "end_offset")))
    return files.groupBy(*by).agg(
        F.transform(listed, lambda f: F.struct(f["file_id"].alias("file_id"), f["end_offset"].alias("end_offset"))).alias("lines")
    )


def ack_batches(
    df: DataFrame,
    by: Sequence[str],
    ack_id: str = "ack_id",
    size: int = ACK_BATCH,
    bucket: Column | None = None,
) -> DataFrame:
    """Distinct acknowledgement ids with a `batch_no`, at most `size` per batch."""
    ids = df.filter(F.col(ack_id).isNotNull()).select(*by, ack_id).distinct()
    return (
        number_rows(ids, [ack_id], list(by), bucket, out="_n")
        .withColumn("batch_no", F.floor(F.col("_n") / size).cast("bigint"))
        .drop("_n")
    )


def latest_checkpoints(raw: DataFrame) -> DataFrame:
    """Newest row per lower-cased key; an old version or unreadable value reads as none."""
    newest = (
        raw.filter(F.col("cursor_key").isNotNull() & F.col("updated_at").isNotNull())
        .withColumn("cursor_key", F.lower("cursor_key"))
        .groupBy("cursor_key")
        .agg(
            F.max_by(
                F.struct(
                    "last_fetch_end", "last_fetch_records", "updated_at", "api_cursor", "version"
                ),
                F.struct("updated_at", "last_fetch_end", "last_fetch_records"),
            ).alias("_c")
        )
        .select("cursor_key", "_c.*")
    )
    usable = (F.col("version") >= CHECKPOINT_VERSION) & F.try_parse_json("api_cursor").isNotNull()
    return newest.withColumn("api_cursor", F.when(usable, F.col("api_cursor")))


def read_checkpoints(spark: SparkSession, path: str) -> DataFrame:
    """Latest checkpoint per key of an append-only folder; damaged files are skipped."""
    raw = (
        spark.read.schema(CHECKPOINT_SCHEMA)
        .option("ignoreCorruptFiles", "true")
        .parquet(path)
    )
    return latest_checkpoints(raw)


def commit(checkpoints: DataFrame, path: str) -> None:
    """Append new checkpoint rows. Call it only after the sink has taken every row."""
    checkpoints.select(*[f.name for f in CHECKPOINT_SCHEMA.fields]).write.mode("append").parquet(
        path
    )


def file_generations(
    df: DataFrame,
    by: Sequence[str],
    arrival: str,
    end_offset: str,
    span: int = 100_000,
) -> DataFrame:
    """Add `generation` and `stale`: a read that does not go past the last offset starts anew.

    `arrival` is a whole number that is unique per file; it is cut into spans, so a file
    with very many reads is not held by one task.
    """
    bucket = span_bucket(arrival, span)
    linked = previous(df, end_offset, arrival, by, bucket, "_before")
    linked = linked.withColumn(
        "_reset", F.coalesce((F.col(end_offset) <= F.col("_before")).cast("bigint"), F.lit(0))
    )
    out = running_sum(linked, "_reset", [arrival], by, bucket, "_resets")
    out = out.withColumn("generation", F.col("_resets") + F.col("_reset"))
    current = linked.groupBy(*by).agg(F.sum("_reset").alias("_current"))
    return (
        join_same(out, current, by)
        .withColumn("stale", F.col("generation") < F.col("_current"))
        .drop("_before", "_reset", "_resets", "_current")
    )

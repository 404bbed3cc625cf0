"""Whole-store dumps as verifiable snapshots, and their reassembly."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.json import as_column, bind, document, pointer_text
from feedloom.functions.numbering import number_rows, previous, span_bucket

# Fixed value: rows above this many bytes become stubs (900 KiB).
DEFAULT_MAX_BYTES = 900 * 1024

FRAME_COLUMNS = (
    "kind",
    "snapshot_id",
    "snapshot_at",
    "timestamp",
    "store",
    "seq",
    "total",
    "record",
    "bytes",
    "row_key",
    "row_count",
    "completed_at",
)


def snapshot_uuid(at_ms: Any, name: Any) -> Column:
    """UUID of version 7 for a moment; the random part comes from `name`, so it repeats.

    A name that is unique per run and store (or item) keeps the ids apart.
    """
    stamp = F.lower(F.lpad(F.hex(as_column(at_ms).cast("bigint")), 12, "0"))
    digest = F.md5(as_column(name).cast("string"))
    nibble = F.conv(F.substring(digest, 19, 1), 16, 10).cast("int") % 4
    return F.concat(
        F.substring(stamp, 1, 8),
        F.lit("-"),
        F.substring(stamp, 9, 4),
        F.lit("-7"),
        F.substring(digest, 1, 3),
        F.lit("-"),
        F.substring(F.lit("89ab"), nibble + 1, F.lit(1)),
        F.substring(digest, 4, 3),
        F.lit("-"),
        F.substring(digest, 7, 12),
    )


def _millis_text(at: Any) -> Column:
    return F.date_format(as_column(at).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def frame_snapshot(
    df: DataFrame,
    store: Any,
    at: Any,
    completed_at: Any,
    run: str,
    order: Sequence[str],
    payload: str = "payload",
    item: str | None = None,
    keep: Callable[[Column], Column] | None = None,
    row_key: str | None = None,
    max_bytes: int = DEFAULT_MAX_BYTES,
    bucket: Column | None = None,
    total: int | None = None,
) -> DataFrame:
    """Begin, numbered rows and end of one snapshot per store, or per `item`.

    Rows are filtered before they are numbered, so `seq` has no holes. `keep` sees the
    enveloped record: `Field(doc, "record.alive")`. Rows over `max_bytes` become stubs,
    which take a number but carry no record and pass no filter. `order` is a unique key;
    `bucket` (growing with it) makes the numbers follow the order. An empty store still
    gives begin and end; an item without rows gives nothing. `run` names the attempt and
    must be fixed by the caller, as must `at` and `completed_at`. `total`, where the store says
    beforehand how many rows it holds, is announced at the begin.
    """
    group = [item] if item else []
    size = F.octet_length(payload).cast("bigint")
    rows = df.withColumn("_bytes", size).withColumn("_over", F.col("_bytes") > max_bytes)
    if item:
        rows = rows.withColumn(
            item,
            F.when(
                F.col(item).isNull(), F.raise_error(F.lit("row without an item mark"))
            ).otherwise(F.col(item)),
        )
    if keep is not None:
        rows = bind(rows, _doc=F.when(~F.col("_over"), document(F.col(payload))))
        enveloped = F.create_map(F.lit("record"), F.to_variant_object("_doc"))
        rows = bind(rows, _env=F.when(F.col("_doc").isNotNull(), enveloped))
        verdict = F.coalesce(keep(F.col("_env")), F.lit(False))
        rows = rows.filter(F.col("_env").isNull() | verdict).drop("_doc", "_env")
    numbered = number_rows(rows, order, group, bucket, out="seq")

    name = F.concat(F.lit(f"{run}|"), as_column(store))
    if item:
        name = F.concat(name, F.lit("|"), F.col(item).cast("string"))
    moment = as_column(at).cast("timestamp")

    def head(frame: DataFrame, kind: Column) -> DataFrame:
        return (
            frame.withColumn("kind", kind)
            .withColumn("snapshot_id", snapshot_uuid(F.unix_millis(moment), name))
            .withColumn("snapshot_at", _millis_text(at))
            .withColumn("timestamp", _millis_text(at))
            .withColumn("store", as_column(store))
        )

    body = head(numbered, F.when(F.col("_over"), F.lit("oversize")).otherwise(F.lit("row")))
    key = pointer_text(F.col(payload), row_key) if row_key else F.lit(None).cast("string")
    body = body.select(
        *group,
        "kind",
        "snapshot_id",
        "snapshot_at",
        "timestamp",
        "store",
        F.col("seq").cast("bigint").alias("seq"),
        F.lit(None).cast("bigint").alias("total"),
        F.when(~F.col("_over"), F.col(payload)).alias("record"),
        F.when(F.col("_over"), F.col("_bytes")).alias("bytes"),
        F.when(F.col("_over"), key).alias("row_key"),
        F.lit(None).cast("bigint").alias("row_count"),
        F.lit(None).cast("string").alias("completed_at"),
    )
    counted = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    ends = head(
        counted.withColumn("_kind", F.explode(F.array(F.lit("begin"), F.lit("end")))),
        F.col("_kind"),
    )
    last = F.col("kind") == "end"
    ends = ends.select(
        *group,
        "kind",
        "snapshot_id",
        "snapshot_at",
        "timestamp",
        "store",
        F.when(last, F.col("_n")).otherwise(F.lit(0)).cast("bigint").alias("seq"),
        F.when(~last, F.lit(total)).cast("bigint").alias("total"),
        F.lit(None).cast("string").alias("record"),
        F.lit(None).cast("bigint").alias("bytes"),
        F.lit(None).cast("string").alias("row_key"),
        F.when(last, F.col("_n")).alias("row_count"),
        F.when(last, _millis_text(completed_at)).alias("completed_at"),
    )
    return body.unionByName(ends)


def frame_payload(frames: DataFrame, out: str = "payload") -> DataFrame:
    """Render frames as JSON text for a topic; the record keeps its bytes."""
    rest = [c for c in FRAME_COLUMNS if c != "record"]
    text = F.to_json(F.struct(*rest))
    with_record = F.concat(
        text.substr(F.lit(1), F.length(text) - 1), F.lit(',"record":'), F.col("record"), F.lit("}")
    )
    return frames.withColumn(
        out, F.when(F.col("record").isNotNull(), with_record).otherwise(text)
    )


def snapshot_status(frames: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Status per snapshot id: unknown, open, complete or truncated; order and repeats are free.

    Complete means exactly the numbers 0 to `row_count` - 1: fewer rows, or more, are truncated.

    The distinct count runs on (id, seq) first, so one huge snapshot is spread over tasks.
    """
    numbered = F.col("kind").isin("row", "oversize")
    seqs = F.when(numbered, F.col("seq"))
    out = frames.groupBy("snapshot_id").agg(
        F.count_distinct(seqs).alias("seen"),
        F.min(seqs).alias("_low"),
        F.max(seqs).alias("_high"),
        F.max(F.when(F.col("kind") == "end", F.col("row_count"))).alias("expected"),
    )
    whole = (F.col("seen") == F.col("expected")) & (
        (F.col("seen") == 0) | ((F.col("_low") == 0) & (F.col("_high") == F.col("expected") - 1))
    )
    out = out.withColumn(
        "status",
        F.when(F.col("expected").isNull(), F.lit("open"))
        .when(F.coalesce(whole, F.lit(False)), F.lit("complete"))
        .otherwise(F.lit("truncated")),
    ).select("snapshot_id", "status", "expected", "seen")
    if ids is not None:
        out = ids.join(out, "snapshot_id", "left").withColumn(
            "status", F.coalesce("status", F.lit("unknown"))
        )
    return out


def rebuild(frames: DataFrame, arrival: str = "arrival") -> DataFrame:
    """Records of complete snapshots by `seq`; the last delivery of a number wins."""
    done = snapshot_status(frames).filter(F.col("status") == "complete").select("snapshot_id")
    latest = (
        frames.filter(F.col("kind").isin("row", "oversize"))
        .groupBy("snapshot_id", "seq")
        .agg(F.max_by(F.struct("kind", "record"), arrival).alias("_f"))
    )
    return (
        latest.join(done, "snapshot_id", "left_semi")
        .filter(F.col("_f.kind") == "row")
        .select("snapshot_id", "seq", F.col("_f.record").alias("record"))
    )


def missing_ranges(frames: DataFrame, span: int = 1_000_000) -> DataFrame:
    """Holes of snapshots that have ended, as inclusive ranges.

    Found from the numbers that did arrive, so the work follows the data that is there and
    not the size of a hole.
    """
    ends = (
        frames.filter(F.col("kind") == "end")
        .groupBy("snapshot_id")
        .agg(F.max("row_count").alias("expected"))
    )
    seen = frames.filter(F.col("kind").isin("row", "oversize")).select("snapshot_id", "seq")
    # A virtual number after the last closes the range at the end.
    marks = seen.unionByName(
        ends.select("snapshot_id", F.col("expected").alias("seq"))
    ).distinct()
    linked = previous(
        marks, "seq", "seq", ["snapshot_id"], span_bucket("seq", span), "_before"
    )
    first = F.coalesce(F.col("_before") + 1, F.lit(0))
    return (
        linked.withColumn("first_missing", first.cast("bigint"))
        .withColumn("last_missing", (F.col("seq") - 1).cast("bigint"))
        .join(ends, "snapshot_id")
        .filter(
            (F.col("first_missing") <= F.col("last_missing"))
            & (F.col("seq") <= F.col("expected"))
        )
        .select("snapshot_id", "first_missing", "last_missing")
    )


def missing_seqs(frames: DataFrame, span: int = 1_000_000) -> DataFrame:
    """Every missing number; long holes are cut up before they are listed."""
    ranges = missing_ranges(frames, span)
    pieces = ranges.select(
        "snapshot_id",
        "last_missing",
        F.explode(F.sequence("first_missing", "last_missing", F.lit(span))).alias("_from"),
    )
    return pieces.select(
        "snapshot_id",
        F.explode(
            F.sequence("_from", F.least(F.col("_from") + span - 1, F.col("last_missing")))
        ).alias("seq"),
    )


def oversize_keys(frames: DataFrame) -> DataFrame:
    """Row keys of stubs, one per number."""
    return (
        frames.filter(F.col("kind") == "oversize")
        .select("snapshot_id", "seq", "row_key", "bytes")
        .distinct()
    )


def routed_dumps(frames: DataFrame, topic: str = "topic") -> DataFrame:
    """Snapshots whose frames lie in several topics: none of those tables can be rebuilt.

    A route to one destination moves rows away while begin and end stay where they were.
    """
    per_topic = frames.groupBy("snapshot_id", topic).agg(
        F.count_if(F.col("kind") == "begin").alias("begins"),
        F.count_if(F.col("kind") == "end").alias("ends"),
        F.count_if(F.col("kind").isin("row", "oversize")).alias("rows"),
    )
    framed = (F.col("begins") > 0) & (F.col("ends") > 0)
    split = per_topic.groupBy("snapshot_id").agg(F.count(F.lit(1)).alias("topics"))
    return (
        per_topic.join(split, "snapshot_id")
        .withColumn("hazard", ~framed | (F.col("topics") > 1))
        .select("snapshot_id", topic, "begins", "ends", "rows", "hazard")
    )

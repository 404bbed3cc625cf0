"""The whole path of one feed: window, filter, route, fan out, stamp."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.json import with_document
from feedloom.operators import accounting, delivery, rules, snapshot
from feedloom.operators.unwrap import unwrap_nested
from feedloom.operators.windows import in_window


@dataclass(frozen=True)
class FeedSpec:
    """What one unit of a connection reads and how its rows are treated."""

    connection: str
    unit: str
    base_topic: str
    shape: str = "incremental"  # or "dump"
    content: str = "json"  # or "binary"
    window: tuple[str, str] | None = None
    row_key: str | None = None
    add_fields: dict[str, object] = field(default_factory=dict)
    keep: Callable[[Column], Column] | None = None
    routes: Sequence[rules.RouteRule] = ()
    defaults: Sequence[str] = ("default",)
    destination_topics: dict[str, str] = field(default_factory=dict)
    snapshot_per_item: bool = False
    topic_per_dump_unit: bool = True
    unwrap: bool = True

    @property
    def store(self) -> str:
        return f"{self.connection}.{self.unit}"


# Fixed value: bytes of an oversize row that its dead letter keeps.
DEAD_LETTER_BYTES = 64 * 1024


@dataclass(frozen=True)
class Landed:
    """What one tick of a feed gives."""

    rows: DataFrame  # outbound, one per destination; `kept` is false for filtered ones
    dead: DataFrame  # copies of rows over the size bound
    report: DataFrame  # one row: rows, bytes, filtered, oversize


def _judged(df: DataFrame, spec: FeedSpec, org: str, now_ms: int, split: bool) -> DataFrame:
    """Rows with fields added, judged, routed, split and stamped, not yet fanned out."""
    out = df
    if spec.add_fields:
        out = rules.add_fields(out, spec.add_fields)
    out = out.withColumn("payload", rules.without_bom(F.col("payload")))
    out = with_document(out, "payload")
    verdict = (
        rules.keep_flag(out, spec.keep(F.col("_doc"))) if spec.keep is not None else F.lit(True)
    )
    out = out.withColumn("kept", verdict)
    out = rules.route(out, spec.routes, source=spec.unit, doc="_doc")
    keys = F.map_keys("_doc")
    if split:
        # a body of several records is cut after its rules; each part is a record to stamp
        out = with_document(rules.split_body(out.drop("_doc")), "payload")
    return rules.stamp(
        out, F.col("source"), spec.store, F.col(org), now_ms, now_ms, keys=keys
    ).drop("_doc")


def _addressed(df: DataFrame, spec: FeedSpec) -> DataFrame:
    topic = rules.unit_topic(
        spec.base_topic, spec.unit, spec.shape == "dump", spec.topic_per_dump_unit, suffix=""
    )
    return df.withColumn("topic", topic)


def land(df: DataFrame, spec: FeedSpec, ts: str, org: str, now_ms: int) -> DataFrame:
    """Rows of an incremental feed as outbound rows, one per destination.

    A filtered row stays with `kept = false`, so one pass gives both the rows to send and
    the counts of what was removed. Each record is parsed once, for filter, routes and stamp.
    """
    out = df
    if spec.window is not None:
        out = in_window(out, ts, F.lit(spec.window[0]), F.lit(spec.window[1]))
    out = out.withColumn("ingested_bytes", F.octet_length("payload").cast("bigint"))
    stamped = _judged(_addressed(out, spec), spec, org, now_ms, split=False)
    return rules.fan_out_rows(stamped, spec.defaults, spec.destination_topics)


def land_feed(
    df: DataFrame,
    spec: FeedSpec,
    ts: str,
    org: str,
    now_ms: int,
    max_bytes: int = snapshot.DEFAULT_MAX_BYTES,
    order: Sequence[str] = (),
    bucket: Column | None = None,
    item: str | None = None,
    at: Any = None,
    completed_at: Any = None,
    run: str = "",
) -> Landed:
    """The whole path of a feed in its order: window, unwrap, size, frame, fields, filter, route, split, stamp.

    Binary rows skip every rule and go out as they are; a dump of them is refused. An oversize row
    of an incremental feed goes to the dead letters alone; in a dump a stub stands in for it as well.
    A dump needs a unique `order`, fixed times and a `run`; its rows are filtered as `record.*`
    before they are numbered, and markers and stubs pass every filter.
    """
    out = df
    if spec.window is not None:
        out = in_window(out, ts, F.lit(spec.window[0]), F.lit(spec.window[1]))
    out = _addressed(out, spec).withColumn("ingested_bytes", F.octet_length("payload").cast("bigint"))
    if spec.content == "binary":
        if spec.shape == "dump":
            raise ValueError("a dump cannot carry binary rows")
        plain = out.withColumns(
            {
                "kept": F.lit(True),
                "tenancy": F.lit("Unstamped"),
                "source": F.lit(spec.unit),
                "destinations": F.lit(None).cast("array<string>"),
            }
        )
        return _landed(plain, plain.filter(F.lit(False)), spec)
    if spec.unwrap:
        out = unwrap_nested(out)
    over = F.octet_length("payload") > max_bytes
    dead = delivery.dead_letters(
        out.filter(over), F.col("topic"), F.lit("too_large"), limit=DEAD_LETTER_BYTES
    )
    if spec.shape == "dump":
        if spec.snapshot_per_item and item is None:
            raise ValueError("a snapshot per item needs the item's column")
        frames = snapshot.frame_snapshot(
            out,
            spec.store,
            at,
            completed_at,
            run,
            order,
            item=item if spec.snapshot_per_item else None,
            keep=spec.keep,
            row_key=spec.row_key,
            max_bytes=max_bytes,
            bucket=bucket,
        )
        framed = _addressed(snapshot.frame_payload(frames), spec).withColumn(org, F.lit(None).cast("string"))
        stub = F.col("kind") != "row"
        framed = framed.withColumn(
            "ingested_bytes", F.when(stub, F.lit(0)).otherwise(F.octet_length("record")).cast("bigint")
        )
        return _landed(_judged(framed, replace(spec, keep=None), org, now_ms, split=False), dead, spec)
    return _landed(_judged(out.filter(~over), spec, org, now_ms, split=True), dead, spec)


def _landed(rows: DataFrame, dead: DataFrame, spec: FeedSpec) -> Landed:
    counted = rows.withColumn("_size", F.octet_length("payload"))
    if "kind" in rows.columns:
        counted = counted.filter(F.col("kind").isin("row", "oversize"))
    report = accounting.tick_report(counted, [], "kept", "_size").withColumn(
        "oversize", dead.agg(F.count(F.lit(1))).scalar()
    )
    return Landed(rules.fan_out_rows(rows, spec.defaults, spec.destination_topics), dead, report)

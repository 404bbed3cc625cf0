"""Queries that read tables in planned batches and publish them: key tails, followed files, topics with checkpoints."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from feedloom.plans.catalog.base import query, table
from feedloom.session import ensure_checkpoint_dir
from feedloom.sources import topics
from feedloom.sources.following import LineFollower
from feedloom.sources.keys import change_stream as changes_after
from feedloom.sources.keys import keyset_stream as rows_after
from feedloom.streaming import commit

KEYS = ["o_orderdate", "o_orderkey"]
CLOCK = "2024-01-01 00:00:00"


def _folder(spark, name):
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def _publish_orders(spark, sf_dir):
    """Folder where all orders are published in three batches, in key order, under their priority."""
    path = _folder(spark, "published")
    limit = table(spark, sf_dir, "orders").count() // 3 + 1
    follower = rows_after(spark, lambda: table(spark, sf_dir, "orders"), KEYS, _folder(spark, "orders"), limit=limit)
    run = commit.publish_batch(lambda df: df, path, "I", "c", lambda: CLOCK, sink_columns=["topic", "payload"])

    def sink(rows, number):
        mark = F.struct(
            F.lit("keyset").alias("kind"),
            F.array(F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderkey").cast("string")).alias("keyset"),
            F.lit(None).cast("timestamp").alias("item_position"),
            F.lit(None).cast("string").alias("item_key"),
            F.lit(None).cast("string").alias("ack_id"),
        )
        order = F.struct(*KEYS)
        marked = rows.select(
            F.col("o_orderstatus").alias("unit"), order.alias("arrival"), mark.alias("mark"),
            F.col("o_orderpriority").alias("topic"), F.to_json(F.struct("o_orderkey")).alias("payload"),
        )
        run(marked, number)

    follower.drain(sink)
    return path


@query(
    "keyset_stream",
    """WITH n AS (SELECT count(*) // 3 + 1 AS most FROM orders)
       SELECT '{"o_orderkey":' || o_orderkey || '}' AS payload, o_orderpriority AS topic,
              CAST((row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) // most AS INT) AS batch FROM orders, n""",
)
def keyset_stream(spark, sf_dir):
    return topics.published(spark, _publish_orders(spark, sf_dir), ["payload", "topic", "batch"])


@query(
    "published_checkpoints",
    """SELECT lower('I.c.' || o_orderstatus) AS cursor_key,
              arg_max(strftime(o_orderdate, '%Y-%m-%d') || '|' || o_orderkey, (o_orderdate, o_orderkey)) AS keyset
       FROM orders GROUP BY o_orderstatus""",
)
def published_checkpoints(spark, sf_dir):
    saved = topics.read_published(spark, _publish_orders(spark, sf_dir))
    value = F.from_json("api_cursor", "keyset array<string>")["keyset"]
    return saved.select("cursor_key", F.concat_ws("|", value).alias("keyset"))


@query(
    "change_stream",
    """WITH f AS (SELECT event_id, event_type <> 'view' AS told FROM events),
       n AS (SELECT count(*) // 2 + 1 AS most FROM f WHERE told)
       SELECT event_id, CAST((row_number() OVER (ORDER BY event_id) - 1) // most AS INT) AS batch FROM f, n WHERE told""",
)
def change_stream(spark, sf_dir):
    """Events that carry a payload, each with the batch that handed it over."""

    def feed():
        told = F.when(F.col("event_type") != "view", F.col("event_type"))
        return table(spark, sf_dir, "events").select("event_id", told.alias("payload"))

    out, limit = _folder(spark, "changes"), feed().filter(F.col("payload").isNotNull()).count() // 2 + 1
    follower = changes_after(spark, feed, "event_id", _folder(spark, "tokens"), limit=limit)
    follower.drain(lambda rows, number: rows.select("event_id").write.mode("overwrite").parquet(f"{out}/batch={number}"))
    return spark.read.parquet(out).select("event_id", "batch")


@query("follow_lines", "SELECT event_id, event_type FROM events")
def follow_lines(spark, sf_dir):
    """Events from the lines of growing files, read in batches of bounded bytes."""
    folder, out = _folder(spark, "lines"), _folder(spark, "followed")
    lines = table(spark, sf_dir, "events").select(F.to_json(F.struct("event_id", "event_type")).alias("value"))
    lines.repartition(6, "value").write.text(folder)
    whole = lines.agg(F.sum(F.octet_length("value") + 1)).first()[0]
    follower = LineFollower(spark, folder, f"{out}-state", max_line=1 << 12, max_bytes=max(1 << 13, whole * 2 // 3))
    follower.drain(lambda rows, number: rows.select("payload").write.mode("overwrite").parquet(f"{out}/batch={number}"))
    event = F.from_json("payload", "event_id long, event_type string")
    return spark.read.parquet(out).select(event.alias("e")).select("e.*")

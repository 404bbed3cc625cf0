"""Queries over batches and delivery outcomes."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.operators import accounting, delivery, rules
from feedloom.plans.catalog.base import EVENTS_FEED, events_feed, query, table

LIMITS = {"max_rows": 20, "max_bytes": 1500, "window_ms": 21_600_000}

_BATCHED = f"""{EVENTS_FEED},
   r AS MATERIALIZED (SELECT event_type AS unit, event_id, strlen(payload) AS len, epoch_us(ts) // 1000 AS ms,
          row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS n,
          sum(strlen(payload)) OVER (PARTITION BY event_type ORDER BY event_id) AS cum FROM feed),
   b(unit, s) AS (
     SELECT unit, n FROM r WHERE n = 0
     UNION ALL
     SELECT unit, nxt FROM (
       SELECT b.unit, (SELECT min(x.n) FROM r x WHERE x.unit = b.unit AND x.n > b.s AND x.n <= b.s + 20
           AND (x.n >= b.s + 20 OR x.cum - f.cum + f.len > 1500 OR x.ms >= f.ms + 21600000)) AS nxt
       FROM b JOIN r f ON f.unit = b.unit AND f.n = b.s) t WHERE nxt IS NOT NULL),
   k AS (SELECT unit, s, row_number() OVER (PARTITION BY unit ORDER BY s) - 1 AS batch_no,
           lead(s) OVER (PARTITION BY unit ORDER BY s) AS e FROM b),
   batched AS (SELECT r.*, k.batch_no, k.s, k.e FROM r JOIN k ON r.unit = k.unit AND r.n >= k.s AND (k.e IS NULL OR r.n < k.e))"""


def _feed(spark, sf_dir):
    return events_feed(spark, sf_dir).select(
        F.col("event_type").alias("unit"),
        "event_id",
        F.octet_length("payload").alias("size"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"),
    )


def _batched(spark, sf_dir):
    return delivery.assign_batches(_feed(spark, sf_dir), ["unit"], "event_id", "size", "ms", span=300, **LIMITS)


@query(
    "assign_batches",
    f"""WITH RECURSIVE {_BATCHED}
       SELECT unit, event_id, CAST(batch_no AS BIGINT) AS batch_no FROM batched""",
)
def assign_batches(spark, sf_dir):
    # Small pieces, so that batches cross their borders on small tables too.
    return _batched(spark, sf_dir).select("unit", "event_id", "batch_no")


@query(
    "batch_triggers",
    f"""WITH RECURSIVE {_BATCHED},
       t AS (SELECT unit, batch_no, count(*) AS rows, sum(len) AS bytes, min(ms) AS first_ms, any_value(e) AS e FROM batched GROUP BY unit, batch_no)
       SELECT t.unit, CAST(t.batch_no AS BIGINT) AS batch_no, CAST(rows AS BIGINT) AS rows, CAST(bytes AS BIGINT) AS bytes,
         CASE WHEN rows >= 20 THEN 'rows' WHEN e IS NULL THEN 'end' WHEN x.ms >= first_ms + 21600000 THEN 'window' ELSE 'bytes' END AS "trigger"
       FROM t LEFT JOIN r x ON x.unit = t.unit AND x.n = t.e""",
)
def batch_triggers(spark, sf_dir):
    batches = delivery.batch_table(
        _batched(spark, sf_dir), ["unit"], "size", "ms", LIMITS["max_rows"], LIMITS["window_ms"]
    )
    return batches.select("unit", "batch_no", "rows", "bytes", "trigger")


def _deliveries(spark, sf_dir):
    """Events at two destinations, with faults on some."""
    events = table(spark, sf_dir, "events")
    out = events.select(
        "event_id",
        "user_id",
        F.explode(F.array(F.lit("lake"), F.lit("search"))).alias("destination"),
    )
    lake = F.col("destination") == "lake"
    fault = (
        F.when(lake & (F.col("event_id") % 11 == 0), F.lit("record"))
        .when(~lake & (F.col("event_id") % 7 == 0), F.lit("record"))
        .when(~lake & (F.col("event_id") % 13 == 0), F.lit("transport"))
    )
    return out.withColumn("outcome", delivery.outcome_of(fault, lake))


@query(
    "classify_outcomes",
    """SELECT event_id, CAST(2 AS BIGINT) AS destinations,
         CASE WHEN event_id % 13 = 0 AND event_id % 7 <> 0 THEN 'held' WHEN event_id % 7 = 0 THEN 'dropped'
              WHEN event_id % 11 = 0 THEN 'dead_lettered' ELSE 'sent' END AS outcome FROM events""",
)
def classify_outcomes(spark, sf_dir):
    return delivery.classify(_deliveries(spark, sf_dir), ["event_id"])


@query(
    "resend_set",
    """SELECT event_id, 'search' AS destination FROM events WHERE event_id % 13 = 0 AND event_id % 7 <> 0""",
)
def resend_set(spark, sf_dir):
    plan = _deliveries(spark, sf_dir)
    taken = plan.filter(F.col("outcome") != "held")
    return delivery.resend(plan, taken, ["event_id", "destination"]).select(
        "event_id", "destination"
    )


@query(
    "dead_letters",
    """SELECT doc_id, 'docs_dlq' AS dead_topic, CASE WHEN strlen(text) > 8192 THEN 'too_large' ELSE 'transport_refused' END AS reason,
         CAST(least(strlen(text), 1000) AS BIGINT) AS copy_bytes, CAST(strlen(text) AS BIGINT) AS original_bytes,
         hex(encode(text)[1:1000]) AS copy_hex
       FROM documents WHERE strlen(text) > 8192 OR doc_id % 20 = 0""",
)
def dead_letters(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("payload"))
    sent, large = delivery.apart_oversize(documents, 8192)
    refused = sent.filter(F.col("doc_id") % 20 == 0)
    faults = large.withColumn("why", F.lit("too_large")).unionByName(
        refused.withColumn("why", F.lit("transport_refused"))
    )
    dead = delivery.dead_letters(faults, F.lit("docs_dlq"), F.col("why"), limit=1000)
    return dead.select(
        "doc_id",
        "dead_topic",
        "reason",
        F.octet_length("copy").cast("bigint").alias("copy_bytes"),
        "original_bytes",
        F.hex("copy").alias("copy_hex"),
    )


@query(
    "dropped_reasons",
    """SELECT lang, CASE WHEN strlen(text) > 8192 THEN 'too_large' WHEN doc_id % 9 = 0 THEN 'unstampable' ELSE 'transport_refused' END AS reason,
         CAST(count(*) AS BIGINT) AS rows FROM documents WHERE strlen(text) > 8192 OR doc_id % 9 = 0 OR doc_id % 10 = 0 GROUP BY ALL""",
)
def dropped_reasons(spark, sf_dir):
    body = F.when(F.col("doc_id") % 9 == 0, F.concat(F.lit("{"), "text")).otherwise(F.col("text"))
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", body.alias("payload"), F.octet_length("text").alias("size")
    )
    reason = (
        F.when(F.col("size") > 8192, F.lit("too_large"))
        .when(rules.tenancy(F.col("payload")) == "Refused", F.lit("unstampable"))
        .when(F.col("doc_id") % 10 == 0, F.lit("transport_refused"))
    )
    lost = documents.withColumn("reason", reason).filter(F.col("reason").isNotNull())
    return delivery.dropped(lost, ["lang"])


@query(
    "incremental_oversize",
    """SELECT lang AS unit, CAST(count(*) FILTER (WHERE strlen(text) <= 4096) AS BIGINT) AS sent,
         CAST(count(*) FILTER (WHERE strlen(text) > 4096) AS BIGINT) AS oversize, max(doc_id) AS checkpoint FROM documents GROUP BY lang""",
)
def incremental_oversize(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", F.col("text").alias("payload"))
    sent, large = delivery.apart_oversize(documents, 4096)
    both = sent.select("lang", "doc_id", F.lit(1).alias("ok")).unionByName(
        large.select("lang", "doc_id", F.lit(0).alias("ok"))
    )
    return both.groupBy(F.col("lang").alias("unit")).agg(
        F.sum("ok").alias("sent"),
        F.sum(1 - F.col("ok")).alias("oversize"),
        F.max("doc_id").alias("checkpoint"),
    )


@query(
    "tick_report",
    f"""WITH {EVENTS_FEED} SELECT event_type AS unit, CAST(count(*) FILTER (WHERE value >= 25) AS BIGINT) AS rows,
         CAST(coalesce(sum(strlen(payload)) FILTER (WHERE value >= 25), 0) AS BIGINT) AS bytes,
         CAST(count(*) FILTER (WHERE value < 25) AS BIGINT) AS filtered FROM feed GROUP BY event_type""",
)
def tick_report(spark, sf_dir):
    feed = events_feed(spark, sf_dir).select(
        F.col("event_type").alias("unit"),
        (F.col("value") >= 25).alias("kept"),
        F.octet_length("payload").cast("bigint").alias("size"),
    )
    return accounting.tick_report(feed, ["unit"], "kept", "size")


@query(
    "usage_by_org",
    f"""WITH {EVENTS_FEED}, u AS (SELECT CASE WHEN event_id % 6 IN (3, 5) THEN 'org-' || (user_id % 3) ELSE 'default' END AS org_id,
           strlen(CASE event_id % 6 WHEN 0 THEN '[' || payload || ',1]' WHEN 1 THEN event_type WHEN 3 THEN chr(65279) || payload ELSE payload END) AS size,
           event_id FROM feed WHERE event_id % 6 NOT IN (2, 4) AND event_type <> 'error' AND user_id % 10 <> 0)
       SELECT org_id, CAST(sum(size) AS BIGINT) AS usage_bytes, CAST(count(*) AS BIGINT) AS rows FROM u GROUP BY org_id""",
)
def usage_by_org(spark, sf_dir):
    from feedloom.plans.catalog.rows import _bodies

    bodies = _bodies(spark, sf_dir)
    rows = bodies.select(
        F.concat(F.lit("org-"), F.col("user_id") % 3).alias("org_id"),
        rules.tenancy(F.col("payload")).alias("tenancy"),
        F.when(rules.tenancy(F.col("payload")) == "Refused", F.lit("dead_lettered"))
        .when(F.col("event_type") == "error", F.lit("dropped"))
        .otherwise(F.lit("sent"))
        .alias("outcome"),
        F.when(F.col("user_id") % 10 == 0, F.lit("oversize")).otherwise(F.lit("row")).alias("frame"),
        F.octet_length("payload").cast("bigint").alias("ingested_bytes"),
    )
    return accounting.usage_by_org(rows)


@query(
    "batches_null_unit",
    f"""WITH RECURSIVE {_BATCHED}
       SELECT CASE WHEN unit <> 'view' THEN unit END AS unit, event_id, CAST(batch_no AS BIGINT) AS batch_no FROM batched""",
)
def batches_null_unit(spark, sf_dir):
    """A unit without a name is a unit like any other."""
    feed = _feed(spark, sf_dir).withColumn("unit", F.when(F.col("unit") != "view", F.col("unit")))
    out = delivery.assign_batches(feed, ["unit"], "event_id", "size", "ms", span=300, **LIMITS)
    return out.select("unit", "event_id", "batch_no")

"""Queries over keyset tails, marks and checkpoints."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.functions.json import object_text
from feedloom.functions.numbering import span_bucket
from feedloom.functions.records import to_record
from feedloom.operators import checkpoint, keyset
from feedloom.plans.catalog.base import events_feed, query, table


@query(
    "keyset_tail",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM (
         SELECT DISTINCT ON (l_orderkey, l_linenumber) * FROM (
           SELECT l_orderkey, l_linenumber, max(l_quantity) AS l_quantity FROM lineitem GROUP BY ALL))
       WHERE (l_orderkey, l_linenumber) > (1000, 3)
       ORDER BY l_orderkey, l_linenumber LIMIT 5000""",
)
def keyset_tail(spark, sf_dir):
    # The test table repeats some keys; a keyset tail needs them unique.
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey", "l_linenumber")
        .agg(F.max("l_quantity").alias("l_quantity"))
    )
    return keyset.keyset_tail(
        lines, ["l_orderkey", "l_linenumber"], (1000, 3), limit=500, max_pages=10
    )


@query(
    "keyset_full_pages",
    """WITH tail AS (SELECT o_orderkey FROM orders WHERE o_orderkey > 500 ORDER BY o_orderkey LIMIT 7000)
       SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(*) // 700 AS BIGINT) AS full_pages FROM tail""",
)
def keyset_full_pages(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    tail = keyset.keyset_tail(orders, ["o_orderkey"], (500,), limit=700, max_pages=10)
    return keyset.tail_pages(tail, 700)


@query(
    "doc_tail",
    """SELECT doc_id, md5(text) AS digest FROM documents WHERE lang = 'en' AND doc_id > 100
       ORDER BY doc_id LIMIT 300""",
)
def doc_tail(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    tail = keyset.doc_tail(documents, F.col("lang") == "en", 100, 300, key="doc_id")
    return tail.select("doc_id", F.md5("text").alias("digest"))


def _changes(spark, sf_dir):
    """Events as a change feed; views pass by without a payload."""
    return events_feed(spark, sf_dir).withColumn(
        "payload", F.when(F.col("event_type") != "view", F.col("payload"))
    )


@query(
    "change_tail",
    """SELECT event_id, event_type FROM events WHERE event_id > 250 AND event_type <> 'view'
       ORDER BY event_id LIMIT 400""",
)
def change_tail(spark, sf_dir):
    events, _ = keyset.change_tail(_changes(spark, sf_dir), "event_id", 250, 400)
    return events.select("event_id", "event_type")


@query(
    "change_advance",
    """SELECT max(event_id) AS token, CAST(count(*) FILTER (WHERE event_type <> 'view' AND event_id > 250) AS BIGINT) AS events
       FROM events""",
)
def change_advance(spark, sf_dir):
    _, advance = keyset.change_tail(_changes(spark, sf_dir), "event_id", 250)
    return advance


@query(
    "dump_records",
    """SELECT o_orderkey,
        '{"o_orderkey":' || o_orderkey || ',"o_totalprice":' || CAST(o_totalprice AS DECIMAL(14,2))
          || ',"o_orderdate":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || 'Z"'
          || ',"day":"' || strftime(o_orderdate, '%Y-%m-%d') || '"'
          || ',"raw":"' || to_base64(encode(o_orderpriority)) || '"'
          || ',"note":' || CASE WHEN o_orderstatus = 'F' THEN '"done"' ELSE 'null' END || '}' AS payload
       FROM orders""",
)
def dump_records(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_totalprice").cast("decimal(14,2)"),
        "o_orderdate",
        F.col("o_orderdate").cast("date").alias("day"),
        F.col("o_orderpriority").cast("binary").alias("raw"),
        F.when(F.col("o_orderstatus") == "F", F.lit("done")).alias("note"),
    )
    return orders.select("o_orderkey", to_record(orders, "odbc").alias("payload"))


def _marked(spark, sf_dir):
    """Three units: keyset marks on even orders, item marks, and a unit that mixes kinds."""
    orders = table(spark, sf_dir, "orders")
    unit = F.concat(F.lit("u"), F.col("o_custkey") % 3)
    kind = (
        F.when(F.col("o_custkey") % 3 == 0, F.lit("keyset"))
        .when(F.col("o_custkey") % 3 == 1, F.lit("item"))
        .otherwise(F.when(F.col("o_orderkey") % 2 == 0, F.lit("item")).otherwise(F.lit("keyset")))
    )
    mark = F.struct(
        kind.alias("kind"),
        F.array(F.col("o_orderdate").cast("string"), F.col("o_orderkey").cast("string")).alias(
            "keyset"
        ),
        F.col("o_orderdate").alias("item_position"),
        F.concat(F.lit("k"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0")).alias("item_key"),
    )
    return orders.select(
        unit.alias("unit"),
        F.col("o_orderkey").alias("arrival"),
        F.when(F.col("o_orderstatus") != "P", mark).alias("mark"),
        "o_orderstatus",
    )


@query(
    "fold_marks",
    """WITH m AS (SELECT 'u' || (o_custkey % 3) AS unit, o_orderkey, o_orderdate,
           CASE WHEN o_custkey % 3 = 0 THEN 'keyset' WHEN o_custkey % 3 = 1 THEN 'item'
                WHEN o_orderkey % 2 = 0 THEN 'item' ELSE 'keyset' END AS kind FROM orders WHERE o_orderstatus <> 'P'),
        last_key AS (SELECT unit, max(o_orderkey) AS k FROM m GROUP BY unit),
        last_item AS (SELECT unit, max((o_orderdate, 'k' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0'))) AS i FROM m GROUP BY unit),
        sums AS (SELECT unit, count(DISTINCT kind) AS kinds, min(kind) AS kind, count(*) AS marks FROM m GROUP BY unit)
       SELECT unit, CASE WHEN kinds = 1 THEN kind END AS kind,
         CASE WHEN kinds = 1 AND kind = 'keyset' THEN CAST(k AS VARCHAR) END AS key_value,
         CASE WHEN kinds = 1 AND kind = 'item' THEN i[2] END AS item_key,
         CAST(marks AS BIGINT) AS marks, kinds > 1 AS inconsistent
       FROM sums JOIN last_key USING (unit) JOIN last_item USING (unit)""",
)
def fold_marks(spark, sf_dir):
    folded = checkpoint.fold_marks(_marked(spark, sf_dir))
    return folded.select(
        "unit",
        "kind",
        F.col("keyset")[1].alias("key_value"),
        F.col("item.key").alias("item_key"),
        "marks",
        "inconsistent",
    )


@query(
    "fold_all_marks",
    """WITH m AS (SELECT 'u' || (o_custkey % 3) AS unit, o_orderkey, 'f' || (o_custkey % 7) AS file_id, o_orderkey * 10 AS off FROM orders WHERE o_custkey % 3 < 2),
       l AS (SELECT unit, file_id, max(off) AS off, min(o_orderkey) AS seen FROM m WHERE unit = 'u0' AND o_orderkey % 4 <> 0 GROUP BY ALL),
       v AS (SELECT unit, string_agg(file_id || ':' || off, ',' ORDER BY seen) AS lines FROM l GROUP BY unit),
       a AS (SELECT unit, count(*) AS acks FROM m WHERE unit = 'u1' OR o_orderkey % 4 = 0 GROUP BY unit)
       SELECT a.unit, CASE a.unit WHEN 'u0' THEN 'line' ELSE 'ack' END AS kind, false AS inconsistent, lines,
         CAST(acks AS BIGINT) AS acks, CAST(ceil(acks / 500) AS BIGINT) AS batches FROM a LEFT JOIN v USING (unit)""",
)
def fold_all_marks(spark, sf_dir):
    """A unit of lines with acknowledgements beside them, and one of acknowledgements alone."""
    orders = table(spark, sf_dir, "orders").filter(F.col("o_custkey") % 3 < 2)
    acks = (F.col("o_custkey") % 3 == 1) | (F.col("o_orderkey") % 4 == 0)
    mark = F.struct(
        F.when(acks, F.lit("ack")).otherwise(F.lit("line")).alias("kind"),
        F.lit(None).cast("array<string>").alias("keyset"),
        F.lit(None).cast("date").alias("item_position"),
        F.lit(None).cast("string").alias("item_key"),
        F.concat(F.lit("f"), F.col("o_custkey") % 7).alias("file_id"),
        (F.col("o_orderkey") * 10).alias("end_offset"),
        F.when(acks, F.concat(F.lit("a"), F.col("o_orderkey"))).alias("ack_id"),
    )
    marked = orders.select(
        F.concat(F.lit("u"), F.col("o_custkey") % 3).alias("unit"), F.col("o_orderkey").alias("arrival"), mark.alias("mark")
    )
    ids = checkpoint.ack_batches(marked.select("unit", F.col("mark.ack_id").alias("ack_id")), ["unit"])
    per = ids.groupBy("unit").agg(
        F.count("ack_id").alias("acks"), (F.max("batch_no") + 1).alias("batches")
    )
    pair = F.transform("lines", lambda f: F.concat(f["file_id"], F.lit(":"), f["end_offset"]))
    lines = checkpoint.fold_lines(marked).select("unit", F.array_join(pair, ",").alias("lines"))
    folded = checkpoint.fold_marks(marked).select("unit", "kind", "inconsistent")
    return folded.join(lines, "unit", "left").join(per, "unit", "left")


@query(
    "mixed_marks",
    """SELECT 'u' || (o_custkey % 3) AS unit,
         count(DISTINCT CASE WHEN o_custkey % 3 = 0 THEN 'keyset' WHEN o_custkey % 3 = 1 THEN 'item'
                WHEN o_orderkey % 2 = 0 THEN 'item' ELSE 'keyset' END) > 1 AS inconsistent
       FROM orders WHERE o_orderstatus <> 'P' GROUP BY unit""",
)
def mixed_marks(spark, sf_dir):
    return checkpoint.fold_marks(_marked(spark, sf_dir)).select("unit", "inconsistent")


@query(
    "consumed_marks",
    """SELECT 'seg-' || c_mktsegment AS unit, max(c_custkey) AS checkpoint_key,
         max(c_custkey) FILTER (WHERE c_acctbal > 5000) AS emitted_key,
         CAST(count(*) AS BIGINT) AS consumed, CAST(count(*) FILTER (WHERE c_acctbal > 5000) AS BIGINT) AS emitted
       FROM customer GROUP BY unit""",
)
def consumed_marks(spark, sf_dir):
    # The fold runs over all rows, so a filtered tail still moves the checkpoint.
    customer = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("seg-"), "c_mktsegment").alias("unit"),
        "c_custkey",
        (F.col("c_acctbal") > 5000).alias("kept"),
    )
    folded = checkpoint.keyset_fold(customer, ["unit"], ["c_custkey"], "c_custkey")
    counts = customer.groupBy("unit").agg(
        F.max(F.when(F.col("kept"), F.col("c_custkey"))).alias("emitted_key"),
        F.count(F.lit(1)).alias("consumed"),
        F.count_if("kept").alias("emitted"),
    )
    return folded.withColumnRenamed("c_custkey", "checkpoint_key").join(counts, "unit")


@query(
    "item_fold",
    """SELECT o_orderpriority AS unit, strftime(i[1], '%Y-%m-%d') AS position, i[2] AS item_key FROM (
         SELECT o_orderpriority, max((o_orderdate, 'k' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0'))) AS i
         FROM orders GROUP BY o_orderpriority)""",
)
def item_fold(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("unit"),
        F.col("o_orderdate").alias("position"),
        F.concat(F.lit("k"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0")).alias("item_key"),
    )
    folded = checkpoint.item_fold(orders, ["unit"], "position", "item_key")
    return folded.withColumn("position", F.date_format("position", "yyyy-MM-dd"))


@query(
    "line_fold",
    """SELECT l_suppkey % 10 AS unit, l_suppkey AS file_id, max(l_orderkey * 8 + l_linenumber) AS end_offset,
              min(l_orderkey) AS first_seen FROM lineitem GROUP BY ALL""",
)
def line_fold(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        (F.col("l_suppkey") % 10).alias("unit"),
        F.col("l_suppkey").alias("file_id"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("end_offset"),
        F.col("l_orderkey").alias("arrival"),
    )
    return checkpoint.line_fold(lines, ["unit"], "file_id", "end_offset", "arrival")


@query(
    "ack_batches",
    """WITH ids AS (SELECT DISTINCT event_type AS unit, event_id AS ack_id FROM events)
       SELECT unit, ack_id, CAST((row_number() OVER (PARTITION BY unit ORDER BY ack_id) - 1) // 500 AS BIGINT) AS batch_no
       FROM ids""",
)
def ack_batches(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("unit"), F.col("event_id").alias("ack_id")
    )
    return checkpoint.ack_batches(events, ["unit"], bucket=span_bucket("ack_id", 1_000_000))


@query(
    "read_checkpoints",
    """WITH raw AS (SELECT 'crm.' || CASE WHEN o_orderkey % 2 = 0 THEN 'Orders' ELSE 'orders' END || '.' || (o_custkey % 50) AS cursor_key,
          o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 1 ELSE 2 END AS version, o_orderkey % 7 = 0 AS broken FROM orders),
         newest AS (SELECT lower(cursor_key) AS cursor_key, max(o_orderkey) AS k FROM raw GROUP BY lower(cursor_key))
       SELECT n.cursor_key, k AS records, CASE WHEN version >= 2 AND NOT broken THEN '{"id":' || k || '}' END AS api_cursor
       FROM newest n JOIN raw r ON r.o_orderkey = n.k""",
)
def read_checkpoints(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    name = F.when(F.col("o_orderkey") % 2 == 0, F.lit("Orders")).otherwise(F.lit("orders"))
    text = F.concat(F.lit('{"id":'), F.col("o_orderkey").cast("string"))
    raw = orders.select(
        F.concat(F.lit("crm."), name, F.lit("."), (F.col("o_custkey") % 50).cast("string")).alias(
            "cursor_key"
        ),
        F.col("o_orderdate").cast("timestamp").alias("last_fetch_end"),
        F.col("o_orderkey").alias("last_fetch_records"),
        F.timestamp_seconds(F.col("o_orderkey")).alias("updated_at"),
        F.when(F.col("o_orderkey") % 7 == 0, text)
        .otherwise(F.concat(text, F.lit("}")))
        .alias("api_cursor"),
        F.when(F.col("o_orderkey") % 11 == 0, 1).otherwise(2).alias("version"),
    )
    return checkpoint.latest_checkpoints(raw).select(
        "cursor_key", F.col("last_fetch_records").alias("records"), "api_cursor"
    )


@query(
    "file_generations",
    """WITH reads AS (SELECT l_suppkey AS file_id, l_orderkey * 8 + l_linenumber AS arrival, max(l_partkey) AS end_offset
          FROM lineitem GROUP BY ALL),
        steps AS (SELECT *, CASE WHEN end_offset <= lag(end_offset) OVER (PARTITION BY file_id ORDER BY arrival) THEN 1 ELSE 0 END AS reset FROM reads),
        gens AS (SELECT *, sum(reset) OVER (PARTITION BY file_id ORDER BY arrival) AS generation FROM steps)
       SELECT file_id, arrival, end_offset, CAST(generation AS BIGINT) AS generation,
              generation < max(generation) OVER (PARTITION BY file_id) AS stale FROM gens""",
)
def file_generations(spark, sf_dir):
    reads = (
        table(spark, sf_dir, "lineitem")
        .groupBy(
            F.col("l_suppkey").alias("file_id"),
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("arrival"),
        )
        .agg(F.max("l_partkey").alias("end_offset"))
    )
    return checkpoint.file_generations(reads, ["file_id"], "arrival", "end_offset", span=20_000)


@query(
    "file_generations_null",
    """WITH reads AS (SELECT CASE WHEN l_suppkey % 3 > 0 THEN l_suppkey END AS file_id, l_orderkey * 8 + l_linenumber AS arrival, max(l_partkey) AS end_offset
          FROM lineitem GROUP BY ALL),
        steps AS (SELECT *, CASE WHEN end_offset <= lag(end_offset) OVER (PARTITION BY file_id ORDER BY arrival) THEN 1 ELSE 0 END AS reset FROM reads),
        gens AS (SELECT *, sum(reset) OVER (PARTITION BY file_id ORDER BY arrival) AS generation FROM steps)
       SELECT file_id, arrival, CAST(generation AS BIGINT) AS generation,
              generation < max(generation) OVER (PARTITION BY file_id) AS stale FROM gens""",
)
def file_generations_null(spark, sf_dir):
    """Reads of a file without a name have generations like any other's."""
    reads = (
        table(spark, sf_dir, "lineitem")
        .groupBy(
            F.when(F.col("l_suppkey") % 3 > 0, F.col("l_suppkey")).alias("file_id"),
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("arrival"),
        )
        .agg(F.max("l_partkey").alias("end_offset"))
    )
    out = checkpoint.file_generations(reads, ["file_id"], "arrival", "end_offset", span=20_000)
    return out.select("file_id", "arrival", "generation", "stale")

"""Queries over fan-out, lookups, manifests and listings."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.functions.json import Field, object_text, with_document
from feedloom.functions.numbering import shuffle_partitions, span_bucket
from feedloom.operators import accounting, decode, fanout, listing, paging
from feedloom.plans.catalog.base import events_feed, query, table
from feedloom.plans.catalog.pages import SEQ, _pages
from feedloom.plans.catalog.spans import _halved

# Rows that a task groups where nearly each is a group.
GROUPED_ROWS = 500_000


@query(
    "fan_out_keys",
    """SELECT c_custkey AS key, CAST(s AS INT) AS step_no,
         epoch_us(TIMESTAMP '2024-01-01') + s * 32400000000 AS step_start,
         least(epoch_us(TIMESTAMP '2024-01-02'), epoch_us(TIMESTAMP '2024-01-01') + (s + 1) * 32400000000) AS step_end
       FROM customer, (SELECT unnest([0, 1, 2]) AS s)""",
)
def fan_out_keys(spark, sf_dir):
    keys = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"))
    return fanout.fan_out(keys, "2024-01-01", "2024-01-02", 9 * 3600).select(
        "key",
        "step_no",
        F.unix_micros("step_start").alias("step_start"),
        F.unix_micros("step_end").alias("step_end"),
    )


@query(
    "fan_out_listed",
    """SELECT o_orderkey, CAST(unnest([o_orderkey * 10, o_orderkey * 10 + 1]) AS VARCHAR) AS key FROM orders""",
)
def fan_out_listed(spark, sf_dir):
    body = object_text(
        {"data": F.struct(F.array(F.col("o_orderkey") * 10, F.col("o_orderkey") * 10 + 1).alias("ids"))}
    )
    first = table(spark, sf_dir, "orders").select("o_orderkey", body.alias("body"))
    return fanout.keys_at(first, "body", "/data/ids").select("o_orderkey", "key")


@query(
    "lookup_batches",
    """WITH n AS (SELECT o_custkey, o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders),
       asked AS (SELECT DISTINCT i // 1000 AS batch_no, o_custkey FROM n)
       SELECT CAST(batch_no AS BIGINT) AS batch_no, c_custkey, c_name FROM asked JOIN customer ON c_custkey = o_custkey""",
)
def lookup_batches(spark, sf_dir):
    ids = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    entities = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return fanout.lookup(
        ids, entities, "c_custkey", ["o_orderkey"], 1000, bucket=span_bucket("o_orderkey", 100_000)
    )


@query(
    "lookup_per_key",
    """WITH n AS (SELECT o_orderpriority, o_custkey,
           row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1 AS i FROM orders),
       asked AS (SELECT DISTINCT o_orderpriority, i // 100 AS batch_no, o_custkey FROM n)
       SELECT o_orderpriority, CAST(batch_no AS BIGINT) AS batch_no, c_custkey, c_mktsegment
       FROM asked JOIN customer ON c_custkey = o_custkey""",
)
def lookup_per_key(spark, sf_dir):
    ids = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", F.col("o_custkey").alias("c_custkey")
    )
    entities = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return fanout.lookup(
        ids,
        entities,
        "c_custkey",
        ["o_orderkey"],
        100,
        by=["o_orderpriority"],
        bucket=span_bucket("o_orderkey", 2_000),
    )


@query(
    "manifest_join",
    """SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS rows, o_orderpriority AS item_priority, l_orderkey AS item_key,
              epoch_us(o_orderdate) AS item_position, l_linenumber AS line
       FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY ALL""",
)
def manifest_join(spark, sf_dir):
    items = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.unix_micros(F.col("o_orderdate").cast("timestamp")).alias("position"),
        "o_orderpriority",
    )
    contents = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", object_text({"line": F.col("l_linenumber")}).alias("payload")
    )
    rows = fanout.manifest(
        items, contents, "l_orderkey", {"item": F.col("o_orderpriority")}, "position"
    )
    parsed = with_document(rows, "payload")
    doc = F.col("_doc")
    lines = parsed.select(
        "l_orderkey",
        "l_linenumber",
        Field(doc, "item").text().alias("item_priority"),
        F.col("mark.item_key").alias("item_key"),
        F.col("mark.item_position").alias("item_position"),
        Field(doc, "line").number().cast("int").alias("line"),
    )
    # adaptive execution merges partitions by their packed bytes, and a task keeps a group for nearly every row
    parts = max(shuffle_partitions(lines), -(-contents.count() // GROUPED_ROWS))
    dealt = lines.repartition(parts, "l_orderkey", "l_linenumber")
    return dealt.groupBy(*lines.columns).agg(F.count(F.lit(1)).alias("rows"))


def _capped(spark, sf_dir, mode):
    items = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    return fanout.cap_items(items, ["o_custkey"], ["o_orderdate", "o_orderkey"], 10, mode)


@query(
    "manifest_cap",
    """SELECT o_custkey, o_orderkey FROM (SELECT o_custkey, o_orderkey,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r FROM orders) WHERE r <= 10""",
)
def manifest_cap(spark, sf_dir):
    return _capped(spark, sf_dir, "cut")[0].select("o_custkey", "o_orderkey")


@query(
    "manifest_skipped",
    """WITH r AS (SELECT o_custkey, o_orderkey,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r FROM orders)
       SELECT o_custkey, 'deferred' AS status, CAST(count(*) - 10 AS BIGINT) AS skipped,
         string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY r) FILTER (WHERE r > 10 AND r <= 15) AS first_skipped
       FROM r GROUP BY o_custkey HAVING count(*) > 10""",
)
def manifest_skipped(spark, sf_dir):
    report = _capped(spark, sf_dir, "defer")[1]
    return report.withColumn("first_skipped", F.array_join("first_skipped", ","))


@query(
    "manifest_fail",
    """SELECT o_custkey, o_orderkey FROM orders WHERE o_custkey IN (
         SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) <= 10)""",
)
def manifest_fail(spark, sf_dir):
    return _capped(spark, sf_dir, "fail")[0].select("o_custkey", "o_orderkey")


def _objects(spark, sf_dir):
    """Pages as stored objects: a few share each second."""
    return table(spark, sf_dir, "pages").select(
        F.concat(F.lit("in/a b*~/"), F.lpad(F.col("page_id").cast("string"), 9, "0"), F.lit("+.json")).alias(
            "key"
        ),
        F.timestamp_seconds(F.lit(1704067200) + F.floor(F.col("page_id") / 4)).alias("last_modified"),
        F.octet_length("html").cast("bigint").alias("size"),
    )


_OBJECTS = """objects AS (SELECT 'in/a b*~/' || lpad(CAST(page_id AS VARCHAR), 9, '0') || '+.json' AS key,
   'in/a%20b%2A~/' || lpad(CAST(page_id AS VARCHAR), 9, '0') || '%2B.json' AS path,
   1704067200 + page_id // 4 AS secs, CAST(strlen(html) AS BIGINT) AS size FROM pages)"""


@query(
    "list_objects",
    f"""WITH {_OBJECTS} SELECT key, path, CAST(secs AS BIGINT) AS changed, size FROM objects
       WHERE (secs > 1704067205 OR (secs = 1704067205 AND key > 'in/a b*~/000000021+.json'))
         AND (secs < 1704067250 OR (secs = 1704067250 AND key < 'in/a b*~/000000202+.json'))""",
)
def list_objects(spark, sf_dir):
    found = listing.list_objects(
        _objects(spark, sf_dir),
        cutoff=(F.timestamp_seconds(F.lit(1704067205)), "in/a b*~/000000021+.json"),
        horizon=(F.timestamp_seconds(F.lit(1704067250)), "in/a b*~/000000202+.json"),
    )
    return found.select("key", "path", F.unix_seconds("last_modified").alias("changed"), "size")


@query(
    "cut_with_ties",
    f"""WITH {_OBJECTS}, r AS (SELECT key, CAST(secs AS BIGINT) AS changed, rank() OVER (ORDER BY secs) AS r FROM objects)
       SELECT key, changed FROM r WHERE r <= 50""",
)
def cut_with_ties(spark, sf_dir):
    cut = listing.cut_with_ties(_objects(spark, sf_dir), 50, "last_modified", "key")
    return cut.select("key", F.unix_seconds("last_modified").alias("changed"))


@query(
    "cut_per_prefix",
    """SELECT o_orderpriority, o_orderkey FROM (SELECT o_orderpriority, o_orderkey,
         rank() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate) AS r FROM orders) WHERE r <= 25""",
)
def cut_per_prefix(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey", "o_orderdate")
    cut = listing.cut_with_ties(orders, 25, "o_orderdate", "o_orderkey", by=["o_orderpriority"])
    return cut.select("o_orderpriority", "o_orderkey")


@query(
    "upload_horizon",
    """SELECT CASE WHEN min(ts) < TIMESTAMP '2024-01-20' THEN epoch_us(min(ts)) ELSE epoch_us(TIMESTAMP '2024-01-20') END AS at,
              CASE WHEN min(ts) < TIMESTAMP '2024-01-20' THEN 'e' || arg_min(event_id, ts) END AS key
       FROM events WHERE event_type = 'signup'""",
)
def upload_horizon(spark, sf_dir):
    # Sign-ups stand for uploads that are still open.
    uploads = (
        table(spark, sf_dir, "events")
        .filter(F.col("event_type") == "signup")
        .select(F.col("ts").alias("initiated"), F.concat(F.lit("e"), F.col("event_id")).alias("key"))
    )
    return listing.upload_horizon(uploads, "2024-01-20").select(
        F.unix_micros("at").alias("at"), "key"
    )


@query(
    "listing_xml",
    """SELECT page_id, 'k&<' || page_id || '-' || p AS key, 1704067200 + page_id AS at, page_id * 10 + p AS size,
              CASE WHEN page_id % 2 = 0 THEN 'tok' || page_id END AS token
       FROM pages, (SELECT unnest([0, 1]) AS p)""",
)
def listing_xml(spark, sf_dir):
    key = F.col("page_id")

    def entry(n: int):
        return F.concat(
            F.lit("<Contents><Key>k&amp;&lt;"), key, F.lit(f"-{n}</Key><LastModified>"),
            F.date_format(F.timestamp_seconds(F.lit(1704067200) + key), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"),
            F.lit("</LastModified><ETag>x</ETag><Size>"), key * 10 + n, F.lit("</Size></Contents>"),
        )

    token = F.when(
        key % 2 == 0, F.concat(F.lit("<NextContinuationToken>tok"), key, F.lit("</NextContinuationToken>"))
    ).otherwise(F.lit(""))
    xml = F.concat(
        F.lit("<ListBucketResult><Name>b</Name>"), entry(0), entry(1), token, F.lit("</ListBucketResult>")
    )
    pages = table(spark, sf_dir, "pages").select("page_id", xml.alias("xml"))
    return listing.parse_listing(pages, "xml").select(
        "page_id", "key", F.unix_seconds("last_modified").alias("at"), "size", "token"
    )


@query(
    "list_files",
    """WITH c AS (SELECT '/in/' || o_custkey || '.jsonl' AS path, o_orderdate AS position, o_orderkey AS size FROM orders),
        l AS (SELECT path, max((epoch_us(position), size)) AS m FROM c GROUP BY path)
       SELECT path, m[1] AS position, m[2] AS size FROM l
       WHERE m[1] > epoch_us(TIMESTAMP '2000-06-01') OR (m[1] = epoch_us(TIMESTAMP '2000-06-01') AND path > '/in/500.jsonl')""",
)
def list_files(spark, sf_dir):
    # Orders stand for sightings of a file per customer, some changed in place.
    sightings = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("/in/"), F.col("o_custkey"), F.lit(".jsonl")).alias("path"),
        F.col("o_orderdate").alias("position"),
        F.col("o_orderkey").alias("size"),
    )
    listed = listing.order_listing(sightings, ("2000-06-01 00:00:00", "/in/500.jsonl"))
    return listed.select(
        "path", F.unix_micros(F.col("position").cast("timestamp")).alias("position"), "size"
    )


@query(
    "read_dump",
    """WITH f AS (SELECT doc_id, strlen(text) % 50 AS position, text FROM documents),
       bad AS (SELECT min((position, doc_id)) AS b FROM f WHERE position >= 40 AND doc_id % 5 = 0),
       w AS (SELECT doc_id, position, unnest(string_split(text, chr(10))) AS line FROM f, bad WHERE (position, doc_id) < b)
       SELECT doc_id, CAST(count(*) AS BIGINT) AS rows FROM w GROUP BY doc_id""",
)
def read_dump(spark, sf_dir):
    # Documents as files of JSON arrays, some cut off in the middle.
    lines = F.transform(F.split("text", "\n"), lambda s: F.struct(s.alias("line")))
    position = F.octet_length("text") % 50
    whole = F.to_json(lines)
    files = table(spark, sf_dir, "documents").select(
        "doc_id",
        position.alias("position"),
        F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("path"),
        F.when(
            (position >= 40) & (F.col("doc_id") % 5 == 0), whole.substr(F.lit(1), F.length(whole) - 1)
        )
        .otherwise(whole)
        .alias("body"),
    )
    rows = decode.explode_array(files, "body", strict=False)
    return listing.sound_prefix(rows).groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "pull_messages",
    """WITH m AS (SELECT event_id, event_id % 4 AS n FROM events),
       r AS (SELECT event_id, n, unnest(CASE WHEN n = 0 THEN [NULL] ELSE generate_series(0, n - 1) END) AS p FROM m)
       SELECT event_id, CASE WHEN n > 0 THEN event_id || '-' || p END AS payload,
              CASE WHEN n = 0 OR p = n - 1 THEN 'a' || event_id END AS ack_id FROM r""",
)
def pull_messages(spark, sf_dir):
    messages = events_feed(spark, sf_dir).select(
        "event_id", F.concat(F.lit("a"), F.col("event_id")).alias("ack_id")
    )
    count = (F.col("event_id") % 4).cast("int")
    rows = F.when(
        count > 0,
        F.transform(
            F.sequence(F.lit(0), count - 1), lambda p: F.concat_ws("-", F.col("event_id").cast("string"), p.cast("string"))
        ),
    )
    return fanout.pull_messages(messages, rows).select("event_id", "payload", "ack_id")


# --- counters ---------------------------------------------------------------------------


@query(
    "error_classes",
    """WITH c AS (SELECT event_type, CASE user_id % 14 WHEN 1 THEN '4xx' WHEN 2 THEN 'throttle' WHEN 3 THEN '5xx' WHEN 4 THEN '5xx'
             WHEN 5 THEN 'timeout' WHEN 6 THEN '4xx' WHEN 7 THEN 'network' WHEN 8 THEN 'page_ceiling' WHEN 9 THEN 'throttle'
             WHEN 10 THEN 'network' WHEN 11 THEN 'throttle' WHEN 12 THEN 'timeout' WHEN 13 THEN '5xx' END AS error_class FROM events)
       SELECT event_type, error_class, CAST(count(*) AS BIGINT) AS calls FROM c WHERE error_class IS NOT NULL GROUP BY ALL""",
)
def error_classes(spark, sf_dir):
    which = (F.col("user_id") % 14).cast("int")
    statuses = (200, 404, 429, 500, 504, 408, 401, None, None, 503, 302, 403, None, 503)
    calls = table(spark, sf_dir, "events").select(
        "event_type",
        F.get(F.array(*[F.lit(s).cast("int") for s in statuses]), which).alias("status"),
        F.when(which == 7, F.lit("connect")).when(which == 8, F.lit("page_ceiling")).alias("kind"),
        F.when(which == 9, F.lit("<Code>SlowDown</Code>"))
        .when(which == 12, F.lit("operation Timed Out after 30 s"))
        .when(which == 13, F.lit("timeout upstream"))
        .alias("text"),
        (which == 11).alias("throttled"),
    )
    return accounting.error_rollup(calls, ["event_type"], "status", "kind", "text", "throttled")


@query(
    "limit_counters",
    """WITH RECURSIVE p AS (SELECT o_custkey AS k, o_orderkey AS id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS n FROM orders),
       f AS (SELECT k, min(n) FILTER (WHERE id % 7 = 0) AS stop, max(n) AS last_n FROM p GROUP BY k),
       seconds AS (SELECT event_type, (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) // 1000000 AS s FROM events),
       spans(event_type, a, b, n, narrowed) AS (
        SELECT event_type, 0::BIGINT, 2592000::BIGINT, count(*), false FROM seconds GROUP BY event_type
        UNION ALL
        SELECT q.event_type, h.a, h.b,
          (SELECT count(*) FROM seconds s WHERE s.event_type = q.event_type AND s.s >= h.a AND s.s < h.b), true
        FROM spans q, LATERAL (SELECT q.a AS a, q.a + (q.b - q.a) // 2 AS b UNION ALL SELECT q.a + (q.b - q.a) // 2, q.b) h
        WHERE q.n > 150 AND q.b - q.a >= 2)
       SELECT 'pages_truncated' AS limit_name, CAST(count(*) FILTER (WHERE coalesce(stop, last_n) >= 4) AS BIGINT) AS n FROM f
       UNION ALL SELECT 'items_skipped', CAST(coalesce(sum(c - 10), 0) AS BIGINT) FROM (SELECT count(*) AS c FROM orders GROUP BY o_custkey HAVING count(*) > 10)
       UNION ALL SELECT 'windows_narrowed', count(*) FROM spans WHERE narrowed AND (n <= 150 OR b - a < 2)
       UNION ALL SELECT 'full_tail_pages', least(count(*), 7000) // 700 FROM orders WHERE o_orderkey > 500""",
)
def limit_counters(spark, sf_dir):
    from feedloom.operators.keyset import keyset_tail, tail_pages

    pages = paging.assemble_pages(
        _pages(spark, sf_dir), SEQ, paging.Pager("link_header"), 4, strict=False
    )
    tail = keyset_tail(
        table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], (500,), 700, 10
    )
    return accounting.limit_counters(
        sequences=paging.sequence_status(pages, SEQ),
        manifest=_capped(spark, sf_dir, "cut")[1],
        spans=_halved(spark, sf_dir, 150),
        tails=tail_pages(tail, 700),
    )


@query(
    "quota_latest",
    """SELECT o_custkey AS seq_key, CAST(arg_max(o_orderkey % 1000, o_orderkey) AS DOUBLE) AS remaining,
              CAST(NULL AS DOUBLE) AS absent FROM orders GROUP BY o_custkey""",
)
def quota_latest(spark, sf_dir):
    return accounting.quota_latest(
        _pages(spark, sf_dir),
        SEQ,
        {"remaining": "x-remaining", "absent": "x-limit"},
        ["page_id"],
    )


@query(
    "cap_null_listing",
    """WITH o AS (SELECT CASE WHEN o_custkey % 4 > 0 THEN o_custkey END AS listing, o_orderdate, o_orderkey FROM orders),
       r AS (SELECT *, row_number() OVER (PARTITION BY listing ORDER BY o_orderdate, o_orderkey) AS r, count(*) OVER (PARTITION BY listing) AS n FROM o)
       SELECT listing, o_orderkey, CAST(NULL AS BIGINT) AS skipped FROM r WHERE n <= 10
       UNION ALL SELECT DISTINCT listing, CAST(NULL AS BIGINT), n FROM r WHERE n > 10""",
)
def cap_null_listing(spark, sf_dir):
    """Items of a listing without a key fail with it, and are reported."""
    items = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_custkey") % 4 > 0, F.col("o_custkey")).alias("listing"), "o_orderdate", "o_orderkey"
    )
    kept, report = fanout.cap_items(items, ["listing"], ["o_orderdate", "o_orderkey"], 10, "fail")
    none = F.lit(None).cast("bigint")
    return kept.select("listing", "o_orderkey", none.alias("skipped")).unionByName(
        report.select("listing", none.alias("o_orderkey"), "skipped")
    )

"""Queries over snapshot framing and reassembly."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.functions.json import Field, object_text
from feedloom.functions.numbering import depth_bucket, even_bucket, number_rows, running_sum, span_bucket
from feedloom.operators import snapshot
from feedloom.plans.catalog.base import query, table

AT = "2024-02-01 00:00:00"
DONE = "2024-02-01 00:05:00"


@query(
    "snapshot_frames",
    """WITH kept AS (SELECT *, CAST(json_object('key', n_nationkey, 'name', n_name, 'alive', n_nationkey % 4 <> 0) AS VARCHAR) AS payload
                    FROM nation WHERE n_nationkey % 4 <> 0),
     id AS (SELECT md5('run-1|geo.nation') AS d, printf('%012x', epoch_ms(TIMESTAMP '2024-02-01')) AS t),
     frames AS (
       SELECT 'row' AS kind, row_number() OVER (ORDER BY n_nationkey) - 1 AS seq, payload AS record, NULL AS row_count, NULL AS completed_at FROM kept
       UNION ALL SELECT 'begin', 0, NULL, NULL, NULL
       UNION ALL SELECT 'end', (SELECT count(*) FROM kept), NULL, (SELECT count(*) FROM kept), '2024-02-01T00:05:00.000Z')
    SELECT kind, CAST(seq AS BIGINT) AS seq, record, CAST(row_count AS BIGINT) AS row_count, completed_at,
      '2024-02-01T00:00:00.000Z' AS snapshot_at, 'geo.nation' AS store,
      left(t, 8) || '-' || t[9:12] || '-7' || d[1:3] || '-' ||
        ('89ab')[1 + (instr('0123456789abcdef', d[19:19]) - 1) % 4] || d[4:6] || '-' || d[7:18] AS snapshot_id
    FROM frames, id""",
)
def snapshot_frames(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    rows = nation.withColumn(
        "payload",
        object_text(
            {
                "key": F.col("n_nationkey"),
                "name": F.col("n_name"),
                "alive": F.col("n_nationkey") % 4 != 0,
            }
        ),
    )
    frames = snapshot.frame_snapshot(
        rows,
        "geo.nation",
        AT,
        DONE,
        "run-1",
        ["n_nationkey"],
        keep=lambda doc: Field(doc, "record.alive").boolean(),
        bucket=span_bucket("n_nationkey", 10),
    )
    return frames.select(
        "kind", "seq", "record", "row_count", "completed_at", "snapshot_at", "store", "snapshot_id"
    )


def _customers(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    return customer.select(
        "c_custkey",
        F.col("c_nationkey").alias("item_key"),
        object_text({"key": F.col("c_custkey"), "name": F.col("c_name")}).alias("payload"),
    )


def _customer_frames(spark, sf_dir, span=100_000):
    return snapshot.frame_snapshot(
        _customers(spark, sf_dir),
        "crm.customer",
        AT,
        DONE,
        "run-1",
        ["c_custkey"],
        item="item_key",
        bucket=span_bucket("c_custkey", span),
    )


@query(
    "snapshot_overfull",
    """SELECT CAST(c_nationkey AS VARCHAR) AS snapshot_id,
         CASE WHEN c_nationkey % 4 = 0 THEN 'complete' ELSE 'truncated' END AS status,
         CAST(count(*) + CASE c_nationkey % 4 WHEN 1 THEN -1 WHEN 2 THEN 1 WHEN 3 THEN -count(*) ELSE 0 END AS BIGINT) AS expected,
         CAST(count(*) AS BIGINT) AS seen FROM customer GROUP BY c_nationkey""",
)
def snapshot_overfull(spark, sf_dir):
    """Snapshots with the rows announced, one more, one less, and none announced."""
    customer = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"), "c_custkey")
    numbered = number_rows(customer, ["c_custkey"], ["nation"], span_bucket("c_custkey", 97), out="seq")
    rows = numbered.select("nation", F.lit("row").alias("kind"), "seq", F.lit(None).cast("bigint").alias("row_count"))
    wrong = F.col("nation") % 4
    said = (
        F.when(wrong == 1, F.col("n") - 1).when(wrong == 2, F.col("n") + 1).when(wrong == 3, F.lit(0)).otherwise(F.col("n"))
    )
    ends = customer.groupBy("nation").agg(F.count("*").alias("n")).select(
        "nation", F.lit("end").alias("kind"), said.alias("seq"), said.alias("row_count")
    )
    frames = rows.union(ends).withColumn("snapshot_id", F.col("nation").cast("string"))
    return snapshot.snapshot_status(frames)


@query(
    "number_null_keys",
    """SELECT c_custkey, CASE WHEN c_nationkey % 3 > 0 THEN c_nationkey END AS nation,
         row_number() OVER (PARTITION BY CASE WHEN c_nationkey % 3 > 0 THEN c_nationkey END ORDER BY c_custkey) - 1 AS seq,
         coalesce(sum(c_nationkey) OVER (PARTITION BY CASE WHEN c_nationkey % 3 > 0 THEN c_nationkey END ORDER BY c_custkey
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM customer""",
)
def number_null_keys(spark, sf_dir):
    """A third of the rows has no group: they are numbered and summed as one group."""
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_nationkey") % 3 > 0, F.col("c_nationkey")).alias("nation"),
        F.col("c_nationkey").cast("bigint").alias("amount"),
    )
    span = span_bucket("c_custkey", 50)
    numbered = number_rows(rows, ["c_custkey"], ["nation"], span, out="seq")
    return running_sum(numbered, "amount", ["c_custkey"], ["nation"], span, "before").select(
        "c_custkey", "nation", F.col("seq").cast("bigint").alias("seq"), F.col("before").cast("bigint").alias("before")
    )


@query(
    "number_sparse",
    """SELECT l_orderkey, l_linenumber, row_number() OVER (ORDER BY l_orderkey, l_linenumber) - 1 AS seq,
         (SELECT least((count(*) + 999) // 1000, 1000000) FROM lineitem) >= 1 AS bounded FROM lineitem""",
)
def number_sparse(spark, sf_dir):
    """One sequence over ids with gaps of a billion: the buckets are as many as the rows by a thousand."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    sparse = lines.withColumn("at", F.col("l_orderkey").cast("bigint") * 1_000_000_000)
    bucket = even_bucket(sparse, "at", 1000)
    numbered = number_rows(sparse, ["at", "l_linenumber"], (), bucket, out="seq")
    most = sparse.select((F.max(bucket) * 1000 <= F.count("*")).alias("bounded"))
    return numbered.select(
        "l_orderkey", "l_linenumber", F.col("seq").cast("bigint").alias("seq"), most.scalar().alias("bounded")
    )


@query(
    "snapshot_per_item",
    """WITH numbered AS (SELECT c_nationkey AS item_key, c_custkey,
             row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS seq,
             CAST(json_object('key', c_custkey, 'name', c_name) AS VARCHAR) AS record FROM customer)
       SELECT item_key, 'row' AS kind, CAST(seq AS BIGINT) AS seq, record, CAST(NULL AS BIGINT) AS row_count FROM numbered
       UNION ALL SELECT item_key, 'begin', 0, NULL, NULL FROM numbered GROUP BY item_key
       UNION ALL SELECT item_key, 'end', count(*), NULL, count(*) FROM numbered GROUP BY item_key""",
)
def snapshot_per_item(spark, sf_dir):
    # A short span, so that the numbering across buckets is exercised on small tables too.
    return _customer_frames(spark, sf_dir, span=97).select(
        "item_key", "kind", "seq", "record", "row_count"
    )


@query(
    "oversize_stub",
    """WITH sized AS (SELECT doc_id, CAST(json_object('id', doc_id, 'text', text) AS VARCHAR) AS payload FROM documents),
      numbered AS (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS seq, strlen(payload) AS size FROM sized)
      SELECT CASE WHEN size > 4096 THEN 'oversize' ELSE 'row' END AS kind, CAST(seq AS BIGINT) AS seq,
        CASE WHEN size > 4096 THEN CAST(size AS BIGINT) END AS bytes,
        CASE WHEN size > 4096 THEN CAST(doc_id AS VARCHAR) END AS row_key,
        CASE WHEN size <= 4096 THEN md5(payload) END AS record_md5
      FROM numbered""",
)
def oversize_stub(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", object_text({"id": F.col("doc_id"), "text": F.col("text")}).alias("payload")
    )
    frames = snapshot.frame_snapshot(
        documents,
        "kb.documents",
        AT,
        DONE,
        "run-1",
        ["doc_id"],
        row_key="/id",
        max_bytes=4096,
        bucket=span_bucket("doc_id", 100_000),
    )
    return frames.filter(F.col("kind").isin("row", "oversize")).select(
        "kind", "seq", "bytes", "row_key", F.md5("record").alias("record_md5")
    )


def _delivered(spark, sf_dir):
    """Customer frames as a topic holds them: some lost, some twice, newer copies later.

    Nation 3 lost rows, nation 5 its end, nation 7 its first row.
    """
    frames = _customer_frames(spark, sf_dir).withColumn("snapshot_id", F.col("item_key").cast("string"))
    numbered = F.col("kind") == "row"
    lost = (
        ((F.col("item_key") == 3) & numbered & (F.col("seq") % 5 == 2))
        | ((F.col("item_key") == 5) & (F.col("kind") == "end"))
        | ((F.col("item_key") == 7) & numbered & (F.col("seq") == 0))
    )
    first = frames.filter(~F.coalesce(lost, F.lit(False))).withColumn("arrival", F.lit(1))
    again = first.filter(numbered & (F.col("seq") % 3 == 0)).withColumn("arrival", F.lit(2))
    again = again.withColumn("record", F.concat(F.lit("["), "record", F.lit("]")))
    return first.unionByName(again)


_DELIVERED = """numbered AS (SELECT c_nationkey AS item_key, c_custkey,
             row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS seq,
             CAST(json_object('key', c_custkey, 'name', c_name) AS VARCHAR) AS record FROM customer),
     arrived AS (SELECT * FROM numbered WHERE NOT (item_key = 3 AND seq % 5 = 2) AND NOT (item_key = 7 AND seq = 0)),
     totals AS (SELECT item_key, count(*) AS n FROM numbered GROUP BY item_key)"""


@query(
    "snapshot_status",
    f"""WITH {_DELIVERED}, seen AS (SELECT item_key, count(*) AS seen FROM arrived GROUP BY item_key)
      SELECT CAST(i AS VARCHAR) AS snapshot_id,
        CASE WHEN n IS NULL THEN 'unknown' WHEN i = 5 THEN 'open'
             WHEN seen = n THEN 'complete' ELSE 'truncated' END AS status,
        CASE WHEN i <> 5 THEN CAST(n AS BIGINT) END AS expected, CAST(seen AS BIGINT) AS seen
      FROM (SELECT n_nationkey AS i FROM nation UNION ALL SELECT r_regionkey + 100 FROM region)
      LEFT JOIN totals ON totals.item_key = i LEFT JOIN seen ON seen.item_key = i""",
)
def snapshot_status(spark, sf_dir):
    asked = (
        table(spark, sf_dir, "nation")
        .select(F.col("n_nationkey").cast("string").alias("snapshot_id"))
        .unionByName(
            table(spark, sf_dir, "region").select(
                (F.col("r_regionkey") + 100).cast("string").alias("snapshot_id")
            )
        )
    )
    return snapshot.snapshot_status(_delivered(spark, sf_dir), asked)


@query(
    "snapshot_rebuild",
    f"""WITH {_DELIVERED}
      SELECT CAST(item_key AS VARCHAR) AS snapshot_id, CAST(seq AS BIGINT) AS seq,
        CASE WHEN seq % 3 = 0 THEN '[' || record || ']' ELSE record END AS record
      FROM numbered JOIN totals USING (item_key)
      WHERE item_key <> 5 AND NOT (item_key = 3 AND n > 2) AND item_key <> 7""",
)
def snapshot_rebuild(spark, sf_dir):
    return snapshot.rebuild(_delivered(spark, sf_dir))


@query(
    "snapshot_missing",
    f"""WITH {_DELIVERED}
      SELECT CAST(item_key AS VARCHAR) AS snapshot_id, CAST(seq AS BIGINT) AS seq FROM numbered
      WHERE (item_key = 3 AND seq % 5 = 2) OR (item_key = 7 AND seq = 0)""",
)
def snapshot_missing(spark, sf_dir):
    return snapshot.missing_seqs(_delivered(spark, sf_dir), span=7)


@query(
    "oversize_keys",
    """WITH sized AS (SELECT doc_id, lang, CAST(json_object('id', doc_id, 'text', text) AS VARCHAR) AS payload FROM documents),
      numbered AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS seq FROM sized)
      SELECT lang AS snapshot_id, CAST(seq AS BIGINT) AS seq, CAST(doc_id AS VARCHAR) AS row_key,
             CAST(strlen(payload) AS BIGINT) AS bytes
      FROM numbered WHERE strlen(payload) > 2048""",
)
def oversize_keys(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", object_text({"id": F.col("doc_id"), "text": F.col("text")}).alias("payload")
    )
    frames = snapshot.frame_snapshot(
        documents,
        "kb.documents",
        AT,
        DONE,
        "run-1",
        ["doc_id"],
        item="lang",
        row_key="/id",
        max_bytes=2048,
        bucket=span_bucket("doc_id", 100_000),
    )
    return snapshot.oversize_keys(frames.withColumn("snapshot_id", F.col("lang")))


@query(
    "routed_dumps",
    """WITH numbered AS (SELECT c_nationkey AS item_key, c_custkey % 2 = 1 AND c_nationkey % 6 = 0 AS moved FROM customer),
      per AS (SELECT item_key, CASE WHEN moved THEN 'vip' ELSE 'crm' END AS topic, count(*) AS rows FROM numbered GROUP BY ALL),
      homes AS (SELECT DISTINCT item_key, 'crm' AS topic FROM numbered),
      full_set AS (SELECT item_key, topic, coalesce(rows, 0) AS rows FROM per FULL JOIN homes USING (item_key, topic))
      SELECT CAST(item_key AS VARCHAR) AS snapshot_id, topic,
        CAST(topic = 'crm' AS BIGINT) AS begins, CAST(topic = 'crm' AS BIGINT) AS ends, CAST(rows AS BIGINT) AS rows,
        topic <> 'crm' OR count(*) OVER (PARTITION BY item_key) > 1 AS hazard
      FROM full_set""",
)
def routed_dumps(spark, sf_dir):
    # Odd customers of every sixth nation are routed away from the dump's own topic.
    frames = _customer_frames(spark, sf_dir).withColumn(
        "snapshot_id", F.col("item_key").cast("string")
    )
    key = F.try_variant_get(F.try_parse_json("record"), "$.key", "bigint")
    moved = (F.col("kind") == "row") & (F.col("item_key") % 6 == 0) & (key % 2 == 1)
    placed = frames.withColumn(
        "topic", F.when(F.coalesce(moved, F.lit(False)), F.lit("vip")).otherwise(F.lit("crm"))
    )
    return snapshot.routed_dumps(placed)


@query(
    "number_clustered",
    """WITH p AS (SELECT event_type, event_id, CASE WHEN event_id % 2 = 0 THEN 1700000000000000 + event_id
         ELSE event_id * 3600000000 END AS place FROM events)
       SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY place, event_id) - 1 AS seq, true AS even FROM p""",
)
def number_clustered(spark, sf_dir):
    """One sequence a type over times of which half lie within a second: no bucket has twice its share."""
    key = F.col("event_id")
    at = F.when(key % 2 == 0, F.lit(1_700_000_000_000_000) + key).otherwise(key * 3_600_000_000)
    events = table(spark, sf_dir, "events").select("event_type", "event_id", at.alias("at"))
    bucket = depth_bucket(events, "at", 100)
    numbered = number_rows(events, ["at", "event_id"], ["event_type"], bucket, out="seq")
    sizes = events.groupBy(bucket.alias("b")).count()
    even = sizes.select((F.max("count") < 2 * F.avg("count")).alias("even"))
    return numbered.select("event_type", "event_id", F.col("seq").cast("bigint").alias("seq"), even.scalar().alias("even"))

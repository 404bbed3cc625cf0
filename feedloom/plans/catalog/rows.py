"""Queries over the row rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.functions.json import Field, with_document
from feedloom.operators import accounting, rules
from feedloom.operators.unwrap import unwrap_nested as unwrap_nested_rows
from feedloom.plans.catalog.base import EVENTS_FEED, events_feed, query, table
from feedloom.plans.feed import FeedSpec, land

ROUTES = (
    rules.RouteRule("type", "error", ("alerts",)),
    rules.RouteRule("type", "purchase", ("billing", "archive")),
    rules.RouteRule("user", "7", ("vip",)),
)


@query(
    "feed_summary",
    f"""WITH {EVENTS_FEED},
    windowed AS (SELECT * FROM feed WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-25'),
    judged AS (SELECT *, value >= 10 AND event_type <> 'view' AS ok FROM windowed),
    routed AS (SELECT *, CASE WHEN event_type = 'error' THEN ['alerts']
                              WHEN event_type = 'purchase' THEN ['billing', 'archive']
                              WHEN user_id = 7 THEN ['vip']
                              ELSE ['lake'] END AS dests FROM judged),
    out AS (SELECT *, unnest(dests) AS destination FROM routed)
    SELECT destination, CASE WHEN len(dests) = 1 AND dests <> ['lake'] THEN dests[1] ELSE 'events' END AS source,
           'org-' || (user_id % 3) AS org_id,
           CAST(count(*) FILTER (WHERE ok) AS BIGINT) AS rows,
           CAST(coalesce(sum(strlen(payload)) FILTER (WHERE ok), 0) AS BIGINT) AS bytes,
           CAST(count(*) FILTER (WHERE NOT ok) AS BIGINT) AS filtered
    FROM out GROUP BY ALL""",
)
def feed_summary(spark, sf_dir):
    spec = FeedSpec(
        connection="shop",
        unit="events",
        base_topic="events",
        window=("2024-01-05", "2024-01-25"),
        keep=lambda doc: (Field(doc, "value").number() >= 10)
        & (Field(doc, "type").text() != "view"),
        routes=ROUTES,
        defaults=("lake",),
    )
    feed = events_feed(spark, sf_dir).withColumn(
        "org_id", F.concat(F.lit("org-"), F.col("user_id") % 3)
    )
    landed = land(feed, spec, ts="ts", org="org_id", now_ms=1706745600000)
    return accounting.tick_report(
        landed, ["destination", "source", "org_id"], "kept", "ingested_bytes"
    )


@query(
    "keep_filter",
    f"""WITH {EVENTS_FEED},
    mixed AS (SELECT event_id, CASE WHEN event_id % 10 = 0 THEN '[' || payload || ']'
                          WHEN event_id % 10 = 1 THEN replace(payload, '"value":', '"value_text":')
                          WHEN event_id % 10 = 2 THEN replace(payload, '"value":', '"value":"75","was":')
                          ELSE payload END AS payload, value, event_type FROM feed)
    SELECT event_id FROM mixed
    WHERE event_id % 10 = 0
       OR (event_id % 10 NOT IN (1, 2) AND value > 50 AND event_type <> 'view')
       OR (event_id % 10 IN (1, 2) AND event_type = 'error')""",
)
def keep_filter(spark, sf_dir):
    # Non-objects pass; a missing or wrongly typed `value` cannot satisfy its test.
    last = F.col("event_id") % 10
    mixed = events_feed(spark, sf_dir).withColumn(
        "payload",
        F.when(last == 0, F.concat(F.lit("["), "payload", F.lit("]")))
        .when(last == 1, F.replace("payload", F.lit('"value":'), F.lit('"value_text":')))
        .when(last == 2, F.replace("payload", F.lit('"value":'), F.lit('"value":"75","was":')))
        .otherwise(F.col("payload")),
    )
    parsed = with_document(mixed, "payload")
    doc = F.col("_doc")
    value, kind = Field(doc, "value").number(), Field(doc, "type").text()
    condition = ((value > 50) & (kind != "view")) | (value.isNull() & (kind == "error"))
    return rules.keep(parsed, condition).select("event_id")


@query(
    "route_first_match",
    """SELECT event_id,
      CASE WHEN event_type = 'error' THEN 0 WHEN event_type = 'purchase' THEN 1
           WHEN user_id = 7 THEN 2 END AS route_index,
      CASE WHEN event_type = 'error' THEN 'alerts' WHEN event_type = 'purchase' THEN 'billing,archive'
           WHEN user_id = 7 THEN 'vip' END AS destinations,
      CASE WHEN event_type = 'error' THEN 'alerts' WHEN event_type = 'purchase' THEN 'events'
           WHEN user_id = 7 THEN 'vip' ELSE 'events' END AS source
    FROM events""",
)
def route_first_match(spark, sf_dir):
    routed = rules.route(events_feed(spark, sf_dir), ROUTES, source="events")
    return routed.select(
        "event_id", "route_index", F.concat_ws(",", "destinations").alias("_d"), "source"
    ).select(
        "event_id",
        "route_index",
        F.when(F.col("_d") != "", F.col("_d")).alias("destinations"),
        "source",
    )


@query(
    "fan_out_rows",
    """WITH routed AS (SELECT event_id, CASE WHEN event_type = 'error' THEN ['alerts']
                              WHEN event_type = 'purchase' THEN ['billing', 'archive']
                              WHEN user_id = 7 THEN ['vip']
                              ELSE ['lake', 'audit'] END AS dests FROM events),
      out AS (SELECT event_id, unnest(dests) AS destination FROM routed)
    SELECT event_id, destination,
      CASE WHEN destination = 'alerts' THEN 'ops-alerts' ELSE 'events' END || '_land' AS out_topic
    FROM out""",
)
def fan_out_rows(spark, sf_dir):
    routed = rules.route(events_feed(spark, sf_dir), ROUTES, source="events")
    out = rules.fan_out_rows(
        routed.withColumn("topic", F.lit("events")), ("lake", "audit"), {"alerts": "ops-alerts"}
    )
    return out.select("event_id", "destination", "out_topic")


@query(
    "topic_names",
    """SELECT n_nationkey,
      CASE WHEN n_nationkey % 2 = 0 THEN 'geo-' || lower(n_name) ELSE 'geo' END || '_land' AS topic,
      'geo_land' AS shared_topic,
      CASE WHEN n_nationkey % 2 = 0 THEN 'geo-' || lower(n_name) ELSE 'geo' END AS source
    FROM nation""",
)
def topic_names(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").withColumn("dump", F.col("n_nationkey") % 2 == 0)
    unit = F.lower("n_name")
    named = nation.select(
        "n_nationkey",
        rules.unit_topic("geo", unit, F.col("dump")).alias("topic"),
        rules.unit_topic("geo", unit, F.col("dump"), per_dump_unit=False).alias("shared_topic"),
    )
    return named.withColumn("source", rules.topic_source(F.col("topic")))


@query(
    "add_fields_park",
    """SELECT event_id, event_type AS type_original,
        CASE WHEN event_id % 4 = 0 THEN 'kept' END AS type_original_kept,
        CASE WHEN event_id % 4 = 0 THEN event_type END AS type_original_2,
        'fixed' AS type, 'u' || user_id AS owner, user_id AS user_value
       FROM (SELECT event_id, event_type, user_id FROM events)""",
)
def add_fields_park(spark, sf_dir):
    # Every fourth record already owns `type_original`, so the next free name is used.
    feed = events_feed(spark, sf_dir).withColumn(
        "payload",
        F.when(
            F.col("event_id") % 4 == 0,
            F.replace("payload", F.lit('"type":'), F.lit('"type_original":"kept","type":')),
        ).otherwise(F.col("payload")),
    )
    added = rules.add_fields(
        feed, {"type": "fixed", "owner": F.concat(F.lit("u"), F.col("user_id"))}
    )
    parsed = with_document(added, "payload")
    doc = F.col("_doc")
    first = Field(doc, "type_original").text()
    second = Field(doc, "type_original_2").text()
    return parsed.select(
        "event_id",
        F.coalesce(second, first).alias("type_original"),
        F.when(second.isNotNull(), first).alias("type_original_kept"),
        second.alias("type_original_2"),
        Field(doc, "type").text().alias("type"),
        Field(doc, "owner").text().alias("owner"),
        Field(doc, "user").number().cast("bigint").alias("user_value"),
    )


@query(
    "stamp_metadata",
    f"""WITH {EVENTS_FEED}
    SELECT event_id, 'Stamped' AS tenancy,
      left(payload, length(payload) - 1)
      || ',"_timestamp_fetcher":1706745600000,"_timestamp_received":1706745600500,"_source":"events","_source_fetcher":"shop.events","_org_id":"org-' || (user_id % 3) || '"}}' AS payload
    FROM feed""",
)
def stamp_metadata(spark, sf_dir):
    stamped = rules.stamp(
        events_feed(spark, sf_dir),
        source="events",
        source_fetcher="shop.events",
        org=F.concat(F.lit("org-"), F.col("user_id") % 3),
        fetched_ms=1706745600000,
        received_ms=1706745600500,
    )
    return stamped.select("event_id", "tenancy", "payload")


@query(
    "stamp_collision",
    """SELECT event_id, 'feed' AS source_value, event_type AS parked, user_id AS user_value FROM events""",
)
def stamp_collision(spark, sf_dir):
    # The record arrives with its own `_source`; stamping parks it.
    feed = events_feed(spark, sf_dir).withColumn(
        "payload", F.replace("payload", F.lit('"type":'), F.lit('"_source":'))
    )
    stamped = rules.stamp(feed, "feed", "shop.events", "org", 1706745600000, 1706745600000)
    parsed = with_document(stamped, "payload")
    doc = F.col("_doc")
    return parsed.select(
        "event_id",
        Field(doc, "_source").text().alias("source_value"),
        Field(doc, "_source_original").text().alias("parked"),
        Field(doc, "user").number().cast("bigint").alias("user_value"),
    )


def _bodies(spark, sf_dir):
    """Events in the body shapes tenancy tells apart."""
    shape = F.col("event_id") % 6
    return events_feed(spark, sf_dir).withColumn(
        "payload",
        F.when(shape == 0, F.concat(F.lit("["), "payload", F.lit(",1]")))
        .when(shape == 1, F.col("event_type"))
        .when(shape == 2, F.concat("payload", F.lit(" trailing")))
        .when(shape == 3, F.concat(F.lit(rules.BOM), "payload"))
        .when(shape == 4, F.lit("{"))
        .otherwise(F.col("payload")),
    )


@query(
    "tenancy",
    """SELECT event_id, CASE WHEN event_id % 6 IN (0, 1) THEN 'Unstamped'
                             WHEN event_id % 6 IN (2, 4) THEN 'Refused'
                             ELSE 'Stamped' END AS tenancy FROM events""",
)
def tenancy(spark, sf_dir):
    return _bodies(spark, sf_dir).select("event_id", rules.tenancy(F.col("payload")).alias("tenancy"))


@query(
    "binary_passthrough",
    f"""WITH {EVENTS_FEED}
    SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'binary' ELSE 'json' END AS content,
           event_id % 5 <> 0 AS stamped,
           CASE WHEN event_id % 5 = 0 THEN md5(payload) END AS digest
    FROM feed WHERE event_id % 5 = 0 OR event_type <> 'view'""",
)
def binary_passthrough(spark, sf_dir):
    feed = events_feed(spark, sf_dir).withColumn(
        "content", F.when(F.col("event_id") % 5 == 0, F.lit("binary")).otherwise(F.lit("json"))
    )
    text, binary = rules.apart_binary(feed)
    ruled = rules.keep(
        with_document(text, "payload"), Field(F.col("_doc"), "type").text() != "view"
    ).drop("_doc")
    ruled = rules.stamp(ruled, "events", "shop.events", "org", 1, 1)
    out = ruled.select(
        "event_id",
        "content",
        F.col("payload").contains('"_org_id":"org"').alias("stamped"),
        F.lit(None).cast("string").alias("digest"),
    )
    raw = binary.select(
        "event_id",
        "content",
        F.col("payload").contains('"_org_id":"org"').alias("stamped"),
        F.md5("payload").alias("digest"),
    )
    return out.unionByName(raw)


_LINES = """lines AS (SELECT conv_id, turn, string_split(text, chr(10)) AS parts FROM conversations),
       flat AS (SELECT conv_id, turn, len(parts) AS n, unnest(parts) AS line,
                       generate_subscripts(parts, 1) - 1 AS part FROM lines)"""


def _line_records(spark, sf_dir):
    """The lines of each turn as JSON records, in one array per turn."""
    turns = table(spark, sf_dir, "conversations")
    return turns.select(
        "conv_id",
        "turn",
        F.transform(
            F.split("text", "\n"),
            lambda s, i: F.struct(i.alias("no"), F.md5(s).alias("digest"), s.alias("line")),
        ).alias("records"),
    )


@query(
    "split_array_body",
    f"""WITH {_LINES} SELECT conv_id, turn, CAST(part AS INT) AS part, CAST(part AS BIGINT) AS no,
              md5(line) AS digest, part = n - 1 AS is_last FROM flat""",
)
def split_array_body(spark, sf_dir):
    bodies = _line_records(spark, sf_dir).withColumn("payload", F.to_json("records"))
    parsed = with_document(rules.split_body(bodies), "payload")
    doc = F.col("_doc")
    return parsed.select(
        "conv_id",
        "turn",
        "part",
        Field(doc, "no").number().cast("bigint").alias("no"),
        F.md5(Field(doc, "line").text()).alias("digest"),
        "is_last",
    )


@query(
    "split_ndjson_body",
    f"""WITH {_LINES} SELECT conv_id, turn, CAST(part AS INT) AS part, CAST(part AS BIGINT) AS no, part = n - 1 AS is_last,
              CAST(strlen(json_object('no', part, 'digest', md5(line))) AS BIGINT) AS ingested_bytes FROM flat""",
)
def split_ndjson_body(spark, sf_dir):
    short = F.transform("records", lambda r: F.to_json(r.dropFields("line")))
    bodies = _line_records(spark, sf_dir).withColumn("payload", F.concat_ws("\n", short))
    parsed = with_document(rules.split_body(bodies), "payload")
    doc = F.col("_doc")
    return parsed.select(
        "conv_id",
        "turn",
        "part",
        Field(doc, "no").number().cast("bigint").alias("no"),
        "is_last",
        "ingested_bytes",
    )


@query(
    "split_pretty_body",
    f"""WITH {EVENTS_FEED}, copies AS (SELECT unnest([0, 1]) AS part)
    SELECT event_id, CAST(part AS INT) AS part, event_type AS type, part = 1 AS is_last FROM feed, copies""",
)
def split_pretty_body(spark, sf_dir):
    # Objects over several lines, one after the other.
    pretty = F.regexp_replace("payload", r',"', ',\n  "')
    bodies = events_feed(spark, sf_dir).withColumn(
        "payload", F.concat(pretty, F.lit("\n"), pretty)
    )
    parsed = with_document(rules.split_body(bodies), "payload")
    return parsed.select(
        "event_id", "part", Field(F.col("_doc"), "type").text().alias("type"), "is_last"
    )


# Texts that Python's parser takes, or ends on, and that are not JSON or no deeper record.
_HOSTILE = (
    '{"a":"[NaN]"}',
    '{"a":"{\\"b\\":1e400}"}',
    '{"a":"[\\"\\\\ud800\\"]"}',
    '{"a":"[-Infinity]"}',
    '{"a":"%s"}' % ("[" * 20_000 + "]" * 20_000),
    '{"a":NaN,"b":"[1]"}',
)


@query(
    "unwrap_hostile",
    """SELECT doc_id, doc_id % 7 = 6 AS changed, CASE WHEN doc_id % 7 = 6 THEN md5(text) END AS digest FROM documents""",
)
def unwrap_hostile(spark, sf_dir):
    """Six rows of seven hold what must stay as it is; the seventh holds its text in text."""
    which = (F.col("doc_id") % 7).cast("int")
    inner = F.to_json(F.struct(F.col("text").alias("t")))
    record = F.when(which == 6, F.to_json(F.struct(inner.alias("a")))).otherwise(
        F.get(F.array(*[F.lit(t) for t in _HOSTILE]), which)
    )
    bodies = table(spark, sf_dir, "documents").select("doc_id", record.alias("before"))
    out = with_document(unwrap_nested_rows(bodies.withColumn("payload", F.col("before"))), "payload")
    text = Field(F.col("_doc"), "a.t").text()
    return out.select("doc_id", (F.col("payload") != F.col("before")).alias("changed"), F.md5(text).alias("digest"))


@query(
    "split_hostile",
    """SELECT doc_id, CAST(p AS INT) AS part, doc_id % 4 = 3 AS whole FROM documents, (SELECT unnest([0, 1]) AS p)
       WHERE p = 0 OR doc_id % 4 = 3""",
)
def split_hostile(spark, sf_dir):
    """Two objects over several lines, of which one is no JSON or too deep on three bodies of four."""
    which = (F.col("doc_id") % 4).cast("int")
    bad = F.array(F.lit("NaN"), F.lit("1e400"), F.lit('{"b":' * 5_000 + "1" + "}" * 5_000), F.lit("2"))
    text = F.to_json(F.struct(F.col("text").alias("t")))
    body = F.concat(F.lit('{"n":\n1}\n{"v":\n'), F.get(bad, which), F.lit("}"))
    bodies = table(spark, sf_dir, "documents").select(
        "doc_id", F.when(which == 3, F.concat(F.regexp_replace(text, "^.", "{\n"), F.lit("\n"), text)).otherwise(body).alias("payload")
    )
    parts = rules.split_body(bodies)
    return parts.select("doc_id", "part", (which == 3).alias("whole"))


@query(
    "unwrap_nested",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_type AS inner_type, '{not json' AS note,
              user_id % 2 = 0 AS changed FROM events""",
)
def unwrap_nested(spark, sf_dir):
    # Even users carry their props as text, with one more level of text inside.
    events = table(spark, sf_dir, "events")
    inner = F.to_json(F.struct(F.to_json(F.struct("event_type")).alias("deep")))
    plain = F.from_json("props", "k bigint")
    record = F.when(
        F.col("user_id") % 2 == 0,
        F.to_json(F.struct(F.col("props"), inner.alias("body"), F.lit("{not json").alias("note"))),
    ).otherwise(
        F.to_json(
            F.struct(
                plain.alias("props"),
                F.struct(F.struct("event_type").alias("deep")).alias("body"),
                F.lit("{not json").alias("note"),
            )
        )
    )
    bodies = events.select("event_id", record.alias("before"))
    out = with_document(unwrap_nested_rows(bodies.withColumn("payload", F.col("before"))), "payload")
    doc = F.col("_doc")
    return out.select(
        "event_id",
        Field(doc, "props.k").number().cast("bigint").alias("k"),
        Field(doc, "body.deep.event_type").text().alias("inner_type"),
        Field(doc, "note").text().alias("note"),
        (F.col("payload") != F.col("before")).alias("changed"),
    )


# --- whole feeds ------------------------------------------------------------------------


@query(
    "feed_incremental",
    """WITH b AS (SELECT doc_id, text, lang, CASE doc_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 1 END AS parts,
           strlen(CAST(json_object('id', doc_id, 'lang', lang, 'text', text) AS VARCHAR)) AS size FROM documents),
       o AS (SELECT *, size * parts + parts - 1 > 4096 AS over FROM b),
       p AS (SELECT doc_id, lang, over, unnest(range(parts)) AS part FROM o)
       SELECT CASE WHEN over THEN 'dead' WHEN lang = 'fr' AND parts = 1 THEN 'filtered' ELSE 'sent' END AS outcome,
         CASE WHEN over THEN NULL WHEN parts = 2 THEN 'lake' WHEN lang = 'de' THEN 'german' ELSE 'lake' END AS destination,
         CAST(count(*) AS BIGINT) AS rows, CAST(sum(doc_id) AS BIGINT) AS ids
       FROM (SELECT doc_id, lang, over, parts, unnest(range(CASE WHEN over THEN 1 ELSE parts END)) FROM o) GROUP BY ALL""",
)
def feed_incremental(spark, sf_dir):
    """Documents as bodies of one object, two lines, or an object with a nested one in text; large ones are dead letters."""
    from feedloom.plans.feed import land_feed

    docs = table(spark, sf_dir, "documents")
    record = F.to_json(F.struct(F.col("doc_id").alias("id"), "lang", "text"))
    body = F.when(F.col("doc_id") % 3 == 1, F.concat(record, F.lit("\n"), record)).otherwise(record)
    rows = docs.select("doc_id", body.alias("payload"), F.lit("org-1").alias("org_id"))
    spec = FeedSpec(
        "docs",
        "texts",
        "texts",
        keep=lambda doc: Field(doc, "lang").text() != "fr",
        routes=(rules.RouteRule("lang", "de", ("german",)),),
        defaults=("lake",),
    )
    landed = land_feed(rows, spec, "ts", "org_id", 1_700_000_000_000, max_bytes=4096)
    sent = landed.rows.select(
        F.when(F.col("kept"), F.lit("sent")).otherwise(F.lit("filtered")).alias("outcome"), "destination", "doc_id"
    )
    dead = landed.dead.select(F.lit("dead").alias("outcome"), F.lit(None).cast("string").alias("destination"), "doc_id")
    both = sent.unionByName(dead).groupBy("outcome", "destination")
    return both.agg(F.count(F.lit(1)).alias("rows"), F.sum("doc_id").alias("ids"))


@query(
    "feed_dump",
    """WITH b AS (SELECT doc_id, lang, strlen(CAST(json_object('id', doc_id, 'lang', lang, 'text', text) AS VARCHAR)) AS size FROM documents),
       k AS (SELECT *, size > 4096 AS over FROM b WHERE size > 4096 OR lang <> 'fr'),
       n AS (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS seq FROM k)
       SELECT CASE WHEN over THEN 'oversize' ELSE 'row' END AS kind, seq, CASE WHEN over THEN CAST(doc_id AS VARCHAR) END AS row_key,
         CASE WHEN over THEN size END AS bytes, CASE WHEN over THEN least(size, 65536) END AS copied FROM n
       UNION ALL SELECT 'begin', 0, NULL, NULL, NULL UNION ALL SELECT 'end', count(*), NULL, NULL, NULL FROM n""",
)
def feed_dump(spark, sf_dir):
    """Documents as a dump: French ones are filtered, large ones stubs with their copy among the dead letters."""
    from feedloom.functions.numbering import span_bucket
    from feedloom.plans.feed import land_feed

    docs = table(spark, sf_dir, "documents")
    record = F.to_json(F.struct(F.col("doc_id").alias("id"), "lang", "text"))
    rows = docs.select("doc_id", record.alias("payload"), F.lit("org-1").alias("org_id"))
    spec = FeedSpec(
        "docs",
        "texts",
        "texts",
        shape="dump",
        row_key="/id",
        keep=lambda doc: Field(doc, "record.lang").text() != "fr",
        defaults=("lake",),
    )
    landed = land_feed(
        rows,
        spec,
        "ts",
        "org_id",
        1_700_000_000_000,
        max_bytes=4096,
        order=["doc_id"],
        bucket=span_bucket("doc_id", 200),
        at="2024-02-01",
        completed_at="2024-02-01 00:05:00",
        run="run-1",
    )
    copies = landed.dead.select(
        F.col("doc_id").cast("string").alias("row_key"), F.octet_length("copy").cast("bigint").alias("copied")
    )
    frames = landed.rows.select("kind", "seq", "row_key", "bytes", "out_topic")
    return frames.join(copies, "row_key", "left").select("kind", "seq", "row_key", "bytes", "copied")


@query(
    "feed_report",
    """WITH b AS (SELECT lang, strlen(CAST(json_object('id', doc_id, 'lang', lang, 'text', text) AS VARCHAR)) > 4096 AS over FROM documents)
       SELECT CAST(count(*) FILTER (WHERE NOT over AND lang <> 'fr') AS BIGINT) AS rows,
         CAST(count(*) FILTER (WHERE NOT over AND lang = 'fr') AS BIGINT) AS filtered,
         CAST(count(*) FILTER (WHERE over) AS BIGINT) AS oversize FROM b""",
)
def feed_report(spark, sf_dir):
    """What one tick over all documents reports."""
    from feedloom.plans.feed import land_feed

    docs = table(spark, sf_dir, "documents")
    record = F.to_json(F.struct(F.col("doc_id").alias("id"), "lang", "text"))
    rows = docs.select("doc_id", record.alias("payload"), F.lit("org-1").alias("org_id"))
    spec = FeedSpec("docs", "texts", "texts", keep=lambda doc: Field(doc, "lang").text() != "fr", defaults=("lake", "copy"))
    landed = land_feed(rows, spec, "ts", "org_id", 1_700_000_000_000, max_bytes=4096)
    return landed.report.select("rows", "filtered", "oversize")

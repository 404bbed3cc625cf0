"""Queries that run whole recipes over pages made from the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.functions.json import Field, object_text, with_document
from feedloom.functions.numbering import span_bucket
from feedloom.plans.catalog.base import query, table
from feedloom.plans.recipes import (
    RECIPES,
    run_dump,
    run_fold,
    run_keys,
    run_lookup,
    run_manifest,
    run_metrics,
    run_objects,
    run_pages,
    run_pull,
    unit_steps,
)


def _page(spark, sf_dir, body, headers=None, seq="o_custkey"):
    """Every order as one response page of its customer's sequence, or of its own."""
    return table(spark, sf_dir, "orders").select(
        F.col(seq).alias("seq_key"),
        F.lit("unit").alias("unit"),
        F.col("o_orderkey").alias("page_id"),
        F.concat(F.lit("https://h/api?p="), F.col("o_orderkey")).alias("url"),
        (headers if headers is not None else F.create_map().cast("map<string,string>")).alias(
            "headers"
        ),
        body.alias("body"),
    )


# Pages of a customer up to and including the first whose key is a multiple of seven.
_KEPT = """e AS (SELECT o_custkey, min(o_orderkey) FILTER (WHERE o_orderkey % 7 = 0) AS stop FROM orders GROUP BY o_custkey),
   kept AS (SELECT o.* FROM orders o JOIN e USING (o_custkey) WHERE stop IS NULL OR o_orderkey <= stop)"""


@query(
    "recipe_audit_events",
    f"""WITH {_KEPT} SELECT o_orderkey AS page_id, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS priority,
         CASE WHEN o_orderkey % 5 = 0 THEN 'missing' END AS problem FROM kept""",
)
def recipe_audit_events(spark, sf_dir):
    key = F.col("o_orderkey")
    inner = F.when(key % 5 != 0, F.to_json(F.struct(F.col("o_orderpriority").alias("p"))))
    body = F.to_json(
        F.struct(
            F.array(F.struct(key.alias("EventId"), inner.alias("CloudTrailEvent"))).alias("Events"),
            F.when(key % 7 != 0, F.concat(F.lit("t"), key)).alias("NextToken"),
        )
    )
    rows, _ = run_pages(_page(spark, sf_dir, body), RECIPES["aws"]["cloudtrail"])
    parsed = with_document(rows, "payload")
    doc = F.col("_doc")
    return parsed.select(
        "page_id",
        Field(doc, "p").text().alias("priority"),
        Field(doc, "_parse_error").text().alias("problem"),
    )


@query(
    "recipe_linked_array",
    f"""WITH {_KEPT} SELECT o_orderkey AS page_id, CAST(p AS INT) AS pos, o_totalprice AS price, 'log' AS kind
       FROM kept, (SELECT unnest([0, 1]) AS p)""",
)
def recipe_linked_array(spark, sf_dir):
    key = F.col("o_orderkey")
    item = F.struct(F.col("o_totalprice").alias("price"))
    link = F.when(
        key % 7 != 0, F.concat(F.lit("<https://h/api?after="), key, F.lit('>; rel="next"'))
    ).otherwise(F.lit('<https://h/api>; rel="self"'))
    pages = _page(
        spark, sf_dir, F.to_json(F.array(item, item)), F.create_map(F.lit("Link"), link)
    )
    rows, _ = run_pages(pages, RECIPES["okta"]["system_log"], fields={"kind": "log"})
    parsed = with_document(rows, "payload")
    doc = F.col("_doc")
    return parsed.select(
        "page_id",
        "pos",
        Field(doc, "price").number().alias("price"),
        Field(doc, "kind").text().alias("kind"),
    )


@query(
    "recipe_failing_pages",
    """WITH bad AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderkey % 13 = 0),
       p AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS n FROM orders
             WHERE o_custkey NOT IN (SELECT * FROM bad))
       SELECT o_custkey AS seq_key, o_orderkey AS page_id, o_orderkey * 2 AS id FROM p WHERE n < greatest(o_custkey % 6, 1)""",
)
def recipe_failing_pages(spark, sf_dir):
    key = F.col("o_orderkey")
    body = F.to_json(
        F.struct(
            F.array(F.struct((key * 2).alias("id"))).alias("result"),
            (key % 13 != 0).alias("success"),
            F.struct((F.col("o_custkey") % 6).alias("total_pages")).alias("result_info"),
        )
    )
    rows, _ = run_pages(_page(spark, sf_dir, body), RECIPES["cloudflare"]["audit_logs"])
    parsed = with_document(rows, "payload")
    return parsed.select(
        "seq_key", "page_id", Field(F.col("_doc"), "id").number().cast("bigint").alias("id")
    )


@query(
    "recipe_lookup",
    """WITH p AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders),
       ids AS (SELECT o_custkey, o_orderkey FROM p WHERE n <= 5),
       b AS (SELECT *, (row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 AS batch_no FROM ids),
       d AS (SELECT DISTINCT batch_no, o_custkey FROM b)
       SELECT CAST(batch_no AS BIGINT) AS batch_no, c_custkey, c_acctbal FROM d JOIN customer ON c_custkey = o_custkey""",
)
def recipe_lookup(spark, sf_dir):
    recipe = RECIPES["crowdstrike"]["alerts"]
    body = F.to_json(
        F.struct(
            F.array(F.col("o_custkey").cast("string")).alias("resources"),
            F.struct(F.struct(F.lit(5).alias("total")).alias("pagination")).alias("meta"),
        )
    )
    listed, _ = run_pages(_page(spark, sf_dir, body), recipe)
    entities = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("id"), "c_custkey", "c_acctbal"
    )
    found = run_lookup(
        listed, recipe, entities, "id", ["page_id"], bucket=span_bucket("page_id", 100_000)
    )
    return found.select("batch_no", "c_custkey", "c_acctbal")


@query(
    "recipe_csv_manifest",
    """SELECT c_custkey, c_name AS name, c_mktsegment AS file, 'item' AS mark FROM customer WHERE c_custkey % 3 <> 0""",
)
def recipe_csv_manifest(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    items = customer.filter(F.col("c_custkey") % 3 != 0).select(
        "c_custkey",
        F.col("c_custkey").alias("position"),
        "c_mktsegment",
        F.floor(F.col("c_custkey") / 300).alias("listing"),
    )
    contents = customer.select(
        "c_custkey",
        F.concat(F.lit("NAME,KEY\r\n"), "c_name", F.lit(","), F.col("c_custkey")).alias("body"),
    )
    rows, _ = run_manifest(
        items,
        contents,
        RECIPES["salesforce"]["event_log_file"],
        "c_custkey",
        "position",
        by=["listing"],
        add={"file": F.col("c_mktsegment")},
    )
    parsed = with_document(rows, "payload")
    doc = F.col("_doc")
    return parsed.select(
        "c_custkey",
        Field(doc, "NAME").text().alias("name"),
        Field(doc, "file").text().alias("file"),
        F.col("mark.kind").alias("mark"),
    )


@query(
    "recipe_columnar",
    """SELECT o_orderkey AS page_id, o_orderstatus AS status, o_totalprice AS price FROM orders""",
)
def recipe_columnar(spark, sf_dir):
    body = F.concat(
        F.lit('{"tables":[{"columns":[{"name":"status"},{"name":"price"}],"rows":[["'),
        F.col("o_orderstatus"),
        F.lit('",'),
        F.col("o_totalprice").cast("decimal(14,2)").cast("string"),
        F.lit("]]}]}"),
    )
    pages = _page(spark, sf_dir, body, seq="o_orderkey")
    rows, _ = run_pages(pages, RECIPES["azure"]["log_analytics"])
    parsed = with_document(rows, "payload")
    doc = F.col("_doc")
    return parsed.select(
        "page_id",
        Field(doc, "status").text().alias("status"),
        Field(doc, "price").number().alias("price"),
    )


@query(
    "recipe_messages",
    """SELECT o_orderkey AS page_id, 'ack' || o_orderkey AS ack_id, o_orderstatus AS status FROM orders
       WHERE o_orderkey % 6 <> 0""",
)
def recipe_messages(spark, sf_dir):
    data = F.base64(object_text({"status": F.col("o_orderstatus")}).cast("binary"))
    message = F.struct(
        F.concat(F.lit("ack"), F.col("o_orderkey")).alias("ackId"),
        F.struct(data.alias("data")).alias("message"),
    )
    # every sixth pull is empty, and the queue goes on all the same
    some = F.to_json(F.struct(F.array(message).alias("receivedMessages")))
    body = F.when(F.col("o_orderkey") % 6 == 0, F.lit("{}")).otherwise(some)
    rows = run_pull(_page(spark, sf_dir, body), RECIPES["gcp_pubsub"]["pull"])
    parsed = with_document(rows, "payload")
    return parsed.select(
        "page_id", "ack_id", Field(F.col("_doc"), "status").text().alias("status")
    )


@query(
    "recipe_ceiling_report",
    """WITH p AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS n FROM orders),
       e AS (SELECT o_custkey, min(n) FILTER (WHERE o_orderkey % 23 = 0) AS stop, max(n) AS last FROM p GROUP BY o_custkey),
       s AS (SELECT o_custkey, CASE WHEN coalesce(stop, last) >= 10 THEN 'over' ELSE 'read' END AS kind, least(coalesce(stop, last), 9) AS upto FROM e)
       SELECT unit, o_custkey AS seq_key, CASE WHEN kind = 'read' THEN 'read' WHEN unit = 'scc' THEN 'cut' ELSE 'ceiling' END AS status,
         CAST(CASE WHEN kind = 'over' AND unit = 'cloud_logging' THEN 0 ELSE upto + 1 END AS BIGINT) AS rows
       FROM s, (VALUES ('cloud_logging'), ('scc')) u(unit)""",
)
def recipe_ceiling_report(spark, sf_dir):
    """Sequences over the ceiling of ten pages: a windowed unit fails, a current state is cut; both are named."""
    key = F.col("o_orderkey")
    out = None
    for unit, at in (("cloud_logging", "entries"), ("scc", "listFindingsResults")):
        token = F.when(key % 23 != 0, F.concat(F.lit("t"), key))
        body = F.to_json(F.struct(F.array(F.struct(key.alias("id"))).alias(at), token.alias("nextPageToken")))
        rows, problems = run_pages(_page(spark, sf_dir, body), RECIPES["gcp"][unit])
        read = rows.groupBy("seq_key").agg(F.count("*").alias("rows"))
        named = read.join(problems.select("seq_key", "status"), "seq_key", "full").select(
            F.lit(unit).alias("unit"),
            "seq_key",
            F.coalesce("status", F.lit("read")).alias("status"),
            F.coalesce("rows", F.lit(0)).alias("rows"),
        )
        out = named if out is None else out.unionByName(named)
    return out


@query(
    "recipe_stops",
    """WITH p AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS n FROM orders),
       e AS (SELECT o_custkey, min(n) FILTER (WHERE o_orderkey % 5 = 0) AS stop FROM p GROUP BY o_custkey)
       SELECT o_custkey AS seq_key, o_orderkey AS page_id FROM p JOIN e USING (o_custkey) WHERE n <= coalesce(stop, 1000000)""",
)
def recipe_stops(spark, sf_dir):
    """Pages whose cursor never ends: `has_more` does."""
    key = F.col("o_orderkey")
    body = F.to_json(
        F.struct(
            F.array(F.struct(key.alias("id"))).alias("items"),
            F.concat(F.lit("c"), key).alias("cursor"),
            (key % 5 != 0).alias("has_more"),
        )
    )
    rows, _ = run_pages(_page(spark, sf_dir, body), RECIPES["onepassword"]["item_usages"])
    return rows.select("seq_key", "page_id")


@query(
    "recipe_objects",
    """WITH o AS (SELECT o_orderkey, 'in/' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS path, CAST(o_orderdate AS TIMESTAMP) AS position FROM orders),
       past AS (SELECT *, row_number() OVER (ORDER BY position, path) AS n FROM o
         WHERE (position > TIMESTAMP '1996-01-01' OR (position = TIMESTAMP '1996-01-01' AND path > 'in/000000700'))
           AND position < TIMESTAMP '1998-01-01 00:05:00' - INTERVAL 300 SECOND)
       SELECT path, CAST(p AS INT) AS part, strftime(position, '%Y-%m-%dT%H:%M:%S.000Z') AS modified,
         CASE p WHEN 0 THEN CAST(o_orderkey AS VARCHAR) END AS id, CASE p WHEN 1 THEN 'not json' END AS raw
       FROM past, (SELECT unnest([0, 1]) AS p) WHERE n <= 1000""",
)
def recipe_objects(spark, sf_dir):
    """Objects past a marker and settled, the oldest thousand; odd ones are gzip, the names say nothing."""
    import gzip

    @F.udf("binary")
    def squeezed(text, odd):
        data = text.encode()
        return gzip.compress(data, mtime=0) if odd else data

    key = F.col("o_orderkey")
    path = F.concat(F.lit("in/"), F.lpad(key.cast("string"), 9, "0"))
    orders = table(spark, sf_dir, "orders")
    objects = orders.select(path.alias("path"), F.col("o_orderdate").cast("timestamp").alias("position"), key.alias("size"))
    text = F.concat(F.lit('{"id":"'), key, F.lit('"}\n\nnot json\n'))
    contents = orders.select(path.alias("path"), squeezed(text, key % 2 == 1).alias("body"))
    rows, _ = run_objects(
        objects,
        contents,
        RECIPES["object_store"]["json_gz"],
        ("1996-01-01", "in/000000700"),
        "1998-01-01 00:05:00",
        "s3",
        "bucket",
    )
    parsed = with_document(rows, "payload")
    doc = F.col("_doc")
    raw = Field(doc, "_raw_line").text()
    return parsed.select(
        Field(doc, "_object.key").text().alias("path"),
        F.when(raw.isNull(), 0).otherwise(1).cast("int").alias("part"),
        Field(doc, "_object.last_modified").text().alias("modified"),
        Field(doc, "id").text().alias("id"),
        raw.alias("raw"),
    )


@query(
    "recipe_dump",
    """WITH n AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS seq FROM customer)
       SELECT 'row' AS kind, seq, c_custkey AS service_id FROM n
       UNION ALL SELECT 'begin', 0, NULL UNION ALL SELECT 'end', count(*), NULL FROM n""",
)
def recipe_dump(spark, sf_dir):
    """A store's rows, twenty-five lines a body, as one snapshot."""
    line = F.concat(F.lit('{"service_id":'), "c_custkey", F.lit("}"))
    bodies = (
        table(spark, sf_dir, "customer")
        .select(F.floor(F.col("c_custkey") / 25).alias("part"), F.col("c_custkey"), line.alias("line"))
        .groupBy("part")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", "line"))), lambda x: x["line"]), "\n").alias("body"))
    )
    lines = bodies.select("part", F.posexplode(F.split("body", "\n")).alias("pos", "body"))
    frames = run_dump(
        lines.withColumn("at", F.col("part") * 25 + F.col("pos")),
        RECIPES["runzero"]["services"],
        "c.services",
        "2024-02-01",
        "2024-02-01 00:05:00",
        "run-1",
        ["at"],
        span_bucket("at", 300),
    )
    parsed = with_document(frames, "record")
    return parsed.select(
        "kind", "seq", Field(F.col("_doc"), "service_id").number().cast("bigint").alias("service_id")
    )


@query(
    "recipe_fold",
    """WITH n AS (SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS i FROM part)
       SELECT p_brand, '{"versions":[' || string_agg('"v' || p_partkey || '"', ',' ORDER BY p_partkey) || '],"version_info":{'
         || string_agg('"v' || p_partkey || '":{"Version":"v' || p_partkey || '"}', ',' ORDER BY p_partkey) || '}}' AS payload
       FROM n WHERE i <= 100 GROUP BY p_brand""",
)
def recipe_fold(spark, sf_dir):
    """The first hundred listed versions of each key, each its own document, folded into one record."""
    listed = table(spark, sf_dir, "part").select(
        "p_brand", F.col("p_partkey").alias("place"), F.concat(F.lit("v"), F.col("p_partkey")).alias("line")
    )
    documents = listed.select("p_brand", "line", object_text({"Version": F.col("line")}).alias("body"))
    folded, _ = run_fold(listed, documents, RECIPES["go_modules"]["metadata"], "p_brand", "line", "place")
    return folded


@query(
    "recipe_steps",
    """WITH c AS (SELECT c_custkey, TIMESTAMP '2024-01-01' + to_hours(CAST(c_custkey % 50 AS INTEGER)) AS a, TIMESTAMP '2024-01-05 12:00:00' AS now FROM customer),
       w AS (SELECT c_custkey, a, least(now, a + INTERVAL 30 HOUR) AS b FROM c),
       s AS (SELECT c_custkey, unnest(generate_series(a, b - INTERVAL 1 MICROSECOND, INTERVAL 24 HOUR)) AS f, b FROM w)
       SELECT c_custkey, strftime(f, '%Y-%m-%dT%H:%M:%S') AS start_text, strftime(least(f + INTERVAL 24 HOUR, b), '%Y-%m-%dT%H:%M:%S') AS end_text FROM s""",
)
def recipe_steps(spark, sf_dir):
    """Windows of thirty hours in steps of a day, as a content feed asks for them."""
    customer = table(spark, sf_dir, "customer")
    units = customer.select(
        F.col("c_custkey").alias("cursor_key"), F.lit(30).alias("default_hours"), F.lit(60).alias("interval_secs")
    )
    hours = F.expr("make_interval(0, 0, 0, 0, cast(c_custkey % 50 as int), 0, 0)")
    cursors = customer.select(
        F.col("c_custkey").alias("cursor_key"), (F.lit("2024-01-01").cast("timestamp") + hours).alias("last_fetch_end")
    )
    steps = unit_steps(units, cursors, RECIPES["m365"]["dlp"], "2024-01-05 12:00:00")
    return steps.select(F.col("cursor_key").alias("c_custkey"), "start_text", "end_text")


@query(
    "recipe_metrics",
    """WITH n AS (SELECT p_partkey, p_brand, p_type, p_size, row_number() OVER (ORDER BY p_partkey) - 1 AS i FROM part)
       SELECT p_partkey, CAST(i // 500 AS BIGINT) AS batch_no, 'q' || (i % 500) AS id, p_brand AS name, 'By' AS unit, 'Average' AS stat,
         'Namespace=Shop;type=' || p_type AS attributes, CAST(p_size AS DOUBLE) AS first_value, 2 AS points FROM n""",
)
def recipe_metrics(spark, sf_dir):
    """Listed descriptors to queries, their answers, in two results each, to gauges."""
    from feedloom.operators import builders

    part = table(spark, sf_dir, "part")
    descriptor = F.struct(
        F.lit("Shop").alias("Namespace"),
        F.col("p_brand").alias("MetricName"),
        F.lit("Bytes").alias("Unit"),
        F.array(F.struct(F.lit("type").alias("Name"), F.col("p_type").alias("Value"))).alias("Dimensions"),
    )
    body = F.to_json(F.struct(F.array(descriptor).alias("Metrics")))
    pages = part.select(
        F.col("p_partkey").alias("seq_key"),
        F.lit("unit").alias("unit"),
        F.col("p_partkey").alias("page_id"),
        F.lit("https://h").alias("url"),
        F.create_map().cast("map<string,string>").alias("headers"),
        body.alias("body"),
    )
    recipe = RECIPES["aws"]["cloudwatch_metrics"]
    listed, _ = run_pages(pages, recipe)
    asked = run_metrics(listed, recipe, ["page_id"], span_bucket("page_id", 1000))
    size = part.select(F.col("p_partkey").alias("page_id"), F.col("p_size").cast("double").alias("v"))
    answers = asked.join(size, "page_id").select(
        "batch_no",
        F.col("query_id").alias("id"),
        F.explode(F.array(F.lit(60.0), F.lit(0.0))).alias("t"),
        "v",
    )
    results = answers.select(
        "batch_no", "id", F.array("t").alias("timestamps"), F.array(F.col("v") + F.col("t")).alias("values")
    )
    gauges = builders.gauge_group(results, asked, "metric", "namespace", "dimensions")
    pair = F.transform("attributes", lambda a: F.concat(a["name"], F.lit("="), a["value"]))
    keyed = asked.select("batch_no", F.col("query_id").alias("id"), F.col("page_id").alias("p_partkey"))
    return gauges.join(keyed, ["batch_no", "id"]).select(
        "p_partkey",
        "batch_no",
        "id",
        "name",
        "unit",
        "stat",
        F.array_join(pair, ";").alias("attributes"),
        F.col("points")[0]["value"].alias("first_value"),
        F.size("points").alias("points"),
    )


# --- profiles with a cursor: every page has one record, and its sequence ends at a multiple of seven --------


def _ids(rows):
    parsed = with_document(rows, "payload")
    return parsed.select("seq_key", "page_id", Field(F.col("_doc"), "id").number().cast("bigint").alias("id"))


def _record():
    return F.array(F.struct((F.col("o_orderkey") * 3).alias("id")))


def _next_token(last=None):
    key = F.col("o_orderkey")
    return F.when(key % 7 != 0, F.concat(F.lit("t"), key)).otherwise(F.lit(last).cast("string"))


_CURSOR_IDS = f"WITH {_KEPT} SELECT o_custkey AS seq_key, o_orderkey AS page_id, o_orderkey * 3 AS id FROM kept"
_SOUND_IDS = """WITH bad AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderkey % 13 = 0),
   e AS (SELECT o_custkey, min(o_orderkey) FILTER (WHERE o_orderkey % 7 = 0) AS stop FROM orders GROUP BY o_custkey)
   SELECT o_custkey AS seq_key, o_orderkey AS page_id, o_orderkey * 3 AS id FROM orders o JOIN e USING (o_custkey)
   WHERE o_custkey NOT IN (SELECT * FROM bad) AND o_orderkey <= coalesce(stop, o_orderkey)"""


@query("recipe_workspace", f"{_CURSOR_IDS} WHERE o_orderkey % 4 <> 0")
def recipe_workspace(spark, sf_dir):
    """An application's activities; a page without the list of items is an empty one."""
    items = F.when(F.col("o_orderkey") % 4 != 0, _record())
    body = F.to_json(F.struct(items.alias("items"), _next_token().alias("nextPageToken")))
    return _ids(run_pages(_page(spark, sf_dir, body), RECIPES["google_workspace"]["drive"])[0])


@query("recipe_github", _CURSOR_IDS)
def recipe_github(spark, sf_dir):
    """Arrays linked by headers."""
    key = F.col("o_orderkey")
    more = F.concat(F.lit("<https://h/api?after="), key, F.lit('>; rel="next", <https://h/api>; rel="first"'))
    link = F.when(key % 7 != 0, more).otherwise(F.lit('<https://h/api>; rel="first"'))
    pages = _page(spark, sf_dir, F.to_json(_record()), F.create_map(F.lit("link"), link))
    return _ids(run_pages(pages, RECIPES["github"]["audit_log"])[0])


@query("recipe_bitwarden", _CURSOR_IDS)
def recipe_bitwarden(spark, sf_dir):
    body = F.to_json(F.struct(F.lit("list").alias("object"), _record().alias("data"), _next_token().alias("continuationToken")))
    return _ids(run_pages(_page(spark, sf_dir, body), RECIPES["bitwarden"]["events"])[0])


@query("recipe_datadog", _CURSOR_IDS)
def recipe_datadog(spark, sf_dir):
    """The token lies two objects deep; the last page has neither."""
    page = F.struct(F.struct(_next_token().alias("after")).alias("page"))
    meta = F.when(F.col("o_orderkey") % 7 != 0, page)
    body = F.to_json(F.struct(_record().alias("data"), meta.alias("meta")))
    return _ids(run_pages(_page(spark, sf_dir, body), RECIPES["datadog"]["audit_events"])[0])


@query("recipe_duo", _SOUND_IDS)
def recipe_duo(spark, sf_dir):
    """The next offset is a list of two; a page that is not OK fails its sequence."""
    key = F.col("o_orderkey")
    offset = F.when(key % 7 != 0, F.array(key.cast("string"), F.concat(F.lit("id-"), key)))
    response = F.struct(_record().alias("authlogs"), F.struct(offset.alias("next_offset")).alias("metadata"))
    stat = F.when(key % 13 == 0, F.lit("FAIL")).otherwise(F.lit("OK"))
    body = F.to_json(F.struct(stat.alias("stat"), F.lit("busy").alias("message"), response.alias("response")))
    return _ids(run_pages(_page(spark, sf_dir, body), RECIPES["duo"]["authentication_logs"])[0])


@query("recipe_slack", _SOUND_IDS)
def recipe_slack(spark, sf_dir):
    """An empty cursor ends a sequence; a page that is not ok fails it."""
    key = F.col("o_orderkey")
    cursor = F.struct(_next_token("").alias("next_cursor"))
    body = F.to_json(F.struct((key % 13 != 0).alias("ok"), F.lit("ratelimited").alias("error"), _record().alias("entries"), cursor.alias("response_metadata")))
    return _ids(run_pages(_page(spark, sf_dir, body), RECIPES["slack"]["audit_logs"])[0])


@query(
    "recipe_entity_set",
    f"""WITH {_KEPT},
       w AS (SELECT c_custkey, TIMESTAMP '2024-01-01' + to_hours(CAST(c_custkey % 50 AS INTEGER)) AS a FROM customer)
       SELECT o_custkey AS seq_key, o_orderkey AS page_id, o_orderkey * 3 AS id,
         strftime(a - INTERVAL 300 SECOND, '%Y-%m-%dT%H:%M:%S') AS start_text,
         strftime(least(TIMESTAMP '2024-01-05 11:55:00', a + INTERVAL 30 HOUR), '%Y-%m-%dT%H:%M:%S') AS end_text
       FROM kept JOIN w ON c_custkey = o_custkey""",
)
def recipe_entity_set(spark, sf_dir):
    """Entities of each unit's window, which is settled and overlaps the one before, linked by URLs in the body."""
    recipe = RECIPES["s4hana"]["entity_set"]
    customer = table(spark, sf_dir, "customer")
    units = customer.select(F.col("c_custkey").alias("cursor_key"), F.lit(30).alias("default_hours"), F.lit(60).alias("interval_secs"))
    hours = F.expr("make_interval(0, 0, 0, 0, cast(c_custkey % 50 as int), 0, 0)")
    cursors = customer.select(F.col("c_custkey").alias("cursor_key"), (F.lit("2024-01-01").cast("timestamp") + hours).alias("last_fetch_end"))
    steps = unit_steps(units, cursors, recipe, "2024-01-05 12:00:00")
    key = F.col("o_orderkey")
    following = F.when(key % 7 != 0, F.concat(F.lit("Set?$skiptoken="), key))
    body = F.to_json(F.struct(F.struct(_record().alias("results"), following.alias("__next")).alias("d")))
    rows = _ids(run_pages(_page(spark, sf_dir, body), recipe)[0])
    return rows.join(steps.select(F.col("cursor_key").alias("seq_key"), "start_text", "end_text"), "seq_key")


def _keyed_answers(spark, sf_dir):
    """An answer for most parts: some unknown to the registry, some refused, some never given."""
    key = F.col("p_partkey")
    part = table(spark, sf_dir, "part")
    status = F.when(key % 11 == 0, F.lit(404)).when(key % 13 == 0, F.lit(500)).otherwise(F.lit(200))
    body = F.when(status == 200, F.concat(F.lit('\n{"info":{"size":'), "p_size", F.lit("}}\n"))).otherwise(F.lit("oops"))
    name = F.concat(F.lit("p"), key)
    answers = part.where(key % 17 != 0).select(name.alias("key"), status.alias("status"), body.alias("body"))
    return part.select(F.explode(F.array(name, name)).alias("key")), answers


_KEYED = """SELECT 'p' || p_partkey AS key, CASE WHEN p_partkey % 17 <> 0 AND p_partkey % 13 <> 0 THEN 'p' || p_partkey END AS named,
   CASE WHEN p_partkey % 17 <> 0 AND p_partkey % 13 <> 0 THEN p_size END AS size,
   CASE WHEN p_partkey % 17 = 0 THEN 'missing' WHEN p_partkey % 13 = 0 THEN 'failed' END AS problem
   FROM part WHERE p_partkey % 17 = 0 OR p_partkey % 11 <> 0"""


def _keyed_rows(spark, sf_dir, profile, named):
    rows, problems = run_keys(*_keyed_answers(spark, sf_dir), RECIPES[profile]["metadata"])
    parsed = with_document(rows, "payload")
    doc, none = F.col("_doc"), F.lit(None)
    return parsed.select(
        "key", Field(doc, named).text().alias("named"), Field(doc, "info.size").number().cast("int").alias("size"), none.cast("string").alias("problem")
    ).unionByName(problems.select("key", none.cast("string").alias("named"), none.cast("int").alias("size"), "problem"))


@query("recipe_pypi", _KEYED)
def recipe_pypi(spark, sf_dir):
    """A document for each listed key, with the key in it; an unknown key is no problem."""
    return _keyed_rows(spark, sf_dir, "pypi", "_package")


@query("recipe_crates", _KEYED)
def recipe_crates(spark, sf_dir):
    return _keyed_rows(spark, sf_dir, "crates_io", "_crate")

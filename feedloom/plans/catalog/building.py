"""Queries over the row builders."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.functions.json import Field, object_text, pointer_text, with_document
from feedloom.functions.numbering import span_bucket
from feedloom.functions.records import cap_values
from feedloom.operators import builders
from feedloom.plans.catalog.base import events_feed, query, table


@query(
    "columnar_table",
    """SELECT o_orderkey, CAST(p AS INT) AS pos, CASE WHEN p = 0 THEN o_orderkey ELSE 0 END AS id,
         CASE WHEN p = 0 THEN o_orderpriority ELSE 'x' END AS status,
         CAST(CASE WHEN p = 0 THEN 2 ELSE 2 END AS INT) AS n_keys
       FROM orders, (SELECT unnest([0, 1]) AS p)""",
)
def columnar_table(spark, sf_dir):
    # `status` comes twice (the later wins in a full row), one column has no name.
    body = F.concat(
        F.lit('{"columns":[{"name":"id"},{"name":"status"},{"kind":"z"},{"name":"status"}],"rows":[['),
        F.col("o_orderkey").cast("string"),
        F.lit(',"old",1,"'),
        F.col("o_orderpriority"),
        F.lit('"],[0,"x"]]}'),
    )
    rows = builders.columnar_table(
        table(spark, sf_dir, "orders").select("o_orderkey", body.alias("body")), "body"
    )
    parsed = with_document(rows, "payload")
    doc = F.col("_doc")
    return parsed.select(
        "o_orderkey",
        "pos",
        Field(doc, "id").number().cast("bigint").alias("id"),
        Field(doc, "status").text().alias("status"),
        F.size(F.map_keys(doc)).alias("n_keys"),
    )


@query(
    "audit_event",
    """SELECT event_id, CASE WHEN event_id % 5 IN (0, 1) THEN event_type END AS type,
         CASE event_id % 5 WHEN 2 THEN 'bad JSON' WHEN 3 THEN 'missing' WHEN 4 THEN 'not an object' END AS problem,
         CASE WHEN event_id % 5 > 1 THEN user_id END AS user_value FROM events""",
)
def audit_event(spark, sf_dir):
    kind = F.col("event_id") % 5
    nested = F.struct(F.col("event_type").alias("type"))
    user = F.col("user_id").alias("user")
    body = (
        F.when(kind == 0, F.to_json(F.struct(user, F.to_json(nested).alias("CloudTrailEvent"))))
        .when(kind == 1, F.to_json(F.struct(user, nested.alias("CloudTrailEvent"))))
        .when(kind == 2, F.to_json(F.struct(user, F.lit("{bad").alias("CloudTrailEvent"))))
        .when(kind == 3, F.to_json(F.struct(user)))
        .otherwise(F.to_json(F.struct(user, F.lit("[1]").alias("CloudTrailEvent"))))
    )
    rows = table(spark, sf_dir, "events").select("event_id", body.alias("payload"))
    parsed = with_document(builders.audit_event(rows), "payload")
    doc = F.col("_doc")
    return parsed.select(
        "event_id",
        Field(doc, "type").text().alias("type"),
        Field(doc, builders.PARSE_ERROR).text().alias("problem"),
        Field(doc, "user").number().cast("bigint").alias("user_value"),
    )


@query(
    "stamp_absent",
    """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'own' ELSE 'grp-' || user_id % 4 END AS log_group,
              'eu-1' AS region, false AS has_account FROM events""",
)
def stamp_absent(spark, sf_dir):
    feed = events_feed(spark, sf_dir).withColumn(
        "payload",
        F.when(
            F.col("event_id") % 3 == 0,
            F.replace("payload", F.lit('"type":'), F.lit('"logGroupName":"own","type":')),
        ).otherwise(F.col("payload")),
    )
    stamped = builders.stamp_absent(
        feed,
        {
            "logGroupName": F.concat(F.lit("grp-"), F.col("user_id") % 4),
            "awsAccountId": F.lit(None).cast("string"),
            "awsRegion": "eu-1",
        },
    )
    parsed = with_document(stamped, "payload")
    doc = F.col("_doc")
    return parsed.select(
        "event_id",
        Field(doc, "logGroupName").text().alias("log_group"),
        Field(doc, "awsRegion").text().alias("region"),
        Field(doc, "awsAccountId").exists().alias("has_account"),
    )


@query(
    "wrap_non_object",
    """SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'object' WHEN 1 THEN 'payload' ELSE 'raw' END AS landed,
         CASE event_id % 3 WHEN 0 THEN event_type WHEN 1 THEN CAST(user_id AS VARCHAR) ELSE event_type || ' {' || user_id END AS content
       FROM events""",
)
def wrap_non_object(spark, sf_dir):
    kind = F.col("event_id") % 3
    user = F.col("user_id").cast("string")
    text = (
        F.when(kind == 0, F.to_json(F.struct(F.col("event_type").alias("type"))))
        .when(kind == 1, F.concat(F.lit(" "), user))
        .otherwise(F.concat("event_type", F.lit(" {"), user))
    )
    rows = table(spark, sf_dir, "events").select(
        "event_id", builders.wrap_non_object(text).alias("payload")
    )
    parsed = with_document(rows, "payload")
    doc = F.col("_doc")
    raw, inner = Field(doc, builders.RAW_LINE), Field(doc, "payload")
    return parsed.select(
        "event_id",
        F.when(raw.exists(), F.lit("raw"))
        .when(inner.exists(), F.lit("payload"))
        .otherwise(F.lit("object"))
        .alias("landed"),
        F.coalesce(raw.text(), inner.as_text(), Field(doc, "type").text()).alias("content"),
    )


@query(
    "message_decode",
    """SELECT event_id, 'ack-' || event_id AS ack_id,
         CASE event_id % 5 WHEN 0 THEN event_type END AS type,
         CASE event_id % 5 WHEN 1 THEN CAST(user_id AS VARCHAR) END AS inner_value,
         CASE event_id % 5 WHEN 2 THEN event_type WHEN 4 THEN '' END AS data,
         CASE WHEN event_id % 5 <> 3 THEN 'm' || event_id END AS message_id,
         CASE WHEN event_id % 5 = 3 THEN 'bad base64' END AS error FROM events""",
)
def message_decode(spark, sf_dir):
    kind = F.col("event_id") % 5
    data = (
        F.when(kind == 0, F.to_json(F.struct(F.col("event_type").alias("type"))))
        .when(kind == 1, F.col("user_id").cast("string"))
        .when(kind == 2, F.col("event_type"))
    )
    encoded = F.when(kind == 3, F.lit("@@not base64@@")).otherwise(F.base64(data.cast("binary")))
    message = F.struct(
        F.concat(F.lit("ack-"), F.col("event_id")).alias("ackId"),
        F.struct(
            encoded.alias("data"),
            F.concat(F.lit("m"), F.col("event_id")).alias("messageId"),
            F.create_map(F.lit("origin"), F.col("event_type")).alias("attributes"),
        ).alias("message"),
    )
    rows = table(spark, sf_dir, "events").select("event_id", F.to_json(message).alias("body"))
    decoded = builders.decode_message(rows, "body", "projects/p/subscriptions/s")
    parsed = with_document(decoded, "payload")
    doc = F.col("_doc")
    return parsed.select(
        "event_id",
        "ack_id",
        Field(doc, "type").text().alias("type"),
        Field(doc, "payload").as_text().alias("inner_value"),
        Field(doc, "data").text().alias("data"),
        Field(doc, "_message.message_id").text().alias("message_id"),
        "error",
    )


@query(
    "event_time",
    """SELECT event_id, CASE event_id % 4 WHEN 0 THEN event_type WHEN 1 THEN 'own' END AS stamped,
              event_id % 4 IN (0, 1, 2) AS has_key FROM events""",
)
def event_time(spark, sf_dir):
    kind = F.col("event_id") % 4
    created = F.to_json(F.struct(F.col("event_type").alias("createdAt")))
    body = (
        F.when(kind == 0, created)
        .when(kind == 1, F.replace(created, F.lit("}"), F.lit(',"timestamp":"own"}')))
        .when(kind == 2, F.replace(created, F.lit("}"), F.lit(',"timestamp":null}')))
        .otherwise(F.lit('{"createdAt":""}'))
    )
    rows = table(spark, sf_dir, "events").select("event_id", body.alias("payload"))
    parsed = with_document(builders.event_time(rows, "createdAt"), "payload")
    field = Field(F.col("_doc"), "timestamp")
    return parsed.select(
        "event_id", field.text().alias("stamped"), field.exists().alias("has_key")
    )


@query(
    "pointer_text",
    """SELECT event_id, CAST(user_id AS VARCHAR) AS key_number, event_type AS key_text,
              CAST(event_id % 2 = 0 AS VARCHAR) AS key_flag, CAST(NULL AS VARCHAR) AS key_object FROM events""",
)
def pointer_text_query(spark, sf_dir):
    body = object_text(
        {
            "a.b": F.array(F.struct(F.col("user_id").alias("x/y"))),
            "t": F.col("event_type"),
            "f": F.col("event_id") % 2 == 0,
        }
    )
    return table(spark, sf_dir, "events").select("event_id", body.alias("p")).select(
        "event_id",
        pointer_text(F.col("p"), "/a.b/0/x~1y").alias("key_number"),
        pointer_text(F.col("p"), "/t").alias("key_text"),
        pointer_text(F.col("p"), "/f").alias("key_flag"),
        pointer_text(F.col("p"), "/a.b/0").alias("key_object"),
    )


@query(
    "capped_values",
    """SELECT doc_id, CASE WHEN strlen(text) > 3000 THEN 'text' END AS too_large FROM documents""",
)
def capped_values(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    kept, refused = cap_values(documents, 3000, 1 << 20)
    return kept.select("doc_id", F.lit(None).cast("string").alias("too_large")).unionByName(
        refused.select("doc_id", F.array_join("too_large", ",").alias("too_large"))
    )


def _metric_queries(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.col("p_brand").alias("metric"),
        F.lit("Shop").alias("namespace"),
        F.array(
            F.struct(F.lit("type").alias("name"), F.col("p_type").alias("value")),
            F.struct(F.lit("").alias("name"), F.lit("lost").alias("value")),
        ).alias("dimensions"),
        F.when(F.col("p_partkey") % 3 == 0, F.lit("Bytes/Second"))
        .when(F.col("p_partkey") % 3 == 1, F.lit("Seconds"))
        .alias("unit"),
        F.col("p_size").cast("double").alias("size"),
        "p_retailprice",
    )
    return builders.metric_queries(
        parts, ["p_partkey"], 500, span_bucket("p_partkey", 100_000)
    )


def _metric_results(queries):
    at = F.col("p_partkey") + F.lit(0.1234)
    return queries.select(
        "batch_no",
        F.when(F.col("p_partkey") % 50 == 7, F.lit("q99999")).otherwise(F.col("query_id")).alias("id"),
        F.when(F.col("p_partkey") % 10 == 3, F.array().cast("array<double>"))
        .otherwise(F.array(at, at + 60))
        .alias("timestamps"),
        F.when(F.col("p_partkey") % 10 == 3, F.array().cast("array<double>"))
        .otherwise(F.array("size", "p_retailprice"))
        .alias("values"),
    )


@query(
    "metric_queries",
    """WITH n AS (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) - 1 AS i FROM part)
       SELECT p_partkey, CAST(i // 500 AS BIGINT) AS batch_no, 'q' || (i % 500) AS query_id, 300 AS period, 'Average' AS stat FROM n""",
)
def metric_queries(spark, sf_dir):
    return _metric_queries(spark, sf_dir).select(
        "p_partkey", "batch_no", "query_id", "period", "stat"
    )


@query(
    "metric_points",
    """SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'Bytes/Second' WHEN 1 THEN 'Seconds' ELSE 'None' END AS unit,
         CAST(p_partkey * 1000 + 123 + p * 60000 AS BIGINT) AS epoch_ms, CASE p WHEN 0 THEN CAST(p_size AS DOUBLE) ELSE p_retailprice END AS value
       FROM part, (SELECT unnest([0, 1]) AS p) WHERE p_partkey % 10 <> 3 AND p_partkey % 50 <> 7""",
)
def metric_points(spark, sf_dir):
    asked = _metric_queries(spark, sf_dir)
    points, _ = builders.metric_points(_metric_results(asked), asked)
    return points.select("p_partkey", "unit", "epoch_ms", "value")


@query(
    "metric_strays",
    """WITH n AS (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) - 1 AS i FROM part)
       SELECT CAST(i // 500 AS BIGINT) AS batch_no, 'q99999' AS id, CAST(count(*) AS BIGINT) AS results
       FROM n WHERE p_partkey % 50 = 7 GROUP BY ALL""",
)
def metric_strays(spark, sf_dir):
    asked = _metric_queries(spark, sf_dir)
    _, stray = builders.metric_points(_metric_results(asked), asked)
    return stray.groupBy("batch_no", "id").agg(F.count(F.lit(1)).alias("results"))


@query(
    "gauge_group",
    """WITH n AS (SELECT *, row_number() OVER (ORDER BY p_partkey) - 1 AS i FROM part)
       SELECT CAST(i // 500 AS BIGINT) AS batch_no, 'q' || (i % 500) AS id, p_brand AS name,
         CASE p_partkey % 3 WHEN 0 THEN 'By/s' WHEN 1 THEN 's' ELSE '1' END AS unit,
         'Namespace=Shop;type=' || p_type AS attributes, 2 AS points,
         CAST(trunc((p_partkey + 0.1234::DOUBLE) * 1000000000.0::DOUBLE) AS BIGINT) AS first_nano
       FROM n WHERE p_partkey % 10 <> 3 AND p_partkey % 50 <> 7""",
)
def gauge_group(spark, sf_dir):
    asked = _metric_queries(spark, sf_dir)
    gauges = builders.gauge_group(
        _metric_results(asked), asked, "metric", "namespace", "dimensions"
    )
    pair = F.transform("attributes", lambda a: F.concat(a["name"], F.lit("="), a["value"]))
    return gauges.select(
        "batch_no",
        "id",
        "name",
        "unit",
        F.array_join(pair, ";").alias("attributes"),
        F.size("points").alias("points"),
        F.col("points")[0]["time_unix_nano"].alias("first_nano"),
    )


@query(
    "version_fold",
    """WITH n AS (SELECT p_brand, p_partkey, 'v' || (p_partkey % 61) AS v,
           CAST(json_object('Version', 'v' || (p_partkey % 61), 'size', p_size) AS VARCHAR) AS doc FROM part),
       l AS (SELECT *, row_number() OVER (PARTITION BY p_brand, v ORDER BY p_partkey DESC) = 1 AS latest FROM n)
       SELECT p_brand, '{"versions":[' || string_agg('"' || v || '"', ',' ORDER BY p_partkey) || '],"version_info":{'
         || string_agg('"' || v || '":' || doc, ',' ORDER BY p_partkey) FILTER (WHERE latest) || '}}' AS payload
       FROM l GROUP BY p_brand""",
)
def version_fold(spark, sf_dir):
    return builders.version_fold(
        _versions(spark, sf_dir), "p_brand", "p_partkey", "doc", span_bucket("p_partkey", 500)
    )


def _versions(spark, sf_dir):
    """A document for each part of a brand; versions come back."""
    version = F.concat(F.lit("v"), F.col("p_partkey") % 61)
    return table(spark, sf_dir, "part").select(
        "p_brand", "p_partkey", object_text({"Version": version, "size": F.col("p_size")}).alias("doc")
    )


@query(
    "version_fold_large",
    """SELECT p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS number, 'v' || (p_partkey % 61) AS version,
         p_size AS size, row_number() OVER (PARTITION BY p_brand, p_partkey % 61 ORDER BY p_partkey DESC) = 1 AS is_latest FROM part""",
)
def version_fold_large(spark, sf_dir):
    """The long form, which has no bound: a row for each document, numbered over small buckets."""
    rows = builders.version_rows(
        _versions(spark, sf_dir), "p_brand", "p_partkey", "doc", span_bucket("p_partkey", 20)
    )
    size = F.try_variant_get(F.try_parse_json("document"), "$.size", "int")
    return rows.select("p_brand", F.col("number").cast("bigint").alias("number"), "version", size.alias("size"), "is_latest")


@query(
    "metric_query_objects",
    """WITH n AS (SELECT p_partkey, p_brand, p_type, row_number() OVER (ORDER BY p_partkey) - 1 AS i FROM part)
       SELECT p_partkey, CAST(json_object('Id', 'q' || (i % 500), 'MetricStat', json_object('Metric', json_object('Namespace', 'Shop',
         'MetricName', p_brand, 'Dimensions', CASE WHEN p_partkey % 4 = 0 THEN json_array()
           ELSE json_array(json_object('Name', 'type', 'Value', p_type)) END), 'Period', 300, 'Stat', 'Average')) AS VARCHAR) AS query FROM n""",
)
def metric_query_objects(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(
        "p_partkey",
        "p_brand",
        F.when(
            F.col("p_partkey") % 4 != 0,
            F.array(F.struct(F.lit("type").alias("name"), F.col("p_type").alias("value"))),
        ).alias("dimensions"),
    )
    asked = builders.metric_queries(part, ["p_partkey"], bucket=span_bucket("p_partkey", 1000))
    text = builders.query_object(
        F.col("query_id"), F.lit("Shop"), F.col("p_brand"), F.col("dimensions"), F.col("period"), F.col("stat")
    )
    return asked.select("p_partkey", text.alias("query"))

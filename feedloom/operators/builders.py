"""Row builders: one source shape to the records that land."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.functions.json import (
    Field,
    as_column,
    bind,
    document,
    is_json,
    is_object,
    json_value,
    object_keys,
    object_members,
    object_text,
    put_fields,
    splice,
    variant_type,
)
from feedloom.functions.numbering import number_rows

# Field names written by the builders.
PARSE_ERROR = "_parse_error"
RAW_LINE = "_raw_line"
AUDIT_KEY = "CloudTrailEvent"

# Metric defaults.
METRIC_PERIOD = 300
METRIC_STAT = "Average"
METRIC_UNIT = "None"

# A fold of more bytes than this is no single record.
VERSION_BYTES = 256 << 20

# Metric units and their UCUM codes.
UCUM = {
    "None": "1",
    "Count": "{Count}",
    "Percent": "%",
    "Seconds": "s",
    "Milliseconds": "ms",
    "Microseconds": "us",
    "Bytes": "By",
    "Kilobytes": "kBy",
    "Megabytes": "MBy",
    "Gigabytes": "GBy",
    "Terabytes": "TBy",
    "Bits": "bit",
    "Kilobits": "kbit",
    "Megabits": "Mbit",
    "Gigabits": "Gbit",
    "Terabits": "Tbit",
    "Count/Second": "{Count}/s",
    "Bytes/Second": "By/s",
    "Kilobytes/Second": "kBy/s",
    "Megabytes/Second": "MBy/s",
    "Gigabytes/Second": "GBy/s",
    "Terabytes/Second": "TBy/s",
    "Bits/Second": "bit/s",
    "Kilobits/Second": "kbit/s",
    "Megabits/Second": "Mbit/s",
    "Gigabits/Second": "Gbit/s",
    "Terabits/Second": "Tbit/s",
}


def columnar_table(df: DataFrame, body: str) -> DataFrame:
    """`{columns:[{name}], rows:[[...]]}` to one object per row: `pos`, `payload`.

    A short row keeps what it has, a column without a name is skipped, and of two columns
    with one name the later wins.
    """
    out = bind(df, _value=json_value(F.col(body)))
    columns = F.try_variant_get("_value", "$.columns", "array<variant>")
    names = F.transform(columns, lambda c: F.try_variant_get(c, "$.name", "string"))
    rows = F.try_variant_get("_value", "$.rows", "array<variant>")
    out = bind(out, _names=names).select("*", F.posexplode(rows).alias("pos", "_row"))
    out = bind(out, _cells=F.try_variant_get("_row", "$", "array<variant>"))
    out = bind(out, _here=F.slice("_names", 1, F.size("_cells")))
    pairs = F.arrays_zip(F.col("_here").alias("key"), F.col("_cells").alias("value"))
    wanted = F.filter(
        pairs,
        lambda e, i: e["key"].isNotNull()
        & (F.array_position(F.reverse("_here"), e["key"]) == F.size("_here") - i),
    )
    return out.withColumn(
        "payload", F.to_json(F.map_from_entries(wanted), {"ignoreNullFields": "false"})
    ).drop("_value", "_names", "_row", "_cells", "_here")


def audit_event(df: DataFrame, payload: str = "payload", key: str = AUDIT_KEY) -> DataFrame:
    """The event nested under `key` (object or JSON string) becomes the row.

    When it is missing or unreadable the row stays, with the reason in a field of its own.
    """
    out = bind(df, _doc=document(F.col(payload)))
    out = bind(out, _inner=F.col("_doc")[key])
    kind = variant_type(F.col("_inner"))
    text = F.when(kind == "STRING", F.try_variant_get("_inner", "$", "string")).when(
        kind == "OBJECT", F.to_json("_inner")
    )
    out = bind(out, _text=text)
    reason = (
        F.when(F.col("_inner").isNull() | F.is_variant_null("_inner"), F.lit("missing"))
        .when(F.col("_text").isNull(), F.lit("not an object"))
        .when(~is_json(F.col("_text")), F.lit("bad JSON"))
        .when(~is_object(F.col("_text")), F.lit("not an object"))
    )
    out = bind(out, _reason=reason)
    row = (
        F.when(F.col("_doc").isNull(), F.raise_error(F.lit("row is not an object")))
        .when(F.col("_reason").isNull(), F.col("_text"))
        .otherwise(F.col(payload))
    )
    # Only a row that stays gets the field; its keys are known from the first parse.
    stays = F.when(F.col("_reason").isNotNull(), F.map_keys("_doc"))
    out = bind(out, **{payload: row}, _stays=stays)
    out = put_fields(out, payload, {PARSE_ERROR: F.col("_reason")}, keys=F.col("_stays"))
    return out.drop("_doc", "_inner", "_text", "_reason", "_stays")


def stamp_absent(df: DataFrame, fields: Mapping[str, Any], payload: str = "payload") -> DataFrame:
    """Add the fields an object does not have yet; NULL or an empty text is not set at all."""
    out = bind(df, _keys=object_keys(F.col(payload)))
    missing = F.concat_ws(
        ",",
        *[
            F.when(
                ~F.array_contains("_keys", name) & (as_column(value).cast("string") != ""),
                object_members({name: value}),
            )
            for name, value in fields.items()
        ],
    )
    out = bind(out, _missing=missing)
    row = F.when(
        F.col("_keys").isNull() | (F.col("_missing") == ""), F.col(payload)
    ).otherwise(splice(F.col(payload), F.col("_missing"), F.size("_keys") == 0))
    return bind(out, **{payload: row}).drop("_keys", "_missing")


def wrap_non_object(text: Column) -> Column:
    """Objects as they are, other JSON under `payload`, anything else as a raw line."""
    raw = object_text({RAW_LINE: text, PARSE_ERROR: "not JSON"})
    return (
        F.when(is_object(text), text)
        .when(is_json(text), F.concat(F.lit('{"payload":'), text, F.lit("}")))
        .otherwise(raw)
    )


def decode_message(
    df: DataFrame, c: str, subscription: Any, envelope_key: str = "_message"
) -> DataFrame:
    """Queue messages to records: `payload`, `ack_id`, `error`.

    Base64 data that is a JSON object becomes the record, other JSON goes under `payload`,
    text under `data`. Message facts go under one key. Bad base64 is an error.
    """
    out = bind(df, _m=json_value(F.col(c)))

    def fact(path: str, kind: str = "string") -> Column:
        return F.try_variant_get("_m", path, kind)

    encoded = F.coalesce(fact("$.message.data"), F.lit(""))
    out = bind(out, _bytes=F.try_to_binary(encoded, F.lit("base64")))
    out = bind(out, _data=F.make_valid_utf8(F.col("_bytes").cast("string")))
    record = (
        F.when(is_object(F.col("_data")), F.col("_data"))
        .when(is_json(F.col("_data")), F.concat(F.lit('{"payload":'), F.col("_data"), F.lit("}")))
        .otherwise(object_text({"data": F.col("_data")}))
    )
    out = bind(
        out,
        payload=F.when(F.col("_bytes").isNotNull(), record),
        ack_id=fact("$.ackId"),
        error=F.when(F.col("_bytes").isNull(), F.lit("bad base64")),
    )
    envelope = F.struct(
        as_column(subscription).alias("subscription"),
        fact("$.message.messageId").alias("message_id"),
        fact("$.message.publishTime").alias("publish_time"),
        fact("$.message.attributes", "map<string,string>").alias("attributes"),
        fact("$.message.orderingKey").alias("ordering_key"),
    )
    return put_fields(out, "payload", {envelope_key: envelope}).drop("_m", "_bytes", "_data")


def event_time(df: DataFrame, field: str, payload: str = "payload") -> DataFrame:
    """Copy a non-empty text field to `timestamp` unless that key is there (even as null)."""
    out = bind(df, _doc=document(F.col(payload)))
    out = bind(out, _time=Field(F.col("_doc"), field).text())
    copy = (F.col("_time") != "") & ~F.map_contains_key("_doc", F.lit("timestamp"))
    members = object_members({"timestamp": F.col("_time")})
    row = F.when(copy, splice(F.col(payload), members, F.lit(False))).otherwise(F.col(payload))
    return bind(out, **{payload: row}).drop("_doc", "_time")


# --- metrics ------------------------------------------------------------------------------


def _or_default(df: DataFrame, name: str, value: Any) -> Column:
    return F.coalesce(F.col(name), F.lit(value)) if name in df.columns else F.lit(value)


def query_object(
    query_id: Column, namespace: Column, metric: Column, dimensions: Column, period: Column, stat: Column
) -> Column:
    """The query a descriptor becomes, as JSON text; missing dimensions are an empty list."""
    listed = F.coalesce(
        F.transform(dimensions, lambda d: F.struct(d["name"].alias("Name"), d["value"].alias("Value"))),
        F.array().cast("array<struct<Name:string,Value:string>>"),
    )
    asked = F.struct(
        namespace.alias("Namespace"), metric.alias("MetricName"), listed.alias("Dimensions")
    )
    return F.to_json(
        F.struct(
            query_id.alias("Id"),
            F.struct(asked.alias("Metric"), period.alias("Period"), stat.alias("Stat")).alias("MetricStat"),
        )
    )


def metric_queries(
    descriptors: DataFrame,
    order: Sequence[str],
    batch: int = 500,
    bucket: Column | None = None,
    group: Sequence[str] = (),
) -> DataFrame:
    """Number descriptors into batches; inside one, `query_id` is `q<position>`."""
    numbered = number_rows(descriptors, order, group, bucket, out="_n")
    return (
        numbered.withColumn("batch_no", F.floor(F.col("_n") / batch).cast("bigint"))
        .withColumn("pos", (F.col("_n") % batch).cast("int"))
        .withColumn("query_id", F.concat(F.lit("q"), F.col("pos").cast("string")))
        .withColumn("period", _or_default(descriptors, "period", METRIC_PERIOD))
        .withColumn("stat", _or_default(descriptors, "stat", METRIC_STAT))
        .drop("_n")
    )


def _matched(results: DataFrame, queries: DataFrame) -> DataFrame:
    described = queries.withColumnRenamed("query_id", "id").withColumn("_known", F.lit(True))
    return results.join(described, ["batch_no", "id"], "left")


def metric_points(results: DataFrame, queries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(points of each descriptor, results that answer no query).

    A result names its query by position in the batch. `results` has `batch_no`, `id`,
    `timestamps` (seconds) and `values`.
    """
    joined = _matched(results, queries)
    if "unit" not in joined.columns:
        joined = joined.withColumn("unit", F.lit(None).cast("string"))
    points = joined.filter("_known").select(
        *[c for c in joined.columns if c not in ("timestamps", "values", "_known", "unit")],
        F.coalesce("unit", F.lit(METRIC_UNIT)).alias("unit"),
        F.explode(
            F.arrays_zip(F.col("timestamps").alias("t"), F.col("values").alias("v"))
        ).alias("_p"),
    )
    points = (
        points.withColumn("epoch_ms", F.round(F.col("_p.t") * 1000).cast("bigint"))
        .withColumn("value", F.col("_p.v"))
        .drop("_p")
    )
    stray = joined.filter(F.col("_known").isNull()).select("batch_no", "id")
    return points, stray


def ucum(unit: Column) -> Column:
    """UCUM code of a metric unit; an unknown unit has the code 1."""
    table = F.create_map(*[F.lit(x) for pair in UCUM.items() for x in pair])
    return F.coalesce(table[unit], F.lit("1"))


def gauge_group(
    results: DataFrame,
    queries: DataFrame,
    name: str,
    namespace: str,
    dimensions: str,
) -> DataFrame:
    """One gauge per answered descriptor: name, UCUM unit, `stat`, attributes and its points.

    All results of a descriptor make one gauge, its points by time; a descriptor's points are
    bounded by the window and period asked for. Dimensions without a name are left out, and a
    descriptor without points gives no row. Times are nanoseconds, cut and not rounded.
    """
    joined = _matched(results, queries).filter("_known")
    unit = _or_default(joined, "unit", METRIC_UNIT)
    named = F.filter(
        F.col(dimensions), lambda d: d["name"].isNotNull() & (d["name"] != "")
    )
    attributes = F.concat(
        F.array(F.struct(F.lit("Namespace").alias("name"), F.col(namespace).alias("value"))), named
    )
    points = F.transform(
        F.arrays_zip(F.col("timestamps").alias("t"), F.col("values").alias("v")),
        lambda p: F.struct(
            (p["t"] * 1_000_000_000.0).cast("bigint").alias("time_unix_nano"),
            p["v"].alias("value"),
        ),
    )
    return (
        joined.filter(F.size("timestamps") > 0)
        .groupBy("batch_no", "id")
        .agg(
            F.first(name).alias("name"),
            F.first(ucum(unit)).alias("unit"),
            F.first(_or_default(joined, "stat", METRIC_STAT)).alias("stat"),
            F.first(attributes).alias("attributes"),
            F.array_sort(F.flatten(F.collect_list(points))).alias("points"),
        )
    )


# --- folds --------------------------------------------------------------------------------


def version_rows(
    df: DataFrame,
    key: str,
    pos: str,
    doc: str,
    bucket: Column,
    version_at: str = "$.Version",
) -> DataFrame:
    """(key, number, version, document, is_latest) of every document, numbered in `pos` order.

    Of several documents of one version the last is `is_latest`. A document without a version is
    an error. `bucket` grows with `pos`, so no task holds one huge key.
    """
    version = F.try_variant_get(F.try_parse_json(doc), version_at, "string")
    known = F.when(
        version.isNull(), F.raise_error(F.lit("document without a version"))
    ).otherwise(version)
    numbered = number_rows(df.withColumn("version", known), [pos], [key], bucket, out="number")
    latest = Window.partitionBy(key, "version").orderBy(F.col("number").desc())
    return numbered.select(
        key,
        "number",
        "version",
        F.col(doc).alias("document"),
        (F.row_number().over(latest) == 1).alias("is_latest"),
    )


def version_fold(
    df: DataFrame,
    key: str,
    pos: str,
    doc: str,
    bucket: Column,
    max_bytes: int = VERSION_BYTES,
    version_at: str = "$.Version",
) -> DataFrame:
    """One `{versions, version_info}` record per key, from `version_rows`.

    `versions` lists every document, `version_info` the last document of each version. A key whose
    documents exceed `max_bytes` is an error before anything is gathered; its long form is there
    whatever the size.
    """
    rows = version_rows(df, key, pos, doc, bucket, version_at)
    sizes = rows.groupBy(F.col(key).alias("_of")).agg(
        F.sum(F.octet_length("document") + F.octet_length("version") + 8).alias("_bytes")
    )
    checked = rows.join(sizes, F.col(key).eqNullSafe(F.col("_of"))).withColumn(
        "document",
        F.when(
            F.col("_bytes") > max_bytes, F.raise_error(F.lit(f"documents of one key exceed {max_bytes} bytes"))
        ).otherwise(F.col("document")),
    )
    entry = F.struct("number", F.col("version").alias("v"), F.when(F.col("is_latest"), F.col("document")).alias("d"))
    folded = checked.groupBy(key).agg(F.array_sort(F.collect_list(entry)).alias("_all"))
    info = F.array_join(
        F.transform(
            F.filter("_all", lambda e: e["d"].isNotNull()),
            lambda e: F.concat(
                F.regexp_replace(F.to_json(F.array(e["v"])), r"^\[|\]$", ""), F.lit(":"), e["d"]
            ),
        ),
        ",",
    )
    return folded.select(
        key,
        F.concat(
            F.lit('{"versions":'),
            F.to_json(F.transform("_all", lambda e: e["v"])),
            F.lit(',"version_info":{'),
            info,
            F.lit("}}"),
        ).alias("payload"),
    )

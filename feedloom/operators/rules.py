"""Row rules: keep-filter, added fields, routing, splitting, stamping, topics."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.json import (
    Field,
    as_column,
    bind,
    is_array,
    is_json,
    is_object,
    object_keys,
    put_fields,
    with_document,
)
from feedloom.operators.unwrap import check_depth, finite_number, no_constant

# Names of the stamped metadata fields.
STAMP_FIELDS = (
    "_timestamp_fetcher",
    "_timestamp_received",
    "_source",
    "_source_fetcher",
    "_org_id",
)

BOM = "﻿"


def _truth(df: DataFrame, condition: Column) -> Column:
    """Boolean as is, a number keeps when it is not zero; unknown is false."""
    kind = df.select(condition.alias("c")).schema["c"].dataType.typeName()
    test = condition if kind in ("boolean", "void") else condition != 0
    return F.coalesce(test, F.lit(False))


def keep(df: DataFrame, condition: Column, doc: str = "_doc") -> DataFrame:
    """Keep rows whose condition holds; rows that are not JSON objects pass untouched."""
    return df.filter(F.col(doc).isNull() | _truth(df, condition))


def keep_flag(df: DataFrame, condition: Column, doc: str = "_doc") -> Column:
    """The verdict of `keep` as a column, for counting what a filter removes."""
    return F.col(doc).isNull() | _truth(df, condition)


def add_fields(df: DataFrame, fields: Mapping[str, Any], payload: str = "payload") -> DataFrame:
    """Set constant or computed fields; a colliding value is parked, never lost."""
    return put_fields(df, payload, fields)


@dataclass(frozen=True)
class RouteRule:
    """First match wins: `field` (dotted path) equals `equals` as text."""

    field: str
    equals: str
    destinations: tuple[str, ...]


def route(
    df: DataFrame,
    rules: Sequence[RouteRule],
    source: str,
    payload: str = "payload",
    doc: str | None = None,
) -> DataFrame:
    """Add `route_index`, `destinations` (NULL = defaults) and `source`.

    A route to exactly one destination renames the source to it; fan-out keeps it.
    """
    working = doc or "_doc"
    out = df if doc else with_document(df, payload)
    index = F.lit(None).cast("int")
    for i in range(len(rules) - 1, -1, -1):
        hit = Field(F.col(working), rules[i].field).as_text() == F.lit(rules[i].equals)
        index = F.when(hit, F.lit(i)).otherwise(index)
    out = bind(out, route_index=index)
    targets = F.lit(None).cast("array<string>")
    for i, rule in enumerate(rules):
        targets = F.when(
            F.col("route_index") == i, F.array(*[F.lit(d) for d in rule.destinations])
        ).otherwise(targets)
    out = out.withColumn("destinations", targets).withColumn(
        "source",
        F.when(F.size("destinations") == 1, F.get("destinations", F.lit(0))).otherwise(F.lit(source)),
    )
    return out if doc else out.drop(working)


def unit_topic(
    base: Any, unit: Any, is_dump: Any, per_dump_unit: bool = True, suffix: str = "_land"
) -> Column:
    """Topic of a unit's rows: a dump has its own topic unless told otherwise."""
    own = F.concat(as_column(base), F.lit("-"), as_column(unit))
    name = F.when(as_column(is_dump), own).otherwise(as_column(base)) if per_dump_unit else (
        as_column(base)
    )
    return F.concat(name, F.lit(suffix))


def topic_source(topic: Column, suffix: str = "_land") -> Column:
    """Source of a topic: the topic without its suffix."""
    cut = topic.substr(F.lit(1), F.length(topic) - len(suffix))
    return F.when(topic.endswith(suffix), cut).otherwise(topic)


def fan_out_rows(
    df: DataFrame,
    defaults: Sequence[str],
    topics: Mapping[str, str] | None = None,
    suffix: str = "_land",
) -> DataFrame:
    """One row per destination, with the destination's own topic or the record's."""
    chosen = F.coalesce("destinations", F.array(*[F.lit(d) for d in defaults]))
    out = df.withColumn("destination", F.explode(chosen))
    own = F.lit(None).cast("string")
    for name, topic in (topics or {}).items():
        own = F.when(F.col("destination") == name, F.lit(topic)).otherwise(own)
    return out.withColumn(
        "out_topic", F.concat(F.coalesce(own, F.col("topic")), F.lit(suffix))
    )


def without_bom(payload: Column) -> Column:
    return F.when(payload.startswith(BOM), payload.substr(F.lit(2), F.length(payload))).otherwise(
        payload
    )


def tenancy(payload: Column) -> Column:
    """Stamped: an object. Refused: opens like an object but is not one. Else Unstamped."""
    body = F.ltrim(without_bom(payload))
    return (
        F.when(body.startswith("{") & is_json(body), F.lit("Stamped"))
        .when(body.startswith("{"), F.lit("Refused"))
        .otherwise(F.lit("Unstamped"))
    )


def stamp(
    df: DataFrame,
    source: Any,
    source_fetcher: Any,
    org: Any,
    fetched_ms: Any,
    received_ms: Any,
    payload: str = "payload",
    keys: Column | None = None,
) -> DataFrame:
    """Add the five metadata fields to object rows and a `tenancy` column to all.

    Times are epoch milliseconds given by the caller once per run, so a re-run of a lost
    task writes the same bytes. Unstamped and refused bodies keep their bytes. `keys` are
    the top-level keys where the caller has parsed the row already (NULL: not an object).
    """
    values = (fetched_ms, received_ms, source, source_fetcher, org)
    body = without_bom(F.col(payload))
    out = bind(df, _found=object_keys(body) if keys is None else keys)
    is_object_row = F.col("_found").isNotNull()
    status = (
        F.when(is_object_row, F.lit("Stamped"))
        .when(F.ltrim(body).startswith("{"), F.lit("Refused"))
        .otherwise(F.lit("Unstamped"))
    )
    out = out.withColumns(
        {"tenancy": status, payload: F.when(is_object_row, body).otherwise(F.col(payload))}
    )
    named = dict(zip(STAMP_FIELDS, values))
    return put_fields(out, payload, named, keys=F.col("_found")).drop("_found")


@F.pandas_udf(T.ArrayType(T.StringType()))
def _following_objects(bodies: pd.Series) -> pd.Series:
    """Texts of the JSON objects a body consists of; NULL when there is anything else."""
    decoder = json.JSONDecoder(parse_float=finite_number, parse_constant=no_constant)

    def cut(text: str | None) -> list[str] | None:
        if text is None:
            return None
        parts, at = [], 0
        while at < len(text):
            if text[at].isspace():
                at += 1
                continue
            try:
                value, end = decoder.raw_decode(text, at)
                check_depth(value, text[at:end])
            except (ValueError, RecursionError):
                return None
            if not isinstance(value, dict):
                return None
            parts.append(text[at:end])
            at = end
        return parts

    return bodies.map(cut)


def split_body(df: DataFrame, body: str = "payload", pretty: bool = True) -> DataFrame:
    """One row per record of a body, with `part`, `is_last` and `ingested_bytes`.

    Splits an array of only objects (`[]` gives no row) and objects that follow one another
    with a line break between. If any part is not an object the whole body stays one row.
    The mark belongs to the row with `is_last`. Objects over several lines need a scanner in
    Python, which gets those bodies only; `pretty=False` leaves it out of the plan.
    """
    text = F.col(body)
    items = F.from_json(text, "array<string>", {"allowSingleQuotes": "false"})
    lines = F.filter(F.transform(F.split(text, "\n"), F.trim), lambda s: F.length(s) > 0)
    out = bind(
        df,
        _items=F.when(is_array(text), items),
        _lines=F.when(F.ltrim(text).startswith("{") & F.rtrim(text).contains("\n"), lines),
    )
    parts = (
        F.when(F.forall("_items", is_object), F.col("_items"))
        .when((F.size("_lines") > 1) & F.forall("_lines", is_object), F.col("_lines"))
        .otherwise(F.array(text))
    )
    out = bind(out, _parts=parts).drop("_items")
    if pretty:
        rest = F.col("_lines").isNotNull() & (F.size("_parts") == 1) & ~is_object(text)
        out = out.withColumn("_scan", _following_objects(F.when(rest, text))).withColumn(
            "_parts", F.when(F.size("_scan") > 1, F.col("_scan")).otherwise(F.col("_parts"))
        ).drop("_scan")
    out = out.drop("_lines")
    return (
        out.select("*", F.posexplode("_parts").alias("part", "_part"))
        .withColumn("is_last", F.col("part") == F.size("_parts") - 1)
        .withColumn(body, F.col("_part"))
        .withColumn("ingested_bytes", F.octet_length(body).cast("bigint"))
        .drop("_part", "_parts")
    )


def apart_binary(df: DataFrame, content: str = "content") -> tuple[DataFrame, DataFrame]:
    """(json rows, binary rows): binary rows skip every row rule and stay byte-identical."""
    return df.filter(F.col(content) == "json"), df.filter(F.col(content) == "binary")


def refuse_binary_dumps(df: DataFrame, content: str = "content", shape: str = "shape") -> DataFrame:
    """A binary dump cannot be framed: raise instead of writing a broken snapshot."""
    bad = (F.col(content) == "binary") & (F.col(shape) == "dump")
    return df.withColumn(
        content,
        F.when(bad, F.raise_error(F.lit("a dump cannot carry binary rows"))).otherwise(
            F.col(content)
        ),
    )


__all__ = [
    "Field",
    "RouteRule",
    "add_fields",
    "apart_binary",
    "fan_out_rows",
    "keep",
    "keep_flag",
    "refuse_binary_dumps",
    "route",
    "split_body",
    "stamp",
    "tenancy",
    "topic_source",
    "unit_topic",
    "without_bom",
]

"""Bodies to rows: every framing becomes one JSON record per row."""

from __future__ import annotations

import csv
import json
import re
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.json import (
    _STRICT,
    array_items,
    at_pointer,
    bind,
    json_value,
    let,
    object_text,
    variant_type,
)
from feedloom.session import bounded_batches

# A text value that begins like an object.
OBJECT_IN_TEXT = r'"(?:\s|\\[nrtbf]|\\u00[012][0-9a-fA-F])*(?:\{|\\u007[bB])'

GZIP_MAGIC = b"\x1f\x8b"
# Unpacked bytes that a task hands back at once; a longer body is a batch of its own.
INFLATED_BYTES = 4 << 20


def _trimmed(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def _texts(value: Column) -> Column:
    """JSON text of each element of a variant array; NULL for any other variant."""
    return F.transform(array_items(value), lambda x: F.to_json(x))


def element_texts(body: Column) -> Column:
    """JSON text of each element of a top-level array; NULL when the array is incomplete.

    An array of objects is cut as text, with one parse. In any other array a text could be taken
    for the object it looks like, so elements are rendered from variants.
    """
    cut = F.from_json(F.concat(F.lit("["), body, F.lit(",[]]")), "array<array<string>>", _STRICT)
    objects = let(
        F.when(~body.rlike(OBJECT_IN_TEXT), cut),
        lambda parts: F.when(
            (F.size(parts) == 2)
            & (F.size(F.get(parts, F.lit(1))) == 0)
            & F.forall(F.get(parts, F.lit(0)), lambda e: e.startswith("{")),
            F.get(parts, F.lit(0)),
        ),
    )
    return let(objects, lambda found: F.coalesce(found, _texts(json_value(body))))


def decode_ndjson(df: DataFrame, body: str, max_row_bytes: int | None = None) -> DataFrame:
    """One row per non-blank line, trimmed; a line over the bound fails the read."""
    out = df.select("*", F.explode(F.split(body, "\n")).alias("_line"))
    out = bind(out, payload=_trimmed(F.col("_line"))).drop("_line")
    return fail_long_rows(out.filter(F.col("payload") != ""), "payload", max_row_bytes)


def fail_long_rows(df: DataFrame, c: str, max_row_bytes: int | None) -> DataFrame:
    if max_row_bytes is None:
        return df
    return df.withColumn(
        c,
        F.when(
            F.octet_length(c) > max_row_bytes,
            F.raise_error(F.lit(f"row longer than {max_row_bytes} bytes")),
        ).otherwise(F.col(c)),
    )


def explode_array(df: DataFrame, body: str, strict: bool = True) -> DataFrame:
    """One row per element of a top-level array, with `pos`; anything else is an error.

    With `strict=False` a bad body gives one row with `error` set and no payload.
    """
    out = bind(df, _items=element_texts(F.col(body)))
    problem = F.when(F.col("_items").isNull(), F.lit("not a complete JSON array"))
    return _explode_items(out, problem, strict)


def rows_at(
    df: DataFrame, body: str, pointer: str, when_absent: str = "fail", strict: bool = False
) -> DataFrame:
    """Rows of the array at a JSON pointer: `pos`, `payload`, `error`.

    A `null` there is an empty page. A pointer that leads nowhere is an error or an empty
    page (`when_absent`). Anything that is not an array is an error.
    """
    if when_absent not in ("fail", "empty"):
        raise ValueError("when_absent is 'fail' or 'empty'")
    out = bind(df, _value=json_value(F.col(body)))
    out = bind(out, _at=at_pointer(F.col("_value"), pointer))
    out = bind(out, _items=_texts(F.col("_at")))
    absent = F.col("_at").isNull()
    problem = F.when(F.col("_value").isNull(), F.lit("body is not JSON")).when(
        F.col("_items").isNull() & ~absent & ~F.is_variant_null("_at"),
        F.lit("pointer does not lead to an array"),
    )
    if when_absent == "fail":
        problem = problem.when(absent, F.lit("pointer leads nowhere"))
    out = (
        out.withColumn("_problem", problem)
        .withColumn("_items", F.coalesce("_items", F.array().cast("array<string>")))
        .drop("_value", "_at")
    )
    return _explode_items(out, F.col("_problem"), strict).drop("_problem")


def _explode_items(df: DataFrame, problem: Column, strict: bool) -> DataFrame:
    out = df.withColumn("error", problem)
    if strict:
        listed = F.when(F.col("error").isNotNull(), F.raise_error(F.col("error"))).otherwise(
            F.col("_items")
        )
        return out.select("*", F.posexplode(listed).alias("pos", "payload")).drop(
            "_items", "error"
        )
    listed = F.when(
        F.col("error").isNotNull(), F.array(F.lit(None).cast("string"))
    ).otherwise(F.col("_items"))
    return out.select("*", F.posexplode(listed).alias("pos", "payload")).drop("_items")


def decode_document(df: DataFrame, body: str) -> DataFrame:
    """The whole body is one row; a blank body gives none."""
    return df.withColumn("payload", _trimmed(F.col(body))).filter(F.col("payload") != "")


def decode_json(df: DataFrame, body: str) -> DataFrame:
    """An array gives its elements, any other body one row, a blank body none."""
    text = _trimmed(F.col(body))
    out = bind(df, _text=text).filter(F.col("_text") != "")
    array = F.col("_text").startswith("[")
    items = F.when(array, element_texts(F.col("_text"))).otherwise(F.array("_text"))
    out = bind(out, _items=items).drop("_text")
    problem = F.when(F.col("_items").isNull(), F.lit("not a complete JSON array"))
    return _explode_items(out, problem, strict=True)


def wrap_line(text: Column) -> Column:
    """A text line as `{"line": ...}`."""
    return object_text({"line": _trimmed(text)})


def decode_lines(df: DataFrame, body: str) -> DataFrame:
    """Each non-blank trimmed line of a text body, wrapped."""
    return decode_ndjson(df, body).withColumn("payload", wrap_line(F.col("payload")))


def unquote(text: Column) -> Column:
    """The row held in a JSON string; anything but a string is an error."""
    return let(
        json_value(text),
        lambda value: F.when(
            variant_type(value) == "STRING", F.try_variant_get(value, "$", "string")
        ).otherwise(F.raise_error(F.lit("quoted row is not a JSON string"))),
    )


def decoder_of(path: Column) -> Column:
    """`ndjson`, `json` or `csv` by extension, of any case, below an optional lower-case `.gz`."""
    bare = F.lower(F.regexp_replace(path, r"\.gz$", ""))
    return (
        F.when(bare.rlike(r"\.(jsonl|ndjson)$"), F.lit("ndjson"))
        .when(bare.endswith(".json"), F.lit("json"))
        .when(bare.endswith(".csv"), F.lit("csv"))
        .otherwise(F.raise_error(F.concat(F.lit("no decoder for "), path)))
    )


def bound_lines(df: DataFrame, c: str, max_bytes: int) -> tuple[DataFrame, DataFrame]:
    """(lines within the bound, lines refused); count the second to report the loss."""
    long = F.octet_length(c) > max_bytes
    return df.filter(~long), df.filter(long)


# --- CSV and gzip: the two framings Spark has no expression for --------------------------


_CSV_STOP = re.compile("[,\r\n]")


def csv_fields(text: str) -> Iterator[list[str]]:
    """Fields of the records of a CSV text, blank lines left out, as `csv.reader` gives them in strict mode.

    A quoted field is found by its end and not character by character, as fields may be long.
    """
    at, size = 0, len(text)
    while at < size:
        if text[at] in "\r\n":
            at += 1
            continue
        fields: list[str] = []
        while True:
            if text.startswith('"', at):
                begin = end = at + 1
                while (end := text.find('"', end)) >= 0 and text.startswith('"', end + 1):
                    end += 2
                if end < 0:
                    raise csv.Error("unexpected end of data")
                fields.append(text[begin:end].replace('""', '"'))
                at = end + 1
                if at < size and text[at] not in ",\r\n":
                    raise csv.Error("',' expected after '\"'")
            else:
                stop = _CSV_STOP.search(text, at)
                end = stop.start() if stop else size
                fields.append(text[at:end])
                at = end
            if at >= size or text[at] != ",":
                break
            at += 1
        yield fields


def csv_records(text: str, header: bool = True) -> Iterator[str]:
    """JSON records of a CSV text; every value a string.

    A field beyond the header, or without one, is `col_<i>`, counted from 0; a short row keeps
    what it has. A field may be as long as its text.
    """
    names: list[str] | None = None
    for fields in csv_fields(text):
        if header and names is None:
            names = fields
            continue
        known = names or []
        record = {
            known[i] if i < len(known) else f"col_{i}": value for i, value in enumerate(fields)
        }
        yield json.dumps(record, ensure_ascii=False, separators=(",", ":"))


def decode_csv(df: DataFrame, body: str, header: bool = True) -> DataFrame:
    """Rows of CSV bodies, ragged ones included: `pos`, `payload`, `error`.

    A body that stops being CSV gives the rows before that place, then one row with `error`.
    """
    bounded_batches(df.sparkSession)

    @F.pandas_udf("struct<rows:array<string>,error:string>")
    def parse(bodies: pd.Series) -> pd.DataFrame:
        rows: list[list[str]] = []
        errors: list[str | None] = []
        for text in bodies:
            good: list[str] = []
            problem = None
            try:
                good.extend(csv_records(text or "", header))
            except csv.Error as error:
                problem = str(error)
            rows.append(good)
            errors.append(problem)
        return pd.DataFrame({"rows": rows, "error": errors})

    nothing = F.lit(None).cast("string")
    good = F.transform(
        F.col("_csv.rows"),
        lambda r, i: F.struct(i.alias("pos"), r.alias("payload"), nothing.alias("error")),
    )
    bad = F.struct(
        F.lit(None).cast("int").alias("pos"), nothing.alias("payload"), F.col("_csv.error").alias("error")
    )
    every = F.when(F.col("_csv.error").isNull(), good).otherwise(F.concat(good, F.array(bad)))
    rest = [F.col(f"`{c}`") for c in df.columns if c not in ("pos", "payload", "error")]
    return df.withColumn("_csv", parse(F.col(body))).select(*rest, F.inline(every))


def gunzip(data: bytes) -> bytes:
    """All members of a gzip sequence; bytes without the magic pass through."""
    if not data.startswith(GZIP_MAGIC):
        return data
    out = []
    while data:
        inflater = zlib.decompressobj(wbits=31)
        out.append(inflater.decompress(data))
        if not inflater.eof:
            raise EOFError("truncated gzip member")
        data = inflater.unused_data.lstrip(b"\0")
    return b"".join(out)


def _inflated(content: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's function that inflates a column and adds `error`, in batches of bounded bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(content)
            begin, bodies, errors, size = 0, [], [], 0
            for i, data in enumerate(batch.column(at)):
                try:
                    bodies.append(gunzip(data.as_py()) if data.is_valid else None)
                    errors.append(None)
                except (EOFError, zlib.error) as problem:
                    bodies.append(None)
                    errors.append(str(problem))
                size += len(bodies[-1] or b"")
                # a body may be far longer than what it was packed in
                if size >= INFLATED_BYTES or i + 1 == batch.num_rows:
                    columns = batch.slice(begin, i + 1 - begin).columns
                    columns[at] = pa.array(bodies, pa.binary())
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(errors, pa.string())], names=[*batch.schema.names, "error"])
                    begin, bodies, errors, size = i + 1, [], [], 0

    return run


def inflate(df: DataFrame, content: str) -> DataFrame:
    """Inflate a binary column by its magic, whatever the name says; adds `error`."""
    schema = T.StructType(
        [f for f in df.schema.fields] + [T.StructField("error", T.StringType())]
    )

    bounded_batches(df.sparkSession)
    return df.mapInArrow(_inflated(content), schema)

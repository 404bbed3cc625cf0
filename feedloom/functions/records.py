"""Typed rows as JSON records, with the text forms each kind of store lands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PROFILES = ("odbc", "hana", "extjson")

# Fixed value: a decimal of more digits than this is landed as text by the `hana` profile.
HANA_NUMBER_DIGITS = 15


def _fraction(text: Column) -> Column:
    """Drop a fraction of zeros and the point before it."""
    return F.regexp_replace(text, r"\.0+$", "")


def _timestamp(c: Column, zone: str) -> Column:
    body = F.concat(
        F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"),
        _fraction(F.concat(F.lit("."), F.date_format(c, "SSSSSS"))),
    )
    return F.concat(body, F.lit(zone))


def _float_text(c: Column) -> Column:
    return (
        F.when(F.isnan(c), F.lit("NaN"))
        .when(c.cast("double") == float("inf"), F.lit("inf"))
        .when(c.cast("double") == float("-inf"), F.lit("-inf"))
    )


def landed(c: Column, kind: T.DataType, profile: str = "odbc") -> Column:
    """One column in the form it has inside a record."""
    if profile not in PROFILES:
        raise ValueError(f"unknown profile {profile!r}")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        if profile == "extjson":
            millis = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
            return F.when(c.isNotNull(), F.struct(millis.alias("$date")))
        return _timestamp(c, "" if profile == "hana" else "Z")
    if isinstance(kind, T.DateType):
        text = F.date_format(c, "yyyy-MM-dd")
        if profile == "extjson":
            return F.when(
                c.isNotNull(), F.struct(F.concat(text, F.lit("T00:00:00.000Z")).alias("$date"))
            )
        return text
    if isinstance(kind, T.BinaryType):
        # Spark's base64 breaks long lines; a record carries one unbroken text.
        text = F.regexp_replace(F.base64(c), r"[\r\n]", "")
        if profile == "extjson":
            inner = F.struct(text.alias("base64"), F.lit("00").alias("subType"))
            return F.when(c.isNotNull(), F.struct(inner.alias("$binary")))
        return text
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        special = _float_text(c)
        return F.when(special.isNotNull(), special.cast("variant")).otherwise(c.cast("variant"))
    if isinstance(kind, T.DecimalType) and profile == "hana":
        digits = F.length(F.regexp_replace(F.abs(c).cast("string"), r"^0+\.?0*|\.", ""))
        whole = (c == F.floor(c)) & c.try_cast("bigint").isNotNull()
        number = F.coalesce(whole, F.lit(False)) | (digits <= HANA_NUMBER_DIGITS)
        return F.when(number, c.cast("variant")).otherwise(c.cast("string").cast("variant"))
    return c


def to_record(df: DataFrame, profile: str = "odbc", columns: Sequence[str] | None = None) -> Column:
    """All (or the named) columns as one JSON record; NULL stays as an explicit `null`."""
    names = list(columns) if columns is not None else df.columns
    packed = F.struct(
        *[landed(F.col(f"`{n}`"), df.schema[n].dataType, profile).alias(n) for n in names]
    )
    return F.to_json(packed, {"ignoreNullFields": "false"})


def cap_values(
    df: DataFrame, max_text_bytes: int, max_binary_bytes: int, columns: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(rows within the caps, rows over them with `too_large` naming the columns).

    A value over its cap fails; nothing is cut.
    """
    names = list(columns) if columns is not None else df.columns
    tests = []
    for name in names:
        kind = df.schema[name].dataType
        if isinstance(kind, T.StringType):
            cap = max_text_bytes
        elif isinstance(kind, T.BinaryType):
            cap = max_binary_bytes
        else:
            continue
        tests.append(F.when(F.octet_length(F.col(f"`{name}`")) > cap, F.lit(name)))
    over = F.array_compact(F.array(*tests)) if tests else F.array().cast("array<string>")
    marked = df.withColumn("too_large", over)
    return (
        marked.filter(F.size("too_large") == 0).drop("too_large"),
        marked.filter(F.size("too_large") > 0),
    )

"""Listings of files and objects, and where a read may start and must stop."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.json import as_column

# Fixed value: how long an object must have rested when open uploads cannot be listed.
SETTLE_SECS = 300

LISTING_XML = T.StructType(
    [
        T.StructField(
            "Contents",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("Key", T.StringType()),
                        T.StructField("LastModified", T.StringType()),
                        T.StructField("Size", T.LongType()),
                    ]
                )
            ),
        ),
        T.StructField("NextContinuationToken", T.StringType()),
    ]
)


def encode_path(key: Column) -> Column:
    """Percent-encode each segment of an object key; the slashes stay."""
    encoded = F.transform(F.split(key, "/"), F.url_encode)
    text = F.array_join(encoded, "/")
    for wrong, right in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        text = F.replace(text, F.lit(wrong), F.lit(right))
    return text


def past(position: Column, key: Column, after: Column, after_key: Column) -> Column:
    """`(position, key)` strictly past a marker."""
    return (position > after) | ((position == after) & (key > after_key))


def list_objects(
    df: DataFrame,
    cutoff: tuple[Any, Any] | None = None,
    horizon: tuple[Any, Any] | None = None,
    position: str = "last_modified",
    key: str = "key",
) -> DataFrame:
    """Objects strictly past the cutoff and strictly before the horizon.

    Cutoff and horizon are `(time, key)`; a horizon without a key stops at the time. Order
    the result by `(position, key)` to read it in sequence.
    """
    kind = df.schema[position].dataType
    out = df
    if cutoff is not None:
        after = as_column(cutoff[0]).cast(kind)
        out = out.filter(
            (F.col(position) >= after)
            & past(F.col(position), F.col(key), after, as_column(cutoff[1]))
        )
    if horizon is not None:
        until, until_key = as_column(horizon[0]).cast(kind), as_column(horizon[1])
        before = (F.col(position) < until) | F.coalesce(
            (F.col(position) == until) & (F.col(key) < until_key), F.lit(False)
        )
        out = out.filter((F.col(position) <= until) & before)
    return out.withColumn("path", encode_path(F.col(key)))


def cut_with_ties(
    df: DataFrame, n: int, position: str, key: str, by: list[str] | None = None
) -> DataFrame:
    """The first `n` rows, and all that share the position of the last; 0 cuts nothing."""
    if n == 0:
        return df
    if by:
        ranked = Window.partitionBy(*by).orderBy(position)
        return df.withColumn("_r", F.rank().over(ranked)).filter(F.col("_r") <= n).drop("_r")
    border = df.orderBy(position, key).limit(n).agg(F.max(position))
    return df.filter(F.col(position) <= border.scalar())


def upload_horizon(
    uploads: DataFrame | None,
    answered_at: Any,
    spark: Any = None,
    settle_secs: int = SETTLE_SECS,
) -> DataFrame:
    """One row `(at, key)`: the earliest open upload if before the answer, else the answer.

    Where uploads cannot be listed, the answer time less the settling time.
    """
    answer = as_column(answered_at).cast("timestamp")
    nobody = F.lit(None).cast("string")
    if uploads is None:
        return spark.range(1).select(
            (answer - F.make_dt_interval(secs=F.lit(settle_secs))).alias("at"), nobody.alias("key")
        )
    first = uploads.agg(
        F.min(F.struct(F.col("initiated").cast("timestamp").alias("at"), "key")).alias("u")
    )
    early = F.coalesce(F.col("u.at") < answer, F.lit(False))
    return first.select(
        F.when(early, F.col("u.at")).otherwise(answer).alias("at"),
        F.when(early, F.col("u.key")).otherwise(nobody).alias("key"),
    )


def parse_listing(df: DataFrame, xml: str) -> DataFrame:
    """Objects of XML listing pages: `key`, `last_modified`, `size`, and the page's `token`."""
    parsed = df.withColumn("_page", F.from_xml(xml, LISTING_XML))
    out = parsed.withColumn("token", F.col("_page.NextContinuationToken")).select(
        "*", F.explode("_page.Contents").alias("_o")
    )
    return (
        out.withColumn("key", F.col("_o.Key"))
        .withColumn("last_modified", F.to_timestamp("_o.LastModified"))
        .withColumn("size", F.col("_o.Size"))
        .drop("_page", "_o")
    )


def order_listing(df: DataFrame, marker: tuple[Any, str] | None = None) -> DataFrame:
    """Candidates strictly past the marker, each path once at its latest change time.

    Sort by `(position, path)` where the order matters; a file changed in place has a new
    position and so comes again.
    """
    latest = df.groupBy("path").agg(
        F.max_by(F.struct("position", "size"), F.struct("position", "size")).alias("_l")
    )
    out = latest.select("path", F.col("_l.position").alias("position"), F.col("_l.size").alias("size"))
    if marker is None:
        return out
    after = as_column(marker[0]).cast(out.schema["position"].dataType)
    return out.filter(past(F.col("position"), F.col("path"), after, F.lit(marker[1])))


def sound_prefix(rows: DataFrame, position: str = "position", path: str = "path") -> DataFrame:
    """Rows of the files before the first file with an error, in `(position, path)` order.

    A bad file fails only from itself on: the files before it stay complete.
    """
    at = F.struct(F.col(position).alias("p"), F.col(path).alias("f"))
    first_bad = rows.filter(F.col("error").isNotNull()).agg(F.min(at))
    border = first_bad.scalar()
    return rows.filter(border.isNull() | (at < border)).drop("error")

"""Tick reports, usage per organisation, error classes, limit counters, quotas."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.operators.paging import header


def tick_report(df: DataFrame, by: Sequence[str], kept: str, size: str) -> DataFrame:
    """Per key: rows and bytes that passed, and rows a filter removed."""
    ok = F.col(kept)
    return df.groupBy(*by).agg(
        F.count_if(ok).alias("rows"),
        F.coalesce(F.sum(F.when(ok, F.col(size))), F.lit(0)).alias("bytes"),
        F.count_if(~ok).alias("filtered"),
    )


def usage_by_org(
    df: DataFrame,
    org: str = "org_id",
    tenancy: str = "tenancy",
    outcome: str = "outcome",
    frame: str = "frame",
    size: str = "ingested_bytes",
    default_org: str = "default",
) -> DataFrame:
    """Fetched bytes of delivered rows per organisation.

    Unstamped rows bill the default organisation; dead-lettered and dropped rows, snapshot
    markers and oversize stubs bill nobody.
    """
    billed = (F.col(outcome) == "sent") & (F.col(frame) == "row")
    owner = F.when(F.col(tenancy) == "Stamped", F.col(org)).otherwise(F.lit(default_org))
    return (
        df.filter(billed)
        .groupBy(owner.alias("org_id"))
        .agg(F.sum(size).alias("usage_bytes"), F.count(F.lit(1)).alias("rows"))
    )


def error_class(
    status: Column, kind: Column, text: Column | None = None, throttled: Column | None = None
) -> Column:
    """Class of a failed call; NULL when it succeeded.

    Failures that never were an answer have a kind; one that is no class by itself is a timeout
    if its kind or text says so, else a network failure. An answer counts by its status, a
    declared throttle first; a 503 that says SlowDown throttles as well, and a status that is
    neither 4xx nor 5xx nor a success is a network failure.
    """
    said = F.coalesce(text if text is not None else F.lit(None).cast("string"), F.lit(""))
    declared = F.coalesce(throttled if throttled is not None else F.lit(False), F.lit(False))
    slow = F.lower(F.concat_ws(" ", kind, said)).rlike("timed out|timeout")
    return (
        F.when(kind.isin("origin_refused", "oversize_page", "page_ceiling"), kind)
        .when(status.between(200, 299), F.lit(None))
        .when(status.isNotNull() & declared, F.lit("throttle"))
        .when((status == 429) | ((status == 503) & said.contains("SlowDown")), F.lit("throttle"))
        .when(status == 408, F.lit("timeout"))
        .when(status.between(400, 499), F.lit("4xx"))
        .when(status.between(500, 599), F.lit("5xx"))
        .when(status.isNotNull(), F.lit("network"))
        .when((kind.isNotNull() | (said != "")) & slow, F.lit("timeout"))
        .when(kind.isNotNull() | (said != ""), F.lit("network"))
    )


def error_rollup(
    df: DataFrame,
    by: Sequence[str],
    status: str,
    kind: str,
    text: str | None = None,
    throttled: str | None = None,
) -> DataFrame:
    """Failed calls counted by class."""
    said = F.col(text) if text else None
    declared = F.col(throttled) if throttled else None
    return (
        df.withColumn("error_class", error_class(F.col(status), F.col(kind), said, declared))
        .filter(F.col("error_class").isNotNull())
        .groupBy(*by, "error_class")
        .agg(F.count(F.lit(1)).alias("calls"))
    )


def limit_counters(
    sequences: DataFrame | None = None,
    manifest: DataFrame | None = None,
    spans: DataFrame | None = None,
    tails: DataFrame | None = None,
) -> DataFrame:
    """One row per limit: pages truncated, items skipped, windows narrowed, full tail pages."""
    parts = []
    if sequences is not None:
        parts.append(
            sequences.agg(F.count_if(F.col("status") == "cut").alias("n")).select(
                F.lit("pages_truncated").alias("limit_name"), "n"
            )
        )
    if manifest is not None:
        parts.append(
            manifest.agg(F.coalesce(F.sum("skipped"), F.lit(0)).alias("n")).select(
                F.lit("items_skipped").alias("limit_name"), "n"
            )
        )
    if spans is not None:
        parts.append(
            spans.agg(F.count_if(F.col("narrowed")).alias("n")).select(
                F.lit("windows_narrowed").alias("limit_name"), "n"
            )
        )
    if tails is not None:
        parts.append(
            tails.agg(F.coalesce(F.sum("full_pages"), F.lit(0)).alias("n")).select(
                F.lit("full_tail_pages").alias("limit_name"), "n"
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def header_number(headers: Column, name: str) -> Column:
    """A response header as a number, whatever the case of its name; NULL if unreadable."""
    return header(headers, name).try_cast("double")


def quota_latest(
    pages: DataFrame, by: Sequence[str], gauges: Mapping[str, str], order: Sequence[str]
) -> DataFrame:
    """Latest readable value of each quota header per source."""
    when = F.struct(*order)
    read = pages.select(
        *by, *order, *[header_number(F.col("headers"), h).alias(g) for g, h in gauges.items()]
    )
    return read.groupBy(*by).agg(
        *[
            F.max_by(F.col(g), F.when(F.col(g).isNotNull(), when)).alias(g)
            for g in gauges
        ]
    )

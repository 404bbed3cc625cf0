"""Incremental read windows: planning, settling, overlap, steps, halving, cursors."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.json import as_column
from feedloom.functions.keys import join_same
from feedloom.functions.numbering import shuffle_partitions
from feedloom.session import cut_lineage

SECOND = 1_000_000  # microseconds


def _micros(c: Column) -> Column:
    return F.unix_micros(c)


def _at(micros: Column) -> Column:
    return F.timestamp_micros(micros)


def duration_micros(text: Column) -> Column:
    """`<n>s|m|h|d` with n > 0 as microseconds, NULL otherwise."""
    count = F.regexp_extract(text, r"^([0-9]+)[smhd]$", 1)
    unit = F.substring(text, -1, 1)
    scale = (
        F.when(unit == "s", 1).when(unit == "m", 60).when(unit == "h", 3600).otherwise(86400)
    )
    n = F.when(count != "", count).try_cast("bigint")
    return F.when(n > 0, n * scale * SECOND)


def in_window(df: DataFrame, ts: str, start: Any, end: Any) -> DataFrame:
    """Half-open `[start, end)`; plain comparisons, so it reaches the file scan."""
    kind = df.schema[ts].dataType
    low, high = as_column(start).cast(kind), as_column(end).cast(kind)
    return df.filter((F.col(ts) >= low) & (F.col(ts) < high))


def plan_windows(
    units: DataFrame,
    cursors: DataFrame,
    now: Any,
    key: str = "cursor_key",
    on_missing: str = "lookback",
) -> DataFrame:
    """Next window per unit: `window_start`, `window_end`, `status`.

    `units` has the key, `default_hours`, `interval_secs`, and optionally `failed_start` and
    `failed_end` of a window to retry. `cursors` has the key and `last_fetch_end`.
    Without a cursor a unit looks back one span or is refused (`on_missing`). A cursor that could
    not be read (`read_error` of `cursors` is set) is no missing one: its unit is `unreadable` and
    gets no window whatever the policy, as looking back would skip or repeat what it stands for.
    """
    for name in ("failed_start", "failed_end"):
        if name not in units.columns:
            units = units.withColumn(name, F.lit(None).cast("timestamp"))
    error = F.col("read_error") if "read_error" in cursors.columns else F.lit(None).cast("string")
    known = cursors.select(key, "last_fetch_end", error.alias("_error"))
    out = units.join(known, key, "left")
    at = _micros(as_column(now).cast("timestamp"))
    span = F.greatest(F.col("default_hours") * 3600, F.col("interval_secs")).cast(
        "bigint"
    ) * F.lit(SECOND)
    failed = _micros(F.col("failed_end")) - _micros(F.col("failed_start"))
    width = F.least(F.coalesce(failed, span), span)  # a retry is never wider than the span
    start = F.coalesce(
        _micros(F.col("last_fetch_end")), _micros(F.col("failed_start")), at - span
    )
    reach = F.greatest(width, F.lit(SECOND))
    out = out.withColumn("_start", start).withColumn(
        "_end", F.greatest(F.col("_start"), F.least(at, F.col("_start") + reach))
    )
    cold = F.col("last_fetch_end").isNull()
    unreadable = F.col("_error").isNotNull()
    refused = unreadable | (cold & F.lit(on_missing == "refuse"))
    return (
        out.withColumn("window_start", F.when(~refused, _at(F.col("_start"))))
        .withColumn("window_end", F.when(~refused, _at(F.col("_end"))))
        .withColumn(
            "status",
            F.when(unreadable, F.lit("unreadable"))
            .when(refused, F.lit("refused"))
            .when(cold, F.lit("cold"))
            .when(F.col("failed_end").isNotNull(), F.lit("retry"))
            .otherwise(F.lit("next")),
        )
        .drop("_start", "_end", "_error")
    )


def settle(df: DataFrame, now: Any, delay_secs: Any) -> DataFrame:
    """Hold the end of each window back from the present; never before its start."""
    limit = _micros(as_column(now).cast("timestamp")) - as_column(delay_secs).cast(
        "bigint"
    ) * F.lit(SECOND)
    end = F.greatest(
        _micros(F.col("window_start")), F.least(_micros(F.col("window_end")), limit)
    )
    return df.withColumn("window_end", _at(end))


def overlap(df: DataFrame, by_secs: Any) -> DataFrame:
    """Move the start back once, so late rows are read again (and delivered twice)."""
    back = as_column(by_secs).cast("bigint") * F.lit(SECOND)
    return df.withColumn("window_start", _at(_micros(F.col("window_start")) - back))


def window_steps(df: DataFrame, step_secs: Any, reads_window: Column | None = None) -> DataFrame:
    """Chunks of at most `step_secs` from each window's own start; the last may be short.

    A unit that reads no window runs once, with NULL bounds.
    """
    step = as_column(step_secs).cast("bigint") * F.lit(SECOND)
    start, end = _micros(F.col("window_start")), _micros(F.col("window_end"))
    starts = F.when(end > start, F.sequence(start, end - 1, step))
    reads = reads_window if reads_window is not None else F.lit(True)
    listed = df.withColumn("_stop", end).withColumn("_step", step)
    out = listed.select(
        "*",
        F.posexplode(
            F.when(~reads, F.array(F.lit(None).cast("bigint"))).otherwise(
                F.coalesce(starts, F.array().cast("array<bigint>"))
            )
        ).alias("step_no", "_from"),
    )
    return (
        out.withColumn("step_start", _at(F.col("_from")))
        .withColumn(
            "step_end",
            F.when(
                F.col("_from").isNotNull(),
                _at(F.least(F.col("_from") + F.col("_step"), F.col("_stop"))),
            ),
        )
        .drop("_from", "_stop", "_step")
    )


# The strftime letters used in bound formats and their Spark patterns.
STRFTIME = {
    "%Y": "yyyy",
    "%m": "MM",
    "%d": "dd",
    "%H": "HH",
    "%M": "mm",
    "%S": "ss",
    "%3f": "SSS",
    "%z": "xx",
    "%Z": "'UTC'",
    "%T": "HH:mm:ss",
    "%F": "yyyy-MM-dd",
}


def strftime_pattern(fmt: str) -> str:
    """A strftime pattern as a Spark date pattern; letters in between are quoted."""
    out, i, quoted = [], 0, ""

    def flush() -> None:
        nonlocal quoted
        if quoted:
            out.append("'" + quoted.replace("'", "''") + "'")
            quoted = ""

    while i < len(fmt):
        size = 3 if fmt[i : i + 3] in STRFTIME else 2
        token = fmt[i : i + size]
        if token in STRFTIME:
            flush()
            out.append(STRFTIME[token])
            i += size
        elif token.startswith("%"):
            raise ValueError(f"unsupported pattern {token!r}")
        else:
            quoted += fmt[i]
            i += 1
    flush()
    return "".join(out).replace("''UTC''", "UTC'")


def _fraction(moment: Column) -> Column:
    """`%.f`: the fraction of a second with its dot, in threes of digits; nothing for whole seconds."""
    micros = F.pmod(F.unix_micros(moment), F.lit(SECOND))
    return (
        F.when(micros == 0, F.lit(""))
        .when(micros % 1000 == 0, F.concat(F.lit("."), F.lpad((micros / 1000).cast("bigint").cast("string"), 3, "0")))
        .otherwise(F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0")))
    )


def format_bound(at: Column, fmt: str = "rfc3339_secs") -> Column:
    """Bound as rfc3339_secs, rfc3339_millis, epoch_secs, epoch_millis or `strftime:<pattern>`.

    Any other name is an error; a pattern may be given without its prefix.
    """
    moment = at.cast("timestamp")
    if fmt == "rfc3339_secs":
        return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    if fmt == "rfc3339_millis":
        return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    if fmt == "epoch_secs":
        return F.unix_seconds(moment).cast("string")
    if fmt == "epoch_millis":
        return F.unix_millis(moment).cast("string")
    pattern = fmt.removeprefix("strftime:")
    if "%" not in pattern:
        raise ValueError(f"unknown format {fmt!r}")
    around = [F.date_format(moment, strftime_pattern(p)) if p else F.lit("") for p in pattern.split("%.f")]
    parts = [around[0]]
    for text in around[1:]:
        parts += [_fraction(moment), text]
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def halve_until(
    events: DataFrame, ts: str, windows: DataFrame, ceiling: int, by: Sequence[str]
) -> DataFrame:
    """Spans of each window that hold at most `ceiling` rows, by repeated halving.

    A span over the ceiling is cut at a whole second, the earlier half first, down to one
    second; a span that cannot be cut is `failed`. Halving depends only on the bounds, so
    every second knows all spans above it: one count per span decides the whole tree
    without a loop. Windows are one row per `by`, with `window_start` and `window_end`.
    """
    bounds = windows.select(
        *by,
        _micros(F.col("window_start").cast("timestamp")).alias("_ws"),
        _micros(F.col("window_end").cast("timestamp")).alias("_we"),
    )
    at = _counted_at(_micros(F.col(ts).cast("timestamp")), bounds)
    counted = events.groupBy(*by, at.alias("_at")).agg(F.count(F.lit(1)).alias("_rows"))
    seconds = (
        join_same(counted, bounds, by)
        .filter((F.col("_at") >= F.col("_ws")) & (F.col("_at") < F.col("_we")))
        .groupBy(
            *by,
            "_ws",
            "_we",
            F.floor((F.col("_at") - F.col("_ws")) / F.lit(SECOND)).cast("bigint").alias("_sec"),
        )
        .agg(F.sum("_rows").alias("_n"))
    )
    # Few bytes but much work per row, so adaptive execution must not merge these partitions.
    seconds = seconds.repartition(shuffle_partitions(events), *by, "_sec")
    # Spans are kept as whole-second offsets [a, b) from the window start; the last span
    # ends at the window end, whatever its fraction.
    width = F.floor((F.col("_we") - F.col("_ws")) / F.lit(SECOND)).cast("bigint")
    top = F.struct(F.lit(0).cast("bigint").alias("a"), F.greatest(width, F.lit(1)).alias("b"))
    levels = F.ceil(F.log2(F.greatest(width, F.lit(1)))) + 1
    path = F.aggregate(
        F.sequence(F.lit(1).cast("bigint"), levels.cast("bigint")),
        F.array(top),
        lambda acc, _: F.when(
            F.element_at(acc, -1)["b"] - F.element_at(acc, -1)["a"] < 2, acc
        ).otherwise(
            F.concat(
                acc,
                F.array(_half_with(F.element_at(acc, -1), F.col("_sec"))),
            )
        ),
    )
    nodes = (
        seconds.select(*by, "_ws", "_we", "_n", F.explode(path).alias("s"))
        .groupBy(*by, "_ws", "_we", F.col("s.a").alias("a"), F.col("s.b").alias("b"))
        .agg(F.sum("_n").alias("rows"))
    )
    # every second gives a row a level; the spans and their rows are read from what was counted once
    nodes = cut_lineage(nodes)
    over = nodes.filter(F.col("rows") > ceiling)
    mid = F.col("a") + F.floor((F.col("b") - F.col("a")) / 2).cast("bigint")
    children = over.filter(F.col("b") - F.col("a") >= 2).select(
        *by,
        "_ws",
        "_we",
        F.explode(
            F.array(
                F.struct(F.col("a").alias("a"), mid.alias("b")),
                F.struct(mid.alias("a"), F.col("b").alias("b")),
            )
        ).alias("s"),
    )
    roots = bounds.select(*by, "_ws", "_we", top.alias("s"))
    spans = (
        children.withColumn("narrowed", F.lit(True))
        .unionByName(roots.withColumn("narrowed", F.lit(False)))
        .select(*by, "_ws", "_we", "narrowed", F.col("s.a").alias("a"), F.col("s.b").alias("b"))
    )
    spans = (
        join_same(spans, nodes.drop("_ws", "_we"), [*by, "a", "b"], "left")
        .withColumn("rows", F.coalesce("rows", F.lit(0)))
    )
    stuck = (F.col("rows") > ceiling) & (F.col("b") - F.col("a") < 2)
    leaves = spans.filter((F.col("rows") <= ceiling) | stuck)
    last = F.col("b") == F.greatest(width, F.lit(1))
    return leaves.select(
        *by,
        _at(F.col("_ws") + F.col("a") * F.lit(SECOND)).alias("span_start"),
        _at(
            F.when(last, F.col("_we")).otherwise(F.col("_ws") + F.col("b") * F.lit(SECOND))
        ).alias("span_end"),
        "rows",
        F.when(stuck, F.lit("failed")).otherwise(F.lit("complete")).alias("status"),
        "narrowed",
    )


# Fractions of a second at which windows may begin or end before events are counted as they are.
MAX_FRACTIONS = 64


def _counted_at(at: Column, bounds: DataFrame) -> Column:
    """Times (microseconds) that may be counted together before the windows are known.

    No window begins or ends inside a second but at the fractions its own bounds have; usually these are
    few, and all events of a key between two of them are one row of the shuffle.
    """
    fractions = bounds.select(
        F.explode(F.array(F.pmod("_ws", F.lit(SECOND)), F.pmod("_we", F.lit(SECOND)))).alias("f")
    ).distinct()
    found = sorted({r["f"] for r in fractions.limit(MAX_FRACTIONS + 1).collect()} - {0, None})
    if len(found) > MAX_FRACTIONS:
        return at
    inside = F.pmod(at, F.lit(SECOND))
    start = F.lit(0).cast("bigint")
    for border in found:
        start = F.when(inside >= border, F.lit(border).cast("bigint")).otherwise(start)
    return at - inside + start


def _half_with(span: Column, second: Column) -> Column:
    """The half of a span that a second falls into."""
    mid = span["a"] + F.floor((span["b"] - span["a"]) / 2).cast("bigint")
    return F.struct(
        F.when(second < mid, span["a"]).otherwise(mid).alias("a"),
        F.when(second < mid, mid).otherwise(span["b"]).alias("b"),
    )


def advance_cursor(cursors: DataFrame, done: DataFrame, updated_at: Any) -> DataFrame:
    """Cursors after a tick: the window end of units that fully succeeded, else unchanged."""
    key = "cursor_key"
    moved = done.filter(F.col("succeeded")).select(
        key,
        F.col("window_end").alias("_end"),
        F.col("records").alias("_records"),
    )
    out = cursors.join(moved, key, "full")
    hit = F.col("_end").isNotNull()
    return out.select(
        key,
        F.coalesce("_end", "last_fetch_end").alias("last_fetch_end"),
        F.coalesce("_records", "last_fetch_records").alias("last_fetch_records"),
        F.when(hit, as_column(updated_at).cast("timestamp"))
        .otherwise(F.col("updated_at"))
        .alias("updated_at"),
    )


def cursor_age(cursors: DataFrame, now: Any) -> DataFrame:
    """Seconds since each cursor's end, never negative."""
    at = _micros(as_column(now).cast("timestamp"))
    age = F.floor((at - _micros(F.col("last_fetch_end"))) / F.lit(SECOND)).cast("bigint")
    return cursors.withColumn("age_secs", F.greatest(F.lit(0).cast("bigint"), age))

"""Queries over read windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.operators import windows
from feedloom.plans.catalog.base import query, table

NOW = "2024-02-01 00:00:00"


def _cursors(spark, sf_dir):
    """One cursor per user, at the last event it has seen."""
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.concat(F.lit("shop.u"), F.col("user_id").cast("string")).alias("cursor_key"))
        .agg(F.max(F.col("ts")).cast("timestamp").alias("last_fetch_end"))
    )


def _units(spark, sf_dir):
    """Users as units, with two thirds of them having a cursor and a few a window to retry."""
    user = F.col("user_id")
    key = F.concat(F.lit("shop.u"), user.cast("string"))
    units = table(spark, sf_dir, "events").select("user_id").distinct()
    return units.select(
        key.alias("cursor_key"),
        "user_id",
        (user % 5 + 1).alias("default_hours"),
        F.lit(7200).alias("interval_secs"),
        F.when(user % 10 == 4, F.timestamp_seconds(1706600000 + user)).alias("failed_start"),
        F.when(user % 10 == 4, F.timestamp_seconds(1706600000 + user + 1800)).alias("failed_end"),
    )


def _planned(spark, sf_dir, on_missing="lookback"):
    cursors = _cursors(spark, sf_dir).filter(
        F.substring_index("cursor_key", "u", -1).cast("int") % 3 != 0
    )
    return windows.plan_windows(
        _units(spark, sf_dir), cursors, F.lit(NOW), on_missing=on_missing
    )


_PLANNED = """cursors AS (SELECT user_id, max(ts) AS last_end FROM events WHERE user_id % 3 <> 0 GROUP BY user_id),
  units AS (SELECT DISTINCT user_id, greatest((user_id % 5 + 1) * 3600, 7200) AS span_secs,
              CASE WHEN user_id % 10 = 4 THEN make_timestamp((1706600000 + user_id) * 1000000) END AS f_start,
              CASE WHEN user_id % 10 = 4 THEN 1800 END AS f_width FROM events),
  starts AS (SELECT u.*, last_end,
      coalesce(last_end, f_start, TIMESTAMP '2024-02-01' - to_seconds(span_secs)) AS w_start,
      greatest(coalesce(f_width, span_secs), 1) AS width FROM units u LEFT JOIN cursors USING (user_id)),
  planned AS (SELECT *, greatest(w_start, least(TIMESTAMP '2024-02-01', w_start + to_seconds(width))) AS w_end FROM starts)"""


@query(
    "window_plan",
    f"""WITH {_PLANNED} SELECT user_id, epoch_us(w_start) AS window_start, epoch_us(w_end) AS window_end,
      CASE WHEN last_end IS NULL THEN 'cold' WHEN f_width IS NOT NULL THEN 'retry' ELSE 'next' END AS status
      FROM planned""",
)
def window_plan(spark, sf_dir):
    planned = _planned(spark, sf_dir)
    return planned.select(
        "user_id",
        F.unix_micros("window_start").alias("window_start"),
        F.unix_micros("window_end").alias("window_end"),
        "status",
    )


@query(
    "missing_cursor",
    f"""WITH {_PLANNED} SELECT user_id, CASE WHEN last_end IS NULL THEN 'refused' WHEN f_width IS NOT NULL THEN 'retry' ELSE 'next' END AS status,
      CASE WHEN last_end IS NOT NULL THEN epoch_us(w_end) END AS window_end FROM planned""",
)
def missing_cursor(spark, sf_dir):
    planned = _planned(spark, sf_dir, on_missing="refuse")
    return planned.select("user_id", "status", F.unix_micros("window_end").alias("window_end"))


@query(
    "cursor_failures",
    """SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'unreadable' WHEN 1 THEN 'next' ELSE 'cold' END AS status,
         CASE c_custkey % 3 WHEN 1 THEN epoch_us(TIMESTAMP '2024-01-10') WHEN 2 THEN epoch_us(TIMESTAMP '2024-02-01') - 7200000000 END AS window_start
       FROM customer""",
)
def cursor_failures(spark, sf_dir):
    """A third of the cursors cannot be read and a third is missing: only the latter look back."""
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("cursor_key"))
    units = customer.select("cursor_key", F.lit(2).alias("default_hours"), F.lit(60).alias("interval_secs"))
    which = F.col("cursor_key") % 3
    cursors = customer.filter(which < 2).select(
        "cursor_key",
        F.when(which == 1, F.lit("2024-01-10").cast("timestamp")).alias("last_fetch_end"),
        F.when(which == 0, F.lit("damaged")).alias("read_error"),
    )
    planned = windows.plan_windows(units, cursors, F.lit("2024-02-01"))
    return planned.select(
        F.col("cursor_key").alias("c_custkey"), "status", F.unix_micros("window_start").alias("window_start")
    )


@query(
    "settle_overlap",
    f"""WITH {_PLANNED}, settled AS (SELECT *, greatest(w_start, least(w_end, TIMESTAMP '2024-02-01' - to_seconds(CAST(user_id % 4 AS INT) * 3600))) AS s_end FROM planned)
      SELECT user_id, epoch_us(w_start) - 300000000 AS window_start, epoch_us(s_end) AS window_end FROM settled""",
)
def settle_overlap(spark, sf_dir):
    settled = windows.settle(_planned(spark, sf_dir), F.lit(NOW), F.col("user_id") % 4 * 3600)
    moved = windows.overlap(settled, 300)
    return moved.select(
        "user_id",
        F.unix_micros("window_start").alias("window_start"),
        F.unix_micros("window_end").alias("window_end"),
    )


@query(
    "window_steps",
    f"""WITH {_PLANNED}, chunks AS (
        SELECT user_id, epoch_us(w_start) AS a, epoch_us(w_end) AS b,
               unnest(generate_series(0, CASE WHEN w_end > w_start THEN (epoch_us(w_end) - epoch_us(w_start) - 1) // 2700000000 ELSE -1 END)) AS step_no
        FROM planned)
      SELECT user_id, CAST(step_no AS INT) AS step_no, a + step_no * 2700000000 AS step_start,
             least(b, a + (step_no + 1) * 2700000000) AS step_end FROM chunks""",
)
def window_steps(spark, sf_dir):
    steps = windows.window_steps(_planned(spark, sf_dir), 2700)
    return steps.select(
        "user_id",
        "step_no",
        F.unix_micros("step_start").alias("step_start"),
        F.unix_micros("step_end").alias("step_end"),
    )


@query(
    "bound_formats",
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS rfc3339,
        strftime(ts, '%Y-%m-%dT%H:%M:%S.') || lpad(CAST((epoch_us(ts) // 1000) % 1000 AS VARCHAR), 3, '0') || 'Z' AS rfc3339_millis,
        CAST(epoch_us(ts) // 1000000 AS VARCHAR) AS epoch, CAST(epoch_us(ts) // 1000 AS VARCHAR) AS epoch_millis,
        strftime(ts, '%Y%m%d at %H:%M') AS pattern,
        strftime(ts, '%H:%M:%S') || CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN '.120' ELSE '.240' END || 'Z' AS fraction FROM events""",
)
def bound_formats(spark, sf_dir):
    at = F.col("ts")
    return table(spark, sf_dir, "events").select(
        "event_id",
        windows.format_bound(at).alias("rfc3339"),
        windows.format_bound(at, "rfc3339_millis").alias("rfc3339_millis"),
        windows.format_bound(at, "epoch_secs").alias("epoch"),
        windows.format_bound(at, "epoch_millis").alias("epoch_millis"),
        windows.format_bound(at, "%Y%m%d at %H:%M").alias("pattern"),
        windows.format_bound(F.date_trunc("second", at) + F.expr("make_interval(0, 0, 0, 0, 0, 0, (event_id % 3) * 0.12)"), "strftime:%H:%M:%S%.fZ").alias("fraction"),
    )


@query(
    "in_window",
    """SELECT event_type, CAST(count(*) AS BIGINT) AS rows, min(event_id) AS first_id, max(event_id) AS last_id
       FROM events WHERE ts >= TIMESTAMP '2024-01-10 06:00:00' AND ts < TIMESTAMP '2024-01-20 18:30:00' GROUP BY event_type""",
)
def in_window(spark, sf_dir):
    picked = windows.in_window(
        table(spark, sf_dir, "events"), "ts", "2024-01-10 06:00:00", "2024-01-20 18:30:00"
    )
    return picked.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("event_id").alias("first_id"),
        F.max("event_id").alias("last_id"),
    )


@query(
    "advance_cursor",
    f"""WITH {_PLANNED}, counts AS (SELECT user_id, count(*) AS records FROM events GROUP BY user_id)
      SELECT 'shop.u' || user_id AS cursor_key,
        epoch_us(CASE WHEN user_id % 7 <> 0 THEN w_end ELSE last_end END) AS last_fetch_end,
        CASE WHEN user_id % 7 <> 0 THEN CAST(records AS BIGINT) ELSE CAST(0 AS BIGINT) END AS last_fetch_records,
        greatest(0, (epoch_us(TIMESTAMP '2024-02-01') - epoch_us(CASE WHEN user_id % 7 <> 0 THEN w_end ELSE last_end END)) // 1000000) AS age_secs
      FROM planned JOIN counts USING (user_id) WHERE user_id % 7 <> 0 OR last_end IS NOT NULL""",
)
def advance_cursor(spark, sf_dir):
    cursors = (
        _cursors(spark, sf_dir)
        .filter(F.substring_index("cursor_key", "u", -1).cast("int") % 3 != 0)
        .withColumn("last_fetch_records", F.lit(0).cast("bigint"))
        .withColumn("updated_at", F.col("last_fetch_end"))
    )
    counts = table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("records")
    )
    done = _planned(spark, sf_dir).join(counts, "user_id").withColumn(
        "succeeded", F.col("user_id") % 7 != 0
    )
    moved = windows.advance_cursor(cursors, done, F.lit(NOW))
    return windows.cursor_age(moved, F.lit(NOW)).select(
        "cursor_key",
        F.unix_micros("last_fetch_end").alias("last_fetch_end"),
        "last_fetch_records",
        "age_secs",
    )


def _halved(spark, sf_dir, ceiling):
    events = table(spark, sf_dir, "events")
    bounds = events.groupBy("event_type").agg(
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("window_start"),
        F.lit("2024-01-31 00:00:00").cast("timestamp").alias("window_end"),
    )
    return windows.halve_until(events, "ts", bounds, ceiling, ["event_type"])


@query(
    "window_halving",
    """WITH RECURSIVE seconds AS (
        SELECT event_type, (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) // 1000000 AS s FROM events),
      spans(event_type, a, b, n, narrowed) AS (
        SELECT event_type, 0::BIGINT, 2592000::BIGINT, count(*), false FROM seconds GROUP BY event_type
        UNION ALL
        SELECT p.event_type, h.a, h.b,
          (SELECT count(*) FROM seconds s WHERE s.event_type = p.event_type AND s.s >= h.a AND s.s < h.b), true
        FROM spans p, LATERAL (SELECT p.a AS a, p.a + (p.b - p.a) // 2 AS b UNION ALL SELECT p.a + (p.b - p.a) // 2, p.b) h
        WHERE p.n > 60 AND p.b - p.a >= 2)
      SELECT event_type, epoch_us(TIMESTAMP '2024-01-01') + a * 1000000 AS span_start,
             epoch_us(TIMESTAMP '2024-01-01') + b * 1000000 AS span_end, CAST(n AS BIGINT) AS rows,
             CASE WHEN n > 60 THEN 'failed' ELSE 'complete' END AS status, narrowed
      FROM spans WHERE n <= 60 OR b - a < 2""",
)
def window_halving(spark, sf_dir):
    return _halved(spark, sf_dir, 60).select(
        "event_type",
        F.unix_micros("span_start").alias("span_start"),
        F.unix_micros("span_end").alias("span_end"),
        "rows",
        "status",
        "narrowed",
    )

"""Registry of queries and the inputs they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.session import prepare

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query and the SQL that must give the same rows."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as a feed: event_id, ts, event_type, user_id, value and one JSON record per row."""
    events = table(spark, sf_dir, "events")
    record = F.struct(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("type"),
        F.col("user_id").alias("user"),
        F.col("value"),
        F.col("props"),
    )
    return events.select(
        "event_id", "ts", "event_type", "user_id", "value", F.to_json(record).alias("payload")
    )


# The same feed in the oracle's SQL.
EVENTS_FEED = """feed AS (
  SELECT event_id, ts, event_type, user_id, value, props,
         CAST(json_object('id', event_id, 'type', event_type, 'user', user_id,
                          'value', value, 'props', props) AS VARCHAR) AS payload
  FROM events)"""

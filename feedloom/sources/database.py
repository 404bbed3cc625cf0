"""Database feeds over Spark's JDBC reader."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime
from decimal import Decimal
from typing import Any

from pyspark.sql import DataFrame, SparkSession

# Statements that pin a database session to UTC.
UTC_PRELUDE = {
    "postgresql": "SET TIME ZONE 'UTC'",
    "mysql": "SET time_zone = '+00:00'",
    "mariadb": "SET time_zone = '+00:00'",
    "oracle": "ALTER SESSION SET TIME_ZONE = 'UTC'",
}


# Engines that bound a result by LIMIT; the others take the standard's clause.
LIMIT_ENGINES = ("mysql", "mariadb", "sqlite")


def literal(value: Any) -> str:
    """A typed SQL literal; Spark's JDBC reader cannot bind parameters."""
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, Decimal)):
        return str(value)
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value.strftime('%Y-%m-%d %H:%M:%S.%f')}'"
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    raise TypeError(f"no literal for {type(value).__name__}")


def tail_query(
    source: str,
    keys: Sequence[str],
    after: Sequence[Any] | None,
    limit: int,
    quote: str | None = None,
    engine: str = "postgresql",
) -> str:
    """Query text of one keyset page: rows past `after`, in key order, at most `limit`.

    `engine` is the name in the JDBC URL; it decides the bound's clause and how names are quoted.
    """
    if quote is None:
        quote = "`" if engine in ("mysql", "mariadb") else '"'
    names = [f"{quote}{k.replace(quote, quote * 2)}{quote}" for k in keys]
    text = f"SELECT * FROM ({source}) t"
    if after is not None:
        cases = []
        for i, name in enumerate(names):
            same = [f"{n} = {literal(v)}" for n, v in zip(names[:i], after[:i])]
            cases.append("(" + " AND ".join([*same, f"{name} > {literal(after[i])}"]) + ")")
        text += " WHERE " + " OR ".join(cases)
    text += f" ORDER BY {', '.join(names)}"
    if engine in LIMIT_ENGINES:
        return f"{text} LIMIT {int(limit)}"
    if engine == "sqlserver":  # its clause needs an offset
        return f"{text} OFFSET 0 ROWS FETCH NEXT {int(limit)} ROWS ONLY"
    return f"{text} FETCH FIRST {int(limit)} ROWS ONLY"


def read_query(
    spark: SparkSession,
    url: str,
    query: str,
    options: Mapping[str, str] | None = None,
    partition: tuple[str, Any, Any, int] | None = None,
) -> DataFrame:
    """A query over JDBC with the session pinned to UTC.

    `partition` is (column, lower, upper, parts): the read is split over that many
    connections. Without it a whole table comes through one.
    """
    engine = url.split(":")[1] if url.startswith("jdbc:") else ""
    reader = spark.read.format("jdbc").option("url", url)
    if engine in UTC_PRELUDE:
        reader = reader.option("sessionInitStatement", UTC_PRELUDE[engine])
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    if partition is None:
        return reader.option("query", query).load()
    column, lower, upper, parts = partition
    return (
        reader.option("dbtable", f"({query}) t")
        .option("partitionColumn", column)
        .option("lowerBound", str(lower))
        .option("upperBound", str(upper))
        .option("numPartitions", str(parts))
        .load()
    )

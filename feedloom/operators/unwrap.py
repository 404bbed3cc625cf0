"""Repair of JSON that arrives as text inside JSON."""

from __future__ import annotations

import json
import math
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: containers at depth 0, 1 and 2 have their text values opened.
DEPTH = 3
# Fixed value: containers within containers that a record may have.
MAX_DEPTH = 127

# A text value that could hold an object or array, as it looks inside the record's text.
CANDIDATE = r'"\s*(?:\\[nrt])*\s*[\{\[]'


def finite_number(text: str) -> float:
    value = float(text)
    if not math.isfinite(value):
        raise ValueError(f"not a finite number: {text}")
    return value


def no_constant(name: str) -> Any:
    raise ValueError(f"not JSON: {name}")


def check_depth(value: Any, text: str) -> None:
    """ValueError if the value parsed from `text` is nested deeper than MAX_DEPTH."""
    if text.count("{") + text.count("[") <= MAX_DEPTH:
        return
    level = [value]
    for _ in range(MAX_DEPTH + 1):
        inner = [x.values() if isinstance(x, dict) else x for x in level if isinstance(x, (dict, list))]
        if not inner:
            return
        level = [x for part in inner for x in part]
    raise ValueError("nested too deeply")


def parse(text: str) -> Any:
    """The JSON value of a text; ValueError for anything else, however deep or long.

    Python takes NaN, Infinity and numbers out of range, and half characters; JSON does not.
    """
    try:
        value = json.loads(text, parse_float=finite_number, parse_constant=no_constant)
        check_depth(value, text)
        if "\\u" in text:
            json.dumps(value, ensure_ascii=False).encode()
    except RecursionError as deep:
        raise ValueError("nested too deeply") from deep
    except UnicodeEncodeError as half:
        raise ValueError("half a character") from half
    return value


def _open(value: Any, level: int, depth: int) -> tuple[Any, bool]:
    """The value with its text containers opened, and whether anything changed."""
    changed = False
    if isinstance(value, str):
        text = value.strip()
        if text[:1] in ("{", "[") and text[-1:] in ("}", "]"):
            try:
                value = parse(text)
                changed = True
            except ValueError:
                return value, False
        else:
            return value, False
    if level >= depth or not isinstance(value, (dict, list)):
        return value, changed
    items = value.items() if isinstance(value, dict) else enumerate(value)
    for key, inner in list(items):
        opened, inner_changed = _open(inner, level + 1, depth)
        if inner_changed:
            value[key] = opened
            changed = True
    return value, changed


def unwrap_text(text: str, depth: int = DEPTH) -> str:
    """One record; returned as it is when nothing in it can be opened."""
    try:
        record = parse(text)
        if not isinstance(record, (dict, list)):
            return text
        record, changed = _open(record, 0, depth)
        return json.dumps(record, ensure_ascii=False, separators=(",", ":")) if changed else text
    except (ValueError, RecursionError):
        return text


def unwrap_nested(df: DataFrame, payload: str = "payload", depth: int = DEPTH) -> DataFrame:
    """Open JSON held in text values, for containers at the first `depth` levels.

    Only records whose text has a candidate go to Python; every other row, and every record
    where nothing opens, keeps its bytes.
    """

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else unwrap_text(t, depth))

    candidate = F.when(F.col(payload).rlike(CANDIDATE), F.col(payload))
    return (
        df.withColumn("_opened", run(candidate))
        .withColumn(payload, F.coalesce("_opened", payload))
        .drop("_opened")
    )

"""Helpers that the corpus operators share: reading, folds, samples and batches of texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

# A task hands its texts to Python in pieces of about this many bytes, whatever the batch holds.
PIECE_BYTES = 1 << 20
# Rows and bytes of an Arrow batch, so that a batch of the longest texts fits the Python worker.
BATCH_ROWS = 512
BATCH_BYTES = 32 << 20

# Fixed: the white space of a word boundary.
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"


def bounded_batches(spark: SparkSession) -> None:
    """Bound what a Python worker is handed at once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; a null id counts as the empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % folds


def without(df: DataFrame, names: Sequence[str]) -> list[str]:
    """Columns of `df` that a result with columns `names` does not replace."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def pieces(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts stay near PIECE_BYTES; a longer single text is a slice alone."""
    lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
    start, held = 0, 0
    for i, n in enumerate(lengths):
        if held and held + n > PIECE_BYTES:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < len(lengths):
        yield batch.slice(start)


def map_texts(
    df: DataFrame,
    compute: Callable[[list[str | None]], dict[str, Any]],
    fields: str,
    keep: Sequence[str] | None = None,
    text: str = "text",
) -> DataFrame:
    """Append columns that `compute` derives from the texts; the kept columns pass through as they are.

    `fields` is a DDL list of the new columns. An input column of the same name is replaced.
    """
    added = T.StructType.fromDDL(fields)
    kept = [c for c in (df.columns if keep is None else keep) if c in without(df, added.names)]
    schema = T.StructType([df.schema[c] for c in kept] + added.fields)
    arrow = [(f.name, to_arrow_type(f.dataType)) for f in added.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, text):
                made = compute(part.column(text).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in kept] + [pa.array(made[n], t) for n, t in arrow],
                    names=schema.names,
                )

    bounded_batches(df.sparkSession)
    read = list(dict.fromkeys([*kept, text]))
    return df.select(*read).mapInArrow(run, schema)


def bounded_sample(df: DataFrame, keys: Sequence[str], most: int, seed: int) -> DataFrame:
    """At most `most` rows, the same on every run: those with the smallest hash of the keys.

    Only for fitting models. All rows are counted and hashed; a hash bound leaves some more than `most`
    of them before the top-k, so that tasks do not send `most` rows each. A bound that leaves fewer, as
    one on few distinct keys may, is not used.
    """
    hashed = F.xxhash64(F.lit(seed), *[F.col(k) for k in keys])
    rows = df.count()
    if rows > 2 * most + 1000:
        part = (1.2 * most + 1000) / rows
        near = df.where(hashed <= F.lit(-(1 << 63) + int(part * (1 << 64))))
        df = near if near.count() >= most else df
    return df.orderBy(hashed, *keys).limit(most)


def sampled_rows(
    docs: DataFrame, ids: DataFrame, columns: Sequence[str], key: str = "doc_id"
) -> list[Any]:
    """One row of `docs` for each key in the bounded frame `ids`, in key order, on the driver.

    Of repeated keys the row with the smallest values counts, so that the bound holds.
    """
    picked = docs.join(F.broadcast(ids.select(key).distinct()), key, "left_semi")
    one = picked.groupBy(key).agg(F.min(F.struct(*columns)).alias("row"))
    return [r["row"] for r in sorted(one.collect(), key=lambda r: str(r[key]))]

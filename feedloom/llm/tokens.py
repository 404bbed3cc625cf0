"""Token counts as rollups that signed changes keep up to date.

A batch of changes inserts, deletes or revises documents. Its tasks count tokens and give signed ledger
rows: a document and its tokens added, or those taken back that earlier batches had added for the same
id. The ledger rows of a batch add up to its change of the totals by source, language and tokenizer
version. Both are written to a folder of the batch's own number, overwritten if the batch runs again;
what a batch takes back depends on the batches before it alone, so committing one twice, or after a
failure half way, gives the same folders and the same totals. Totals are sums over committed batches.

Nulls: a null or empty text has 0 tokens and counts as a document; a null source or language is a
group of its own; a change with a null id can only insert, as it names no earlier document; a null or
unknown action is an insertion. A very long text is encoded whole in its row. There are no ties. Rows repeated in a batch all count; an id deleted and revised in one
batch is taken back once. Empty batches commit nothing and change nothing. Changes hold the named
columns only, so further columns cannot clash.
"""

from __future__ import annotations

import base64
import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import map_texts, table
from feedloom.session import ensure_checkpoint_dir

TOKENIZERS = "/opt/tokenizers"
# Fixed: the pattern by which the byte-level vocabularies split text before merging.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
INSERT, DELETE, REVISE = "insert", "delete", "revise"
GROUP = ("source", "lang", "version")

_LOADED: dict[str, Any] = {}


class Vocabulary:
    """A rank file, read on the driver (about a megabyte) and sent to the tasks with the code."""

    def __init__(self, version: str, folder: str = TOKENIZERS) -> None:
        with open(f"{folder}/{version}.tiktoken", "rb") as file:
            self.lines = file.read()
        self.version = version

    def count(self, text: str) -> int:
        import tiktoken

        held = _LOADED.get(self.version)
        if held is None or held[0] != len(self.lines):
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, self.lines.splitlines())}
            made = tiktoken.Encoding(self.version, pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
            held = _LOADED[self.version] = (len(self.lines), made)
        return len(held[1].encode_ordinary(text))


def with_token_counts(docs: DataFrame, vocabulary: Vocabulary, keep: list[str], text: str = "text") -> DataFrame:
    """The kept columns with `tokens`, counted over whole texts."""

    def compute(texts: list[str | None]) -> dict[str, Any]:
        return {"tokens": [vocabulary.count(t) if t else 0 for t in texts]}

    return map_texts(docs, compute, "tokens bigint", keep, text)


class TokenRollup:
    """Ledger and totals under a folder that all executors share."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _folder(self, kind: str, batch: int) -> str:
        return f"{self.root}/{kind}/batch={batch:08d}"

    def _committed(self, kind: str) -> list[int]:
        """Numbers of the batches whose folder a finished job has marked."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{kind}")
        files = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        found = files.globStatus(jvm.org.apache.hadoop.fs.Path(path, "batch=*/_SUCCESS"))
        return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in found or [])

    def _read(self, kind: str, batches: list[int], schema: str) -> DataFrame:
        if not batches:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[self._folder(kind, b) for b in batches])

    ledger_schema = "doc_id bigint, source string, lang string, version string, docs bigint, tokens bigint"
    total_schema = "source string, lang string, version string, docs bigint, tokens bigint"

    def ledger(self, before: int | None = None) -> DataFrame:
        batches = [b for b in self._committed("ledger") if before is None or b < before]
        return self._read("ledger", batches, self.ledger_schema)

    def totals(self) -> DataFrame:
        """(source, lang, version, docs, tokens) over all committed batches; groups at zero are left out."""
        summed = self._read("totals", self._committed("totals"), self.total_schema).groupBy(*GROUP)
        return summed.agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs <> 0 OR tokens <> 0")

    def commit(self, batch: int, changes: DataFrame, vocabulary: Vocabulary) -> None:
        """Apply `changes` (doc_id, source, lang, text, action) as batch number `batch`, once or again."""
        kind = F.coalesce(F.col("action"), F.lit(INSERT))
        added = with_token_counts(changes.where(kind != DELETE), vocabulary, ["doc_id", "source", "lang"]).select(
            "doc_id", "source", "lang", F.lit(vocabulary.version).alias("version"), F.lit(1).cast("long").alias("docs"), "tokens"
        )
        rows = added
        if any(b < batch for b in self._committed("ledger")):
            gone = changes.where(kind.isin(DELETE, REVISE)).select("doc_id").dropna().distinct()
            held = self.ledger(batch).join(gone, "doc_id").groupBy("doc_id", *GROUP)
            back = held.agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs <> 0")
            rows = added.union(back.select("doc_id", *GROUP, (-F.col("docs")).alias("docs"), (-F.col("tokens")).alias("tokens")))
        rows.write.mode("overwrite").parquet(self._folder("ledger", batch))
        mine = self._read("ledger", [batch], self.ledger_schema).groupBy(*GROUP)
        delta = mine.agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        delta.write.mode("overwrite").parquet(self._folder("totals", batch))


def changes_of_documents(docs: DataFrame) -> list[tuple[DataFrame, str]]:
    """Batches (changes, tokenizer version) over the whole table: all rows, then some revised by
    their own text twice, some deleted, some counted anew by another version."""
    rows = docs.select("doc_id", "source", "lang", "text")
    part = F.coalesce(F.col("doc_id"), F.lit(-1)) % 20
    revised = rows.where(part == 3).withColumn("text", F.concat("text", F.lit("\n"), "text"))
    first, second = "byte_bpe_50k", "byte_bpe_multi_50k"
    return [
        (rows.withColumn("action", F.lit(INSERT)), first),
        (revised.withColumn("action", F.lit(REVISE)), first),
        (rows.where(part == 7).withColumn("action", F.lit(DELETE)), first),
        (rows.where(part == 11).withColumn("action", F.lit(REVISE)), second),
    ]


def token_totals_of_documents(spark: SparkSession, sf_dir: str, folder: str = TOKENIZERS) -> DataFrame:
    """Totals after all batches over `documents`, the third of which is committed twice."""
    ensure_checkpoint_dir(spark)
    rollup = TokenRollup(spark, f"{spark.sparkContext.getCheckpointDir()}/tokens-{uuid.uuid4().hex}")
    batches = changes_of_documents(table(spark, sf_dir, "documents"))
    for number in (1, 2, 3, 3, 4):
        changes, version = batches[number - 1]
        rollup.commit(number, changes, Vocabulary(version, folder))
    return rollup.totals()


VERSIONS = ("byte_bpe_50k", "byte_bpe_multi_50k")


def changes_back_to_documents(docs: DataFrame) -> list[DataFrame]:
    """Batches that end at the whole table: all rows; then some revised to their own text twice and some
    deleted; then the first revised to their text as it is and the others inserted again."""
    rows = docs.select("doc_id", "source", "lang", "text")
    part = F.coalesce(F.col("doc_id"), F.lit(-1)) % 20
    doubled = F.when(part == 3, F.concat("text", F.lit("\n"), "text"))
    some = rows.where(part.isin(3, 7))
    return [
        rows.withColumn("action", F.lit(INSERT)),
        some.withColumn("text", doubled).withColumn("action", F.when(part == 3, F.lit(REVISE)).otherwise(F.lit(DELETE))),
        some.withColumn("action", F.when(part == 3, F.lit(REVISE)).otherwise(F.lit(INSERT))),
    ]


def whole_token_totals(spark: SparkSession, sf_dir: str, folder: str = TOKENIZERS) -> DataFrame:
    """Totals of all documents under each tokenizer version, after batches the second of which is
    committed twice. A revision takes back what any version had counted, so each has a rollup of its own."""
    ensure_checkpoint_dir(spark)
    root = f"{spark.sparkContext.getCheckpointDir()}/tokens-{uuid.uuid4().hex}"
    batches = changes_back_to_documents(table(spark, sf_dir, "documents"))
    out = None
    for version in VERSIONS:
        rollup, vocabulary = TokenRollup(spark, f"{root}/{version}"), Vocabulary(version, folder)
        for number in (1, 2, 2, 3):
            rollup.commit(number, batches[number - 1], vocabulary)
        out = rollup.totals() if out is None else out.union(rollup.totals())
    return out

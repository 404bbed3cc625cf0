"""File feeds: text, JSON and CSV files, directory listings and directory dumps."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedloom.functions.json import as_column
from feedloom.operators import decode
from feedloom.operators.framing import JsonFrame, rows_of_pieces
from feedloom.operators.listing import past
from feedloom.session import cut_lineage
from feedloom.sources import members as gzip

# A gzip file that its name tells is held whole up to this size, so that damage is an error of that file; Spark's
# reader unpacks a larger one as a stream. The rows are the same either way.
WHOLE_FILE_BYTES = 256 << 20
SEPARATORS = {"json": JsonFrame.sep, "csv": "\n"}


def read_ndjson(
    spark: SparkSession, paths: str | Sequence[str], max_row_bytes: int | None = None
) -> DataFrame:
    """One row per non-blank line; large files are split over tasks."""
    lines = spark.read.text(paths if isinstance(paths, str) else list(paths))
    trimmed = lines.select(F.regexp_replace("value", r"^\s+|\s+$", "").alias("payload"))
    return decode.fail_long_rows(trimmed.filter(F.col("payload") != ""), "payload", max_row_bytes)


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One `{"line": ...}` record per non-blank line."""
    rows = read_ndjson(spark, paths)
    return rows.select(decode.wrap_line(F.col("payload")).alias("payload"))


def read_documents(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row per file that is not blank."""
    names = paths if isinstance(paths, str) else list(paths)
    return decode.decode_document(
        spark.read.text(names, wholetext=True).select("value"), "value"
    ).select("payload")


def read_json_array(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row per element of each file's top-level array."""
    names = paths if isinstance(paths, str) else list(paths)
    bodies = spark.read.text(names, wholetext=True).select("value")
    return decode.explode_array(bodies, "value").select("pos", "payload")


def read_csv_rows(
    spark: SparkSession, paths: str | Sequence[str], header: bool = True, ragged: bool = False
) -> DataFrame:
    """CSV records as JSON, every value a string.

    Files of one shape go through the built-in reader. `ragged` parses each file on its own
    and keeps fields beyond the header.
    """
    names = paths if isinstance(paths, str) else list(paths)
    if ragged:
        bodies = spark.read.text(names, wholetext=True).select("value")
        return decode.decode_csv(bodies, "value", header).select("payload", "error")
    table = spark.read.csv(
        names, header=header, inferSchema=False, multiLine=True, quote='"', escape='"'
    )
    if not header:
        table = table.toDF(*[f"col_{i}" for i in range(len(table.columns))])
    return table.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in table.columns])).alias("payload"))


def list_files(
    spark: SparkSession, globs: str | Sequence[str], marker: tuple[Any, str] | None = None
) -> DataFrame:
    """`path`, `position` (modification time) and `size`, strictly past the marker.

    Only names and times are read. Spark knows the time of the last change of the content,
    not of the file entry.
    """
    found = _files(spark, globs, marker).select("path", "position", "size")
    return found.distinct()


def _files(spark: SparkSession, globs: str | Sequence[str], marker: tuple[Any, str] | None) -> DataFrame:
    names = globs if isinstance(globs, str) else list(globs)
    raw = spark.read.format("binaryFile").load(names)
    if marker is not None:
        # A plain range first: the reader skips older files by it.
        raw = raw.filter(F.col("modificationTime") >= as_column(marker[0]).cast("timestamp"))
    out = raw.select(
        "path",
        F.col("modificationTime").alias("position"),
        F.col("length").alias("size"),
        "content",
    )
    if marker is not None:
        after = as_column(marker[0]).cast("timestamp")
        out = out.filter(past(F.col("position"), F.col("path"), after, F.lit(marker[1])))
    return out


def _pieces(spark: SparkSession, paths: list[str], sep: str) -> DataFrame:
    """Text of files between separators, range by range."""
    return spark.read.text(paths, lineSep=sep).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("chunk"),
        F.make_valid_utf8("value").alias("value"),
    )


def _packed_paths(spark: SparkSession, paths: list[str]) -> set[str]:
    """Files that begin with gzip's magic. Only their first pieces cross to the driver, as a flag for each file.

    A file's first piece, up to a byte that text seldom holds, begins with the file's first byte.
    """
    raw = spark.read.option("encoding", "ISO-8859-1").text(paths, lineSep=decode.GZIP_MAGIC.decode("latin-1"))
    first = raw.where(F.col("_metadata.file_block_start") == 0).select(
        F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("at"), (F.octet_length("value") == 0).alias("bare")
    )
    flags = first.groupBy("path").agg(F.min(F.struct("at", "bare")).alias("f"))
    return {r["path"] for r in flags.where("f.bare").select("path").collect()}


def _split_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines of files, split over tasks, numbered in each file as if read whole.

    Lines follow each other within a split, so a line's number is that of its split's first line,
    from a count by split, plus its place there.
    """
    lines = _pieces(spark, paths, "\n").withColumnRenamed("value", "payload")
    return numbered_lines(lines.withColumn("_id", F.monotonically_increasing_id()))


def numbered_lines(lines: DataFrame) -> DataFrame:
    """`path`, `pos`, `payload`, `error` of lines that `_id` numbers in each chunk; blank ones count, and go."""
    splits = lines.groupBy("path", "chunk").agg(F.count(F.lit(1)).alias("_lines"), F.min("_id").alias("_first"))
    along = Window.partitionBy("path").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = splits.withColumn("_before", F.coalesce(F.sum("_lines").over(along), F.lit(0)))
    placed = lines.join(before, ["path", "chunk"])
    pos = (F.col("_before") + F.col("_id") - F.col("_first")).cast("int")
    trimmed = placed.select("path", pos.alias("pos"), F.regexp_replace("payload", r"^\s+|\s+$", "").alias("payload"))
    return trimmed.filter(F.col("payload") != "").withColumn("error", F.lit(None).cast("string"))


def _framed(spark: SparkSession, kind: str, paths: list[str]) -> DataFrame:
    """`path`, `pos`, `payload`, `error` of plain files of one framing."""
    if kind == "ndjson":
        return _split_lines(spark, paths)
    return rows_of_pieces(_pieces(spark, paths, SEPARATORS[kind]), kind)


def _unpacked(spark: SparkSession, kind: str, paths: list[str]) -> DataFrame:
    """The same of gzip files whose name does not tell, their members unpacked in parallel."""
    found = gzip.members(gzip.raw_pieces(spark, paths))
    damaged = gzip.problems(found)
    sound = found.join(damaged.select("path"), "path", "left_anti")
    pieces = gzip.member_pieces(sound, SEPARATORS.get(kind, "\n"))
    if kind == "ndjson":
        rows = numbered_lines(pieces.withColumnRenamed("value", "payload").withColumnRenamed("i", "_id"))
    else:
        rows = rows_of_pieces(pieces, kind, order=["i"])
    nothing = F.lit(None).cast("string")
    bad = damaged.select("path", F.lit(None).cast("int").alias("pos"), nothing.alias("payload"), "error")
    return rows.unionByName(bad)


def _held(files: DataFrame) -> DataFrame:
    """Rows of files whose whole content is a value."""
    bodies = decode.inflate(files, "content").withColumnRenamed("error", "_broken")
    bodies = bodies.withColumn("_body", F.make_valid_utf8(F.col("content").cast("string"))).drop("content")
    good = bodies.filter(F.col("_broken").isNull())
    lines = good.filter(F.col("_decoder") == "ndjson").select("path", F.posexplode(F.split("_body", "\n")).alias("pos", "payload"))
    trimmed = lines.withColumn("payload", F.regexp_replace("payload", r"^\s+|\s+$", "")).filter(F.col("payload") != "")
    nothing = F.lit(None).cast("string")
    keep = ["path", "pos", "payload", "error"]
    broken = bodies.filter(F.col("_broken").isNotNull())
    return reduce(
        DataFrame.unionByName,
        [
            broken.select("path", F.lit(None).cast("int").alias("pos"), nothing.alias("payload"), F.col("_broken").alias("error")),
            trimmed.withColumn("error", nothing),
            decode.explode_array(good.filter(F.col("_decoder") == "json"), "_body", strict=False).select(*keep),
            decode.decode_csv(good.filter(F.col("_decoder") == "csv"), "_body").select(*keep),
        ],
    )


def read_dump(
    spark: SparkSession,
    globs: str | Sequence[str],
    marker: tuple[Any, str] | None = None,
    whole_file_bytes: int = WHOLE_FILE_BYTES,
) -> DataFrame:
    """Rows of every listed file: `path`, `position`, `pos`, `payload`, `error`.

    Files of any size are split over tasks, and so are gzip files whose name does not end in `.gz`, at
    their members. Spark's readers unpack files of that name themselves and show no members: such a file is one task's
    work, held whole up to `whole_file_bytes` and read as a stream above them, where damage fails the
    job instead of giving a row. A file that cannot be read gives a row with `error`; pass the result to `sound_prefix` to
    stop before the first of them. Sizes come from the listing, and no content is loaded to be thrown away.
    Files of no bytes are passed over, as by all of Spark's readers.
    """
    # `decoder_of` raises for a name it does not know
    files = _files(spark, globs, marker).withColumn("_decoder", decode.decoder_of(F.col("path")))
    listed = cut_lineage(files.select("path", "position", "size", "_decoder").distinct())
    named = F.col("path").endswith(".gz")
    ranged = listed.filter(~named | (F.col("size") > whole_file_bytes))
    by_kind: dict[tuple[str, bool], list[str]] = {}
    for r in ranged.select("path", "_decoder", named.alias("named")).collect():
        by_kind.setdefault((r["_decoder"], r["named"]), []).append(r["path"])
    parts = [_held(files.filter(named & (F.col("size") <= whole_file_bytes)))]
    for (kind, is_named), paths in sorted(by_kind.items()):
        packed = set() if is_named else _packed_paths(spark, paths)
        plain = [p for p in paths if p not in packed]
        parts += [_framed(spark, kind, plain)] if plain else []
        parts += [_unpacked(spark, kind, sorted(packed))] if packed else []
    rows = reduce(DataFrame.unionByName, parts)
    # one row a file, most often few enough to be broadcast; adaptive execution sees
    out = rows.join(listed.select("path", "position"), "path")
    return out.select("path", "position", "pos", "payload", "error")

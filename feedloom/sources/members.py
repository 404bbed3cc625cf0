"""Gzip bodies of many members, whatever their files' names: members found, verified and unpacked in parallel.

The bytes come as pieces between gzip's magic, which a text reader with that separator gives from ranges of a
file. Each piece may begin a member, or the magic stands by chance in packed bytes; the check sum at a member's
end tells. Members inside a chunk are unpacked there; one that crosses chunks is put together from its parts. A
member's unpacked bytes are one value, so a member may hold 2 GB at most.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedloom.operators.framing import chunk_batches
from feedloom.session import bounded_batches, cut_lineage

MAGIC = b"\x1f\x8b\x08"

_FOUND = "path string, chunk long, part int, n long, kind string, data binary, error string"
_TYPES = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.binary(), pa.string()]
_MEMBER = "path string, chunk long, n long, content binary, error string"


def raw_pieces(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Bytes of files between gzip magics: `path`, `chunk` (the range's first byte) and `value`, in order."""
    text = spark.read.option("encoding", "ISO-8859-1").text(list(paths), lineSep=MAGIC.decode("latin-1"))
    return text.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("chunk"),
        F.col("value").cast("binary").alias("value"),
    )


class _Unpacker:
    """Members of one chunk, from its pieces in order."""

    def __init__(self, path: str, chunk: int) -> None:
        self.path, self.chunk, self.n = path, chunk, 0
        self.lead: list[bytes] = []  # what an earlier chunk's member goes on with
        self.raw: list[bytes] = []  # pieces of the member that is being tried
        self.sure = False  # whether a member has ended in this chunk
        self.lost = False  # inside of a damaged member
        self.again()

    def again(self) -> None:
        self.inflater, self.out = zlib.decompressobj(wbits=31), []

    def row(self, part: int, kind: str, data: bytes | None, error: str | None = None) -> tuple:
        return self.path, self.chunk, part, self.n, kind, data, error

    def bad(self, problem: str) -> Iterator[tuple]:
        if not self.lost:
            yield self.row(2, "bad", None, problem)
            self.n += 1
        self.lost = True

    def feed(self, piece: bytes) -> Iterator[tuple]:
        waiting = [piece]
        while waiting:
            piece = waiting.pop(0)
            self.raw.append(piece)
            try:
                self.out.append(self.inflater.decompress(piece))
            except zlib.error as problem:
                # no member begins at the first of these pieces; one may begin at the next
                first, waiting = self.raw[0], self.raw[1:] + waiting
                self.raw = []
                self.again()
                if self.sure:
                    yield from self.bad(str(problem))
                else:
                    self.lead.append(first)
                continue
            if self.inflater.eof:
                yield self.row(2, "member", b"".join(self.out))
                self.n, self.sure, self.lost = self.n + 1, True, False
                if self.inflater.unused_data.strip(b"\0"):
                    yield from self.bad("bytes between members")
                self.raw = []
                self.again()

    def end(self) -> Iterator[tuple]:
        if self.lead:
            yield self.row(0, "lead", b"".join(self.lead))
        if self.raw:
            yield self.row(1, "open" if self.sure else "maybe", b"".join(self.raw))


# Rows, and bytes of them, that a task hands back at once; a longer row is a batch of its own.
GATHER_ROWS, GATHER_BYTES = 4096, 4 << 20


def _gathered(schema: str, types: Sequence[pa.DataType], rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows in batches of bounded size: members may be short, and a batch for each costs more than its bytes."""
    names = [f.split()[0] for f in schema.split(", ")]

    def made(held: list[tuple]) -> pa.RecordBatch:
        columns = zip(zip(*held, strict=True), types, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names=names)

    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, bytes))
        if len(held) >= GATHER_ROWS or size >= GATHER_BYTES:
            yield made(held)
            held, size = [], 0
    if held:
        yield made(held)


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for (path, chunk), own in chunk_batches(batches):
        unpacker, first = _Unpacker(path, chunk), True
        for batch in own:
            for value in batch.column("value"):
                # what stands before a body's first magic is no member, and nothing in a sound body
                head, first = first and chunk == 0, False
                piece = value.as_py() if head else MAGIC + value.as_py()
                if head and not piece:
                    continue
                yield from unpacker.feed(piece)
        yield from unpacker.end()


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _gathered(_FOUND, _TYPES, _unpacked(batches))


def _joined_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Members that cross chunks, from their parts in order; the parts of one owner stand together."""
    owner, start, inflater, got = None, None, None, []

    def give(content: bytes | None, error: str | None) -> tuple:
        return (start["path"], start["chunk"], start["n"], content, error)

    for batch in batches:
        for i in range(batch.num_rows):
            p = {c: batch.column(c)[i].as_py() for c in ("path", "owner", "chunk", "n", "data")}
            if (p["path"], p["owner"]) != owner:
                if inflater is not None:
                    yield give(None, "truncated gzip member")
                owner, inflater = (p["path"], p["owner"]), None
            if inflater is None:
                start, inflater, got = p, zlib.decompressobj(wbits=31), []
            try:
                got.append(inflater.decompress(p["data"]))
            except zlib.error as problem:
                yield give(None, str(problem))
                inflater = None
                continue
            if inflater.eof:
                yield give(b"".join(got), None)
                if inflater.unused_data.strip(b"\0"):
                    yield give(None, "bytes between members")
                inflater = None
    if inflater is not None:
        yield give(None, "truncated gzip member")


def _crossing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.string()]
    yield from _gathered(_MEMBER, types, _joined_parts(batches))


def members(pieces: DataFrame) -> DataFrame:
    """`path`, `member` (counted from 0), `content`, `error` of gzip bodies in raw pieces; written once.

    A damaged member has its place and an `error`, and no content.
    """
    bounded_batches(pieces.sparkSession)
    found = cut_lineage(pieces.select("path", F.col("chunk").cast("long").alias("chunk"), "value").mapInArrow(_found, _FOUND))
    parts = found.where(F.col("kind").isin("lead", "open", "maybe"))
    # a part goes on with the last member that surely began before it
    along = Window.partitionBy("path").orderBy("chunk", "part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begins = F.last(F.when(F.col("kind") == "open", F.col("chunk")), ignorenulls=True).over(along)
    owners = parts.select("path", "chunk", "part", "kind").withColumn("owner", F.coalesce(begins, F.lit(-1)))
    whole = found.where(F.col("kind").isin("member", "bad")).select("path", "chunk", "n", F.col("data").alias("content"), "error")
    crossing = (
        parts.join(owners.select("path", "chunk", "part", "owner"), ["path", "chunk", "part"])
        .repartition("path", "owner")
        .sortWithinPartitions("path", "owner", "chunk", "part")
        .mapInArrow(_crossing, _MEMBER)
    )
    every = cut_lineage(whole.unionByName(crossing).withColumn("_id", F.monotonically_increasing_id()))
    order = Window.partitionBy("path").orderBy("chunk", "n", "_id")
    numbers = every.select("path", "chunk", "n", "_id").withColumn("member", F.row_number().over(order) - 1)
    return every.join(numbers.select("_id", "member"), "_id").select("path", "member", "content", "error")


def member_pieces(found: DataFrame, sep: str) -> DataFrame:
    """Unpacked bodies as pieces between separators: `path`, `chunk`, `i` (their order in it) and `value`.

    A piece may cross members; it is put together in the chunk of the member that it begins in.
    """
    mark = sep.encode()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for path, member, content in zip(*[batch.column(c) for c in ("path", "member", "content")], strict=True):
                name, number, data = path.as_py(), member.as_py(), content.as_py().split(mark)
                last = len(data) - 1
                kinds = ["mid"] if not last else ["head", *["whole"] * (last - 1), "tail"]
                yield from ((name, number, i, kind, part) for i, (kind, part) in enumerate(zip(kinds, data, strict=True)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        yield from _gathered(schema, types, rows(batches))

    schema = "path string, member long, i long, kind string, data binary"
    sound = found.select("path", F.col("member").cast("long").alias("member"), "content")
    # members are joined to their numbers and cut once; all that follows reads what was written
    pieces = cut_lineage(sound.mapInArrow(cut, schema))
    before = Window.partitionBy("path").orderBy("member").rowsBetween(Window.unboundedPreceding, -1)
    begun = pieces.where("i = 0").select("path", "member", (F.col("kind") == "head").alias("has"))
    owner = F.coalesce(F.last(F.when(F.col("has"), F.col("member")), ignorenulls=True).over(before), F.lit(-1))
    owners = begun.withColumn("owner", owner).drop("has")
    whole = pieces.where("kind = 'whole'").select("path", F.col("member").alias("chunk"), "i", "data")
    parts = pieces.where("kind <> 'whole'").join(owners, ["path", "member"])
    parts = parts.withColumn("owner", F.when(F.col("kind") == "tail", F.col("member")).otherwise(F.col("owner")))
    joined = parts.groupBy("path", F.col("owner").alias("chunk")).agg(
        F.max(F.when(F.col("kind") == "tail", F.col("i")).otherwise(F.lit(0))).alias("i"),
        F.expr("aggregate(array_sort(collect_list(struct(member, data))), x'', (a, p) -> concat(a, p.data))").alias("data"),
        F.max((F.col("kind") == "head").cast("int")).alias("closed"),
    )
    # behind a body's last separator there is no piece unless something stands there
    joined = joined.where((F.col("closed") == 1) | (F.octet_length("data") > 0)).drop("closed")
    text = F.make_valid_utf8(F.col("data").cast("string"))
    return whole.unionByName(joined).select("path", "chunk", "i", text.alias("value"))


def problems(found: DataFrame) -> DataFrame:
    """`path` and `error` of the bodies with a damaged member: the first of them and its place."""
    bad = found.where(F.col("error").isNotNull())
    first = bad.groupBy("path").agg(F.min(F.struct("member", "error")).alias("f"))
    return first.select("path", F.format_string("gzip member %d: %s", F.col("f.member"), F.col("f.error")).alias("error"))

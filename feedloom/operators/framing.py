"""Rows of bodies that no task holds: JSON arrays and CSV cut in chunks, each chunk a task's work.

A body arrives as pieces, its text between one separator and the next (commas of JSON, line breaks of CSV),
in chunks of consecutive pieces. Whether a separator ends a row depends on everything before it, but a chunk
only has two ways to begin: inside a quoted text or not. So each chunk tells what it does to either state;
the states at all chunk borders follow from these few numbers by a walk along the chunks of a body, and every
chunk then cuts its rows by itself. A row that crosses a border is put together from its parts.

Two passes read the pieces: one for the states, one that cuts the rows and writes them to the checkpoint folder,
where their errors are looked for before they are given. Of the states only one small row for each chunk is kept.
"""

from __future__ import annotations

import csv
import io
import json
import sys
from collections.abc import Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.functions.json import bind
from feedloom.functions.numbering import shuffle_partitions
from feedloom.operators.decode import element_texts
from feedloom.session import bounded_batches, cut_lineage

# Chunks, and bytes of headers, that are broadcast; beyond them the pieces or rows are shuffled once.
BROADCAST_CHUNKS = 1_000_000
BROADCAST_BYTES = 32 << 20

OUT, QUOTED, BROKEN = 0, 1, 2

_SUMMARY = (
    "path string, chunk long, exit0 int, exit1 int, delta0 long, delta1 long, low0 long, low1 long, "
    "ends0 boolean, ends1 boolean"
)
_ENTRY = "path string, chunk long, state int, depth long, fresh boolean, owner long, last boolean"
_CUT = "path string, chunk long, part long, n long, whole boolean, text string, fields array<string>, error string"


class JsonFrame:
    """Elements of a top-level array, cut at its own commas."""

    sep = ","

    @staticmethod
    def states(values: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """At the end of each piece: quotes so far (odd or even) and the depth of brackets outside of texts.

        The depths are for a first piece that begins outside and inside of a text. A comma is no part of an
        escape, so none crosses a piece's end.
        """
        offsets = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1]
        data = np.frombuffer(values.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        ends = offsets[1:] - offsets[0]
        quotes = np.flatnonzero(data == 34)
        slashes = np.flatnonzero(data == 92)
        if len(slashes) and len(quotes):
            # slashes in a row before a quote, within its piece
            plain = np.ones(len(data), bool)
            plain[slashes] = False
            begin = np.append(0, ends[:-1])
            last = np.where(plain, np.arange(len(data)), -1)
            last = np.maximum.accumulate(np.append(-1, last))[quotes]
            piece = np.searchsorted(ends, quotes, side="right")
            quotes = quotes[(quotes - 1 - np.maximum(last, begin[piece] - 1)) % 2 == 0]
        kinds = data | 32
        brackets = np.flatnonzero((kinds == 123) | (kinds == 125))
        step = np.where((data[brackets] | 32) == 123, 1, -1)
        inside = np.searchsorted(quotes, brackets) % 2
        upto = np.searchsorted(brackets, ends)
        depths = [np.append(0, np.cumsum(np.where(inside == s, step, 0)))[upto] for s in (0, 1)]
        return np.searchsorted(quotes, ends) % 2, depths[0], depths[1]


def csv_exit(text: str, quoted: bool) -> int:
    """State behind a piece of CSV that begins at a record's start or inside a quoted field."""
    at = 0
    while True:
        if quoted:
            at = text.find('"', at)
            if at < 0:
                return QUOTED
            if text.startswith('""', at):
                at += 2
                continue
            at += 1
            if at == len(text):
                return OUT
            if text[at] not in ",\r":
                return BROKEN
            at, quoted = at + 1, False
        if text.startswith('"', at):
            at, quoted = at + 1, True
            continue
        comma, line = text.find(",", at), text.find("\r", at)
        if comma < 0 and line < 0:
            return OUT
        at = min(x for x in (comma, line) if x >= 0) + 1


def csv_rows(text: str) -> Iterator[list[str]]:
    """Fields of the records in a text; blank lines give none."""
    csv.field_size_limit(sys.maxsize)
    yield from (fields for fields in csv.reader(io.StringIO(text, newline=""), strict=True) if fields)


# Rows, and bytes of them, that a task hands back at once.
GATHER_ROWS, GATHER_BYTES = 4096, 4 << 20


def runs_of(batch: pa.RecordBatch) -> list[tuple[tuple, int, int]]:
    """((path, chunk), begin, end) of the rows of each chunk in a batch whose rows stand chunk by chunk."""
    paths, chunks = batch.column("path"), np.asarray(batch.column("chunk"))
    codes = np.asarray(paths.dictionary_encode().indices)
    cuts = (np.flatnonzero((np.diff(codes) != 0) | (np.diff(chunks) != 0)) + 1).tolist()
    return [((paths[a].as_py(), int(chunks[a])), a, b) for a, b in zip([0, *cuts], [*cuts, len(chunks)], strict=True)]


def chunk_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Iterator[pa.RecordBatch]]]:
    """((path, chunk), its batches) for rows that stand chunk by chunk."""

    def runs() -> Iterator[tuple[tuple, pa.RecordBatch]]:
        for batch in batches:
            if not batch.num_rows:
                continue
            for key, a, b in runs_of(batch):
                yield key, batch.slice(a, b - a)

    source = runs()
    held = next(source, None)
    while held is not None:
        key = held[0]

        def own() -> Iterator[pa.RecordBatch]:
            nonlocal held
            while held is not None and held[0] == key:
                yield held[1]
                held = next(source, None)

        yield key, own()


def _rows(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    names = [f.split()[0] for f in schema.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string())}
    types = [kinds[f.split()[1]] for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def _gathered(schema: str, rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows in batches of bounded size; many chunks are short, and a batch for each would cost more than its rows."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) if isinstance(v, str) else sum(map(len, v)) if isinstance(v, list) else 8 for v in row)
        if len(held) >= GATHER_ROWS or size >= GATHER_BYTES:
            yield _rows(schema, held)
            held, size = [], 0
    if held:
        yield _rows(schema, held)


# Depth of a chunk that has no piece ending outside of a text; no body is as deep.
_NO_LOW = 1 << 60


def _json_summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """What each chunk does to either state, from one walk over a whole batch; a chunk over two batches is composed."""

    def row(key: tuple, ways: list[tuple[int, int, int]]) -> tuple:
        lows = [None if low >= _NO_LOW // 2 else low for _, _, low in ways]
        return (*key, *[w[0] for w in ways], *[w[1] for w in ways], *lows, None, None)

    key, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        runs = runs_of(batch)
        begin, end = np.array([a for _, a, _ in runs]), np.array([b for _, _, b in runs])
        flips, *depths = (np.append(0, x) for x in JsonFrame.states(batch.column("value")))
        before, of = flips[begin], np.repeat(np.arange(len(runs)), end - begin)
        ways = []
        for s in (0, 1):
            text = flips[1:] ^ before[of] ^ s
            inside = (before ^ s) == 1
            moved = np.where(inside[of], depths[1][1:], depths[0][1:])
            moved = moved - np.where(inside, depths[1][begin], depths[0][begin])[of]
            low = np.minimum.reduceat(np.where(text == 0, moved, _NO_LOW), begin)
            ways.append(list(zip(text[end - 1].tolist(), moved[end - 1].tolist(), low.tolist(), strict=True)))
        for (own, _, _), *mine in zip(runs, *ways, strict=True):
            if own == key:
                held = [(mine[x][0], d + mine[x][1], min(low, d + mine[x][2])) for x, d, low in held]
                continue
            if key is not None:
                yield row(key, held)
            key, held = own, mine
    if key is not None:
        yield row(key, held)


def _summarise_json(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _gathered(_SUMMARY, _json_summaries(batches))


def _csv_summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for (path, chunk), own in chunk_batches(batches):
        state, ends = [OUT, QUOTED], [False, False]
        for batch in own:
            for text in batch.column("value").to_pylist():
                if '"' in text:
                    state = [s if s == BROKEN else csv_exit(text, s == QUOTED) for s in state]
                ends = [e or s == OUT for e, s in zip(ends, state, strict=True)]
        yield (path, chunk, *state, 0, 0, None, None, *ends)


def _summarise_csv(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _gathered(_SUMMARY, _csv_summaries(batches))


def _entries(kind: str) -> Any:
    """Walk along the chunks of bodies: the state that each begins in, and the chunk its first row began in.

    The rows of a body stand together, in order. One walk goes over all bodies of a partition, so a body costs
    no more than its chunks.
    """

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        last: tuple | None = None
        state, depth, owner = OUT, 0, None
        for batch in batches:
            for r in batch.to_pylist():
                if last is not None:
                    yield (*last, r["path"] != last[0])
                if last is None or r["path"] != last[0]:
                    state, depth, owner = OUT, 0, None
                fresh = owner is None
                begun = r["chunk"] if fresh else owner
                last = (r["path"], r["chunk"], state, depth, fresh, begun)
                if state == BROKEN:
                    continue
                way = str(state)
                if kind == "json":
                    low = r["low" + way]
                    top = None if low is None else depth + low
                    depth += r["delta" + way]
                    state = r["exit" + way]
                    if top is not None and top < 1:
                        state = BROKEN
                    ends, whole = top == 1, state == OUT and depth == 1
                else:
                    ends, state = r["ends" + way], r["exit" + way]
                    whole = state == OUT
                owner = None if whole else r["chunk"] if ends else begun
        if last is not None:
            yield (*last, True)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _gathered(_ENTRY, walked(batches))

    return walk


# Chunks of one partition of the walk, about; adaptive execution would merge all into a task, as they are short.
WALK_CHUNKS = 20_000


def _walked(summary: DataFrame, kind: str, chunks: int) -> DataFrame:
    parts = max(shuffle_partitions(summary), -(-chunks // WALK_CHUNKS))
    return summary.repartition(parts, "path").sortWithinPartitions("path", "chunk").mapInArrow(_entries(kind), _ENTRY)


class _Cutter:
    """Rows of one chunk: whole ones numbered from 0, and the parts of those that cross its borders."""

    def __init__(self, key: tuple, entry: dict[str, Any]) -> None:
        (self.path, self.chunk), self.entry = key, entry
        self.n, self.held, self.open = 0, [], not entry["fresh"]
        self.done = entry["state"] == BROKEN
        self.out: list[tuple] = []

    def give(self, text: str | None = None, fields: list[str] | None = None, error: str | None = None) -> None:
        self.out.append((self.path, self.chunk, self.chunk, self.n, True, text, fields, error))
        self.n += 1

    def fail(self, error: str) -> None:
        self.give(error=error)
        self.done = True

    def part(self, text: str) -> None:
        """A piece of a row that began in another chunk, or one that ends there."""
        n = -1 if self.open else self.n
        owner = self.entry["owner"] if self.open else self.chunk
        self.out.append((self.path, owner, self.chunk, n, False, text, None, None))

    def taken(self) -> list[tuple]:
        made, self.out = self.out, []
        return made


def _entry_of(batch: pa.RecordBatch, at: int = 0) -> dict[str, Any]:
    entry = {c: batch.column(c)[at].as_py() for c in ("state", "depth", "fresh", "owner", "last")}
    if entry["state"] is None:
        raise ValueError("the chunks of a body changed between two reads")
    return entry


NOT_AN_ARRAY = "not a complete JSON array"


class _JsonCutter(_Cutter):
    """Rows of one chunk of a JSON array, from its pieces and what they leave the state and the depth at."""

    def __init__(self, key: tuple, entry: dict[str, Any]) -> None:
        super().__init__(key, entry)
        self.parity, self.depth, self.over = entry["state"], entry["depth"], False
        self.first = self.depth == 0 and entry["fresh"] and self.parity == OUT
        if not self.first and self.depth < 1:
            self.done = True
        if self.done:
            self.fail(NOT_AN_ARRAY)

    def run(self, text: str, ending: bool) -> None:
        """A row's text is complete, or the chunk ends in it."""
        if self.first:  # the body's first row begins behind the bracket
            self.first = False
            if not text.lstrip().startswith("["):
                return self.fail(NOT_AN_ARRAY)
            text = text.lstrip()[1:]
        if ending and self.over:  # the last one ends before the bracket
            text = text.rstrip()
            if not text.endswith("]"):
                return self.fail(NOT_AN_ARRAY)
            text = text[:-1]
            if not text.strip() and not self.n and not self.open and self.entry["depth"] == 0:
                return None
        if self.open or (ending and not self.over):
            self.part(text)
            self.open = self.open and ending
            return None
        return self.give(text)

    def feed(self, values: list[str], flips: np.ndarray, depths: Sequence[np.ndarray]) -> None:
        """Pieces with quotes (odd or even) and brackets since the first of them, as `JsonFrame.states` gives them."""
        if self.done:
            return
        depth = self.depth + depths[self.parity]
        text = flips ^ self.parity
        self.parity, self.depth = int(text[-1]), int(depth[-1])
        if self.over:  # something follows the array
            return self.fail(NOT_AN_ARRAY)
        closed = np.flatnonzero((text == 0) & (depth < 1))
        if len(closed) and int(closed[0]) < len(values) - 1:
            return self.fail(NOT_AN_ARRAY)
        self.over = bool(len(closed))
        at = 0
        for end in np.flatnonzero((text == 0) & (depth == 1)).tolist():
            self.run(",".join([*self.held, *values[at : end + 1]]), False)
            self.held, at = [], end + 1
            if self.done:
                break
        self.held += values[at:]
        return None

    def end(self) -> None:
        if self.done:
            return
        if self.entry["last"] != (self.over and bool(self.held)):
            self.fail(NOT_AN_ARRAY)
        elif self.held:
            self.run(",".join(self.held), True)


def _json_cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    key, cutter = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column("value").to_pylist()
        flips, *depths = (np.append(0, x) for x in JsonFrame.states(batch.column("value")))
        for own, a, b in runs_of(batch):
            if own != key:
                if cutter is not None:
                    cutter.end()
                    yield from cutter.taken()
                key, cutter = own, _JsonCutter(own, _entry_of(batch, a))
            moved = [d[a + 1 : b + 1] - d[a] for d in depths]
            # brackets are told apart by the quotes since the batch began
            cutter.feed(values[a:b], flips[a + 1 : b + 1] ^ flips[a], moved[::-1] if flips[a] else moved)
            yield from cutter.taken()
    if cutter is not None:
        cutter.end()
        yield from cutter.taken()


def _cut_json(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _gathered(_CUT, _json_cuts(batches))


def _csv_cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for key, own in chunk_batches(batches):
        cutter: _Cutter | None = None
        state = OUT

        def run(text: str) -> None:
            if cutter.open:
                cutter.part(text)
                cutter.open = False
                return
            try:
                for fields in csv_rows(text):
                    cutter.give(fields=fields)
            except csv.Error as problem:
                cutter.fail(str(problem))

        for batch in own:
            if cutter is None:
                cutter = _Cutter(key, _entry_of(batch))
                state = cutter.entry["state"]
            if cutter.done:
                continue
            for text in batch.column("value").to_pylist():
                cutter.held.append(text)
                if '"' in text:
                    state = csv_exit(text, state == QUOTED)
                if state != QUOTED:
                    run("\n".join(cutter.held))
                    cutter.held = []
                    cutter.done = cutter.done or state == BROKEN
                    yield from cutter.taken()
                if cutter.done:
                    break
        if cutter.held and not cutter.done:
            text = "\n".join(cutter.held)
            if cutter.entry["last"]:
                run(text)
            else:
                cutter.part(text)
        yield from cutter.taken()


def _cut_csv(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _gathered(_CUT, _csv_cuts(batches))


def _merged_csv(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of texts that were put together from their parts."""

    def cuts() -> Iterator[tuple]:
        for batch in batches:
            for r in batch.to_pylist():
                n = r["n"]
                try:
                    for fields in csv_rows(r["text"]):
                        yield (r["path"], r["chunk"], r["chunk"], n, True, None, fields, None)
                        n += 1
                except csv.Error as problem:
                    yield (r["path"], r["chunk"], r["chunk"], n, True, None, None, str(problem))

    yield from _gathered(_CUT, cuts())


def _attached(pieces: DataFrame, entries: DataFrame, chunks: int, order: Sequence[str]) -> DataFrame:
    """Pieces with their chunk's entry, still chunk by chunk and in order.

    A sort below a join may be dropped, as a join keeps no order that it promises; so it is made above.
    """
    if chunks <= BROADCAST_CHUNKS:
        joined = pieces.join(F.broadcast(entries), ["path", "chunk"], "left")
        return joined.sortWithinPartitions("path", "chunk", *order) if order else joined
    if not order:
        pieces, order = pieces.withColumn("_order", F.monotonically_increasing_id()), ["_order"]
    joined = pieces.join(entries.hint("merge"), ["path", "chunk"], "left")
    return joined.sortWithinPartitions("path", "chunk", *order)


def _merged(cut: DataFrame, sep: str) -> DataFrame:
    """(path, chunk, n, text) of the rows that cross borders, put together from their parts in order."""
    parts = F.array_sort(F.collect_list(F.struct("part", "text")))
    return cut.where("NOT whole").groupBy("path", "chunk").agg(
        F.max("n").alias("n"), F.array_join(F.transform(parts, lambda t: t["text"]), sep).alias("text")
    )


def _json_rows(cut: DataFrame) -> DataFrame:
    """(path, chunk, n, payload, error): every text has to be one JSON value."""
    columns = ["path", "chunk", "n", "text", "error"]
    texts = cut.where("whole").select(*columns).unionByName(
        _merged(cut, JsonFrame.sep).withColumn("error", F.lit(None).cast("string"))
    )
    texts = bind(texts, _items=element_texts(F.concat(F.lit("["), F.col("text"), F.lit("]"))))
    wrong = F.col("_items").isNull() | (F.size("_items") != 1)
    return texts.select(
        "path",
        "chunk",
        "n",
        F.get("_items", F.lit(0)).alias("payload"),
        F.coalesce("error", F.when(wrong, F.lit(NOT_AN_ARRAY))).alias("error"),
    )


def _csv_rows(cut: DataFrame) -> DataFrame:
    """(path, chunk, n, fields, error)."""
    merged = _merged(cut, "\n").mapInArrow(_merged_csv, _CUT)
    return cut.where("whole").unionByName(merged).select("path", "chunk", "n", "fields", "error")


def _stops(rows: DataFrame, *more: Column) -> DataFrame:
    """By chunk: the rows before it in its body, and the body's first error, if any (chunk, n, error)."""
    good = F.col("error").isNull()
    counted = cut_lineage(
        rows.groupBy("path", "chunk").agg(
            F.sum(good.cast("long")).alias("rows"), F.min(F.when(~good, F.struct("n", "error"))).alias("bad"), *more
        )
    )
    body = Window.partitionBy("path")
    along = body.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    bad = F.struct("chunk", F.col("bad.n").alias("n"), F.col("bad.error").alias("error"))
    return counted.select(
        "path",
        "chunk",
        F.coalesce(F.sum("rows").over(along), F.lit(0)).alias("before"),
        F.min(F.when(F.col("bad").isNotNull(), bad)).over(body).alias("stop"),
        *[m for m in counted.columns if m == "first"],
    )


def _placed(rows: DataFrame, stops: DataFrame, chunks: int) -> DataFrame:
    """Sound rows with what is known of their chunk."""
    known = stops.select("path", "chunk", "before", "stop")
    good = rows.where(F.col("error").isNull()).drop("error")
    return good.join(F.broadcast(known) if chunks <= BROADCAST_CHUNKS else known, ["path", "chunk"])


def _json_out(rows: DataFrame, stops: DataFrame, chunks: int) -> DataFrame:
    out = _placed(rows, stops, chunks).where(F.col("stop").isNull())
    return out.select("path", (F.col("before") + F.col("n")).alias("pos"), "payload")


def _csv_out(rows: DataFrame, stops: DataFrame, chunks: int, header: bool) -> DataFrame:
    out = _placed(rows, stops, chunks)
    at = F.struct("chunk", "n") < F.struct(F.col("stop.chunk").alias("chunk"), F.col("stop.n").alias("n"))
    out = out.where(F.col("stop").isNull() | at).withColumn("pos", F.col("before") + F.col("n"))
    if not header:
        return out.select("path", "pos", _record(F.col("fields"), F.array().cast("array<string>")).alias("payload"))
    # the first record of a body names the fields of the others
    first = F.min(F.when(F.col("first").isNotNull(), F.struct("chunk", "first")))
    names = cut_lineage(
        stops.groupBy("path").agg(first.alias("f")).select("path", F.col("f.first.fields").alias("names"))
    )
    size = names.agg(F.sum(F.octet_length(F.array_join("names", ",")) + F.octet_length("path"))).first()[0] or 0
    named = out.where("pos > 0").join(F.broadcast(names) if size <= BROADCAST_BYTES else names, "path")
    return named.select("path", (F.col("pos") - 1).alias("pos"), _record(F.col("fields"), F.col("names")).alias("payload"))


def _record(fields: Column, names: Column) -> Column:
    """The fields as a JSON object; one beyond the names is `col_<i>`."""

    def compose(every: pd.Series, named: pd.Series) -> pd.Series:
        out = []
        for own, known in zip(every, named, strict=True):
            keys = [*known, *[f"col_{i}" for i in range(len(known), len(own))]]
            out.append(json.dumps(dict(zip(keys, own, strict=False)), ensure_ascii=False, separators=(",", ":")))
        return pd.Series(out, dtype=object)

    return F.pandas_udf(compose, "string")(fields, names)


def rows_of_pieces(
    pieces: DataFrame, kind: str, header: bool = True, order: Sequence[str] = ()
) -> DataFrame:
    """`path`, `pos`, `payload`, `error` of bodies that come as pieces.

    `pieces` has `path`, `chunk` (a whole number that grows along the body) and `value`, the text between two
    separators. The pieces of a chunk stand in order in one partition, as a text reader with that separator
    gives them, or the columns `order` say it and the pieces are shuffled by chunk. kind: `json` (a top-level array, pieces between commas; a body that is none gives one row with
    `error` and no other) or `csv` (pieces between line feeds; a body that stops being CSV gives the rows before that
    place, then one with `error`). The rows do not depend on where the chunks end.
    """
    if kind not in ("json", "csv"):
        raise ValueError("kind is 'json' or 'csv'")
    bounded_batches(pieces.sparkSession)
    pieces = pieces.select("path", F.col("chunk").cast("long").alias("chunk"), "value", *order)
    if order:
        pieces = pieces.repartition("path", "chunk")
    ordered = pieces.sortWithinPartitions("path", "chunk", *order) if order else pieces
    if order:  # made and shuffled once; a reader's ranges are read again instead
        ordered = pieces = cut_lineage(ordered)
    summary = cut_lineage(ordered.mapInArrow(_summarise_json if kind == "json" else _summarise_csv, _SUMMARY))
    chunks = summary.count()
    entries = cut_lineage(_walked(summary, kind, chunks))
    cut = _attached(pieces, entries, chunks, order).mapInArrow(_cut_json if kind == "json" else _cut_csv, _CUT)
    # every row is cut and parsed once; the errors and the rows are read from what was written
    cut = cut_lineage(cut)
    if kind == "json":
        rows = cut_lineage(_json_rows(cut))
        stops = _stops(rows)
        out = _json_out(rows, stops, chunks)
    else:
        rows = _csv_rows(cut)
        stops = _stops(rows, F.min(F.when(F.col("error").isNull(), F.struct("n", "fields"))).alias("first"))
        out = _csv_out(rows, stops, chunks, header)
    nothing = F.lit(None).cast("string")
    failed = stops.where(F.col("stop.chunk") == F.col("chunk")).select(
        "path", F.lit(None).cast("int").alias("pos"), nothing.alias("payload"), F.col("stop.error").alias("error")
    )
    return out.select("path", F.col("pos").cast("int").alias("pos"), "payload", nothing.alias("error")).unionByName(failed)

"""Growing files at scale: every finished line once, in batches of bounded bytes (S13, S14).

The `line_tail` stream keeps its offsets on the driver, which opens every file. Here the offsets are a table
and a batch is planned by Spark jobs: files are listed by Spark's reader, opened, told apart and measured in
tasks, and the bytes that a batch may take are dealt along a running total over the files. The driver sees
counts only. A plan is published by one rename before its lines are read, and a commit names it done, so a
batch that failed is read again with the same ranges.

Files must be where the driver and all executors see them under one path.
"""

from __future__ import annotations

import fnmatch
import json
import os
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.numbering import index_in_order, running_sum, span_bucket
from feedloom.session import bounded_batches, cut_lineage
from feedloom.sources.planned import PlannedBatches
from feedloom.sources.tail import BLOCK, SCHEMA, _block_sum, fingerprint, goes_on, range_lines

# Plans for which the end of a vanished file is kept, in case its content turns up elsewhere.
KEEP_PLANS = 10
PLAN = (
    "file_id string, path string, node string, key string, start long, end long, "
    "marks string, level int, level_sum long, served long, seen long"
)
PROBE = "path string, node string, key string, size long"
# Rows that Arrow hands over at once; a row of lines holds at most `max_line` bytes.
BATCH_BYTES = 4 << 20
BATCH_ROWS = 4096


def break_before(path: str, low: int, high: int) -> int:
    """Offset behind the last line break between two offsets; `low` if there is none."""
    with open(path, "rb") as file:
        end = high
        while end > low:
            begin = max(low, end - BLOCK)
            file.seek(begin)
            at = file.read(end - begin).rfind(b"\n")
            if at >= 0:
                return begin + at + 1
            end = begin
    return low


def break_after(path: str, at: int) -> int:
    """Offset behind the first line break at or after `at`; `at` if there is none."""
    with open(path, "rb") as file:
        file.seek(at)
        passed = at
        while piece := file.read(BLOCK):
            found = piece.find(b"\n")
            if found >= 0:
                return passed + found + 1
            passed += len(piece)
    return at


def prefix_marks(path: str, end: int) -> list[list[int]]:
    """[place, checksum] of the blocks that end at each power of two up to `end`, and at `end`.

    Places do not depend on `end` but for the last, so files can be compared before their ends are known.
    """
    places = {1 << k for k in range(end.bit_length())} | ({end} if end else set())
    with open(path, "rb") as file:
        return [[at, _block_sum(file, at)] for at in sorted(places)]


def _per_file(step: Callable[[dict], dict | None]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """A task's function that handles a row a file; a file that went away meanwhile has no row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for row in batch.to_dict("records"):
                try:
                    found.append(step(row))
                except FileNotFoundError:
                    continue
            rows = [r for r in found if r is not None]
            if rows:
                yield pd.DataFrame(rows)

    return run


def _known(value: object) -> bool:
    return value is not None and not pd.isna(value)


class LineFollower(PlannedBatches):
    """Batches of lines from files under `globs`; plans and commits are kept in `state`.

    `max_bytes` bounds what a batch reads; it must exceed `max_line`. A longer line than `max_line` is
    refused: it has no payload and its size in `refused_bytes`; if it exceeds a whole batch it makes one
    alone. Files take turns, those served longest ago first. `read_from="end"` passes over what the files
    hold at the first plan. A file is known by its inode as long as it begins with what was read; a copy,
    or a file that was moved across file systems, goes on where the vanished content ended. Names that
    begin with `_` or `.` are hidden, as to all of Spark's readers.
    """

    def __init__(
        self,
        spark: SparkSession,
        globs: str | Sequence[str],
        state: str,
        exclude: Sequence[str] = (),
        read_from: str = "beginning",
        header: int = 0,
        max_line: int = 1 << 20,
        max_bytes: int = 1 << 30,
        split: int = 64 << 20,
        wrap: bool = False,
    ) -> None:
        if read_from not in ("beginning", "end"):
            raise ValueError("read_from is 'beginning' or 'end'")
        if max_bytes <= max_line:
            raise ValueError("max_bytes must exceed max_line")
        super().__init__(spark, state)
        self.globs = [globs] if isinstance(globs, str) else list(globs)
        self.exclude, self.read_from, self.header = list(exclude), read_from, header
        self.max_line, self.max_bytes, self.split, self.wrap = max_line, max_bytes, split, wrap
        bounded_batches(spark)

    def _listed(self) -> DataFrame:
        found = None
        for names in self.globs:
            try:
                one = self.spark.read.format("binaryFile").load(names).select("path")
            except AnalysisException as problem:
                if problem.getCondition() != "PATH_NOT_FOUND":
                    raise
                continue
            found = one if found is None else found.unionByName(one)
        if found is None:
            found = self.spark.createDataFrame([], "path string")
        paths = found.select(F.regexp_replace("path", "^file:(//)?", "").alias("path")).distinct()
        for pattern in self.exclude:
            paths = paths.filter(~F.col("path").rlike(fnmatch.translate(pattern)))
        return paths

    def _probed(self) -> DataFrame:
        header = self.header

        def probe(row: dict) -> dict | None:
            state = os.stat(row["path"])
            key = fingerprint(row["path"], header)
            node = f"{state.st_dev:x}-{state.st_ino:x}"
            return key and {"path": row["path"], "node": node, "key": key, "size": state.st_size}

        files = self._listed().mapInPandas(_per_file(probe), PROBE)
        # names of one file by hard links
        return files.groupBy("node").agg(F.min_by(F.struct("path", "key", "size"), "path").alias("f")).select("node", "f.*")

    def _plan(self, number: int) -> bool:
        if number:
            known = self.spark.read.schema(PLAN).parquet(self._folder(number - 1))
        else:
            known = self.spark.createDataFrame([], PLAN)
        started = self._started(known)
        from_end = number == 0 and self.read_from == "end"

        def limit(row: dict) -> dict:
            row["limit"] = break_before(row["path"], int(row["start"]), int(row["size"]))
            if from_end:
                row["start"] = row["limit"]
            return row

        fields = f"{PROBE}, start long, marks string, level int, level_sum long, served long"
        limited = started.mapInPandas(_per_file(limit), f"{fields}, limit long")
        placed = index_in_order(limited.withColumn("_want", F.col("limit") - F.col("start")), ["served", "path"], "_place")
        dealt = running_sum(placed, "_want", ["_place"], [], span_bucket("_place", 100_000), "_taken")
        most = self.max_bytes

        def settle(row: dict) -> dict:
            path, start, left = row["path"], int(row["start"]), most - int(row["_taken"])
            end = int(row["limit"])
            if left <= 0:
                end = start
            elif end - start > left:
                end = break_before(path, start, start + left)
                if end == start and left == most:  # a line longer than a batch
                    end = break_after(path, start + left)
            marks = row["marks"] if end == start and _known(row["marks"]) else None
            if marks is None:
                marks = json.dumps(prefix_marks(path, end))
            level = end.bit_length() - 1
            sums = dict(json.loads(marks))
            return {
                "file_id": f"{row['key']}/{row['node']}", "path": path, "node": row["node"], "key": row["key"],
                "start": start, "end": end, "marks": marks, "level": level, "level_sum": sums.get(1 << level if end else 0, 0),
                "served": number if end > start else row["served"], "seen": number,
            }

        plan = dealt.mapInPandas(_per_file(settle), PLAN)
        gone = known.join(started.select("node"), "node", "left_anti").filter(F.col("seen") > number - KEEP_PLANS)
        idle = gone.withColumn("start", F.col("end")).select(*plan.columns)

        def wanted(written: DataFrame) -> bool:
            if from_end and not written.isEmpty():  # what is passed over is remembered
                return True
            return not written.filter(F.col("end") > F.col("start")).isEmpty()

        return self._publish(plan.unionByName(idle), number, wanted)

    def _started(self, known: DataFrame) -> DataFrame:
        """Files as they are now, with the offset that each goes on from."""

        def check(row: dict) -> dict:
            same = _known(row["end"]) and goes_on(row["path"], {"end": int(row["end"]), "marks": json.loads(row["marks"])})
            row["same"] = same
            row["here"] = None if same else json.dumps(prefix_marks(row["path"], int(row["size"])))
            return row

        kept = known.select("node", "end", "marks", "level", "level_sum", "served")
        with_known = self._probed().join(kept, "node", "left")
        fields = f"{PROBE}, end long, marks string, level int, level_sum long, served long"
        checked = cut_lineage(
            with_known.select("path", "node", "key", "size", "end", "marks", "level", "level_sum", "served").mapInPandas(
                _per_file(check), f"{fields}, same boolean, here string"
            )
        )
        same = checked.filter("same")
        other = checked.filter("NOT same").select("path", "node", "key", "size", "here")
        # Content whose file is gone or holds something else; equal content once.
        orphans = (
            known.filter(F.col("end") > 0)
            .join(same.select("node"), "node", "left_anti")
            .select("key", "level", "level_sum", "end", "marks")
            .distinct()
        )
        places = F.explode(F.from_json("here", "array<array<bigint>>"))
        at_power = other.select("path", "key", "size", places.alias("m")).select(
            "path", "key", "size", F.col("m")[0].alias("_at"), F.col("m")[1].alias("level_sum")
        )
        powers = at_power.filter(F.col("_at").bitwiseAND(F.col("_at") - 1) == 0).withColumn(
            "level", F.round(F.log2("_at")).cast("int")
        )
        candidates = powers.join(orphans, ["key", "level", "level_sum"]).filter(F.col("end") <= F.col("size"))

        def verify(row: dict) -> dict | None:
            fits = goes_on(row["path"], {"end": int(row["end"]), "marks": json.loads(row["marks"])})
            return {"path": row["path"], "end": row["end"]} if fits else None

        moved = (
            candidates.select("path", "end", "marks")
            .mapInPandas(_per_file(verify), "path string, end long")
            .groupBy("path")
            .agg(F.max("end").alias("start"))
        )
        fresh = other.join(moved, "path", "left").select(
            "path", "node", "key", "size", F.coalesce("start", F.lit(0)).cast("bigint").alias("start"),
            F.lit(None).cast("string").alias("marks"), F.lit(None).cast("int").alias("level"),
            F.lit(None).cast("bigint").alias("level_sum"), F.lit(-1).cast("bigint").alias("served"),
        )
        going = same.select("path", "node", "key", "size", F.col("end").alias("start"), "marks", "level", "level_sum", "served")
        return cut_lineage(going.unionByName(fresh))

    def _rows(self, number: int) -> DataFrame:
        plan = self.spark.read.schema(PLAN).parquet(self._folder(number)).filter(F.col("end") > F.col("start"))
        split, max_line, wrap = self.split, self.max_line, self.wrap
        begins = F.explode(F.sequence(F.col("start"), F.col("end") - 1, F.lit(split)))
        ranges = plan.select("path", "file_id", begins.alias("_from"), "end").select(
            "path", "file_id", "_from", F.least(F.col("_from") + split, F.col("end")).alias("_to")
        )
        size = plan.agg(F.sum(F.col("end") - F.col("start")).alias("n")).first()["n"] or 0
        return ranges.repartition(max(1, -(-size // split))).mapInArrow(_reader(max_line, wrap), SCHEMA)


def _reader(max_line: int, wrap: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's function that reads the lines of byte ranges, in batches of bounded rows and bytes."""
    names = [field.split()[0] for field in SCHEMA.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64()}
    types = [kinds[field.split()[1]] for field in SCHEMA.split(", ")]

    def made(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(zip(*rows, strict=True), types, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names=names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for r in batch.select(["path", "file_id", "_from", "_to"]).to_pylist():
                for row in range_lines(r["path"], r["file_id"], r["_from"], r["_to"], max_line, wrap):
                    rows.append(row)
                    held += row[3] - row[2]
                    # a short line costs far more as a row than its bytes
                    if held >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
                        yield made(rows)
                        rows, held = [], 0
        if rows:
            yield made(rows)

    return read

"""A sink that publishes all topics of a batch and its checkpoint by one rename (D7, K8).

`df.write.format("topic_sink")` takes rows with a topic; rows with a text in the column `checkpoint` are the
batch's checkpoint instead. Tasks write files into a staging folder and hand their names to the driver. The
commit removes what failed or repeated attempts left there and renames the folder to `batch=<number>`, which
readers then see with every topic and the checkpoint, or not at all. A failure leaves the batch unpublished,
and a batch that is published already stays as it is, so a replay adds nothing.

Layout: `<path>/batch=<n>/topic=<name>/<file>.parquet` and `<path>/batch=<n>/_checkpoint/<file>.json`.
`spark.read.parquet(path)` reads the topics; hidden folders (the staging, the checkpoints) are none of its.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from feedloom.operators.checkpoint import CHECKPOINT_SCHEMA, latest_checkpoints

CHECKPOINT = "checkpoint"
# Fixed value: how Spark's readers name a partition of NULL.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
# Bytes that a task gathers for all of its topics before it writes them out as row groups.
BUFFER_BYTES = 32 << 20
# Files that a task keeps open at once; topics beyond begin files of their own again.
OPEN_FILES = 64


# Fixed value: characters that Spark's readers expect as %XX in the name of a partition's folder.
ESCAPED = frozenset("\"#%'*/:=?\\{[]^\x7f") | {chr(n) for n in range(32)}


def _folder_name(value: str) -> str:
    return "".join(f"%{ord(c):02X}" if c in ESCAPED else c for c in value)


def file_system(path: str) -> tuple[pa.fs.FileSystem, str]:
    """Arrow's file system of a path or URI, and the path inside it."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path.replace("file:/", "file:///") if path.startswith("file:/") and "://" not in path else path)
    return fs.LocalFileSystem(), path


@dataclass
class Written(WriterCommitMessage):
    """Files of one task, below the staging folder, and their rows."""

    files: list[str]
    rows: int


class TopicWriter(DataSourceArrowWriter):
    def __init__(self, path: str, batch: int, topic: str, schema: StructType) -> None:
        self.path, self.batch, self.topic = path.rstrip("/"), batch, topic
        self.columns = [f.name for f in schema.fields if f.name not in (topic, CHECKPOINT)]
        # a folder for each try of the whole job, whose name all tasks get with this writer
        self.staging = f"{self.path}/_staging/{batch}-{uuid.uuid4().hex}"

    @property
    def target(self) -> str:
        return f"{self.path}/batch={self.batch}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        context = TaskContext.get()
        files, root = file_system(self.staging)
        # attempts of one task do not meet
        name = f"part-{context.partitionId():05d}-{context.taskAttemptId()}"
        task = _TaskFiles(files, root, name)
        try:
            for batch in iterator:
                self._add(task, pa.Table.from_batches([batch]))
        finally:
            task.close()
        return Written(task.files, task.rows)

    def _add(self, task: _TaskFiles, table: pa.Table) -> None:
        if CHECKPOINT in table.column_names:
            held = pc.is_valid(table[CHECKPOINT])
            for text in table.filter(held)[CHECKPOINT].to_pylist():
                task.checkpoint(text)
            table = table.filter(pc.invert(held))
        topics = pc.dictionary_encode(table[self.topic].combine_chunks().cast(pa.string()), null_encoding="encode")
        body = table.select(self.columns)
        for code, value in enumerate(topics.dictionary.to_pylist()):
            task.add(value, body.filter(pc.equal(topics.indices, code)))

    def commit(self, messages: list[Written | None]) -> None:
        from pyarrow import fs

        files, staging = file_system(self.staging)
        _, target = file_system(self.target)
        files.create_dir(staging, recursive=True)
        if files.get_file_info(target).type != fs.FileType.NotFound:
            files.delete_dir(staging)
            return
        kept = {name for m in messages if m is not None for name in m.files}
        for found in files.get_file_info(fs.FileSelector(staging, recursive=True)):
            if found.type == fs.FileType.File and found.path[len(staging) :].lstrip("/") not in kept:
                files.delete_file(found.path)
        files.move(staging, target)

    def abort(self, messages: list[Written | None]) -> None:
        from pyarrow import fs

        files, staging = file_system(self.staging)
        if files.get_file_info(staging).type != fs.FileType.NotFound:
            files.delete_dir(staging)


class _TaskFiles:
    """Files of one task attempt: one a topic, written in row groups, and one of checkpoint rows."""

    def __init__(self, files: pa.fs.FileSystem, root: str, name: str) -> None:
        self.system, self.root, self.name = files, root, name
        self.files: list[str] = []
        self.rows = 0
        self._open: dict[str | None, pq.ParquetWriter] = {}
        self._held: dict[str | None, list[pa.Table]] = {}
        self._bytes = 0
        self._checkpoint = None

    def _new(self, folder: str, ending: str) -> str:
        self.system.create_dir(f"{self.root}/{folder}", recursive=True)
        path = f"{folder}/{self.name}-{len(self.files)}.{ending}"
        self.files.append(path)
        return f"{self.root}/{path}"

    def add(self, topic: str | None, table: pa.Table) -> None:
        if not table.num_rows:
            return
        self.rows += table.num_rows
        self._held.setdefault(topic, []).append(table)
        self._bytes += table.nbytes
        if self._bytes >= BUFFER_BYTES:
            self._flush()

    def _flush(self) -> None:
        for topic, tables in self._held.items():
            table = pa.concat_tables(tables)
            if topic not in self._open:
                if len(self._open) >= OPEN_FILES:
                    self._open.pop(next(iter(self._open))).close()
                value = NULL_PARTITION if topic is None or topic == "" else _folder_name(topic)
                self._open[topic] = pq.ParquetWriter(self._new(f"topic={value}", "parquet"), table.schema, filesystem=self.system)
            self._open[topic].write_table(table)
        self._held, self._bytes = {}, 0

    def checkpoint(self, text: str) -> None:
        if self._checkpoint is None:
            self._checkpoint = self.system.open_output_stream(self._new("_checkpoint", "json"))
        self._checkpoint.write(text.encode() + b"\n")

    def close(self) -> None:
        self._flush()
        for writer in self._open.values():
            writer.close()
        if self._checkpoint is not None:
            self._checkpoint.close()


class TopicSink(DataSource):
    """`df.write.format("topic_sink").option("path", folder).option("batch", n).mode("append").save()`.

    The topic is in the column `topic`, or the one that the option of that name gives; a NULL or empty one is
    read back as NULL. Publishing relies on a rename that is atomic, as HDFS and local file systems have it.
    """

    @classmethod
    def name(cls) -> str:
        return "topic_sink"

    def writer(self, schema: StructType, overwrite: bool) -> TopicWriter:
        if overwrite:
            raise ValueError("a published batch is never overwritten; use mode append")
        options = {k.lower(): v for k, v in self.options.items()}
        topic = options.get("topic", "topic")
        if topic not in schema.names:
            raise ValueError(f"no column {topic!r}")
        return TopicWriter(options["path"], int(options["batch"]), topic, schema)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TopicSink)


def publish(
    out: DataFrame, checkpoints: DataFrame, path: str, batch: int, topic: str = "topic", form: str = "topic_sink"
) -> None:
    """Publish a batch's rows under their topics together with its checkpoint rows (CHECKPOINT_SCHEMA)."""
    if form == TopicSink.name():
        register(out.sparkSession)
    kept = checkpoints.select(*CHECKPOINT_SCHEMA.names)
    marks = kept.select(F.to_json(F.struct(*kept.columns)).alias(CHECKPOINT))
    both = out.withColumn(CHECKPOINT, F.lit(None).cast("string")).unionByName(marks, allowMissingColumns=True)
    both.write.format(form).option("path", path).option("batch", str(batch)).option("topic", topic).mode("append").save()


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """Latest checkpoint of each key: that of the highest published batch, whatever the writers' clocks say."""
    try:
        rows = spark.read.schema(CHECKPOINT_SCHEMA).json(f"{path.rstrip('/')}/batch=*/_checkpoint/*.json")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return latest_checkpoints(spark.createDataFrame([], CHECKPOINT_SCHEMA))
    batch = F.regexp_extract(F.col("_metadata.file_path"), r"/batch=(\d+)/_checkpoint/[^/]*$", 1).cast("long")
    newest = F.max_by(F.struct(*CHECKPOINT_SCHEMA.names), batch)
    return latest_checkpoints(rows.groupBy(F.lower("cursor_key").alias("_key")).agg(newest.alias("c")).select("c.*"))


def published(spark: SparkSession, path: str, columns: Sequence[str] = ()) -> DataFrame:
    """Rows of all published batches, with `batch` and `topic`."""
    rows = spark.read.option("mergeSchema", "true").parquet(path)
    return rows.select(*columns) if columns else rows

"""Micro-batches with the checkpoint written after the sink."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.operators import checkpoint
from feedloom.sources import topics


class InconsistentMarks(RuntimeError):
    """A unit carries marks of two kinds; nothing of it may be committed."""


def _mark_fields(marked: DataFrame) -> set[str]:
    return set(marked.schema["mark"].dataType.names)


def checkpoint_rows(marked: DataFrame, instance: str, connection: str, now: str) -> DataFrame:
    """Checkpoint rows of one batch: one per unit, over all marks that were read.

    The value has the key tuple, the item or the offset of every file that the batch read lines of.
    Units with acknowledgements alone have no value to resume from, but a row that counts them.
    """
    folded = checkpoint.fold_marks(marked)
    parts = ["kind", "keyset", "item"]
    if {"file_id", "end_offset"} <= _mark_fields(marked):
        lines = checkpoint.fold_lines(marked).withColumnRenamed("unit", "_of")
        folded = folded.join(lines, F.col("unit").eqNullSafe(F.col("_of")), "left").drop("_of")
        parts.append("lines")
    value = F.to_json(F.struct(*parts))
    return folded.filter(F.col("kind").isNotNull() | F.col("inconsistent")).select(
        checkpoint.cursor_key(F.lit(instance), F.lit(connection), F.col("unit")).alias(
            "cursor_key"
        ),
        F.lit(now).cast("timestamp").alias("last_fetch_end"),
        F.col("marks").alias("last_fetch_records"),
        F.lit(now).cast("timestamp").alias("updated_at"),
        value.alias("api_cursor"),
        F.lit(checkpoint.CHECKPOINT_VERSION).alias("version"),
        "inconsistent",
    )


def run_batch(
    land: Callable[[DataFrame], DataFrame],
    sink_path: str,
    checkpoint_path: str,
    instance: str,
    connection: str,
    clock: Callable[[], str],
    topic: str = "topic",
    sink_columns: Sequence[str] | None = None,
    acknowledge: Callable[[DataFrame], None] | None = None,
) -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` function: land, write the sink, then append the checkpoint.

    Then `acknowledge` gets the ids that the batch's marks carry (unit, ack_id, batch_no): a queue
    may forget its messages only once they are written.

    A batch has a folder of its own that is overwritten when the batch runs again, so a
    replay after a failure does not leave a row twice in the folder. Readers that follow
    the topic meanwhile may see rows again: delivery is at least once.
    """

    def run(df: DataFrame, batch_id: int) -> None:
        df = df.persist()
        try:
            marks = checkpoint_rows(df, instance, connection, clock())
            # One row per unit of the connection.
            bad = [r["cursor_key"] for r in marks.filter("inconsistent").limit(10).collect()]
            if bad:
                raise InconsistentMarks(f"two kinds of marks: {bad}")
            out = land(df)
            if sink_columns is not None:
                out = out.select(*sink_columns)
            out.write.mode("overwrite").partitionBy(topic).parquet(
                f"{sink_path}/batch={batch_id}"
            )
            checkpoint.commit(marks, checkpoint_path)
            if acknowledge is not None:
                ids = df.select("unit", F.col("mark.ack_id").alias("ack_id"))
                acknowledge(checkpoint.ack_batches(ids, ["unit"]))
        finally:
            df.unpersist()

    return run


def publish_batch(
    land: Callable[[DataFrame], DataFrame],
    path: str,
    instance: str,
    connection: str,
    clock: Callable[[], str],
    topic: str = "topic",
    sink_columns: Sequence[str] | None = None,
    acknowledge: Callable[[DataFrame], None] | None = None,
    form: str = "topic_sink",
) -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` function like `run_batch` whose topics and checkpoint appear by one rename.

    A batch number is published once: its replay leaves what is there, so every row is in the folder exactly
    once as long as the source gives a replayed batch the same rows. `topics.read_published` reads the
    checkpoints. Only then does `acknowledge` get the ids.
    """

    def run(df: DataFrame, batch_id: int) -> None:
        df = df.persist()
        try:
            marks = checkpoint_rows(df, instance, connection, clock()).persist()
            bad = [r["cursor_key"] for r in marks.filter("inconsistent").limit(10).collect()]
            if bad:
                raise InconsistentMarks(f"two kinds of marks: {bad}")
            out = land(df)
            if sink_columns is not None:
                out = out.select(*sink_columns)
            topics.publish(out, marks, path, batch_id, topic, form)
            marks.unpersist()
            if acknowledge is not None:
                ids = df.select("unit", F.col("mark.ack_id").alias("ack_id"))
                acknowledge(checkpoint.ack_batches(ids, ["unit"]))
        finally:
            df.unpersist()

    return run

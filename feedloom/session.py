"""Session settings the operators rely on, and the shared checkpoint folder."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Runtime settings that change results, so they are set on whatever session is given.
RESULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # of a key that an object repeats, at any depth, the last one counts
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings that decide results (time zone, duplicate-key policy)."""
    for key, value in RESULT_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def bounded_batches(spark: SparkSession) -> None:
    """Bound the bytes that a Python worker is handed at once; rows may be long."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's `spark.checkpoint.dir`; a private folder only for a driver without executors.

    Executors on other machines cannot see a folder of the driver's, so none is made up for them.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None and not re.fullmatch(r"local(\[.*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="feedloom-checkpoint-"))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise `df` in the shared checkpoint folder, so later reads see the same rows."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)

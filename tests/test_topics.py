"""Topics and checkpoint published together: lost tasks, lost commits, replays."""

import json
import os

import pytest
from pyspark.sql import functions as F

from feedloom.sources import topics
from feedloom.streaming import commit

MARKED = (
    "unit string, arrival long, payload string, topic string, "
    "mark struct<kind:string,keyset:array<string>,item_position:timestamp,item_key:string,ack_id:string>"
)


def marked(spark, rows):
    return spark.createDataFrame([(u, a, p, t, ("keyset", [str(a)], None, None, None)) for u, a, p, t in rows], MARKED)


def names(folder):
    """Everything under a folder but check sums."""
    return sorted(os.path.join(at, n) for at, _, files in os.walk(folder) for n in files)


def test_rows_topics_and_checkpoint_appear_together(spark, tmp_path):
    path = str(tmp_path / "sink")
    told = []
    run = commit.publish_batch(
        lambda d: d.filter("payload IS NOT NULL"), path, "i", "C", lambda: "2024-01-01 00:00:00",
        sink_columns=["topic", "payload", "arrival"], acknowledge=lambda ids: told.append(ids.count()),
    )
    rows = [("u", 1, '{"a":1}', "t1"), ("u", 2, '{"a":2}', "t/2 =ü"), ("u", 3, None, "t1"), ("v", 4, "{}", None), ("v", 5, "{}", "t1")]
    run(marked(spark, rows), 0)
    got = {(r["batch"], r["topic"], r["payload"], r["arrival"]) for r in topics.published(spark, path).collect()}
    assert got == {(0, "t1", '{"a":1}', 1), (0, "t/2 =ü", '{"a":2}', 2), (0, None, "{}", 4), (0, "t1", "{}", 5)}
    saved = {r["cursor_key"]: json.loads(r["api_cursor"])["keyset"] for r in topics.read_published(spark, path).collect()}
    assert saved == {"i.c.u": ["3"], "i.c.v": ["5"]} and len(told) == 1
    # a replay changes nothing; a further batch moves the checkpoint on
    before = names(path)
    run(marked(spark, rows), 0)
    assert names(path) == before
    run(marked(spark, [("u", 9, "{}", "t1")]), 1)
    saved = {r["cursor_key"]: json.loads(r["api_cursor"])["keyset"] for r in topics.read_published(spark, path).collect()}
    assert topics.published(spark, path).count() == 5 and saved["i.c.u"] == ["9"]
    assert not names(f"{path}/_staging")


def test_a_lost_task_leaves_neither_rows_nor_checkpoint(spark, tmp_path):
    path = str(tmp_path / "sink")
    rows = marked(spark, [("u", n, "{}", f"t{n % 3}") for n in range(40)]).repartition(8)

    def land(df):  # one task dies after others, and its own first rows, were written
        bad = F.when(F.col("arrival") == 17, F.raise_error(F.lit("lost"))).otherwise(F.col("payload"))
        return df.withColumn("payload", bad.cast("string"))

    run = commit.publish_batch(land, path, "i", "c", lambda: "2024-01-01", sink_columns=["topic", "payload"])
    with pytest.raises(Exception, match="lost"):
        run(rows, 0)
    assert not names(path)
    assert topics.read_published(spark, path).count() == 0
    whole = commit.publish_batch(lambda d: d, path, "i", "c", lambda: "2024-01-01", sink_columns=["topic", "payload"])
    whole(rows, 0)
    assert topics.published(spark, path).count() == 40
    assert topics.read_published(spark, path).count() == 1


class LostCommit(topics.TopicWriter):
    def commit(self, messages):
        assert sum(m.rows for m in messages if m is not None) == 3
        raise RuntimeError("commit lost")


class LostSink(topics.TopicSink):
    @classmethod
    def name(cls):
        return "lost_sink"

    def writer(self, schema, overwrite):
        return LostCommit(self.options["path"], int(self.options["batch"]), "topic", schema)


def test_a_lost_commit_leaves_neither_rows_nor_checkpoint(spark, tmp_path):
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(__import__(__name__))
    spark.dataSource.register(LostSink)
    path = str(tmp_path / "sink")
    told = []
    run = commit.publish_batch(
        lambda d: d, path, "i", "c", lambda: "2024-01-01", sink_columns=["topic", "payload"], form="lost_sink", acknowledge=told.append
    )
    with pytest.raises(Exception, match="commit lost"):
        run(marked(spark, [("u", n, "{}", "t") for n in range(3)]), 0)
    assert not names(path) and not told
    assert topics.read_published(spark, path).count() == 0


def test_attempts_that_do_not_count_are_not_published(tmp_path):
    from pyspark.sql.types import StringType, StructField, StructType

    schema = StructType([StructField("topic", StringType()), StructField("payload", StringType())])
    writer = topics.TopicWriter(str(tmp_path), 4, "topic", schema)
    for name in ("part-00000-1-0.parquet", "part-00000-2-0.parquet"):
        os.makedirs(f"{writer.staging}/topic=t", exist_ok=True)
        open(f"{writer.staging}/topic=t/{name}", "wb").close()
    writer.commit([topics.Written(["topic=t/part-00000-2-0.parquet"], 0), None])
    assert names(tmp_path) == [f"{tmp_path}/batch=4/topic=t/part-00000-2-0.parquet"]


def test_empty_batches_and_refusals(spark, tmp_path):
    path = str(tmp_path / "sink")
    run = commit.publish_batch(lambda d: d, path, "i", "c", lambda: "2024-01-01", sink_columns=["topic", "payload"])
    run(marked(spark, []), 0)
    assert os.path.isdir(f"{path}/batch=0") and topics.read_published(spark, path).count() == 0
    with pytest.raises(Exception, match="never overwritten"):
        rows = marked(spark, []).select("topic", "payload")
        rows.write.format("topic_sink").option("path", path).option("batch", "1").mode("overwrite").save()

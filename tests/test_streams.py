"""Streams: growing files, commit order, replay, topic sink, stateful reassembly."""

import json
import os

import pytest
from pyspark.sql import functions as F

from feedloom.operators import checkpoint, snapshot
from feedloom.sources import tail
from feedloom.streaming import commit, reassemble


def append(path, data):
    with open(path, "ab") as file:
        file.write(data)


def start(spark, folder, work, rows, **options):
    tail.register(spark)
    reader = spark.readStream.format("line_tail").option("path", f"{folder}/*.log")
    for key, value in options.items():
        reader = reader.option(key, value)
    out = os.path.join(work, "out")
    return (
        reader.load()
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", os.path.join(work, "state"))
        .trigger(availableNow=True)
        .start(),
        out,
    )


def payloads(spark, out):
    rows = spark.read.parquet(out).orderBy("path", "start_offset").collect()
    return [r["payload"] for r in rows]


def test_tail_follows_growing_files_across_restarts(spark, tmp_path):
    folder, work = tmp_path / "in", tmp_path / "work"
    folder.mkdir()
    append(folder / "a.log", b'{"n":1}\n\n  {"n":2}  \n{"n":3')
    query, out = start(spark, folder, str(work), 0)
    query.awaitTermination()
    assert payloads(spark, out) == ['{"n":1}', '{"n":2}']
    append(folder / "a.log", b"}\n")
    append(folder / "b.log", b'{"m":1}\n')
    query, _ = start(spark, folder, str(work), 0)
    query.awaitTermination()
    assert payloads(spark, out) == ['{"n":1}', '{"n":2}', '{"n":3}', '{"m":1}']


def test_tail_refuses_long_lines_and_counts_them(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    append(folder / "a.log", b"short\n" + b"x" * 500 + b"\nlast\n")
    query, out = start(
        spark, folder, str(tmp_path / "w"), 0, maxLineBytes="100", decode="line", splitBytes="64"
    )
    query.awaitTermination()
    rows = spark.read.parquet(out).orderBy("start_offset").collect()
    assert [r["payload"] and json.loads(r["payload"])["line"] for r in rows] == [
        "short",
        None,
        "last",
    ]
    assert [r["refused_bytes"] for r in rows] == [None, 501, None]


def test_tail_splits_files_without_losing_or_repeating_lines(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    append(folder / "a.log", b"".join(b"%d\n" % i for i in range(1000)))
    query, out = start(spark, folder, str(tmp_path / "w"), 0, splitBytes="37")
    query.awaitTermination()
    assert payloads(spark, out) == [str(i) for i in range(1000)]


def test_tail_truncated_file_starts_over(spark, tmp_path):
    folder, work = tmp_path / "in", tmp_path / "work"
    folder.mkdir()
    append(folder / "a.log", b"head\none\ntwo\n")
    query, out = start(spark, folder, str(work), 0)
    query.awaitTermination()
    with open(folder / "a.log", "wb") as file:
        file.write(b"head\nnew\n")
    query, _ = start(spark, folder, str(work), 0)
    query.awaitTermination()
    got = sorted(payloads(spark, out))
    assert got == sorted(["head", "one", "two", "head", "new"])


def test_tail_keeps_a_renamed_file(spark, tmp_path):
    folder, work = tmp_path / "in", tmp_path / "work"
    folder.mkdir()
    append(folder / "a.log", b"first line\nsecond\n")
    query, out = start(spark, folder, str(work), 0)
    query.awaitTermination()
    os.rename(folder / "a.log", folder / "a-1.log")
    append(folder / "a-1.log", b"third\n")
    append(folder / "a.log", b"fresh file\n")
    query, _ = start(spark, folder, str(work), 0)
    query.awaitTermination()
    assert sorted(payloads(spark, out)) == ["first line", "fresh file", "second", "third"]


MARKED = (
    "unit string, arrival long, payload string, topic string, "
    "mark struct<kind:string,keyset:array<string>,item_position:timestamp,item_key:string>"
)


def marked(spark, rows):
    return spark.createDataFrame(
        [(u, a, p, t, (k, ks, None, None) if k else None) for u, a, p, t, k, ks in rows], MARKED
    )


def test_checkpoint_follows_the_sink_and_replay_repeats_nothing_in_it(spark, tmp_path):
    sink, marks = str(tmp_path / "sink"), str(tmp_path / "marks")
    rows = marked(
        spark,
        [
            ("u", 1, '{"a":1}', "t1", "keyset", ["1"]),
            ("u", 2, '{"a":2}', "t2", "keyset", ["2"]),
            ("u", 3, None, "t1", "keyset", ["3"]),
        ],
    )

    def land(df):
        return df.filter(F.col("payload").isNotNull())

    run = commit.run_batch(land, sink, marks, "i", "C", lambda: "2024-01-01 00:00:00")
    run(rows, 0)
    run(rows, 0)
    assert spark.read.parquet(f"{sink}/batch=0").count() == 2
    assert sorted(
        r["topic"] for r in spark.read.parquet(f"{sink}/batch=0").select("topic").collect()
    ) == ["t1", "t2"]
    saved = checkpoint.read_checkpoints(spark, marks).collect()
    assert [r["cursor_key"] for r in saved] == ["i.c.u"]
    # The row without a payload was filtered, and its mark still counts.
    assert json.loads(saved[0]["api_cursor"])["keyset"] == ["3"]


def test_failing_sink_leaves_no_checkpoint(spark, tmp_path):
    sink, marks = str(tmp_path / "sink"), str(tmp_path / "marks")
    rows = marked(spark, [("u", 1, '{"a":1}', "t1", "keyset", ["1"])])

    def broken(df):
        return df.withColumn("payload", F.raise_error(F.lit("sink down")))

    with pytest.raises(Exception, match="sink down"):
        commit.run_batch(broken, sink, marks, "i", "c", lambda: "2024-01-01")(rows, 0)
    assert not os.path.exists(marks)


def test_two_kinds_of_marks_commit_nothing(spark, tmp_path):
    rows = marked(
        spark,
        [("u", 1, "{}", "t", "keyset", ["1"]), ("u", 2, "{}", "t", "item", None)],
    )
    run = commit.run_batch(
        lambda d: d, str(tmp_path / "s"), str(tmp_path / "m"), "i", "c", lambda: "2024-01-01"
    )
    with pytest.raises(commit.InconsistentMarks):
        run(rows, 0)
    assert not os.path.exists(tmp_path / "m")


def test_stream_commits_after_each_batch(spark, tmp_path):
    source = str(tmp_path / "in")
    marked(spark, [("u", 1, "{}", "t", "keyset", ["1"])]).write.parquet(source)
    run = commit.run_batch(
        lambda d: d, str(tmp_path / "s"), str(tmp_path / "m"), "i", "c", lambda: "2024-01-01"
    )
    query = (
        spark.readStream.schema(spark.read.parquet(source).schema)
        .parquet(source)
        .writeStream.foreachBatch(run)
        .option("checkpointLocation", str(tmp_path / "c"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert checkpoint.read_checkpoints(spark, str(tmp_path / "m")).count() == 1


def test_streamed_reassembly_agrees_with_the_batch_status(spark, tmp_path):
    rows = spark.range(50).select(
        (F.col("id") % 3).cast("string").alias("item"),
        F.col("id"),
        F.concat(F.lit('{"id":'), F.col("id"), F.lit("}")).alias("payload"),
    )
    frames = snapshot.frame_snapshot(
        rows, "s", "2024-01-01", "2024-01-01", "r", ["id"], item="item"
    )
    lost = (F.col("item") == "1") & (F.col("kind") == "row") & (F.col("seq") == 4)
    no_end = (F.col("item") == "2") & (F.col("kind") == "end")
    frames = frames.filter(~F.coalesce(lost | no_end, F.lit(False)))
    source = str(tmp_path / "frames")
    frames.union(frames.filter(F.col("seq") % 2 == 0)).repartition(6).write.parquet(source)
    stored = spark.read.parquet(source)
    out = str(tmp_path / "progress")

    def save(df, batch_id):
        df.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    query = (
        reassemble.lane_progress(
            spark.readStream.schema(stored.schema).option("maxFilesPerTrigger", 2).parquet(source),
            span=7,
        )
        .writeStream.outputMode("update")
        .foreachBatch(save)
        .option("checkpointLocation", str(tmp_path / "c"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    got = {tuple(r) for r in reassemble.fold_progress(spark.read.parquet(out)).collect()}
    want = {tuple(r) for r in snapshot.snapshot_status(stored).collect()}
    assert got == want
    assert {r[1] for r in got} == {"complete", "truncated", "open"}


def test_files_that_begin_alike_are_both_read(spark, tmp_path):
    folder = tmp_path / "twins"
    folder.mkdir()
    (folder / "a.log").write_text("same head\nonly a\n")
    (folder / "b.log").write_text("same head\nonly b\n")
    reader = tail.LineTailReader({"path": f"{folder}/*.log", "decode": "line"})
    first = reader.latestOffset()
    rows = [r for p in reader.partitions({"files": {}}, first) for r in reader.read(p)]
    assert sorted(json.loads(r[4])["line"] for r in rows) == ["only a", "only b", "same head", "same head"]
    with open(folder / "b.log", "a") as file:
        file.write("more b\n")
    second = reader.latestOffset()
    rows = [r for p in reader.partitions(first, second) for r in reader.read(p)]
    assert [json.loads(r[4])["line"] for r in rows] == ["more b"]


def test_line_offsets_and_acknowledgements_are_committed(spark, tmp_path):
    sink, marks = str(tmp_path / "sink"), str(tmp_path / "marks")
    schema = (
        "unit string, arrival long, payload string, topic string, mark struct<kind:string,keyset:array<string>,"
        "item_position:timestamp,item_key:string,file_id:string,end_offset:long,ack_id:string>"
    )
    line = lambda f, end: ("line", None, None, None, f, end, None)
    ack = lambda name: ("ack", None, None, None, None, None, name)
    rows = spark.createDataFrame(
        [
            ("u", 1, "{}", "t", line("b", 10)), ("u", 2, "{}", "t", line("a", 7)), ("u", 3, "{}", "t", line("b", 30)),
            ("u", 4, "{}", "t", ack("m1")), ("q", 1, "{}", "t", ack("m2")), ("q", 2, "{}", "t", None),
        ],
        schema,
    )
    told = []
    run = commit.run_batch(
        lambda d: d.drop("mark"), sink, marks, "i", "c", lambda: "2024-01-01",
        acknowledge=lambda ids: told.extend((r["unit"], r["ack_id"], r["batch_no"]) for r in ids.collect()),
    )
    run(rows, 0)
    saved = {r["cursor_key"]: json.loads(r["api_cursor"]) for r in checkpoint.read_checkpoints(spark, marks).collect()}
    assert [(x["file_id"], x["end_offset"]) for x in saved["i.c.u"]["lines"]] == [("b", 30), ("a", 7)]
    assert saved["i.c.u"]["kind"] == "line" and saved["i.c.q"]["kind"] == "ack"
    assert sorted(told) == [("q", "m2", 0), ("u", "m1", 0)]


def followed(folder, *steps, **options):
    """Payloads of each step: a step writes, then the reader plans from the offset it had before."""
    reader = tail.LineTailReader({"path": f"{folder}/*.log*", **options})
    at, out = {"files": {}}, []
    for step in steps:
        step()
        end = json.loads(json.dumps(reader.latestOffset()))
        out.append(sorted(row[4] for part in reader.partitions(at, end) for row in reader.read(part)))
        at = end
    return out


def write(path, data, mode="ab"):
    def step():
        with open(path, mode) as file:
            file.write(data)

    return step


@pytest.mark.parametrize("identity", ["checksum", "inode"])
def test_tail_reads_a_file_that_regrew_past_its_old_end(tmp_path, identity):
    log = tmp_path / "a.log"
    got = followed(
        tmp_path,
        write(log, b"head\none\ntwo\n"),
        write(log, b"head\nnew one\nnew two\nnew three\n", "wb"),
        write(log, b"four\n"),
        identity=identity,
    )
    assert got == [["head", "one", "two"], ["head", "new one", "new three", "new two"], ["four"]]


def test_tail_sees_a_change_in_a_long_file_that_keeps_its_length(tmp_path):
    log, lines = tmp_path / "a.log", [b"line %06d\n" % i for i in range(20_000)]
    changed = lines[:1] + [b"LINE %06d\n" % i for i in range(1, 20_000)]
    got = followed(tmp_path, write(log, b"".join(lines)), write(log, b"more\n"), write(log, b"".join(changed) + b"more\nlast\n", "wb"))
    assert [len(g) for g in got] == [20_000, 1, 20_002]


def test_tail_goes_on_when_twins_come_and_go(tmp_path):
    log, twin = tmp_path / "a.log", tmp_path / "b.log"
    got = followed(
        tmp_path,
        write(log, b"head\na1\n"),
        write(twin, b"head\nb1\n"),
        write(log, b"a2\n"),
        lambda: (os.remove(twin), write(log, b"a3\n")()),
    )
    assert got == [["a1", "head"], ["b1", "head"], ["a2"], ["a3"]]


def test_tail_rotation_under_one_header(tmp_path):
    log = tmp_path / "a.log"

    def rotate():
        write(log, b"a2\n")()
        os.rename(log, tmp_path / "a.log.1")
        write(tmp_path / "a.log.1", b"a3\n")()
        write(log, b"head\nb1\n")()

    def copy_and_truncate():
        (tmp_path / "a.log.2").write_bytes(log.read_bytes() + b"b2\n")
        write(log, b"head\nc1\nc2 that is longer\n", "wb")()

    got = followed(tmp_path, write(log, b"head\na1\n"), rotate, copy_and_truncate)
    assert got == [["a1", "head"], ["a2", "a3", "b1", "head"], ["b2", "c1", "c2 that is longer", "head"]]

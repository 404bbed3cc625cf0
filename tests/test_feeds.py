"""Snapshots, windows, tails, listings and file sources on fixtures."""

import gzip
import json
import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from feedloom.functions.json import Field
from feedloom.functions.numbering import index_in_order, number_rows, previous, running_sum, span_bucket
from feedloom.operators import checkpoint, fanout, keyset, listing, snapshot, windows
from feedloom.sources import database, files


def frames_of(spark, n, **options):
    df = spark.range(n).select(
        "id",
        F.concat(F.lit('{"id":'), "id", F.lit(',"alive":'), (F.col("id") % 3 != 0).cast("string"), F.lit("}")).alias("payload"),
    )
    return snapshot.frame_snapshot(
        df, "c.u", "2024-01-01", "2024-01-01 00:00:09", "run", ["id"], **options
    )


def test_snapshot_survives_shuffle_and_repeats(spark):
    frames = frames_of(spark, 40).withColumn("arrival", F.lit(1))
    mixed = frames.unionByName(frames.withColumn("arrival", F.lit(2))).repartition(5)
    got = sorted(json.loads(r["record"])["id"] for r in snapshot.rebuild(mixed).collect())
    assert got == list(range(40))


def test_filtered_snapshot_has_no_holes(spark):
    frames = frames_of(spark, 10, keep=lambda d: Field(d, "record.alive").boolean())
    seqs = sorted(r["seq"] for r in frames.filter("kind = 'row'").collect())
    end = frames.filter("kind = 'end'").first()
    assert seqs == list(range(6)) and end["row_count"] == 6


def test_empty_store_still_gives_begin_and_end(spark):
    frames = frames_of(spark, 0)
    assert sorted(r["kind"] for r in frames.collect()) == ["begin", "end"]
    assert snapshot.snapshot_status(frames).first()["status"] == "complete"


def test_dropping_any_frame_is_noticed(spark):
    frames = frames_of(spark, 6).cache()
    for seq in range(6):
        lost = (F.col("kind") == "row") & (F.col("seq") == seq)
        left = frames.filter(~F.coalesce(lost, F.lit(False)))
        assert snapshot.snapshot_status(left).first()["status"] == "truncated"
        assert [r["seq"] for r in snapshot.missing_seqs(left).collect()] == [seq]
    assert snapshot.snapshot_status(frames.filter("kind != 'end'")).first()["status"] == "open"


def test_lost_tail_is_one_range(spark):
    frames = frames_of(spark, 20, bucket=span_bucket("id", 7))
    left = frames.filter("kind != 'row' or seq < 5")
    assert [tuple(r)[1:] for r in snapshot.missing_ranges(left, span=3).collect()] == [(5, 19)]


def test_snapshot_ids_are_version_seven_and_repeat(spark):
    a, b = (frames_of(spark, 1).first()["snapshot_id"] for _ in range(2))
    assert a == b and a[14] == "7" and a[19] in "89ab"
    at = int(datetime(2024, 1, 1).timestamp() * 1000)
    assert int(a.replace("-", "")[:12], 16) - at in range(-86400000, 86400001)


def test_row_without_item_mark_is_an_error(spark):
    df = spark.sql("select 1 id, '{}' payload, cast(null as string) item")
    with pytest.raises(Exception, match="item mark"):
        snapshot.frame_snapshot(df, "s", "2024-01-01", "2024-01-01", "r", ["id"], item="item").collect()


def test_oversize_row_skips_the_filter(spark):
    frames = frames_of(spark, 3, max_bytes=10, row_key="/id", keep=lambda d: F.lit(False))
    stubs = frames.filter("kind = 'oversize'").orderBy("seq").collect()
    assert [r["seq"] for r in stubs] == [0, 1, 2] and all(r["record"] is None for r in stubs)
    assert {r["row_key"] for r in stubs} == {"0", "1", "2"}


def test_numbering_matches_one_ordered_pass(spark):
    dice = random.Random(5)
    data = [(dice.choice("ab"), i * 3, dice.randint(0, 9)) for i in range(500)]
    df = spark.createDataFrame(data, "g string, pos long, v long").repartition(7)
    bucket = span_bucket("pos", 100)
    out = number_rows(df, ["pos"], ["g"], bucket, out="n")
    out = running_sum(out, "v", ["pos"], ["g"], bucket, "before")
    out = previous(out, "v", "pos", ["g"], bucket, "prev")
    for g in "ab":
        rows = [r for r in out.orderBy("pos").collect() if r["g"] == g]
        total, last = 0, None
        for i, r in enumerate(rows):
            assert (r["n"], r["before"], r["prev"]) == (i, total, last)
            total, last = total + r["v"], r["v"]


def test_numbering_by_hash_is_contiguous(spark):
    out = number_rows(spark.range(1000).withColumn("g", F.col("id") % 2), ["id"], ["g"], out="n")
    sums = out.groupBy("g").agg(F.min("n"), F.max("n"), F.count_distinct("n")).collect()
    assert {tuple(r)[1:] for r in sums} == {(0, 499, 500)}


def test_index_over_the_whole_table_follows_the_order(spark):
    df = spark.range(2000).select((F.col("id") * 7919 % 2003).alias("k")).repartition(5)
    rows = index_in_order(df, ["k"], partitions=6).orderBy("k").collect()
    assert [r["position"] for r in rows] == list(range(2000))


def test_tail_in_chunks_equals_one_scan(spark):
    rows = [(t, i, f"{t}-{i}") for t in range(20) for i in range(t % 4 + 1)]
    df = spark.createDataFrame(rows, "ts long, id long, body string").repartition(4)
    after, got = None, []
    while True:
        page = keyset.keyset_tail(df, ["ts", "id"], after, limit=7, max_pages=1).collect()
        if not page:
            break
        got += [r["body"] for r in page]
        after = (page[-1]["ts"], page[-1]["id"])
    assert got == [r[2] for r in rows]


def test_null_key_is_an_error(spark):
    df = spark.sql("select cast(null as int) id, 'x' body union all select 2, 'y'")
    with pytest.raises(Exception, match="NULL in key column"):
        keyset.keyset_tail(df, ["id"], (1,), 5, 1).collect()
    with pytest.raises(ValueError, match="not in the result"):
        keyset.keyset_tail(df, ["nope"], None, 5, 1)


def test_keyset_predicate_reaches_the_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    tail = keyset.keyset_tail(df, ["l_orderkey", "l_linenumber"], (10, 2), 5, 1)
    plan = tail._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    assert "GreaterThanOrEqual(l_orderkey,10)" in plan or "Or(" in plan


def test_change_tail_advances_when_idle(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, None)], "token long, payload string")
    events, advance = keyset.change_tail(df, "token", 1, 10)
    assert events.count() == 0 and advance.first()["token"] == 3
    events, advance = keyset.change_tail(df, "token", 3, 10)
    assert advance.first()["token"] == 3


def test_halved_spans_tile_the_window(spark):
    dice = random.Random(11)
    start = datetime(2024, 1, 1)
    stamps = [start + timedelta(seconds=dice.choice([1, 2, 3, 1000, dice.randint(0, 4999)]), microseconds=dice.randint(0, 999999)) for _ in range(300)]
    events = spark.createDataFrame([("u", s) for s in stamps], "unit string, ts timestamp_ntz")
    bounds = spark.createDataFrame(
        [("u", start, start + timedelta(seconds=5000, microseconds=500))],
        "unit string, window_start timestamp_ntz, window_end timestamp_ntz",
    )
    spans = windows.halve_until(events, "ts", bounds, 20, ["unit"]).orderBy("span_start").collect()
    assert sum(r["rows"] for r in spans) == 300
    for a, b in zip(spans, spans[1:]):
        assert a["span_end"] == b["span_start"]
    for r in spans:
        seconds = (r["span_end"] - r["span_start"]).total_seconds()
        assert r["rows"] <= 20 or (r["status"] == "failed" and seconds < 2)


def test_window_of_a_cursor_ahead_of_now_is_empty(spark):
    units = spark.sql("select 'k' cursor_key, 1 default_hours, 60 interval_secs")
    cursors = spark.sql("select 'k' cursor_key, timestamp'2024-01-02' last_fetch_end")
    row = windows.plan_windows(units, cursors, "2024-01-01").first()
    assert row["window_start"] == row["window_end"]
    steps = windows.window_steps(windows.plan_windows(units, cursors, "2024-01-01"), 60)
    assert steps.count() == 0


def test_unit_without_window_runs_once(spark):
    df = spark.sql("select cast(null as timestamp) window_start, cast(null as timestamp) window_end")
    rows = windows.window_steps(df, 60, reads_window=F.lit(False)).collect()
    assert len(rows) == 1 and rows[0]["step_start"] is None


def test_durations(spark):
    df = spark.createDataFrame([("5m",), ("2h",), ("0s",), ("5x",), ("-1s",)], "t string")
    got = [r[0] for r in df.select(windows.duration_micros(F.col("t"))).collect()]
    assert got == [300_000_000, 7_200_000_000, None, None, None]


def test_checkpoints_read_the_latest_usable_value(spark, tmp_path):
    rows = [
        ("I.c.U", 1, "2024-01-01", '{"a":1}', 2),
        ("i.C.u", 2, "2024-01-02", "{broken", 2),
        ("i.c.old", 3, "2024-01-01", '{"a":1}', 1),
    ]
    df = spark.createDataFrame(rows, "cursor_key string, n int, at string, api_cursor string, v int").select(
        "cursor_key",
        F.col("at").cast("timestamp").alias("last_fetch_end"),
        F.col("n").cast("long").alias("last_fetch_records"),
        F.col("at").cast("timestamp").alias("updated_at"),
        "api_cursor",
        F.col("v").alias("version"),
    )
    path = str(tmp_path / "c")
    checkpoint.commit(df, path)
    with open(os.path.join(path, "part-bad.parquet"), "w") as file:
        file.write("not parquet")
    got = {r["cursor_key"]: (r["last_fetch_records"], r["api_cursor"]) for r in checkpoint.read_checkpoints(spark, path).collect()}
    assert got == {"i.c.u": (2, None), "i.c.old": (3, None)}


def test_cap_reports_every_item_left_out(spark):
    items = spark.range(100).withColumn("k", F.lit("hot"))
    kept, report = fanout.cap_items(items, ["k"], ["id"], 10)
    row = report.first()
    assert kept.count() == 10 and row["skipped"] == 90 and row["first_skipped"] == [str(i) for i in range(10, 15)]
    kept, report = fanout.cap_items(items, ["k"], ["id"], 10, mode="fail")
    assert kept.count() == 0 and report.first()["skipped"] == 100


def test_horizon_without_uploads_rests(spark):
    row = listing.upload_horizon(None, "2024-01-01 00:10:00", spark).first()
    assert row["at"] == datetime(2024, 1, 1, 0, 5) and row["key"] is None


@pytest.fixture
def folder(tmp_path):
    path = tmp_path / "in"
    path.mkdir()
    (path / "a.jsonl").write_text('{"id":1}\n\n {"id":2} ')
    (path / "b.json.gz").write_bytes(gzip.compress(b'[{"id":3}]'))
    (path / "c.csv.gz").write_bytes(gzip.compress(b"id,n\n4,x\n") + gzip.compress(b"5,y,z\n"))
    (path / "d.jsonl").write_bytes(gzip.compress(b'{"id":6}\n'))
    for i, name in enumerate(["a.jsonl", "b.json.gz", "c.csv.gz", "d.jsonl"]):
        os.utime(path / name, (1_700_000_000 + i, 1_700_000_000 + i))
    return path


def test_dump_reads_every_format_by_magic(spark, folder):
    rows = files.read_dump(spark, f"{folder}/*")
    got = {}
    for r in listing.sound_prefix(rows).orderBy("position", "pos").collect():
        got.setdefault(os.path.basename(r["path"]), []).append(json.loads(r["payload"]))
    assert got == {
        "a.jsonl": [{"id": 1}, {"id": 2}],
        "b.json.gz": [{"id": 3}],
        "c.csv.gz": [{"id": "4", "n": "x"}, {"id": "5", "n": "y", "col_2": "z"}],
        "d.jsonl": [{"id": 6}],
    }


def test_large_json_lines_are_read_as_text(spark, folder):
    rows = files.read_dump(spark, f"{folder}/a.jsonl", whole_file_bytes=1)
    assert sorted(json.loads(r["payload"])["id"] for r in rows.collect()) == [1, 2]


def test_a_size_changes_no_row(spark, folder):
    text = "\n".join("" if i % 7 == 3 else f' {{"id":{i}}}' for i in range(5000))
    (folder / "e.jsonl").write_text(text)
    (folder / "f.ndjson.gz").write_bytes(gzip.compress(text.encode()))
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        names = [f"{folder}/{n}" for n in ("a.jsonl", "e.jsonl", "f.ndjson.gz", "b.json.gz")]
        key = lambda r: (os.path.basename(r["path"]), r["position"], r["pos"], r["payload"], r["error"])
        whole = sorted(map(key, files.read_dump(spark, names).collect()), key=str)
        split = sorted(map(key, files.read_dump(spark, names, whole_file_bytes=1).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
    assert whole == split and len(whole) > 8000
    hidden = files.read_dump(spark, f"{folder}/d.jsonl", whole_file_bytes=1).collect()
    assert [(r["payload"], r["error"]) for r in hidden] == [('{"id":6}', None)]


def test_bad_file_fails_only_from_itself_on(spark, folder):
    data = (folder / "b.json.gz").read_bytes()
    (folder / "b.json.gz").write_bytes(data[:-12])
    os.utime(folder / "b.json.gz", (1_700_000_001, 1_700_000_001))
    rows = listing.sound_prefix(files.read_dump(spark, f"{folder}/*"))
    assert {os.path.basename(r["path"]) for r in rows.collect()} == {"a.jsonl"}


def test_listing_is_strictly_past_its_marker_and_sees_changed_files(spark, folder):
    listed = files.list_files(spark, f"{folder}/*").orderBy("position").collect()
    assert [os.path.basename(r["path"]) for r in listed] == ["a.jsonl", "b.json.gz", "c.csv.gz", "d.jsonl"]
    marker = (F.lit(listed[2]["position"]), listed[2]["path"])
    rest = files.list_files(spark, f"{folder}/*", marker).collect()
    assert [os.path.basename(r["path"]) for r in rest] == ["d.jsonl"]
    os.utime(folder / "a.jsonl", (1_700_000_100, 1_700_000_100))
    rest = files.list_files(spark, f"{folder}/*", marker).collect()
    assert sorted(os.path.basename(r["path"]) for r in rest) == ["a.jsonl", "d.jsonl"]


def test_plain_readers(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a,b\n1,"q ""r""\ns"\n')
    assert json.loads(files.read_csv_rows(spark, str(tmp_path / "x.csv")).first()["payload"]) == {"a": "1", "b": 'q "r"\ns'}
    (tmp_path / "x.txt").write_text("one\n\n two \n")
    got = [json.loads(r["payload"])["line"] for r in files.read_lines(spark, str(tmp_path / "x.txt")).collect()]
    assert got == ["one", "two"]
    assert files.read_documents(spark, str(tmp_path / "x.txt")).first()["payload"] == "one\n\n two"
    (tmp_path / "x.json").write_text('[{"a":1},\n{"a":2}]')
    assert files.read_json_array(spark, str(tmp_path / "x.json")).count() == 2
    with pytest.raises(Exception, match="row longer"):
        files.read_ndjson(spark, str(tmp_path / "x.txt"), max_row_bytes=2).collect()


def test_tail_query_text():
    text = database.tail_query("SELECT * FROM e", ["ts", "id"], (datetime(2024, 1, 1), "a'b"), 10)
    assert text == (
        "SELECT * FROM (SELECT * FROM e) t WHERE (\"ts\" > TIMESTAMP '2024-01-01 00:00:00.000000') OR "
        "(\"ts\" = TIMESTAMP '2024-01-01 00:00:00.000000' AND \"id\" > 'a''b') "
        "ORDER BY \"ts\", \"id\" FETCH FIRST 10 ROWS ONLY"
    )
    for engine in ("mysql", "mariadb"):
        text = database.tail_query("SELECT * FROM e", ["a`b"], (1,), 5, engine=engine)
        assert text == "SELECT * FROM (SELECT * FROM e) t WHERE (`a``b` > 1) ORDER BY `a``b` LIMIT 5"
    assert database.tail_query("e", ["k"], None, 5, engine="sqlserver").endswith("OFFSET 0 ROWS FETCH NEXT 5 ROWS ONLY")
    assert database.tail_query("e", ["k"], None, 5, engine="oracle").endswith("FETCH FIRST 5 ROWS ONLY")


def test_every_declared_field_of_a_recipe_is_read():
    import dataclasses
    import inspect

    from feedloom.plans import recipes

    source = inspect.getsource(recipes)
    for name in (f.name for f in dataclasses.fields(recipes.Recipe)):
        assert f"recipe.{name}" in source or f"self.{name}" in source, name
    assert sum(len(units) for units in recipes.RECIPES.values()) > 100


def test_buckets_of_clustered_positions_are_even(spark):
    from feedloom.functions.numbering import depth_bucket

    at = F.when(F.col("id") % 2 == 0, F.col("id") + 10**15).otherwise(F.col("id") * 10**9)
    df = spark.range(40_000).select("id", F.when(F.col("id") % 1000 > 0, at).alias("at"))
    for rows, most in ((500, 512), (100, 20), (10**6, 512)):
        bucket = depth_bucket(df, "at", rows, most)
        sizes = [r["count"] for r in df.groupBy(bucket.alias("b")).count().collect()]
        assert max(sizes) < 2 * sum(sizes) / len(sizes) and len(sizes) <= min(most, -(-40_000 // rows))
        out = number_rows(df.where("at IS NOT NULL"), ["at"], [], bucket, out="n").orderBy("at").collect()
        assert [r["n"] for r in out] == list(range(len(out)))


def test_halving_with_windows_that_begin_within_a_second(spark):
    """Events counted together before the windows are known give what counting them one by one gives."""
    dice = random.Random(2)
    rows = [(dice.choice(["a", None, "c"]), datetime(2024, 1, 1) + timedelta(microseconds=dice.randrange(90_000_000))) for _ in range(3000)]
    events = spark.createDataFrame(rows, "k string, ts timestamp")
    bounds = [("a", 1_234_567, 80_000_000), (None, 0, 61_500_000), ("c", 999_999, 1_500_001)]
    at = lambda us: datetime(2024, 1, 1) + timedelta(microseconds=us)
    frame = spark.createDataFrame([(k, at(a), at(b)) for k, a, b in bounds], "k string, window_start timestamp, window_end timestamp")
    got = {}
    for r in windows.halve_until(events, "ts", frame, 100, ["k"]).collect():
        got.setdefault(r["k"], []).append((r["span_start"], r["span_end"], r["rows"], r["status"]))
    many = windows.MAX_FRACTIONS
    windows.MAX_FRACTIONS = 0
    try:
        plain = {}
        for r in windows.halve_until(events, "ts", frame, 100, ["k"]).collect():
            plain.setdefault(r["k"], []).append((r["span_start"], r["span_end"], r["rows"], r["status"]))
    finally:
        windows.MAX_FRACTIONS = many
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in plain.items()}
    for k, a, b in bounds:
        spans = sorted(got[k])
        assert spans[0][0] == at(a) and spans[-1][1] == at(b)
        for begin, end, n, _ in spans:
            assert n == sum(x == k and begin <= t < end for x, t in rows)

"""Steps whose cost must follow the input, whatever its chunks, bodies and batches are like."""

from __future__ import annotations

import csv
import io
import random
import re
import zlib

import pyarrow as pa
from pyspark.sql import functions as F

from feedloom.operators import decode, framing, paging
from feedloom.session import bounded_batches
from feedloom.sources import following, members


def _chunks(n, value="[1],[2]"):
    return pa.RecordBatch.from_pydict({"path": ["a"] * n, "chunk": list(range(n)), "value": [value] * n})


def test_short_chunks_share_batches():
    made = list(framing._summarise_json(iter([_chunks(3000)])))
    assert len(made) == 1 and made[0].num_rows == 3000


def test_a_chunk_over_two_batches_is_summarised_as_one():
    pieces = ['[{"a":"x', 'y\\",', '"},[2', "3]", '"open']
    whole = pa.RecordBatch.from_pydict({"path": ["a"] * 5, "chunk": [7] * 5, "value": pieces})
    one = [b.to_pylist() for b in framing._summarise_json(iter([whole]))]
    for cut in range(1, 5):
        assert [b.to_pylist() for b in framing._summarise_json(iter([whole.slice(0, cut), whole.slice(cut)]))] == one


def test_many_bodies_are_walked_in_many_tasks(spark):
    summary = spark.range(500).select(
        F.concat(F.lit("b"), "id").alias("path"), F.lit(0).cast("long").alias("chunk"),
        *[F.lit(0).cast(k).alias(c) for c, k in [f.split() for f in framing._SUMMARY.split(", ")[2:8]]],
        F.lit(True).alias("ends0"), F.lit(True).alias("ends1"),
    )
    walked = framing._walked(summary, "json", 500)
    assert walked.rdd.getNumPartitions() >= 8
    assert walked.where("fresh AND last").count() == 500


def test_csv_cuts_share_batches_and_python_is_handed_few_bytes(spark):
    batch = _chunks(3000, "1,x")
    entry = {"state": [0] * 3000, "depth": [0] * 3000, "fresh": [True] * 3000, "owner": list(range(3000)), "last": [False] * 3000}
    batch = pa.RecordBatch.from_pydict({**batch.to_pydict(), **entry})
    made = list(framing._cut_csv(iter([batch])))
    assert len(made) == 1 and made[0].num_rows == 3000
    bounded_batches(spark)
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 8 << 20


def test_unpacked_bodies_are_handed_back_in_bounded_batches(spark):
    packed = zlib.compress(bytes(1 << 20), wbits=31)
    files = spark.range(0, 64, 1, 1).select("id", F.lit(packed).alias("content"))
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    out = decode.inflate(files, "content")
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 8 << 20
    assert out.where(F.length("content") == 1 << 20).where("error IS NULL").count() == 64
    # the step itself, outside of Spark
    step = decode._inflated("content")
    sizes = [b.num_rows for b in step(iter([pa.RecordBatch.from_pydict({"id": list(range(64)), "content": [packed] * 64})]))]
    assert sum(sizes) == 64 and max(sizes) <= 4


def test_short_members_share_batches():
    packed = zlib.compress(b"x\n", wbits=31).split(members.MAGIC)[1]
    batch = pa.RecordBatch.from_pydict({"path": ["a"] * 2000, "chunk": [1] * 2000, "value": [packed] * 2000})
    made = list(members._found(iter([batch])))
    assert len(made) == 1 and made[0].column("kind").to_pylist() == ["member"] * 2000


def _captures(spark):
    rows = [(None, 1, None, "a"), (None, 2, "a", "b"), (None, 3, "a", "z"), (None, 4, "b", ""), (1, 1, None, "c"), (1, 2, "c", "d"), (1, 3, "d", "c")]
    rows += [(2, 5, "q", "r"), (2, 6, "r", "gone"), (2, 7, "elsewhere", "q2"), (3, 1, "m", "m"), (3, 2, None, "m")]
    rows += [(4, i * 7919 % 997, f"t{i}" if i else None, f"t{i + 1}" if i < 996 else "") for i in range(997)]
    pages = spark.createDataFrame(rows, "seq_key int, page_id long, asked string, next string")
    return pages.select("seq_key", "page_id", "asked", F.to_json(F.struct("next")).alias("body"))


def test_links_of_short_sequences_are_followed_without_rounds(spark, monkeypatch):
    pages, pager = _captures(spark), paging.Pager("cursor", at="/next")

    def followed(most):
        monkeypatch.setattr(paging, "LOCAL_PAGES", most)
        return [sorted(map(str, d.drop("body").collect())) for d in paging.follow_links(pages, ["seq_key"], pager, 1000, asked=F.col("asked"))]

    rounds, mixed = followed(0), followed(100)
    monkeypatch.setattr(paging, "_reached", None)
    assert followed(50_000) == rounds == mixed
    assert len(rounds[0]) == 997 + 3 + 3 + 2 + 2 and len(rounds[1]) == 5


def test_short_sequences_are_numbered_by_one_shuffle(spark, monkeypatch):
    pages = spark.range(600).select(
        (F.col("id") % 40).cast("int").alias("seq_key"), (F.col("id") * 1_000_003).alias("page_id"),
        F.to_json(F.struct(F.when(F.col("id") < 400, F.concat(F.lit("t"), F.col("id") % 280)).alias("next"), F.array(F.lit(1)).alias("rows"))).alias("body"),
    ).where("seq_key > 0 OR id < 200")
    pages = pages.withColumn("seq_key", F.when(F.col("seq_key") != 3, F.col("seq_key")))
    for pager in (paging.Pager("cursor", at="/next"), paging.Pager("offset", rows_at="/rows", page_size=1)):
        signals = paging._signals(pages, ["seq_key"], pager).localCheckpoint()
        rows = []
        for span in (5, 14, 10_000):
            monkeypatch.setattr(paging, "PAGE_SPAN", span)
            judged = paging._judge(signals, ["seq_key"], pager)
            rows.append(sorted(map(str, judged.select("seq_key", "page_id", "page_no", "_ends", "_loop").collect())))
        assert rows[0] == rows[1] == rows[2] and len(rows[0]) == 590
        plan = judged._jdf.queryExecution().sparkPlan().toString()
        assert "Join" not in plan


def test_short_lines_are_handed_over_in_bounded_batches(tmp_path):
    path = tmp_path / "a.log"
    path.write_text("".join(f"line {i}\n" for i in range(20_000)))
    ranges = pa.RecordBatch.from_pydict({"path": [str(path)], "file_id": ["f"], "_from": [0], "_to": [path.stat().st_size], "end": [0]})
    made = list(following._reader(1 << 10, False)(iter([ranges])))
    assert max(b.num_rows for b in made) <= 4096
    assert [t for b in made for t in b.column("payload").to_pylist()] == [f"line {i}" for i in range(20_000)]


def test_csv_fields_are_those_of_the_strict_reader(spark):
    def read(rows):
        out = []
        try:
            out.extend(f for f in rows if f)
        except csv.Error as problem:
            return out, str(problem)
        return out, None

    pick = random.Random(7)
    for _ in range(20_000):
        text = "".join(pick.choice('a",\r\n" ') for _ in range(pick.randint(0, 12)))
        assert read(decode.csv_fields(text)) == read(csv.reader(io.StringIO(text, newline=""), strict=True)), text
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    decode.decode_csv(spark.createDataFrame([("a\n1",)], "body string"), "body")
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 8 << 20


def test_lines_of_a_manifest_are_grouped_in_partitions_by_their_count(spark, monkeypatch):
    from feedloom.plans.catalog import QUERIES, listings

    monkeypatch.setattr(listings, "GROUPED_ROWS", 300)
    plan = QUERIES["manifest_join"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()
    assert "RepartitionByExpression [l_orderkey" in plan and f"], {-(-lines // 300)}" in plan


def test_only_long_sequences_are_walked_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(paging, "LOCAL_PAGES", 100)
    walked, rounds = [], paging._walked_in_rounds

    def counted(links):
        walked.append(links.count())
        return rounds(links)

    monkeypatch.setattr(paging, "_walked_in_rounds", counted)
    kept, _ = paging.follow_links(_captures(spark), ["seq_key"], paging.Pager("cursor", at="/next"), 1000, asked=F.col("asked"))
    assert walked == [997]
    ordered = kept.where("seq_key = 4").orderBy("page_no").select("page_id").collect()
    assert [r.page_id for r in ordered] == [i * 7919 % 997 for i in range(997)]


def test_pages_that_are_kept_are_not_broadcast(spark, tmp_path):
    def plan(df):
        return df._jdf.queryExecution().sparkPlan().toString()

    _captures(spark).write.parquet(f"{tmp_path}/pages")
    pages, pager = spark.read.parquet(f"{tmp_path}/pages"), paging.Pager("cursor", at="/next")
    kept, problems = paging.follow_links(pages, ["seq_key"], pager, 1000, asked=F.col("asked"))
    # a few files say nothing of the rows that a checkpoint holds
    assert "Broadcast" not in plan(kept)
    # the ends of sequences come with the pages that were walked, so one join is left and no aggregate
    assert plan(kept).count("SortMergeJoin") == plan(kept).count("Join") == 1 and "Aggregate" not in plan(kept)
    assert "Join" not in plan(problems) and "Aggregate" not in plan(problems)
    assembled = plan(paging.assemble_pages(pages, ["seq_key"], pager, 1000))
    assert re.search(r"\w+Join", assembled).group() == "SortMergeJoin"


def test_ends_of_sequences_are_those_of_a_plain_walk(spark, monkeypatch):
    pick, rows, want, last = random.Random(3), [], set(), set()
    for s in range(150):
        n = pick.randint(1, 9)
        links = [None, *(f"k{i}" for i in range(n))]
        pages = [(s, p, pick.choice(links), pick.choice([*links, "gone"])) for p in pick.sample(range(99), n)]
        rows += pages
        first = {}
        for _, p, asked, to in sorted(pages, key=lambda r: r[1]):
            first.setdefault(asked, (p, to))
        lead = {p: first[to][0] for p, to in first.values() if to is not None and to in first}
        named = {b for a, b in lead.items() if a != b}
        at = min(first, key=lambda a: (a is not None, first[a][0] in named, first[a][0]))
        way = []
        while first[at][0] not in way:
            way.append(first[at][0])
            to = first[at][1]
            if to is None or to not in first:
                break
            at = to
        how = "complete" if to is None else "open" if to not in first else "loop"
        short = "cut" if len(way) > 3 else how
        want |= {(s, p, i, short) for i, p in enumerate(way[:3])}
        if how != "complete":
            last.add((s, "missing" if how == "open" else "loop", way[-1], to))
    captured = spark.createDataFrame(rows, "seq_key int, page_id long, asked string, next string")
    captured = captured.select("seq_key", "page_id", "asked", F.to_json(F.struct("next")).alias("body"))
    for most, few in ((50_000, 0), (0, 0), (4, 10_000)):
        monkeypatch.setattr(paging, "LOCAL_PAGES", most)
        monkeypatch.setattr(paging, "FEW_SEQUENCES", few)
        kept, problems = paging.follow_links(captured, ["seq_key"], paging.Pager("cursor", at="/next"), 3, False, F.col("asked"))
        assert {tuple(r) for r in kept.select("seq_key", "page_id", "page_no", "status").collect()} == want
        found = problems.where("kind IN ('missing', 'loop')").collect()
        assert len(found) == len(last) and {tuple(r) for r in found} == last

"""Gzip bodies of many members and dump files read in ranges: the same rows at every range size."""

import gzip
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from feedloom.sources import files, members

DICE = random.Random(11)


def body(kind, rows):
    if kind == "json":
        return json.dumps([{"id": i, "t": 'a,"\\é' * (i % 5)} for i in range(rows)]).encode()
    if kind == "csv":
        return "".join(["id,t\n"] + [f'{i},"x\n,""{"é" * (i % 4)}"\n' for i in range(rows)]).encode()
    return "".join("\n" if i % 7 == 3 else f'{{"id":{i},"t":"é"}}\n' for i in range(rows)).encode()


def split_gzip(data, cuts, zeros=5):
    """Members cut anywhere, inside of characters too, with zeros between some."""
    at = sorted({0, len(data), *[DICE.randrange(len(data)) for _ in range(cuts)]})
    return b"".join(gzip.compress(data[a:b]) + b"\0" * (a % 3 == 1) * zeros for a, b in zip(at, at[1:], strict=False))



@pytest.fixture(scope="module")
def dump(tmp_path_factory):
    folder = tmp_path_factory.mktemp("dump")
    for kind, name in (("json", "json"), ("csv", "csv"), ("ndjson", "jsonl")):
        for rows in (0 if kind != "json" else 1, 3, 300):
            data = body(kind, rows)
            (folder / f"plain{rows}.{name}").write_bytes(data)
            (folder / f"named{rows}.{name}.gz").write_bytes(split_gzip(data, 3, 0) if data else gzip.compress(data))
            (folder / f"hidden{rows}.{name}").write_bytes(split_gzip(data, 25) if data else gzip.compress(data))
    stored = b"".join(gzip.compress(b'{"raw":"\x1f\x8b\x08' + bytes(DICE.choices(b"abc", k=90)) + b'"}\n', compresslevel=0) for _ in range(40))
    (folder / "stored.jsonl").write_bytes(stored)
    (folder / "void.json").write_bytes(b"")
    (folder / "void.csv").write_bytes(b"")
    good = split_gzip(body("ndjson", 300), 12)
    (folder / "cut.jsonl").write_bytes(good[:-9])
    hurt = bytearray(good)
    hurt[len(hurt) // 2] ^= 0x55
    (folder / "hurt.csv").write_bytes(bytes(hurt))
    return folder


def read(spark, folder, size, **options):
    held = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for k in held:
        spark.conf.set(k, str(size))
    try:
        rows = files.read_dump(spark, f"{folder}/*", **options).collect()
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    out = {}
    for r in rows:
        out.setdefault(os.path.basename(r["path"]), []).append((r["pos"], r["payload"] and json.dumps(json.loads(r["payload"], strict=False)), r["error"]))
        assert r["position"] is not None
    return {k: sorted(v, key=str) for k, v in out.items()}


@pytest.mark.parametrize("size", [700, 128 << 20])
def test_ranges_and_members_change_no_row(spark, dump, size):
    got = read(spark, dump, size)
    for name in ("json", "csv", "jsonl"):
        for rows in (1, 3, 300):
            if f"plain{rows}.{name}" in got:
                assert got[f"plain{rows}.{name}"] == got[f"hidden{rows}.{name}"] == got[f"named{rows}.{name}.gz"], (name, rows)
    assert len(got["plain300.json"]) == len(got["plain300.csv"]) == 300
    assert [p for p, _, _ in sorted(got["plain300.csv"])] == list(range(300))
    assert sorted(p for p, _, _ in got["plain300.jsonl"]) == [i for i in range(300) if i % 7 != 3]
    assert len(got["stored.jsonl"]) == 40 and all("raw" in p for _, p, _ in got["stored.jsonl"])
    # a header alone gives no row, and Spark's readers pass over files of no bytes
    assert not {"void.csv", "void.json", "plain0.csv", "plain0.jsonl"} & set(got)
    assert len(got["cut.jsonl"]) == len(got["hurt.csv"]) == 1
    assert "gzip member" in got["cut.jsonl"][0][2] and "gzip member" in got["hurt.csv"][0][2]


def test_named_files_read_as_streams_give_the_same_rows(spark, dump):
    held, streamed = (read(spark, dump, 128 << 20, whole_file_bytes=n) for n in (1 << 30, 1))
    assert held == streamed


def test_members_are_counted_and_damage_has_its_place(spark, tmp_path):
    parts = [gzip.compress(f"part {i} ".encode() * 40) for i in range(30)]
    parts[17] = parts[17][:15] + b"\xff\xff" + parts[17][17:]
    (tmp_path / "x.bin").write_bytes(b"".join(parts))
    for size in ("150", "100000000"):
        held = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        raw = members.raw_pieces(spark, [str(tmp_path / "x.bin")])
        found = members.members(raw)
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
        rows = found.orderBy("member").collect()
        good = {bytes(r["content"]).split()[1] for r in rows if r["error"] is None}
        assert good == {str(i).encode() for i in range(30) if i != 17}
        assert [r["member"] for r in rows if r["error"]] == [17]
        assert members.problems(found).where(F.col("error").startswith("gzip member 17")).count() == 1

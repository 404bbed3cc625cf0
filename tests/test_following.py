"""Files followed by Spark jobs: bounded batches, replay, rotation, copies, many files."""

import builtins
import os
import shutil

import pytest
from pyspark.sql import functions as F

from feedloom.sources.following import LineFollower


def write(path, data, mode="ab"):
    with open(path, mode) as file:
        file.write(data)


def drained(follower):
    """(payloads, bytes) of each batch until the follower is idle."""
    out = []

    def sink(lines, number):
        rows = lines.collect()
        out.append((sorted(r["payload"] or f"refused {r['refused_bytes']}" for r in rows), sum(r["end_offset"] - r["start_offset"] for r in rows)))

    follower.drain(sink)
    return out


def payloads(follower):
    return sorted(p for batch, _ in drained(follower) for p in batch)


def test_many_files_in_bounded_batches_without_the_driver_opening_one(spark, tmp_path, monkeypatch):
    folder = tmp_path / "in"
    folder.mkdir()
    for n in range(2000):
        write(folder / f"{n:04d}.log", b"".join(b"file %d line %d\n" % (n, i) for i in range(1 + n % 7)))
    whole = sum(os.path.getsize(folder / name) for name in os.listdir(folder))
    opened = []
    real = builtins.open

    def watched(name, *args, **kwargs):
        if str(name).startswith(str(folder)):
            opened.append(name)
        return real(name, *args, **kwargs)

    monkeypatch.setattr(builtins, "open", watched)
    follower = LineFollower(spark, f"{folder}/*.log", str(tmp_path / "state"), max_line=1000, max_bytes=70_000)
    got = drained(follower)
    assert not opened
    assert all(size <= 70_000 for _, size in got) and len(got) == -(-whole // 70_000)
    assert sum(size for _, size in got) == whole
    lines = [p for batch, _ in got for p in batch]
    assert len(lines) == len(set(lines)) == sum(1 + n % 7 for n in range(2000))


def test_a_batch_that_was_not_committed_is_read_again_alike(spark, tmp_path):
    log, state = tmp_path / "a.log", str(tmp_path / "state")
    write(log, b"one\ntwo\n")
    number, lines = LineFollower(spark, str(log), state).next()
    assert number == 0 and lines.count() == 2
    write(log, b"three\n")
    again = LineFollower(spark, str(log), state)
    number, lines = again.next()
    assert number == 0 and sorted(r["payload"] for r in lines.collect()) == ["one", "two"]
    again.commit(0)
    assert payloads(again) == ["three"]
    assert again.next() is None


def test_a_batch_ends_behind_a_line_and_files_take_turns(spark, tmp_path):
    for name in "ab":
        write(tmp_path / f"{name}.log", b"".join(b"%s%04d\n" % (name.encode(), i) for i in range(20)))
    got = drained(LineFollower(spark, f"{tmp_path}/*.log", str(tmp_path / "state"), max_line=10, max_bytes=50))
    assert all(size <= 50 for _, size in got)
    assert {p[0] for p in got[0][0]} == {"a"} and {p[0] for p in got[1][0]} == {"b"}
    assert sorted(p for batch, _ in got for p in batch) == sorted(f"{n}{i:04d}" for n in "ab" for i in range(20))


def test_long_lines_are_refused_and_do_not_hold_up_a_file(spark, tmp_path):
    write(tmp_path / "a.log", b"first\n" + b"x" * 500 + b"\nlast\nopen")
    got = payloads(LineFollower(spark, f"{tmp_path}/*.log", str(tmp_path / "state"), max_line=20, max_bytes=40, split=7))
    assert got == ["first", "last", "refused 501"]


def test_rotation_copies_and_regrown_files(spark, tmp_path):
    log, folder = tmp_path / "in" / "a.log", tmp_path / "in"
    folder.mkdir()
    follower = LineFollower(spark, f"{folder}/*", str(tmp_path / "state"))
    write(log, b"head\na1\n")
    assert payloads(follower) == ["a1", "head"]
    # renamed, written on, and a new file under the old name and header
    write(log, b"a2\n")
    os.rename(log, folder / "a.log.1")
    write(folder / "a.log.1", b"a3\n")
    write(log, b"head\nb1\n")
    assert payloads(follower) == ["a2", "a3", "b1", "head"]
    # copied and truncated, and grown again past its old end
    shutil.copy(log, folder / "a.log.2")
    write(folder / "a.log.2", b"b2\n")
    write(log, b"head\nc1\nc2 that is longer\n", "wb")
    assert payloads(follower) == ["b2", "c1", "c2 that is longer", "head"]
    # a file that went away and came back elsewhere
    shutil.copy(folder / "a.log.1", tmp_path / "aside")
    os.remove(folder / "a.log.1")
    write(log, b"c3\n")
    assert payloads(follower) == ["c3"]
    shutil.copy(tmp_path / "aside", folder / "z.log")
    write(folder / "z.log", b"a4\n")
    assert payloads(follower) == ["a4"]


def test_from_the_end_excluded_and_empty(spark, tmp_path):
    state = str(tmp_path / "state")
    folder = tmp_path / "in"
    folder.mkdir()
    follower = LineFollower(spark, f"{folder}/*.log", state, read_from="end", exclude=["*/no-*"])
    assert follower.next() is None
    write(folder / "a.log", b"old\n")
    write(folder / "no-b.log", b"left out\n")
    assert payloads(follower) == []
    write(folder / "a.log", b"new\n")
    write(folder / "empty.log", b"")
    assert payloads(follower) == ["new"]
    with pytest.raises(ValueError):
        LineFollower(spark, "x", state, max_line=10, max_bytes=10)

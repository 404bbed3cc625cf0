"""Fill-in-middle against its SQL, the skip list against plain cutting, and odd texts."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle import compare, duck
from pyspark.sql import functions as F

from feedloom.llm import middles as M

SF = "/root/testdata/sf0.001"


def plain(key, text, seed=7):
    """(n, form, prefix, middle, output) by matching the lines and joining them."""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    a, b = sorted((h[0] % (len(lines) + 1), h[1] % (len(lines) + 1)))
    parts = ["".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return len(lines), "plain", None, None, text
    if h[3] % 100 < 50:
        return len(lines), "spm", len(parts[0]), len(parts[1]), f"<S>{parts[2]}<P>{parts[0]}<M>{parts[1]}"
    return len(lines), "psm", len(parts[0]), len(parts[1]), f"<P>{parts[0]}<S>{parts[2]}<M>{parts[1]}"


def test_documents_equal_the_oracle(spark):
    _, _, problem = compare(spark, duck(SF), "op13", M.middles_of_documents, M.ORACLE, SF)
    assert problem is None, problem


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(1, 50), min_size=1, max_size=60), min_size=1, max_size=6))
def test_descent_reaches_every_rank(texts):
    lanes = M.build_lanes([np.array(t) for t in texts])
    for i, widths in enumerate(texts):
        ranks = np.arange(len(widths) + 1)
        got = M.descend(lanes, np.full(len(ranks), i), ranks)
        assert got.tolist() == np.concatenate([[0], np.cumsum(widths)]).tolist()


def test_lanes_thin_out():
    lanes = M.build_lanes([np.full(20_000, 3), np.array([5])])
    sizes = [len(lane.units) for lane in lanes]
    assert sizes[0] == 20_001 and sizes[-1] == 2 and len(sizes) > 6
    assert all(0.15 * a < b < 0.4 * a for a, b in zip(sizes, sizes[1:], strict=False) if a > 1000)
    assert all(int(lane.chars.sum()) == 60_005 for lane in lanes)


@pytest.mark.parametrize("stretch", [1, 3, 1 << 20])
def test_line_widths(monkeypatch, stretch):
    monkeypatch.setattr(M, "STRETCH", stretch)
    for text in ("", "a", "\n", "a\n\nb", "😀\né\n", "\n\n", "x\r\ny"):
        assert M.line_widths(text).tolist() == [len(x) for x in re.findall(r"[^\n]*\n|[^\n]+", text)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 999), st.text(alphabet="ab\n<PSM>é😀", max_size=40)), max_size=8))
def test_transform_equals_plain_cutting(rows):
    got = M.transform([str(k) for k, _ in rows], [t for _, t in rows])
    for i, (key, text) in enumerate(rows):
        assert tuple(got[c][i] for c in ("n", "form", "prefix_chars", "middle_chars", "output")) == plain(key, text)


def test_query_on_odd_rows(spark, tmp_path):
    long = "".join(f"line {i} é😀\n" for i in range(200_000)) + "end"
    rows = [(1, None), (2, ""), (None, "a\nb\nc"), (3, "<M>\nx"), (4, "one"), (5, long), (6, "\n" * 3), (6, "\n" * 3)]
    rows += [(i, f"<\n<P\n{i}\n<S\n>M>") for i in range(10, 40)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, form string, n int")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, M.middles_of_documents(spark, str(tmp_path)).collect()), key=str)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for key, text in rows:
        n, form, a, b, output = plain("" if key is None else key, text or "")
        want.append((key, n, form, a, b, sha(output), sha(text or "")))
    assert got == sorted(want, key=str)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    # other columns pass through, those with a result's name are replaced
    made = M.fill_in_middle(frame, rate=0)
    assert made.columns == ["doc_id", "text", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert made.where(F.col("output") != F.coalesce("text", F.lit(""))).count() == 0


def test_empty_table(spark):
    assert M.fill_in_middle(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []

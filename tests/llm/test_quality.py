"""Quality counts against a plain count, the forest's paths, the calibrated cut, and odd rows."""

import random
import re

import numpy as np

from feedloom.llm import quality as Q

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id bigint, text string, n_words int, kept string"


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    inside = set()
    for i, run in enumerate(runs):
        if runs.count(run) > 1:
            inside.update(range(i, i + 5))
    seen, dups = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dups += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(inside)


def test_counts_against_a_plain_count():
    rng = random.Random(2)
    texts = [None, "", "\n\n", "a b   c", "a b c d e a b c d e", "x y z " * 40, "é\né\r\né\n é"]
    for _ in range(300):
        texts.append("".join(rng.choices(["a", "bb", "é", "𝔘", " ", "  ", "\n", "\t", "\x1c", "\x85", "#", "<", "a b c d e "], k=60)))
    for t in texts:
        assert Q.text_counts(t) == plain(t), repr(t)


def test_documents_against_a_plain_count(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = Q.quality_of_documents(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        if len(texts[r.doc_id]) < 4000:
            assert tuple(r[c] for c in Q.COUNTS) == plain(texts[r.doc_id])
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_good_rows_stay(spark):
    out = Q.quality_of_documents(spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = out.join(labels, "doc_id").where("NOT base_failed").groupBy("quality", "kept").count().collect()
    n = {(r.quality, r.kept): r["count"] for r in rows}
    assert n[1, True] / (n[1, True] + n.get((1, False), 0)) > 0.99
    assert n[0, False] > 0.3 * (n[0, False] + n[0, True])


def test_forest_isolates_odd_rows():
    rng = np.random.default_rng(0)
    usual = rng.normal(size=(2000, 5))
    odd = np.full((3, 5), 9.0)
    forest = Q.grow_forest(np.concatenate([usual, odd]))
    scores = forest.scores(np.concatenate([usual, odd]))
    assert scores[-3:].min() > np.quantile(scores[:-3], 0.99)
    assert 0 < scores.min() and scores.max() < 1
    again = Q.grow_forest(np.concatenate([usual, odd])).scores(odd)
    assert (again == scores[-3:]).all()
    assert Q.grow_forest(np.zeros((1, 5))) is None
    assert np.isfinite(Q.grow_forest(np.zeros((50, 5))).scores(odd)).all()


def test_path_of_one_row_by_hand():
    """Paths of a tree against a walk over its nodes."""
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(40, 5))
    forest = Q.grow_forest(rows, trees=3, subsample=16)
    for row, score in zip(rows, forest.scores(rows), strict=True):
        total = 0.0
        for t in range(3):
            node = 0
            while forest.feature[t, node] >= 0:
                right = row[forest.feature[t, node]] >= forest.cut[t, node]
                node = forest.left[t, node] + int(right)
            total += forest.length[t, node]
        assert abs(2 ** (-total / 3 / Q.average_path(16)) - score) < 1e-9


def test_odd_rows(spark):
    prose = [f"the quiet river number {i} ran past seven old houses and a mill on its way to the sea" for i in range(80)]
    junk = [f"a#{i} $$ %% && ** || << >> ## $$ %% && ** {i} || ## b" for i in range(6)]
    rows = [(i, t, 1, "x") for i, t in enumerate(prose + junk)] + [(None, prose[0], None, None), (200, None, 1, "y"), (0, prose[0], 1, "x")]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame(
        [(i, 1) for i in range(80)] + [(i, 0) for i in range(80, 86)] + [(1, 0), (2, None), (None, 0), (900, 0)], "doc_id bigint, quality int"
    )
    out = Q.judge_quality(docs, labels).collect()
    assert len(out) == len(rows)
    kept = {r.doc_id: r.kept for r in out}
    assert not kept[200] and all(kept[i] for i in range(80)) and not any(kept[i] for i in range(80, 86))
    bare = Q.judge_quality(docs, labels.limit(0)).collect()
    assert all(r.kept != r.base_failed for r in bare)
    assert Q.judge_quality(docs.limit(0), labels).count() == 0


def test_very_long_texts_are_counted_whole(spark):
    """A word that repeats, and a line that repeats, at the far end of 400,000 words."""
    words = [f"w{i}" for i in range(400_000)]
    text = " ".join(words) + "\nsame line\nsame line\n" + " ".join(words[:6]) + " ##"
    docs = spark.createDataFrame([(1, text, 1, "x"), (2, "short one", 1, "x")], SCHEMA)
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    row = {r.doc_id: r for r in Q.judge_quality(docs, labels).collect()}[1]
    assert row.n_words == 400_000 + 4 + 6 + 1 and row.n_dup_lines == 1 and row.n_symbols == 2
    # the first six words stand twice: two windows of five, six words at either end
    assert row.n_repeat_words == 12 and not row.base_failed and row.kept

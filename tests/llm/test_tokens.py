"""Token rollups against counts made directly, batch by batch."""

from collections import Counter

import pytest

from feedloom.llm import tokens as K

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def first():
    return K.Vocabulary("byte_bpe_50k")


def shown(frame):
    return {(r.source, r.lang, r.version): (r.docs, r.tokens) for r in frame.collect()}


def test_documents_against_direct_counts(spark, first):
    second = K.Vocabulary("byte_bpe_multi_50k")
    want = Counter()
    docs = Counter()
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        part = r.doc_id % 20
        if part == 7:
            continue
        vocabulary = second if part == 11 else first
        text = f"{r.text}\n{r.text}" if part == 3 else r.text
        want[r.source, r.lang, vocabulary.version] += vocabulary.count(text)
        docs[r.source, r.lang, vocabulary.version] += 1
    assert shown(K.token_totals_of_documents(spark, SF)) == {k: (docs[k], n) for k, n in want.items()}


def test_batches_in_any_repetition(spark, first, tmp_path):
    schema = "doc_id bigint, source string, lang string, text string, action string, tokens string"
    batches = [
        [(1, "a", "en", "one two", "insert", "x"), (1, "a", "en", "one two", "insert", "x"), (2, None, None, None, None, "x"),
         (None, "a", "en", "", "insert", None), (3, "b", "en", "x" * 200_000, "insert", "y")],
        [(1, "a", "fr", "three", "revise", None), (2, None, None, None, "delete", None), (None, "a", "en", "", "delete", None)],
        [],
        [(3, "b", "en", "", "delete", None), (3, "b", "en", "four five", "revise", None), (9, "b", "en", "six", "delete", None)],
    ]
    frames = [spark.createDataFrame(b, schema) for b in batches]
    count = first.count
    v = first.version
    after = [
        {("a", "en", v): (3, 2 * count("one two")), (None, None, v): (1, 0), ("b", "en", v): (1, count("x" * 200_000))},
        {("a", "en", v): (1, 0), ("a", "fr", v): (1, count("three")), ("b", "en", v): (1, count("x" * 200_000))},
    ]
    after.append(after[1])
    after.append({**after[1], ("b", "en", v): (1, count("four five"))})
    rollup = K.TokenRollup(spark, str(tmp_path / "rollup"))
    assert shown(rollup.totals()) == {}
    for n, frame in enumerate(frames, 1):
        rollup.commit(n, frame, first)
        assert shown(rollup.totals()) == after[n - 1]
        rollup.commit(n, frame, first)
        assert shown(rollup.totals()) == after[n - 1]
    for n in (2, 4, 1):  # replays out of order
        rollup.commit(n, frames[n - 1], first)
    assert shown(rollup.totals()) == after[-1]


def test_a_batch_without_its_mark_does_not_count(spark, first, tmp_path):
    rollup = K.TokenRollup(spark, str(tmp_path / "rollup"))
    rows = spark.createDataFrame([(1, "a", "en", "one", "insert")], "doc_id bigint, source string, lang string, text string, action string")
    rollup.commit(1, rows, first)
    rollup.commit(2, rows, first)
    (tmp_path / "rollup/totals/batch=00000002/_SUCCESS").unlink()
    (tmp_path / "rollup/ledger/batch=00000002/_SUCCESS").unlink()
    assert shown(rollup.totals()) == {("a", "en", first.version): (1, 1)}
    rollup.commit(2, rows, first)
    assert shown(rollup.totals()) == {("a", "en", first.version): (2, 2)}


def test_registered_totals_are_those_of_all_documents(spark):
    from feedloom.llm.queries import QUERIES

    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = {}
    for version in ("byte_bpe_50k", "byte_bpe_multi_50k"):
        vocabulary = K.Vocabulary(version)
        for r in rows:
            docs, tokens = want.get((r.source, r.lang, version), (0, 0))
            want[r.source, r.lang, version] = (docs + 1, tokens + vocabulary.count(r.text or ""))
    assert shown(QUERIES["op6_token_counts"](spark, SF)) == want


def test_batches_pass_through_other_totals(spark, first, tmp_path):
    """Before the last batch deleted ids are gone and revised ones count their text twice."""
    docs = spark.createDataFrame([(3, "a", "en", "one two"), (7, "a", "en", "three"), (None, "a", "en", "four")], "doc_id bigint, source string, lang string, text string")
    rollup, count = K.TokenRollup(spark, str(tmp_path / "rollup")), first.count
    seen = []
    for n, batch in enumerate(K.changes_back_to_documents(docs), 1):
        rollup.commit(n, batch, first)
        seen.append(shown(rollup.totals())["a", "en", first.version])
    whole = (3, count("one two") + count("three") + count("four"))
    assert seen == [whole, (2, count("one two\none two") + count("four")), whole]


def test_empty_tables_and_columns_of_clashing_names(spark, first, tmp_path):
    schema = "doc_id bigint, source string, lang string, text string, tokens string, version string, batch int, sign int"
    none, some = spark.createDataFrame([], schema), spark.createDataFrame([(1, "a", "en", "one two", "x", "y", 7, 8)], schema)
    for name, docs, want in (("none", none, {}), ("some", some, {("a", "en", first.version): (1, first.count("one two"))})):
        rollup = K.TokenRollup(spark, str(tmp_path / name))
        for n, batch in enumerate(K.changes_back_to_documents(docs), 1):
            rollup.commit(n, batch, first)
        assert {k: v for k, v in shown(rollup.totals()).items() if v[0]} == want

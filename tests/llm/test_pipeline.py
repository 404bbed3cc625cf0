"""The pipeline: stages in order, each on all that the one before kept, with its columns and effect."""

import pytest

import corpus_pipeline as P
from feedloom.llm.decontaminate import benchmark_hits
from feedloom.llm.secrets import RULES, scan_secrets
from feedloom.llm.simhash import simhash_groups

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's result, written and read again."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in P.STAGES:
        stage(spark, docs, SF).write.parquet(str(folder / name))
        docs = spark.read.parquet(str(folder / name))
        out.append(docs)
    return out


def test_names_and_columns(stages):
    assert [n for n, _ in P.STAGES] == ["language_id", "simhash_dedup", "decontaminate", "secret_scan", "mixing"]
    for frame in stages[:-1]:
        assert frame.columns == stages[0].columns
    assert set(stages[0].columns) < set(stages[-1].columns)


def test_each_stage_has_its_effect(spark, stages):
    docs, spoken, single, clean, cleared, mixed = stages
    n = [f.count() for f in stages]
    assert n[0] >= n[1] > n[2] > n[3] == n[4] > n[5]
    assert n[1] > 0.99 * n[0]
    rows = {f: {r.doc_id: r for r in f.collect()} for f in (docs, spoken, single, clean)}
    assert rows[docs].items() >= rows[spoken].items() >= rows[single].items() >= rows[clean].items()
    groups = simhash_groups(spoken).collect()
    assert set(rows[single]) == {r.component_id for r in groups}
    leaked = {r.doc_id for r in benchmark_hits(single, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert leaked and set(rows[clean]) == set(rows[single]) - leaked
    held = {r.doc_id for r in scan_secrets(clean).where("size(secrets) > 0").collect()}
    changed = {r.doc_id for r in cleared.collect() if r.text != rows[clean][r.doc_id].text}
    assert held and changed == held
    for r in mixed.collect():
        assert 0 < r.taken <= 2 * r.size and r.doc_id in rows[clean]


def test_run_equals_the_stages(spark, stages):
    got = sorted((r.doc_id, r.text, r.taken) for r in P.run(spark, SF).collect())
    assert got == sorted((r.doc_id, r.text, r.taken) for r in stages[-1].collect())


def test_stages_on_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (1, "", "en", None, 0), (1, "the same words", "en", "a", 1), (1, "the same words", "en", "a", 1)], SCHEMA
    )
    for name, stage in P.STAGES:
        assert stage(spark, empty, SF).count() == 0, name
        out = stage(spark, odd, SF)
        assert out.columns[: len(odd.columns)] == odd.columns
        assert out.count() <= 4


def test_rules_are_told_by_kind():
    assert len({r.kind for r in RULES}) == len(RULES)

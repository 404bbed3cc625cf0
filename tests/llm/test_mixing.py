"""The mix against its SQL, its targets against the plain iteration, and odd rows."""

import pytest
from oracle import compare, duck
from pyspark.sql import functions as F

from feedloom.llm import mixing as M

SF = "/root/testdata/sf0.001"


def plain_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Excess over the caps is reshared by weight until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left = share * sum(sizes.values())
    target = dict.fromkeys(order, 0.0)
    free = set(order)
    while free and left > 1e-9:
        each = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        left = 0.0
        for s, n in each.items():
            room = most * sizes[s] - target[s]
            target[s] += min(n, room)
            left += n - min(n, room)
        free = {s for s in free if most * sizes[s] - target[s] > 1e-9}
    return target


def test_documents_equal_the_oracle(spark):
    _, _, problem = compare(spark, duck(SF), "op2", M.mixed_documents, M.oracle(), SF)
    assert problem is None, problem


@pytest.mark.parametrize(
    "sizes", [{"a": 10, "b": 1000, "c": 10, None: 5}, {"z": 0, "a": 0}, {"a": 7}, {"b": 3, "é": 900, "": 40, "Z": 1, None: 0}]
)
def test_targets_against_the_iteration(spark, sizes):
    rows = [(s, "w " * n, i) for i, (s, n) in enumerate(sizes.items())]
    docs = spark.createDataFrame(rows, "source string, text string, doc_id bigint")
    sized = docs.select(*M._measured(docs, "doc_id", "text", "source"))
    got = {None if r.bare else r.name: r.target for r in M.source_targets(sized).collect()}
    want = plain_targets(sizes)
    assert got.keys() == want.keys()
    for s, t in want.items():
        assert got[s] == pytest.approx(t, abs=1e-6)


def test_taken_words_and_positions(spark):
    rows = M.mixed_documents(spark, SF).collect()
    by = {}
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size
        assert (r.position is not None) == (r.taken > 0)
        assert r.position is None or 0 <= r.position <= 1
        assert r.again is None or r.again >= r.position
        by.setdefault(r.source_size, []).append(r)
    for group in by.values():
        targets = {r.target for r in group}
        if len(targets) == 1:
            assert sum(r.taken for r in group) == int(group[0].target)
    places = [r.position for r in rows if r.position is not None]
    assert places == sorted(places)
    assert [r for r in M.mixed_documents(spark, SF).collect()] == rows


@pytest.mark.parametrize("schedule", M.SCHEDULES)
def test_positions_invert_the_demand(spark, schedule):
    """The integral of the schedule up to the position is the fraction asked for."""
    frame = spark.range(101).select((F.col("id") / 100).alias("f"))
    areas = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(schedule, schedule[1:], strict=False)]
    for r in frame.select("f", M.demand_position(F.col("f"), schedule).alias("t")).collect():
        got = 0.0
        for a, b in zip(schedule, schedule[1:], strict=False):
            x = min(max(r.t, a[0]), b[0]) - a[0]
            got += a[1] * x + (b[1] - a[1]) / (b[0] - a[0]) * x * x / 2
        assert got / sum(areas) == pytest.approx(r.f, abs=1e-9)


def test_odd_rows(spark):
    rows = [(1, None, "a", 9), (2, "", "a", 9), (None, "x y z", None, 9), (3, "x y", "a", 9), (3, "x y", "a", 9), (4, "v " * 50_000, "b", 9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, size int").selectExpr("*", "'q' AS mix_key", "0 AS bucket")
    out = M.mixed(docs)
    assert out.columns == ["doc_id", "text", "source", "mix_key", "bucket", *M.RESULT]
    got = out.collect()
    assert all(r.taken > 0 for r in got) and {r.doc_id for r in got} <= {None, 3, 4}
    twice = [r.taken for r in got if r.doc_id == 3]
    assert len(twice) == 2 and len(set(twice)) == 1
    assert M.mixed(docs.limit(0)).count() == 0
    assert M.mixed(docs.where("text IS NULL")).count() == 0


def test_no_python_in_the_plan(spark):
    plan = M.mixed_documents(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))

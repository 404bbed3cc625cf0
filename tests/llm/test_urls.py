"""Captures against a plain replay of the list, and the query against its SQL."""

from datetime import datetime, timedelta

from oracle import compare, duck

from feedloom.llm import urls as U

SF = "/root/testdata/sf0.001"
DAY = datetime(2024, 1, 1)


def at(days):
    return DAY + timedelta(days=days)


def test_pages_equal_the_oracle(spark):
    _, _, problem = compare(spark, duck(SF), "op5", U.urls_of_pages, U.ORACLE, SF)
    assert problem is None, problem


LOG = [
    ("host", "a.example.com", True, at(1)), ("host", "a.example.com", False, at(5)), ("host", "a.example.com", True, at(9)),
    ("domain", "example.com", True, at(3)), ("domain", "example.com", True, at(4)), ("domain", "example.com", False, at(6)),
    ("prefix", "b.org/x", True, at(2)), ("prefix", "b.org/x/y", True, at(2)), ("prefix", "b.org/x/y", False, at(2)),
    ("host", "c.net", False, at(1)), ("host", None, True, at(1)), ("host", "c.net", True, None), (None, "c.net", True, at(0)),
]
URLS = [
    "http://a.example.com/", "https://A.Example.com:8080/q?x=1", "http://u:p@b.org/x/y/z", "http://b.org/xy", "http://c.net",
    "ftp://example.com#f", "http://notexample.com/", "nonsense", "", None, "http://", "http://b.org//x//y",
]


def replay(url, when):
    """(kind, pattern) of the entries in force for a URL, by going through the log."""
    if not url or when is None or "://" not in url:
        return set()
    rest = url.split("://", 1)[1]
    authority = rest.split("#")[0].split("?")[0].split("/")[0]
    host = authority.split("@")[-1].split(":")[0].lower()
    path = [p for p in rest.split("#")[0].split("?")[0].split("/")[1:] if p]
    state = {}
    for kind, pattern, added, t in sorted((e for e in LOG if None not in e), key=lambda e: (e[3], e[2] is False)):
        if t <= when:
            state[kind, pattern] = added
    on = {k for k, v in state.items() if v}
    return {
        (k, p)
        for k, p in on
        if host
        and ((k == "host" and p == host) or (k == "domain" and (host == p or host.endswith("." + p)))
             or (k == "prefix" and p.split("/")[0] == host and path[: len(p.split("/")) - 1] == p.split("/")[1:]))
    }


def test_captures_against_a_replay(spark):
    entries = spark.createDataFrame(LOG, "kind string, pattern string, added boolean, at timestamp")
    rows = [(i * 100 + d, u, at(d) if d < 12 else None) for i, u in enumerate(URLS) for d in range(13)] * 2
    captures = spark.createDataFrame(rows, "page_id bigint, url string, fetched_at timestamp").selectExpr("*", "1 AS host", "2 AS kind", "3 AS since")
    got = U.filter_urls(captures, entries).collect()
    assert len(got) == len(rows)
    asked = {r[0]: r for r in rows}
    for r in got:
        want = replay(*asked[r.page_id][1:])
        assert r.n_active == len(want), (r, want)
        assert r.blocked == bool(want)
        assert not want or (r.kind, r.pattern) in want
    assert U.filter_urls(captures.limit(0), entries).count() == 0
    assert not any(r.blocked for r in U.filter_urls(captures, entries.limit(0)).collect())


def test_intervals(spark):
    entries = spark.createDataFrame(LOG, "kind string, pattern string, added boolean, at timestamp")
    got = {(r.pattern, r.since, r.until) for r in U.validity_intervals(entries).collect()}
    assert got == {
        ("a.example.com", at(1), at(5)), ("a.example.com", at(9), None), ("example.com", at(3), at(6)), ("b.org/x", at(2), None)
    }


def test_no_python_in_the_plan(spark):
    plan = U.urls_of_pages(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_very_long_urls(spark):
    """Thousands of folders, labels and letters: the entry of the deepest folder and of the last label count."""
    deep = "http://long.org" + "/f" * 1500
    wide = "http://" + "a." * 300 + "wide.org/" + "x" * 100_000
    log = [("prefix", "long.org" + "/f" * 1200, True, at(1)), ("domain", "wide.org", True, at(1)), ("prefix", "long.org/g", True, at(1))]
    entries = spark.createDataFrame(log, "kind string, pattern string, added boolean, at timestamp")
    rows = [(1, deep, at(2)), (2, wide, at(2)), (3, deep, at(0)), (4, "http://long.org/" + "f" * 100_000, at(2))]
    captures = spark.createDataFrame(rows, "page_id bigint, url string, fetched_at timestamp")
    got = {r.page_id: r.n_active for r in U.filter_urls(captures, entries).collect()}
    assert got == {1: 1, 2: 1, 3: 0, 4: 0}

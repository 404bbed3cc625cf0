"""Secret spans against each rule run over every text, without the index."""

import hashlib
import random
import re

from feedloom.llm import secrets as S

SF = "/root/testdata/sf0.01"

# The base kinds as the contract words them; short matches are dropped after the search.
PLAIN = [
    ("assign", r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
]


def plain_base(text):
    found = []
    for n, (kind, pattern, group, least) in enumerate(PLAIN):
        found += [(m.start(), n, kind, m.end()) for m in re.finditer(pattern, text or "") if len(m.group(group)) >= least]
    return [(k, a, b) for a, _, k, b in sorted(found)]


def plain_all(text):
    found = [(a, n, r.kind, b) for n, r in enumerate(S.RULES) for a, b in r.spans(text or "")]
    return [(k, a, b) for a, _, k, b in sorted(found)]


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def hostile(seed=6):
    rng = random.Random(seed)
    bits = [
        "password", "PassWd", "toKen", "token", "ſecret", "api_key", "APIKEY", "'", '"', " ", "  ", ":", "=", "=:",
        "AKIA", "akia", "A1B2C3D4E5F6G7H8", "0123456789abcdef", "beef", "é", "𝔘", "\n", "İ", "secret=token:abcdefg",
        "ghp_" + "a1" * 18, "-----BEGIN RSA PRIVATE KEY-----", "xoxb-1234567890", "://u:p@h", "eyJhbGciOi.eyJhbGciOi.abcdefgh1",
    ]
    return ["".join(rng.choices(bits, k=rng.randint(0, 30))) for _ in range(600)]


def test_hostile_texts_against_full_scans():
    texts = [None, "", "x" * 300_000, "a" * 100_000, *hostile()]
    got = S.find_spans(texts)
    for text, spans in zip(texts, got, strict=True):
        assert [(S.RULES[n].kind, a, b) for a, b, n in spans] == plain_all(text)
        base = [(S.RULES[n].kind, a, b) for a, b, n in spans if n < 3]
        assert base == plain_base(text)


def test_documents_against_full_scans(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = S.secrets_of_documents(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    assert any(r.spans for r in rows)
    for r in rows:
        base = plain_base(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(joined(base).encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == x for x, _, _ in base) for k in ("assign", "access", "hex")]
        assert r.spans == joined(plain_all(texts[r.doc_id]))


def test_queries_of_expressions():
    assert S.trigram_query("[0-9a-f]{24,}") == S.EVERYTHING
    assert S.trigram_query("AKIA[A-Z]+") == [frozenset({b"aki", b"kia"})]
    assert {frozenset(q) for q in S.trigram_query("(abc|xyz)+def?")} == {frozenset({b"abc"}), frozenset({b"xyz"})}
    assert S.trigram_query("a(bcde)?f") == [frozenset()] or all(S.trigram_query("a(bcde)?f"))
    assert S.trigram_query("x*") == S.EVERYTHING


def test_index_holds_what_texts_hold():
    texts = hostile(9)[:50]
    index = S.Index(texts, [b"tok", b"aki", b"zzz"])
    for t, rows in index.postings.items():
        assert rows.tolist() == [i for i, x in enumerate(texts) if t in x.encode().lower()]


def test_odd_rows(spark):
    rows = [(1, None, "a"), (1, None, "a"), (None, "", None), (3, "my password=abc123def!", "s"), (4, "clean", "t")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, secrets string")
    out = {(r.doc_id, r.text, r.secrets) for r in S.without_secrets(docs).collect()}
    assert out == {(1, None, "a"), (None, "", None), (3, "my [assign]!", "s"), (4, "clean", "t")}
    assert S.without_secrets(docs).columns == docs.columns
    assert S.without_secrets(docs).count() == 5
    found = {r.doc_id: [tuple(s) for s in r.secrets] for r in S.scan_secrets(docs).collect()}
    assert found == {1: [], None: [], 3: [("assign", 3, 21)], 4: []}
    assert S.scan_secrets(docs.limit(0)).count() == 0
    assert S.redacted("abcdef", [(0, 3, 0), (2, 5, 1)]) == "[assign]f"

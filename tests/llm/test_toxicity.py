"""Toxicity: hashes and gradients against plain code, held-out accuracy, and odd rows."""

import math
import re

import numpy as np
from pyspark.sql import functions as F

from feedloom.llm import toxicity as X

SF = "/root/testdata/sf0.1"


def test_words_hash_alike_wherever_they_stand():
    rows, edges = X.word_rows([b"", b"Hello, big world", b"big", "HELLO é WORLD é".encode(), b" -- "])
    per = [rows[a:b].tolist() for a, b in zip(edges, edges[1:], strict=False)]
    assert [len(p) for p in per] == [0, 3, 1, 4, 0]
    assert per[1][1] == per[2][0] and per[1][0] == per[3][0] and per[3][1] == per[3][3] and per[1][2] == per[3][2]
    assert per[1][0] != per[1][2]
    many = [f"word{i}".encode() for i in range(3000)]
    rows, _ = X.word_rows(many)
    assert len({tuple(r[:2]) for r in rows.tolist()}) > 2990
    assert len({r[2] for r in rows.tolist()}) == 1  # the same first four bytes


def test_stretches_change_nothing(monkeypatch):
    rng = np.random.default_rng(4)
    texts = [b" ".join(rng.choice([b"aa", b"bb", b"cc", b"dddddddd", b"e" * 90], n)) for n in (0, 1, 400, 3, 50)]
    rows, edges = X.word_rows(texts)
    net = X.train_classifier([rows[a:b] for a, b in zip(edges, edges[1:])], [0, 1, 0, 1, 1], ["x", "y", None, "x", "y"], steps=3)
    whole = X.raw_scores(net, rows, edges)
    monkeypatch.setattr(X, "STRETCH", 40)
    monkeypatch.setattr(X, "WORDS", 7)
    again, same = X.word_rows(texts)
    assert (again == rows).all() and (same == edges).all()
    cut = X.raw_scores(net, again, same)
    assert np.allclose(whole[0], cut[0], atol=1e-6) and (whole[1] == cut[1]).all()


def test_gradients_against_differences():
    rng = np.random.default_rng(1)
    rows = [X.word_rows([b" ".join(rng.choice([b"aa", b"bb", b"cc", b"dddddddd"], 6))])[0] for _ in range(4)]
    net = X.train_classifier(rows * 3, [0, 1, 0, 1] * 3, [None] * 12, steps=2)
    words, edges = X._words_of(rows, np.arange(4))
    truth = np.array([0, 1, 0, 1])

    def loss():
        found = X.responses(net, X.embedded(net, words), edges)
        flat = np.concatenate([X.largest(f, edges) for f in found], axis=1).astype(float)
        p = 1 / (1 + np.exp(-(flat @ net.weight + net.bias)))
        return -np.mean(truth * np.log(p) + (1 - truth) * np.log(1 - p)) + 0.5e-4 * float((net.weight.astype(float) ** 2).sum())

    grads = X._gradients(net, words, edges, truth)
    for w, g in zip(net.weights(), grads, strict=True):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        held, step = w[at], 1e-3
        w[at] = held + step
        up = loss()
        w[at] = held - step
        down = loss()
        w[at] = held
        assert abs((up - down) / (2 * step) - g[at]) < 2e-3 + 0.05 * abs(g[at])


def test_held_out_documents(spark):
    out = X.toxicity_of_documents(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = out.join(labels, "doc_id").where("held_out").groupBy("toxic", "predicted").count().collect()
    n = {(r.toxic, r.predicted): r["count"] for r in rows}
    assert n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) > 0.85
    assert n[0, 0] / (n[0, 0] + n.get((0, 1), 0)) > 0.97
    assert out.where("score < 0 OR score > 1 OR predicted <> int(score >= 0.7)").count() == 0


def test_thresholds():
    assert X.best_threshold([(900, 5, 0), (100, 0, 5)]) == 0.5
    assert X.best_threshold([(900, 5, 0)]) is None
    cut = X.best_threshold([(950, 4, 0), (900, 1, 1), (800, 0, 3), (100, 0, 9)])
    assert 0.8 < cut < 0.95


def test_score_rises_with_the_raw_score(spark):
    frame = spark.range(1001).select((F.col("id") / 1000).alias("raw"))
    rows = frame.select("raw", X.stretched(F.col("raw"), F.lit(0.9)).alias("s")).orderBy("raw").collect()
    assert all(a.s <= b.s for a, b in zip(rows, rows[1:], strict=False))
    assert all((r.s >= X.CUT) == (r.raw >= 0.9) and 0 <= r.s <= 1 for r in rows)


def test_odd_rows(spark):
    rows = [(i, ("nasty words here" if i % 3 == 0 else "kind words here") + f" {i}", "en", 7.0) for i in range(60)]
    rows += [(None, None, None, None), (100, None, "en", None), (101, "", None, 1.0), (102, "nasty " * 50_000, "xx", 1.0), (1, "kind", "en", 0.0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score double")
    labels = spark.createDataFrame(
        [(i, int(i % 3 == 0)) for i in range(60)] + [(3, 0), (None, 1), (5, None), (999, 1)], "doc_id bigint, toxic int"
    )
    out = X.score_toxicity(docs, labels).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r.predicted for r in out}
    assert by[102] == 1 and by[100] == by[101] == by[None] == 0
    assert all(by[i] == int(i % 3 == 0) for i in range(60))
    one_kind = X.score_toxicity(docs, labels.where("toxic = 1")).collect()
    assert {(r.score, r.predicted) for r in one_kind} == {(0.0, 0)}
    assert X.score_toxicity(docs.limit(0), labels).count() == 0
    assert X.score_toxicity(docs, labels.limit(0)).count() == len(rows)


def plain_score(net, text):
    """Probability and language of a text, a word, a filter and a number at a time."""
    words = [w.encode() for w in re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+", text)]
    rows = []
    for w in words:
        low = bytes(c + 32 if 65 <= c <= 90 else c for c in w)
        own = []
        for i, most in enumerate(X.PREFIXES):
            h = sum((c + 1) * pow(X._STEP, k, 1 << 64) for k, c in enumerate(low[:most] if most else low)) % (1 << 64)
            h ^= h >> 32
            own.append(((h * int(X._MIX[i])) % (1 << 64) >> 49) + i * X.ROWS)
        rows.append(own)
    vectors = [[sum(float(net.table[r, d]) for r in own) for d in range(net.table.shape[1])] for own in rows]
    logit = float(net.bias[0])
    for n, (span, kernel, shift) in enumerate(zip(X.SPANS, net.filters, net.shift)):
        for f in range(X.FILTERS):
            best = 0.0
            for at in range(len(vectors)):
                told = float(shift[f])
                for j, v in enumerate(vectors[at : at + span]):
                    told += sum(x * float(kernel[j, d, f]) for d, x in enumerate(v))
                best = max(best, told)
            logit += best * float(net.weight[n * X.FILTERS + f])
    spoken = [sum(float(net.speech[own[0], s]) for own in rows) for s in range(len(net.languages))]
    return 1 / (1 + math.exp(-logit)), spoken.index(max(spoken))


def test_scores_equal_a_plain_word_loop():
    texts = ["", "One two THREE", "ugly ugly word", "Größe — naïve x1", "word", "a-b_c " * 9]
    rows, edges = X.word_rows([t.encode() for t in texts])
    taught = [rows[a:b] for a, b in zip(edges[1:], edges[2:])]
    net = X.train_classifier(taught, [0, 1, 0, 0, 1], ["x", "y", "x", "y", None], steps=4)
    net.shift[0] += 0.3
    got, speech = X.raw_scores(net, rows, edges)
    for t, p, s in zip(texts, got, speech):
        want, spoken = plain_score(net, t)
        assert abs(p - want) < 1e-5 and s == spoken


def test_thresholds_come_from_every_row_that_the_fit_left(spark):
    """Of more labels than the sample takes, all others count, weighed to what each label has."""
    known = spark.range(6000).select(F.col("id").alias("labelled"), (F.col("id") % 20 == 0).cast("int").alias("toxic"))
    taught = X.sampled_labels(known, 100)
    left = known.join(taught, "labelled", "left_anti")
    assert left.count() == 5800
    zero, one = X._shares(known, left)
    assert abs(zero - 5700 / 5600) < 1e-9 and abs(one - 300 / 200) < 1e-9

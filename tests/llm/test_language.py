"""Language identification: gradients against differences, held-out accuracy, whole texts, odd rows."""

import math

import numpy as np

from feedloom.llm import language as L

SF = "/root/testdata/sf0.01"
WORDS = {"aa": b"the of and that with this ", "bb": "für über schön und nicht ".encode()}


def small_net(steps=60):
    windows, labels = [], []
    for i in range(40):
        for label, w in WORDS.items():
            windows.append((w * 5)[i : i + L.WINDOW - (i % 7) * 5])
            labels.append(label)
    return L.train_network(windows, labels, hidden=6, steps=steps)


def test_gradients_against_differences():
    rng = np.random.default_rng(2)
    net = L.fresh_network(["aa", "bb", "cc"], 5, 1)
    window = rng.integers(97, 110, (9, 4)).astype(np.uint8)
    length, truth = np.array([9, 4, 1, 7]), np.array([0, 1, 2, 1])
    _, grads = L._gradients(net, window, length, truth)
    for w, g in zip(net.weights(), grads, strict=True):
        order = np.abs(g).reshape(-1).argsort()[-3:]
        for flat in order:
            at = np.unravel_index(flat, g.shape)
            held, step = w[at], 1e-2
            w[at] = held + step
            up, _ = L._gradients(net, window, length, truth)
            w[at] = held - step
            down, _ = L._gradients(net, window, length, truth)
            w[at] = held
            assert abs((up - down) / (2 * step) - g[at]) < 2e-4 + 0.02 * abs(g[at])


def test_pooling_equals_positions():
    """Blocks of windows of many texts give each text the mean over its own positions."""
    net = small_net(10)
    texts = [b"", b"a", WORDS["aa"] * 30, WORDS["bb"] * 7 + b"x", b"q" * L.WINDOW, WORDS["aa"] * 3000]
    mean, won = L.pooled(net, texts)
    for t, m, w in zip(texts, mean, won, strict=True):
        if t:
            each = L.label_positions(net, t)
            assert len(each) == len(t)
            assert np.allclose(each.mean(axis=0), m, atol=1e-4)
            assert w.sum() >= len(t)
        else:
            assert not m.any()


def test_held_out_documents(spark):
    out = L.language_of_documents(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = out.join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 150
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(spark):
    net = small_net()
    rows = [
        (1, None, "aa"), (2, "", None), (3, "123 456 !?", "aa"), (4, "the and of this", "zz"), (None, "für schön über", None),
        (5, "the " * 40_000, "aa"), (4, "the and of this", "zz"), (6, "中文字", "aa"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang_pred string").selectExpr("*", "9.5 AS score", "1 AS positions")
    out = {r.doc_id: r.lang_pred for r in L.identify(docs, net).collect()}
    assert (out[1], out[2], out[3], out[4], out[5], out[None]) == ("und", "und", "und", "aa", "aa", "bb")
    assert out[6] in ("aa", "bb")
    assert {r.score for r in L.identify(docs, net).where("lang_pred = 'und'").collect()} == {0.0}
    kept = L.keep_identified(docs, net, 0.0)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["4", "4", "5", "6", "None"]
    assert {r.lang_pred for r in kept.collect()} == {"aa", "zz", None}
    assert L.identify(docs, None).where("lang_pred <> 'und'").count() == 0
    assert L.identify(docs.limit(0), net).count() == 0
    labelled = docs.withColumn("lang", docs.lang_pred)
    assert L.fit_network(labelled.limit(0)) is None
    assert L.fit_network(labelled.where("lang IS NULL")) is None
    one = L.fit_network(labelled.where("doc_id = 5"))
    assert one.labels == ["aa"]


def plain_probabilities(net, text):
    """Probabilities of the labels at each byte, a byte and a number at a time."""
    hidden = net.inner.shape[2]
    sigmoid = lambda x: 1 / (1 + math.exp(-x))
    out = []
    for start in range(0, len(text), L.WINDOW):
        window = text[start : start + L.WINDOW]
        states = [[None] * len(window) for _ in range(2)]
        for d, places in enumerate((range(len(window)), range(len(window) - 1, -1, -1))):
            h = [0.0] * hidden
            for t in places:
                told = [float(x) for x in net.table[d][:, window[t]]]
                inner = [sum(float(w) * x for w, x in zip(row, h, strict=True)) for row in net.inner[d]]
                inner = [x + float(b) for x, b in zip(inner, net.bias[d][:, 0], strict=True)]
                z = [sigmoid(told[i] + inner[i]) for i in range(hidden)]
                r = [sigmoid(told[hidden + i] + inner[hidden + i]) for i in range(hidden)]
                n = [math.tanh(told[2 * hidden + i] + r[i] * inner[2 * hidden + i]) for i in range(hidden)]
                h = [n[i] + z[i] * (h[i] - n[i]) for i in range(hidden)]
                states[d][t] = h
        for t in range(len(window)):
            both = states[0][t] + states[1][t]
            logits = [sum(float(w) * x for w, x in zip(row, both, strict=True)) + float(b) for row, b in zip(net.head, net.head_bias[:, 0], strict=True)]
            top = [math.exp(x - max(logits)) for x in logits]
            out.append([x / sum(top) for x in top])
    return np.array(out)


def test_the_forward_pass_equals_a_plain_byte_loop(monkeypatch):
    rng = np.random.default_rng(4)
    net = L.fresh_network(["a", "b", "c"], 5, 2)
    net.bias += rng.normal(size=net.bias.shape).astype(np.float32)
    net.head *= 20
    texts = [b"", b"x", bytes(rng.integers(0, 256, 64, dtype=np.uint8)), "Ein Satz, über drei Fenster: ".encode() * 6]
    want = [plain_probabilities(net, t) for t in texts]
    for block in (1, 3, 1024):
        monkeypatch.setattr(L, "BLOCK", block)
        chance, won = L.pooled(net, texts)
        for i, w in enumerate(want):
            assert np.allclose(chance[i], w.mean(axis=0) if len(w) else 0, atol=2e-6)
            assert won[i].tolist() == np.bincount(w.argmax(axis=1) if len(w) else [], minlength=3).tolist()


def test_many_rows_of_few_ids_still_give_a_network(spark):
    """More rows than the sample takes, under two ids: the network learns and no document is undetermined."""
    from pyspark.sql import functions as F

    rows = spark.range(6000).select(
        (F.col("id") % 2).alias("doc_id"),
        F.when(F.col("id") % 2 == 0, F.lit("the cat sat on the mat")).otherwise(F.lit("der hund lief zum fluss")).alias("text"),
        F.when(F.col("id") % 2 == 0, F.lit("en")).otherwise(F.lit("de")).alias("lang"),
    )
    net = L.fit_network(rows)
    got = {(r.doc_id, r.lang_pred) for r in L.identify(rows, net, keep=["doc_id"]).select("doc_id", "lang_pred").distinct().collect()}
    assert got == {(0, "en"), (1, "de")}

"""Toxicity of texts by a convolutional classifier over hashed word embeddings.

A text's words (runs of ASCII letters and digits and of other characters, A-Z in lower case) get
embeddings as sums of HASHES hashed rows: two of the whole word and one of each of its first four to
seven bytes, so inflected forms share a part and two words rarely share all. Filters of several
widths run over the embedded words, the largest response of each filter over the whole text is taken,
and a logistic unit weighs them. It is written in numpy and trained on the driver on a bounded sample
of labelled rows; the tasks score whole texts with it.

Thresholds differ by language. The language is the model's own guess from the words (naive Bayes over
the same hashes); no column but the text is an input. Labelled rows give
counts of raw scores by language and label, from which each language's threshold is taken; the raw
score is then stretched so that every language's threshold comes to CUT. The fit takes its sample from
four fifths of the labelled ids; the thresholds come from every labelled row that the sample left, each
label weighed to what it has of all labelled rows. A guess that ties goes to the first language in order.

Nulls: a null or empty text has no words and is scored like any other, from the bias alone. Null labels
and labels of unknown ids do not count; an id labelled both ways is toxic. Without labels of both kinds
every score is 0. Repeated rows give repeated results; an empty table gives no rows. Only the named
columns are read, so further columns cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import bounded_sample, fold, map_texts, sampled_rows, table
from feedloom.session import cut_lineage

ROWS = 1 << 15
# Bytes of a word that each of its rows is hashed from; 0: all.
PREFIXES = (0, 0, 4, 5, 6, 7)
HASHES = len(PREFIXES)
# Part of the words of a training batch that show their beginnings only, as an unknown form would.
UNKNOWN = 0.5
# A row that fewer documents of the sample have stays zero: it says nothing yet.
LEAST_SEEN = 3
WIDTH = 8
FILTERS = 8
SPANS = (1, 2, 3)
# Bound of the fit: documents of each label, and words of each (evenly spread pieces of long texts).
SAMPLE_DOCS = 2500
SAMPLE_WORDS = 400
STEPS = 300
BATCH = 64
CUT = 0.7
# Bytes that are hashed, and words that run through the filters, at once.
STRETCH = 1 << 20
WORDS = 1 << 17
GRID = 1000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
# An odd multiplier, its inverse and mixers, modulo 2**64.
_STEP = 0x5851F42D4C957F2D
_MIX = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_bounds(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of every word of bytes that end with none."""
    edge = np.diff(_INSIDE[raw].astype(np.int8), prepend=0)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_rows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(words, HASHES) table rows of every word of all texts, and where each text's words begin (and end).

    The polynomial hash of a word is a difference of prefix sums, moved to the word's start by the
    inverse power, so all words are hashed at once. Each hash has ROWS rows of the table for itself.
    """
    joined = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    begin, end = word_bounds(joined)
    rows = np.empty((len(begin), HASHES), np.int32)
    at = 0
    while at < len(begin):  # words that begin within a stretch, and at least one
        upto = max(int(np.searchsorted(begin, begin[at] + STRETCH)), at + 1)
        low = int(begin[at])
        part = joined[low : end[upto - 1]]
        sums = np.zeros(len(part) + 1, np.uint64)
        terms = (_LOWER[part].astype(np.uint64) + np.uint64(1)) * _powers(_STEP, len(part))
        np.cumsum(terms, out=sums[1:])
        first, last = begin[at:upto] - low, end[at:upto] - low
        inverse = _powers(pow(_STEP, -1, 1 << 64), len(part))[first]
        for i, most in enumerate(PREFIXES):
            until = np.minimum(last, first + most) if most else last
            hashed = (sums[until] - sums[first]) * inverse
            hashed ^= hashed >> np.uint64(32)
            rows[at:upto, i] = ((hashed * _MIX[i]) >> np.uint64(64 - 15)).astype(np.int32) + i * ROWS
        at = upto
    lengths = np.array([len(t) + 1 for t in texts])
    return rows, np.searchsorted(begin, np.append(0, np.cumsum(lengths)))


@dataclass
class Classifier:
    table: np.ndarray  # (HASHES * ROWS + 1, WIDTH)
    filters: list[np.ndarray]  # for each span (span, WIDTH, FILTERS)
    shift: list[np.ndarray]  # (FILTERS,)
    weight: np.ndarray  # (len(SPANS) * FILTERS,)
    bias: np.ndarray  # (1,)
    languages: list[str]
    speech: np.ndarray  # (ROWS, languages) log probability of a word's first row in each language

    def weights(self) -> list[np.ndarray]:
        return [self.table, *self.filters, *self.shift, self.weight, self.bias]


def embedded(net: Classifier, rows: np.ndarray) -> np.ndarray:
    out = net.table[rows[:, 0]]
    for i in range(1, HASHES):
        out = out + net.table[rows[:, i]]
    return out


def responses(net: Classifier, words: np.ndarray, edges: np.ndarray) -> list[np.ndarray]:
    """For each span, (words, FILTERS) responses at every place; beyond a text's end words are zero."""
    out = []
    after = np.repeat(edges[1:], np.diff(edges)) - np.arange(len(words))
    for span, kernel, shift in zip(SPANS, net.filters, net.shift, strict=True):
        total = words @ kernel[0] + shift
        for j in range(1, span):
            more = words[j:] @ kernel[j]
            more[(after <= j)[: len(more)]] = 0
            total[: len(more)] += more
        out.append(np.maximum(total, 0, out=total))
    return out


def largest(found: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """(texts, FILTERS) largest response in each text; 0 for a text without words."""
    out = np.zeros((len(edges) - 1, found.shape[1]), np.float32)
    some = np.flatnonzero(np.diff(edges))
    if len(some):
        out[some] = np.maximum.reduceat(found, edges[some], axis=0)
    return out


def raw_scores(net: Classifier, rows: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of each text, and the number of the language its words are likeliest in."""
    pooled = np.zeros((len(edges) - 1, len(SPANS) * FILTERS), np.float32)
    for at in range(0, len(rows), WORDS):  # with the words that the last places look ahead to
        upto = min(at + WORDS, len(rows))
        ahead = min(upto + max(SPANS) - 1, len(rows))
        found = responses(net, embedded(net, rows[at:ahead]), np.clip(edges - at, 0, ahead - at))
        here = np.clip(edges - at, 0, upto - at)
        part = np.concatenate([largest(f[: upto - at], here) for f in found], axis=1)
        np.maximum(pooled, part, out=pooled)
    logit = np.clip(pooled.astype(float) @ net.weight.astype(float) + float(net.bias[0]), -30, 30)
    sums = np.zeros((len(edges) - 1, len(net.languages)))
    some = np.flatnonzero(np.diff(edges))
    if len(some):
        sums[some] = np.add.reduceat(net.speech[rows[:, 0]], edges[some], axis=0)
    return 1 / (1 + np.exp(-logit)), sums.argmax(axis=1)


def _words_of(rows: list[np.ndarray], pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    chosen = [rows[i] for i in pick]
    return np.concatenate(chosen), np.cumsum([0] + [len(c) for c in chosen])


def train_classifier(
    rows: list[np.ndarray], toxic: list[int], speech: list[str | None], steps: int = STEPS, seed: int = 5
) -> Classifier:
    """Adam on the cross entropy of batches with as many toxic texts as others.

    The embeddings begin small and random but for one coordinate, the word's log odds of standing in a
    toxic text of the sample; the filters learn what to make of it.
    """
    rng = np.random.default_rng(seed)
    normal = lambda *s: rng.normal(size=s).astype(np.float32)
    truth = np.array(toxic)
    languages = sorted({s for s in speech if s is not None}) or ["any"]
    spoken = np.full((ROWS, len(languages)), 0.1)
    counts = np.zeros((2, HASHES * ROWS + 1))
    for r, y, s in zip(rows, truth, speech, strict=True):
        counts[int(y), np.unique(r)] += 1
        if s is not None:
            np.add.at(spoken[:, languages.index(s)], r[:, 0], 1)
    odds = [np.log((counts[y] + 0.5) / ((truth == y).sum() + 1)) for y in (0, 1)]
    net = Classifier(
        normal(HASHES * ROWS + 1, WIDTH) * 0.05,  # the last row, of an unknown form, stays zero
        [normal(span, WIDTH, FILTERS) * 0.3 for span in SPANS],
        [np.zeros(FILTERS, np.float32) for _ in SPANS],
        np.abs(normal(len(SPANS) * FILTERS)) * 0.2,
        np.full(1, -1.0, np.float32),
        languages,
        np.log(spoken / spoken.sum(axis=0)).astype(np.float32),
    )
    net.table[:, 0] += np.clip(odds[1] - odds[0], -2, 4) / HASHES
    unseen = counts.sum(axis=0) < LEAST_SEEN
    net.table[unseen] = 0
    for kernel in net.filters:
        kernel[0, 0, : FILTERS // 2] = np.abs(kernel[0, 0, : FILTERS // 2]) + 0.2
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in net.weights()]
    groups = [np.flatnonzero(truth == y) for y in (0, 1)]
    for step in range(1, steps + 1):
        pick = np.concatenate([rng.choice(g, BATCH // 2) for g in groups])
        words, edges = _words_of(rows, pick)
        words[np.ix_(rng.random(len(words)) < UNKNOWN, [i for i, n in enumerate(PREFIXES) if not n])] = HASHES * ROWS
        grads = _gradients(net, words, edges, truth[pick])
        grads[0][unseen] = 0
        pace = 0.01 * min(1.0, 2 * (1 - step / (steps + 1)))
        for w, g, (m, v) in zip(net.weights(), grads, moments, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    return net


def _gradients(net: Classifier, rows: np.ndarray, edges: np.ndarray, truth: np.ndarray) -> list[np.ndarray]:
    """Gradients through the pooled places alone: each filter of each text learns from one place."""
    words = embedded(net, rows)
    found = responses(net, words, edges)
    pooled = [largest(f, edges) for f in found]
    flat = np.concatenate(pooled, axis=1)
    error = (1 / (1 + np.exp(-np.clip(flat @ net.weight + net.bias, -30, 30))) - truth) / len(truth)
    d_weight = flat.T @ error + 1e-4 * net.weight
    d_table = np.zeros_like(net.table)
    d_filters, d_shift = [np.zeros_like(k) for k in net.filters], [np.zeros_like(s) for s in net.shift]
    some = np.flatnonzero(np.diff(edges))
    ends = edges[1:][some][:, None]
    for n, (span, f) in enumerate(zip(SPANS, found, strict=True)):
        w = net.weight[n * FILTERS : (n + 1) * FILTERS]
        at = np.array([edges[t] + f[edges[t] : edges[t + 1]].argmax(axis=0) for t in some]).reshape(len(some), -1)
        g = np.where(pooled[n][some] > 0, error[some][:, None] * w, 0).astype(np.float32)
        d_shift[n] += g.sum(axis=0)
        for j in range(span):
            live = np.where(at + j < ends, g, 0)
            place = np.minimum(at + j, ends - 1)
            d_filters[n][j] += np.einsum("tfw,tf->wf", words[place], live)
            back = (live[:, :, None] * net.filters[n][j].T).reshape(-1, words.shape[1])
            hit = rows[place.reshape(-1)]
            for i in range(HASHES):
                np.add.at(d_table, hit[:, i], back)
    return [d_table, *d_filters, *d_shift, d_weight.astype(np.float32), np.array([error.sum()], np.float32)]


def spread_words(text: str | None, most: int = SAMPLE_WORDS) -> bytes:
    """All words of a short text; of a longer one four evenly spread stretches, `most` words in all."""
    raw = (text or "").encode("utf-8", "surrogatepass") + b"\n"
    begin, end = word_bounds(np.frombuffer(raw, np.uint8))
    if len(begin) <= most:
        return raw
    part = most // 4
    at = np.linspace(0, len(begin) - part, 4).astype(int)
    return b"\n".join(raw[begin[a] : end[a + part - 1]] for a in at)


def label_rows(labels: DataFrame, label: str = "toxic", key: str = "doc_id") -> DataFrame:
    """(labelled, toxic): one row for each id with a label; 1 if any of its labels is over 0."""
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull())
    return known.groupBy(F.col(key).alias("labelled")).agg(F.max((F.col(label) > 0).cast("int")).alias("toxic"))


def sampled_labels(known: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """At most `sample_docs` rows (labelled, toxic) of each label."""
    sides = [bounded_sample(known.where(F.col("toxic") == y), ["labelled"], sample_docs, 10) for y in (0, 1)]
    return cut_lineage(sides[0].union(sides[1]))


def fit_classifier(
    docs: DataFrame, ids: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang"
) -> Classifier | None:
    """Learn from the documents of the sampled labels; None if a label has none.

    Tasks cut long texts down, so the driver gets a bounded size.
    """

    def words(texts: list[str | None]) -> dict[str, Any]:
        return {"words": [spread_words(t) for t in texts]}

    speech = F.col(lang) if lang in docs.columns else F.lit(None).cast("string")
    chosen = docs.join(F.broadcast(ids), docs[key] == ids["labelled"]).select(
        "labelled", "toxic", speech.alias("speech"), F.col(text).alias("text")
    )
    frame = map_texts(chosen, words, "words binary", ["labelled", "toxic", "speech"])
    rows = sampled_rows(frame, ids, ["toxic", "speech", "words"], "labelled")
    toxic = [r["toxic"] for r in rows]
    if len(set(toxic)) < 2:
        return None
    every, edges = word_rows([bytes(r["words"]) for r in rows])
    words_of = [every[a:b] for a, b in zip(edges, edges[1:], strict=False)]
    return train_classifier(words_of, toxic, [r["speech"] for r in rows])


def with_raw_scores(docs: DataFrame, net: Classifier, keep: list[str], text: str = "text") -> DataFrame:
    """`raw` (on the grid's scale, 0 to 1) and `speech`, the language that the words speak for."""

    def compute(texts: list[str | None]) -> dict[str, Any]:
        rows, edges = word_rows([(t or "").encode("utf-8", "surrogatepass") for t in texts])
        raw, speech = raw_scores(net, rows, edges)
        return {"raw": np.round(raw, 6), "speech": [net.languages[s] for s in speech]}

    return map_texts(docs, compute, "raw double, speech string", keep, text)


def best_threshold(rows: list[tuple[int, float, float]]) -> float | None:
    """The middle of the widest gap among the cuts with the best F1; rows of (bin, toxic, others)."""
    positives = sum(r[1] for r in rows)
    if not positives or not sum(r[2] for r in rows):
        return None
    hit = wrong = 0
    cuts: list[tuple[float, int, int]] = []
    ordered = sorted(rows, reverse=True)
    for i, (at, t, o) in enumerate(ordered):
        hit, wrong = hit + t, wrong + o
        below = ordered[i + 1][0] if i + 1 < len(ordered) else 0
        cuts.append((2 * hit / (hit + wrong + positives), at - below, at))
    f1 = max(c[0] for c in cuts)
    _, gap, at = max(c for c in cuts if c[0] >= f1 - 1e-12)
    return min(max((at - gap / 2) / GRID, 1 / GRID), 1 - 1 / GRID)


def language_thresholds(
    scored: DataFrame, known: DataFrame, key: str = "doc_id", weights: tuple[float, float] = (1.0, 1.0)
) -> tuple[dict[str, float], float]:
    """A threshold for each language with labels of both kinds, and one over all, from all rows of `known`.

    `weights` are those of a row with label 0 and with label 1.
    """
    judged = scored.join(known, scored[key] == known["labelled"])
    counts = judged.groupBy("speech", F.round(F.col("raw") * GRID).cast("int").alias("bin")).agg(
        F.sum("toxic").alias("hit"), F.sum(1 - F.col("toxic")).alias("other")
    )
    by: dict[str, list] = {}
    whole: dict[int, list[float]] = {}
    for r in counts.collect():  # GRID + 1 rows for each language at most
        hit, other = r["hit"] * weights[1], r["other"] * weights[0]
        by.setdefault(r["speech"], []).append((r["bin"], hit, other))
        both = whole.setdefault(r["bin"], [0, 0])
        both[0], both[1] = both[0] + hit, both[1] + other
    cuts = {s: t for s, rows in by.items() if (t := best_threshold(rows)) is not None}
    return cuts, best_threshold([(b, *n) for b, n in whole.items()]) or 0.5


def stretched(raw: Column, cut: Column) -> Column:
    """The raw score with its language's threshold moved to CUT, rising all along."""
    low = raw * F.lit(CUT) / cut
    high = F.lit(CUT) + (raw - cut) * F.lit(1 - CUT) / (1 - cut)
    return F.round(F.when(raw < cut, F.least(low, F.lit(CUT - 1e-6))).otherwise(high), 6)


def _shares(known: DataFrame, unseen: DataFrame) -> tuple[float, float]:
    """What a row of each label in `unseen` stands for of all known rows."""
    every, left = [{r["toxic"]: r["count"] for r in df.groupBy("toxic").count().collect()} for df in (known, unseen)]
    zero, one = (every.get(y, 0) / max(left.get(y, 0), 1) for y in (0, 1))
    return zero, one


def score_toxicity(
    docs: DataFrame, labels: DataFrame, learn_from: Column | None = None, key: str = "doc_id", text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """Score and prediction of every row of `docs`; only labelled rows where `learn_from` holds teach."""
    kept = [key, *(keep or [])]
    known = cut_lineage(label_rows(labels, key=key).where(F.lit(True) if learn_from is None else learn_from))
    fifth = F.pmod(F.xxhash64(F.lit(10), F.col("labelled")), F.lit(5)) == 0
    taught = sampled_labels(known.where(~fifth))
    net = fit_classifier(docs, taught, key=key, text=text)
    if net is None:
        blank = {"score": F.lit(0.0), "predicted": F.lit(0), "raw": F.lit(0.0), "speech": F.lit(None).cast("string")}
        return docs.select(*kept, *[v.alias(n) for n, v in blank.items()])
    scored = cut_lineage(with_raw_scores(docs, net, kept, text))
    unseen = known.join(taught.select("labelled"), "labelled", "left_anti")
    cuts, other = language_thresholds(scored, unseen, key, _shares(known, unseen))
    cut = F.lit(other)
    for speech, value in cuts.items():
        cut = F.when(F.col("speech") == speech, F.lit(value)).otherwise(cut)
    out = scored.select(*kept, stretched(F.col("raw"), cut).alias("score"), "raw", "speech")
    return out.select(*kept, "score", (F.col("score") >= CUT).cast("int").alias("predicted"), "raw", "speech")


def toxicity_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; a third of the ids is held out of the labels learnt from."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = score_toxicity(docs, labels, fold(F.col("labelled"), 3) != 1)
    held = (fold(F.col("doc_id"), 3) == 1).alias("held_out")
    return out.select("doc_id", held, *[c for c in out.columns if c != "doc_id"])

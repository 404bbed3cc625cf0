"""Quality rules, and an isolation forest on the statistics that the rules count.

A text's statistics are computed once, in the task that reads it. A forest of random splits is grown
on bounded subsamples of them (that is the method: TREES trees over SUBSAMPLE rows each); rows that few
splits isolate have short paths and a high anomaly score. The score above which a row is rejected is
calibrated on all labelled rows, from counts of scores by label: the cut with the best balance of
rejected bad and kept good rows among those that keep LEAST_KEPT of the good ones.

Nulls: a null text has no words, so every count is 0 and the base rule fails. Labels that are null, or
of an id that no document has, do not count; an id labelled both ways counts as good. Without labels
of both kinds, or with none that any cut parts, only the base rule decides. A row without an id is
scored like any other. A very long text is counted whole; of cuts that tie the one that keeps most counts. Repeated rows give repeated results. An empty table gives no rows. Only the
named columns are read, so further columns cannot clash.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from typing import Any

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import bounded_sample, map_texts, table
from feedloom.session import cut_lineage

# Fixed: the characters that count as symbols.
SYMBOLS = frozenset("#*$%&|<>")
_SPACE = b" \t\n\v\f\r"

TREES = 100
SUBSAMPLE = 256
# Part of the good labelled rows that the calibrated cut must keep.
LEAST_KEPT = 0.995
# Scores are compared on this grid.
GRID = 1000
BASE_WINDOW = 5

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("f_word", "f_symbols", "f_dup_lines", "f_repeats", "f_marks")
# Words of usual text that each rate counts in addition, so that short texts are not odd by chance.
STEADY = 40


def repeated_words(words: list[bytes], window: int = BASE_WINDOW) -> int:
    """Words that lie in a run of `window` words found twice or more, the first one included."""
    if len(words) <= window:
        return 0
    runs = list(zip(*[words[i:] for i in range(window)], strict=False))
    seen = Counter(runs)
    if len(seen) == len(runs):
        return 0
    total, end = 0, 0
    for i, run in enumerate(runs):
        if seen[run] > 1:
            total += i + window - max(i, end)
            end = i + window
    return total


def text_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a whole text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()  # of bytes: ASCII white space
    chars = len(text or "") - (len(raw) - sum(map(len, words)))
    symbols = sum(raw.count(c.encode()) for c in SYMBOLS)
    lines = [line for line in raw.split(b"\n") if line.strip(_SPACE)]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words)


def text_features(text: str | None, counts: tuple[int, int, int, int, int]) -> list[float]:
    """The rules' statistics as rates, so that texts of different length compare."""
    n, chars, symbols, dups, repeats = counts
    raw = (text or "").encode("utf-8", "surrogatepass")
    marks = len(raw) - len(raw.translate(None, b"0123456789.,;:|/-_#*$%&<>()[]{}=+@!?"))
    words = n + STEADY
    return [
        (chars + 5.0 * STEADY) / words,
        symbols / words,
        dups / (raw.count(b"\n") + 4),
        repeats / words,
        (marks + 0.1 * STEADY) / words,
    ]


@dataclass
class Forest:
    """Trees in arrays (trees, nodes): a node's feature (-1: leaf), cut, left child and path length."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    length: np.ndarray
    depth: int
    typical: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Anomaly of each row, 0 to 1: two to the power of minus its mean path by the typical one."""
        total = np.zeros(len(rows))
        each = np.arange(len(rows))
        for t in range(len(self.feature)):
            node = np.zeros(len(rows), np.int64)
            for _ in range(self.depth):
                f = self.feature[t, node]
                right = rows[each, f] >= self.cut[t, node]
                node = np.where(f < 0, node, self.left[t, node] + right)
            total += self.length[t, node]
        return np.exp2(-total / (len(self.feature) * max(self.typical, 1e-9)))


def average_path(n: int) -> float:
    """Mean length of an unsuccessful search among n rows."""
    if n < 2:
        return 0.0
    return 2 * (float(np.log(n - 1)) + 0.5772156649015329) - 2 * (n - 1) / n


def grow_forest(rows: np.ndarray, trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = 7) -> Forest | None:
    """Random splits of random subsamples, to the depth at which a subsample is isolated on average."""
    if len(rows) < 2:
        return None
    rng = np.random.default_rng(seed)
    size = min(subsample, len(rows))
    depth = int(np.ceil(np.log2(size)))
    nodes = 2 ** (depth + 1)
    feature = np.full((trees, nodes), -1)
    cut, left, length = np.zeros((trees, nodes)), np.zeros((trees, nodes), np.int64), np.zeros((trees, nodes))
    for t in range(trees):
        stack = [(0, rows[rng.choice(len(rows), size, replace=False)], 0)]
        free = 1
        while stack:
            at, held, level = stack.pop()
            low, high = held.min(axis=0), held.max(axis=0)
            varied = np.flatnonzero(high > low)
            if level == depth or len(held) < 2 or not len(varied):
                length[t, at] = level + average_path(len(held))
                continue
            f = int(rng.choice(varied))
            c = rng.uniform(low[f], high[f])
            if c <= low[f]:
                c = high[f]
            feature[t, at], cut[t, at], left[t, at] = f, c, free
            up = held[:, f] >= c
            stack += [(free, held[~up], level + 1), (free + 1, held[up], level + 1)]
            free += 2
    return Forest(feature, cut, left, length, depth, average_path(size))


def with_statistics(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The counts and rates of each text, written out: the texts are read once."""

    def compute(texts: list[str | None]) -> dict[str, Any]:
        counts = [text_counts(t) for t in texts]
        rates = [text_features(t, c) for t, c in zip(texts, counts, strict=True)]
        return {n: [c[i] for c in counts] for i, n in enumerate(COUNTS)} | {
            n: [r[i] for r in rates] for i, n in enumerate(FEATURES)
        }

    fields = ", ".join([f"{c} bigint" for c in COUNTS] + [f"{f} double" for f in FEATURES])
    return cut_lineage(map_texts(docs, compute, fields, keep, text))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def fit_forest(stats: DataFrame, key: str = "doc_id", trees: int = TREES, subsample: int = SUBSAMPLE) -> Forest | None:
    """A forest over at most trees * subsample rows that pass the base rule, by the smallest hashes."""
    good = stats.where(~base_failed()).select(key, *FEATURES)
    rows = bounded_sample(good, [key, *FEATURES], trees * subsample, 7).collect()
    values = np.array([[r[f] for f in FEATURES] for r in rows], float).reshape(-1, len(FEATURES))
    return grow_forest(values, trees, subsample)


def with_anomaly(stats: DataFrame, forest: Forest | None) -> DataFrame:
    """`stats` with `anomaly`, on the grid; 0 without a forest."""
    if forest is None:
        return stats.withColumn("anomaly", F.lit(0.0))

    @F.pandas_udf("double")
    def score(*columns):  # type: ignore[no-untyped-def]
        import pandas as pd

        rows = np.column_stack([c.to_numpy(float) for c in columns])
        return pd.Series(np.round(forest.scores(rows) * GRID) / GRID)

    return stats.withColumn("anomaly", score(*[F.col(f) for f in FEATURES]))


def calibrated_cut(
    scored: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", least_kept: float = LEAST_KEPT
) -> float | None:
    """The anomaly from which rows are rejected, from counts over all labelled rows; None for no cut."""
    known = labels.where(F.col(label).isNotNull()).groupBy(F.col(key).alias("labelled")).agg(F.max(label).alias("good"))
    judged = scored.where(~base_failed()).join(known, scored[key] == known["labelled"])
    counts = judged.groupBy("anomaly").agg(
        F.sum((F.col("good") > 0).cast("long")).alias("good"), F.sum((F.col("good") <= 0).cast("long")).alias("bad")
    )
    rows = sorted(((r["anomaly"], r["good"], r["bad"]) for r in counts.collect()), reverse=True)
    good, bad = sum(r[1] for r in rows), sum(r[2] for r in rows)
    if not good or not bad:
        return None
    best, gain, lost, caught = None, 0.0, 0, 0
    for at, g, b in rows:
        lost, caught = lost + g, caught + b
        if lost > (1 - least_kept) * good:
            break
        if caught / bad - lost / good > gain:
            best, gain = at, caught / bad - lost / good
    return best


def judge_quality(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """The counts of every row of `docs`, base_failed, its anomaly, and whether it is kept."""
    stats = with_statistics(docs, [key, *(keep or [])], text)
    scored = cut_lineage(with_anomaly(stats, fit_forest(stats, key)))
    cut = calibrated_cut(scored, labels, key)
    passes = F.lit(True) if cut is None else F.col("anomaly") < cut
    return scored.select(
        key,
        *(keep or []),
        *COUNTS,
        base_failed().alias("base_failed"),
        (~base_failed() & passes).alias("kept"),
        "anomaly",
    )


def quality_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality counts and verdict of every document."""
    return judge_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))

"""Benchmark passages against a plain edit-distance search, on whole small tables and planted rows."""

import os
import random
import subprocess
import sys

import numpy as np
import pytest

from feedloom.llm import decontaminate as D

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"


def form(text):
    out = []
    for c in (text or ""):
        if c.isalnum():
            out.append(c.lower() if len(c.lower()) == 1 else c)
        elif out and out[-1] != " ":
            out.append(" ")
    return "".join(out)


def best_edits(window, text):
    """Fewest edits of `window` against any passage of `text`, by the full table, a row at a time."""
    codes = np.array([ord(c) for c in text])
    step = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, int)
    for c in window:
        new = np.append(row[0] + 1, np.minimum(row[:-1] + (codes != ord(c)), row[1:] + 1))
        row = np.minimum.accumulate(new - step) + step
    return row.min()


def leaks(item, text):
    item, text = form(item).rstrip(" "), form(text)
    size = min(len(item), D.WINDOW)
    most = size * D.EDITS // D.WINDOW
    return any(best_edits(item[s : s + size], text) <= most for s in range(0, len(item) - size + 1))


def test_planted_passages_against_the_full_table():
    """Copies with 0 to 12 edits spread over the item, and clean texts of the same syllables."""
    rng = random.Random(4)
    syllables = ["the", "on", "er", "in", "ti", "sh", "ble", "re", "an", "ou", "wh", "es"]
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(1, 3)))
    prose = lambda n: " ".join(word() for _ in range(n))
    items = [(i, prose(16).capitalize() + ".") for i in range(4)] + [(9, prose(8)[:45])]
    texts = [prose(30) for _ in range(4)]
    for n in (0, 2, 4, 5, 6, 7, 9, 12, 16):
        for _, t in items:
            chars = list(t)
            for at in sorted(rng.sample(range(len(chars)), n), reverse=True):
                kind = rng.random()
                if kind < 0.4:
                    chars[at] = rng.choice("xyz")
                elif kind < 0.7:
                    del chars[at]
                else:
                    chars.insert(at, "q")
            texts.append(prose(10) + ",  " + "".join(chars).upper() + " " + prose(10))
    block = D.make_block(items)
    got = {(h[0], h[1]) for h in D.scan(block, texts)}
    want = {(r, i) for r, t in enumerate(texts) for i, x in items if leaks(x, t)}
    assert got == want
    assert len(want) > 20


def test_documents_whole_tables(spark):
    """Every document that holds an item in normal form is found; all others are proven to be near."""
    got = {(r.doc_id, r.item_id): r for r in D.benchmark_in_documents(spark, SF).collect()}
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    plain = {d: form(t) for d, t in docs.items()}
    windows = {(i, form(x)[s : s + D.WINDOW]) for i, x in items.items() for s in range(len(form(x).rstrip()) - D.WINDOW + 1)}
    exact = {(d, i) for d, t in plain.items() for i, w in windows if w in t}
    assert exact <= set(got) and exact
    for (d, i), r in got.items():
        assert leaks(items[i], docs[d][max(0, r.doc_start - 20) : r.doc_end + 20])


def test_stretches_change_nothing(monkeypatch):
    rng = random.Random(12)
    item = "".join(rng.choices("abcde fgh", k=300))
    texts = ["".join(rng.choices("abcde fgh", k=500)) + item[40:200] + "x" * 90, item, "short"]
    block = D.make_block([(1, item)])
    whole = D.scan(block, texts)
    monkeypatch.setattr(D, "STRETCH", 37)
    assert D.scan(block, texts) == whole and {h[0] for h in whole} == {0, 1}


def test_places_are_those_of_the_text(spark):
    item = "The quick brown fox jumps over the lazy dog while 42 small cats are sleeping in the old barn"
    text = "Éé—ß: «" + item.upper().replace(" ", " -- ") + "» and more"
    hits = D.scan(D.make_block([(1, item)]), [None, "", "𝔘 x", text])
    (row, found, start, end, a, b, edits, _shared) = hits[0]
    assert len(hits) == 1 and (row, found, a, b, edits) == (3, 1, 0, len(item), 0)
    assert text[start:end] == item.upper().replace(" ", " -- ")


@pytest.mark.parametrize("most", [5000, 2_000_000])
def test_odd_rows(spark, most, monkeypatch):
    monkeypatch.setattr(D.benchmark_blocks, "__defaults__", ("item_id", "text", most))
    rng = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyz     "
    long_item = "".join(rng.choices(letters, k=9000))
    items = spark.createDataFrame(
        [(1, None), (2, ""), (3, "Xyzzy"), (None, long_item), (5, "…")], "item_id int, text string"
    )
    rows = [
        (1, None, "a"), (2, "", "b"), (None, "say xyzzy now", None), (4, "xyzzyx", "d"),
        (5, "".join(rng.choices(letters, k=50_000)) + long_item[7000:7100], "e"), (5, long_item, "e"), (6, "clean", "f"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, leaked string")
    kept = D.without_benchmark(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 4, 6]
    hits = {(r.doc_id, r.item_id) for r in D.benchmark_hits(docs, items).collect()}
    assert hits == {(None, 3), (5, None)}
    assert D.without_benchmark(docs, items.limit(0)).count() == 7
    assert D.benchmark_hits(docs.limit(0), items).count() == 0


def test_items_of_every_length_against_the_full_table():
    """Items of 1 to 73 characters, copied with 0 to one more than the permitted edits, spread or together."""
    rng = random.Random(3)
    letters = "etaoinshrdlu "
    prose = lambda n: form("".join(rng.choices(letters, k=4 * n))).strip()[:n]
    items, texts = [], []
    for size in range(1, D.WINDOW + 2):
        item = prose(size - 1).strip().ljust(size - 1, "z") + "e"
        items.append((size, item))
        for n in range(min(size, D.WINDOW) * D.EDITS // D.WINDOW + 2):
            for places in (sorted(rng.sample(range(size), min(n, size))), [(i * size) // n + size // (2 * n) for i in range(n)]):
                chars = list(item)
                for at in reversed(places):
                    chars[at : at + 1] = rng.choice((["x"], [], [chars[at], "q"]))
                texts.append(prose(20) + " " + "".join(chars) + " " + prose(20))
    texts.append("")
    got = {(h[0], h[1]) for h in D.scan(D.make_block(items), texts)}
    near = lambda i, x, t: leaks(x, t) if i >= D.GRAM else f" {x} " in f" {form(t)} "
    want = {(r, i) for r, t in enumerate(texts) for i, x in items if near(i, x, t)}
    assert got == want
    assert {i for _, i in want} == set(range(1, D.WINDOW + 2))


@pytest.mark.parametrize("item", ["What is the capital of France?", "Who wrote Hamlet?", "Solve for x: 2x+3=7"])
def test_short_questions_as_they_are(item):
    hits = D.scan(D.make_block([(1, item)]), ["Quiz: " + item.upper() + " Next.", "nothing of it"])
    assert [(h[0], h[1], h[6]) for h in hits] == [(0, 1, 0)]


def test_a_window_is_64_characters():
    """A passage of 64 characters of a longer item, as it is and with 5 edits spread over it."""
    rng = random.Random(6)
    item = "".join(rng.choices("abcdefgh", k=200))
    piece = item[70:134]
    near = "".join("z" if i in (5, 17, 29, 46, 58) else c for i, c in enumerate(piece))
    texts = [f"z {piece} z", f"z {near} z", f"z {piece[:50]} z"]
    assert {h[0] for h in D.scan(D.make_block([(1, item)]), texts)} == {0, 1}


def test_the_finer_count_loses_nothing(monkeypatch):
    """The windows that it drops before the alignment are those that the alignment would drop."""
    rng = random.Random(15)
    item = "".join(rng.choices("abcde fgh", k=400))
    texts = []
    for n in range(60):
        at = rng.randrange(0, 300)
        chars = list(item[at : at + rng.randint(20, 100)])
        for place in sorted(rng.sample(range(len(chars)), n % 9), reverse=True):
            chars[place : place + 1] = rng.choice((["x"], [], [chars[place], "q"]))
        texts.append("z" * rng.randint(0, 40) + "".join(chars) + "z" * rng.randint(0, 40))
    block, aligned, plain = D.make_block([(1, item), (2, item[:40])]), [], D.window_edits
    monkeypatch.setattr(D, "window_edits", lambda w, *rest: aligned.append(len(w)) or plain(w, *rest))
    fewer, few = D.scan(block, texts), sum(aligned)
    aligned.clear()
    monkeypatch.setattr(D, "_near", lambda item, text, rows, *rest: rows)
    assert D.scan(block, texts) == fewer and 0 < few < sum(aligned)


def test_whole_passages_and_all_places():
    """A letter changed in the middle, two far parts of an item, and a short item that stands twice."""
    rng = random.Random(21)
    item = "".join(rng.choices("abcdefgh", k=300))
    changed = item[:150] + "z" + item[151:]
    apart = item[:80] + "z" * 140 + item[220:]
    hits = D.scan(D.make_block([(1, item), (2, "Xyzzy")]), [changed, apart, "xyzzy, Xyzzy and xyzzy"])
    assert [h[2:6] for h in hits if h[0] == 0] == [(0, 300, 0, 300)]
    ends = [h[2:6] for h in hits if h[0] == 1]
    assert len(ends) == 2 and ends[0][0] == 0 and ends[0][3] >= 80 and ends[1][2] <= 220 and ends[1][3] == 300
    assert [h[2:4] for h in hits if h[0] == 2] == [(0, 5), (7, 12), (17, 22)]


def plain_hits(item, text):
    """(row starts of windows within the budget) by the full table."""
    size = min(len(item), D.WINDOW)
    return [s for s in range(len(item) - size + 1) if best_edits(item[s : s + size], text) <= size * D.EDITS // D.WINDOW]


@pytest.mark.parametrize("unit", ["0 ", "ha ho "])
def test_repetitive_texts_against_the_full_table(monkeypatch, unit):
    """The same passages whether pairs are made at once, by piece or along the diagonals."""
    item = (unit * 200)[:300].strip()
    mixed = "some words of another kind " + item[:90] + " and more that differs from it"
    texts = [(unit * 300)[:500], "clean " * 30, "x " + (unit * 30)[:63] + "y", "x" + (unit * 30)[:64], mixed]
    items = [(1, item), (2, mixed[:80] + item[:100])]
    found = []
    for pairs in (1 << 22, 3000, 1):
        monkeypatch.setattr(D, "PAIRS", pairs)
        found.append(sorted(h[:7] for h in D.scan(D.make_block(items), texts)))
    # where a word repeats, alignments of the same cost may end some characters apart
    for other in found[1:]:
        assert len(other) == len(found[0])
        assert all(a[:2] == b[:2] and np.abs(np.subtract(a[2:], b[2:])).max() <= D.EDITS for a, b in zip(found[0], other, strict=True))
    want = {(r, i) for r, t in enumerate(texts) for i, x in items if plain_hits(form(x), form(t))}
    assert {h[:2] for h in found[0]} == want and len(want) > 3
    # all of the item stands in the first text, and all of the text is one passage
    assert (0, 1, 0, len(form(texts[0]).rstrip()), 0, len(item), 0) in found[0] or found[0][0][4:6] == (0, len(item))


@pytest.mark.parametrize("words", ["ha", "ha ho"])
def test_long_texts_of_one_word_in_bounded_memory(words):
    """An item of 2,000 words in a document of 20,000 is one passage, found in some hundred megabytes."""
    code = f"""
import resource
from feedloom.llm import decontaminate as D
words = {words.split()!r}
item, text = " ".join((words * 2000)[:2000]), " ".join((words * 20_000)[:20_000])
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
hits = D.scan(D.make_block([(1, item)]), [text])
assert [h[:7] for h in hits] == [(0, 1, 0, len(text), 0, len(item), 0)], hits
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=ROOT, check=False)
    assert out.returncode == 0, out.stderr[-500:]
    assert int(out.stdout) < 500


def test_ends_are_those_of_the_alignment():
    rng = random.Random(33)
    item = "".join(rng.choices("abcdefgh", k=130))
    chars = list(item[20:100])
    chars[5], chars[40] = "z", "z"
    del chars[60]
    text = "y" * 50 + "".join(chars) + "y" * 50
    ((_, _, start, end, a, b, edits, _),) = D.scan(D.make_block([(1, item)]), [text])
    assert abs(start - 50) <= D.EDITS and abs(end - 129) <= D.EDITS and edits <= 3
    assert abs(a - 20) <= D.EDITS and abs(b - 100) <= D.EDITS
    # two places of the item, one after the other in the text: two rows
    swapped = D.scan(D.make_block([(1, item)]), [item[65:] + item[:65]])
    assert [h[4] < 20 for h in sorted(h[:7] for h in swapped)] == [False, True]
    again = D.scan(D.make_block([(1, item)]), [item[:70] + item[:70]])
    assert len(again) == 2 and all(h[4] == 0 and 70 <= h[5] <= 80 for h in again)


def test_the_sample_bound_keeps_few_distinct_keys(spark):
    from feedloom.llm.common import bounded_sample
    from pyspark.sql import functions as F

    for keys in (1, 2, 5):
        rows = spark.range(50_000).select((F.col("id") % keys).alias("k"))
        assert bounded_sample(rows, ["k"], 2000, 8).count() == 2000

"""Benchmark passages in documents, found by the q-gram lemma and verified by banded alignment.

Both sides are compared in a normal form: letters and digits in lower case, every run of other
characters one space. A document is contaminated by an item if some WINDOW characters of the item
stand in it with EDITS edits or fewer. Such a passage keeps WINDOW - GRAM + 1 - EDITS * GRAM of the
window's q-grams, all on diagonals (place in the document minus place in the item) at most EDITS
apart; so shared q-grams are counted in overlapping diagonal bands, regions that reach the bound are
retained, and each is verified by an alignment within its band, after the same count of FINE-grams there. An item shorter than WINDOW is one
window, with the budget in proportion; where that leaves no q-gram to count on, the item has shorter
grams with postings of their own. One shorter than GRAM has to stand there as it is.

The benchmark goes to the tasks in blocks of at most BLOCK_CHARS characters, one pass over the
documents for each block, long items in overlapping pieces. Nothing else is broadcast, and no text
is shuffled.

Repetitive texts are no exception: pairs of a gram's places in a document and in an item are made for so
many documents at once as have PAIRS of them; of a document that has more by itself and a piece of an item
that shares more with it, the grams are counted along the diagonals instead, a band at a time.

A passage's ends are those of its alignment. Passages of one item that overlap in the document and in the
item are one. Very long texts are searched whole, their grams hashed a stretch at a time.

Nulls: a null or empty text has no hits; a null or empty item gives none. Repeated documents and
items give repeated hits. Empty tables give no hits. Columns are carried by position, so an extra
column of a result's name does no harm.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from feedloom.llm.common import bounded_batches, map_texts, pieces, table

GRAM = 10
WINDOW = 64
EDITS = 5
# Length of the grams that windows over the bound are counted by once more before their alignment.
FINE = 4
# Bound of what a task gets of the benchmark at once, in characters of the normal form.
BLOCK_CHARS = 2_000_000
PIECE_CHARS = 4096
# Characters whose q-grams are hashed at once.
STRETCH = 1 << 20
# Pairs of places, in a document and in the items, that are looked at together.
PAIRS = 1 << 19
_BAND = EDITS + 1
_NOTHING = np.uint32(0x110000)
# An odd multiplier and its powers, modulo 2**64.
_POWER = {n: np.uint64(pow(0x9E3779B97F4A7C15, n, 1 << 64)) for n in (1, 2, 4, 8)}


def _tables() -> tuple[np.ndarray, np.ndarray]:
    low, good = np.arange(65536, dtype=np.uint32), np.zeros(65536, bool)
    for i in range(65536):
        c = chr(i)
        good[i] = c.isalnum()
        small = c.lower()
        if len(small) == 1:
            low[i] = ord(small)
    return low, good


_LOW, _GOOD = _tables()


def normal_form(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all texts in normal form, one after another; their places there; the code points' places."""
    sizes = np.array([len(t) for t in texts], np.int64)
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    low, good = _LOW.take(codes, mode="clip"), _GOOD.take(codes, mode="clip")
    if len(codes) and codes.max() > 0xFFFF:
        far = codes > 0xFFFF
        low[far], good[far] = codes[far], True
    after = np.zeros(len(codes), bool)
    after[1:] = good[:-1]
    starts = np.cumsum(sizes) - sizes
    after[starts[sizes > 0]] = False
    kept = np.flatnonzero(good | after)
    out = np.where(good[kept], low[kept], np.uint32(32))
    edges = np.searchsorted(kept, np.append(starts, len(codes)))
    return out, edges, kept


def gram_hashes(codes: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A 64-bit hash of the `gram` codes at each place, built by doubling (10 = 2 + 8)."""
    count = len(codes) - gram + 1
    if count < 1:
        return np.zeros(0, np.uint64)
    part, out, done = codes.astype(np.uint64), np.zeros(count, np.uint64), 0
    for n, power in _POWER.items():
        if gram & n:
            out = out * power + part[done : done + count]
            done += n
        if 2 * n <= gram:
            part = part[:-n] * power + part[n:]
    return out ^ (out >> np.uint64(29))


def gram_of(size: int) -> int:
    """The longest gram up to GRAM of which a window of `size` keeps one or more under its budget."""
    return min(GRAM, size // (size * EDITS // WINDOW + 1))


@dataclass
class Block:
    """Pieces of items, and the postings of their q-grams."""

    gram: int
    ids: list[Any]  # item of each piece
    codes: list[np.ndarray]
    offset: np.ndarray  # place of the piece in the item's normal form
    size: np.ndarray  # window of the piece
    edits: np.ndarray
    least: np.ndarray  # q-grams that a passage keeps
    grams: np.ndarray  # distinct hashes, sorted
    first: np.ndarray  # postings of each
    piece: np.ndarray
    place: np.ndarray
    seen: np.ndarray  # by the hash's top bits: whether any gram may have it
    shift: int
    short: list[tuple[Any, str]]
    rest: list[Block]  # the items that need shorter grams


def make_block(items: list[tuple[Any, str | None]]) -> Block:
    parts: dict[int, list[tuple[Any, np.ndarray, int]]] = {GRAM: []}
    short = []
    for item, text in items:
        own = normal_form([text or ""])[0]
        if len(own) and own[-1] == 32:
            own = own[:-1]
        if len(own) < GRAM:
            if len(own):
                short.append((item, own.astype("<u4").tobytes().decode("utf-32-le")))
            continue
        for at in range(0, max(len(own) - WINDOW + 1, 1), PIECE_CHARS - WINDOW + 1):
            parts.setdefault(gram_of(min(len(own), WINDOW)), []).append((item, own[at : at + PIECE_CHARS], at))
    block, *rest = [_postings(gram, found) for gram, found in parts.items()]
    return replace(block, short=short, rest=rest)


def _postings(gram: int, found: list[tuple[Any, np.ndarray, int]]) -> Block:
    ids, codes, offset = [f[0] for f in found], [f[1] for f in found], [f[2] for f in found]
    size = np.minimum([len(c) for c in codes], WINDOW).astype(np.int64)
    edits = size * EDITS // WINDOW
    hashes = [gram_hashes(c, gram) for c in codes]
    flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    piece = np.repeat(np.arange(len(codes)), [len(h) for h in hashes])
    place = np.concatenate([np.arange(len(h)) for h in hashes]) if hashes else np.zeros(0, np.int64)
    order = np.argsort(flat, kind="stable")
    grams, first = np.unique(flat[order], return_index=True)
    bits = max(12, int(len(grams) * 16).bit_length())
    seen = np.zeros(1 << bits, bool)
    seen[grams >> np.uint64(64 - bits)] = True
    return Block(
        gram, ids, codes, np.array(offset, np.int64), size, edits, size - gram + 1 - edits * gram,
        grams, np.append(first, len(flat)), piece[order], place[order], seen, 64 - bits, [], [],
    )


def window_edits(window: np.ndarray, text: np.ndarray, starts: np.ndarray, low: int, high: int) -> np.ndarray:
    """Fewest edits of each window (rows) in `text`, on diagonals low..high of its start in the item."""
    return _costs(window, text, starts, low, high).min(axis=1)


def _costs(window: np.ndarray, text: np.ndarray, starts: np.ndarray, low: int, high: int) -> np.ndarray:
    """Fewest edits of each window by the diagonal, low..high, on which the passage ends.

    After r steps, place d holds the cost of the window's first r characters against the text up to
    start + r + d. Any diagonal may begin and end the passage.
    """
    count, size = window.shape
    wide = high - low + 1
    step = np.arange(wide, dtype=np.int16)
    cost = np.zeros((count, wide), np.int16)
    # beyond the text's ends stand codes that no character has
    first = int(starts.min()) + low
    body = text[max(first, 0) : max(int(starts.max()) + high + size, 0)]
    ahead = np.full(max(-first, 0), _NOTHING, np.uint32)
    after = np.full(count + wide + size + int(np.ptp(starts)), _NOTHING, np.uint32)
    codes = np.concatenate([ahead, body, after])
    seen = np.lib.stride_tricks.sliding_window_view(codes, wide)
    for r in range(size):
        new = cost + (seen[starts - int(starts.min()) + r] != window[:, r : r + 1])
        np.minimum(new[:, :-1], cost[:, 1:] + 1, out=new[:, :-1])
        new -= step
        cost = np.minimum.accumulate(new, axis=1, out=new)
        cost += step
        if int(cost.min()) > EDITS:
            break
    return cost


def _first_place(item: np.ndarray, text: np.ndarray, row: int, size: int, low: int, high: int) -> int:
    """Where in `text` the best alignment of a window begins: the end of that of both read backwards."""
    back = np.array([len(text) - row - size])
    cost = _costs(item[row : row + size][::-1][None], text[::-1], back, -high, -low)[0]
    return row + high - int(cost.argmin())


def _last_place(item: np.ndarray, text: np.ndarray, row: int, size: int, low: int, high: int) -> int:
    """Where in `text` the best alignment of a window ends."""
    cost = _costs(item[row : row + size][None], text, np.array([row]), low, high)[0]
    return row + size + low + int(cost.argmin())


def _near(item: np.ndarray, text: np.ndarray, rows: np.ndarray, low: int, high: int, size: int, most: int) -> np.ndarray:
    """Windows that keep enough of their FINE-grams on diagonals low..high; an alignment with `most` edits there does."""
    if not len(rows):
        return rows
    first, end = int(rows[0]), int(rows[-1]) + size
    body = text[max(first + low, 0) : max(end + high, 0)]
    ahead = min(max(-first - low, 0), end - first + high - low)
    codes = np.full(end - first + high - low, _NOTHING, np.uint32)
    codes[ahead : ahead + len(body)] = body
    same = np.lib.stride_tricks.sliding_window_view(codes, end - first) == item[first:end]
    for n in range(1, FINE):
        same = same[:, :-1] & same[:, 1:]
    held = np.append(0, np.cumsum(same.any(axis=0)))
    at = rows - first
    return rows[held[at + size - FINE + 1] - held[at] >= size - FINE + 1 - most * FINE]


def _exact_runs(item: np.ndarray, text: np.ndarray, low: int, high: int, size: int) -> list[tuple[int, int, int]]:
    """All runs of `size` or more equal characters on diagonals low..high: (place in item, in text, length)."""
    found = []
    for d in range(low, high + 1):
        a, b = max(0, -d), min(len(item), len(text) - d)
        if b - a < size:
            continue
        edges = np.concatenate([[-1], np.flatnonzero(item[a:b] != text[a + d : b + d]), [b - a]])
        runs = np.diff(edges) - 1
        for k in np.flatnonzero(runs >= size).tolist():
            start = a + int(edges[k]) + 1
            found.append((start, start + d, int(runs[k])))
    return found


def shared_grams(block: Block, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of grams that the block has, and their numbers; hashes are made a stretch at a time."""
    places, grams = [], []
    for start in range(0, len(codes) - block.gram + 1, STRETCH):
        hashes = gram_hashes(codes[start : start + STRETCH + block.gram - 1], block.gram)
        at = np.flatnonzero(block.seen[hashes >> np.uint64(block.shift)])
        gram = np.searchsorted(block.grams, hashes[at])
        gram[gram == len(block.grams)] = 0
        real = block.grams[gram] == hashes[at]
        places.append(at[real] + start)
        grams.append(gram[real])
    return np.concatenate(places), np.concatenate(grams)


def scan(block: Block, texts: list[str | None]) -> list[tuple[int, Any, int, int, int, int, int, int]]:
    """Hits (row, item, doc_start, doc_end, item_start, item_end, edits, shared) of the texts.

    Places in the document are code points of the text; those in the item are of its normal form.
    """
    codes, edges, kept = normal_form([t or "" for t in texts])
    hits = _short_hits(block, codes, edges, kept) if block.short else []
    merged: dict[tuple[int, Any], list] = {}
    for part in (block, *block.rest):
        for row, own, (a, b, c, d, e, n) in _passages(part, codes, edges):
            shift = int(part.offset[own])
            merged.setdefault((row, part.ids[own]), []).append((a, b, c + shift, d + shift, e, n))
    for (row, item), regions in merged.items():
        base = edges[row]
        origin = sum(len(t or "") for t in texts[:row])
        for a, b, c, d, e, n in _merge(sorted(regions)):
            start, end = int(kept[base + a]) - origin, int(kept[base + b - 1]) + 1 - origin
            hits.append((row, item, start, end, c, d, e, n))
    return hits


def _passages(block: Block, codes: np.ndarray, edges: np.ndarray) -> Iterator[tuple[int, int, tuple]]:
    """Verified passages (row, piece, places in normal forms with edits and shared grams)."""
    if not len(block.grams) or len(codes) < block.gram:
        return
    at, gram = shared_grams(block, codes)
    doc = np.searchsorted(edges, at, side="right") - 1
    inside = at + block.gram <= edges[doc + 1]
    at, gram, doc = at[inside], gram[inside], doc[inside]
    if not len(at):
        return
    many = block.first[gram + 1] - block.first[gram]
    begins = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
    ends = np.append(begins[1:], len(doc))
    weight = np.add.reduceat(many, begins)
    lo = 0
    while lo < len(begins):
        hi = max(lo + 1, int(np.searchsorted(np.cumsum(weight[lo:]), PAIRS, side="right")) + lo)
        own = slice(int(begins[lo]), int(ends[hi - 1]))
        if weight[lo] > PAIRS:
            yield from _by_piece(block, codes, edges, at[own], gram[own], int(doc[own.start]))
        else:
            yield from _together(block, codes, edges, at[own], gram[own], doc[own])
        lo = hi


def _together(block: Block, codes: np.ndarray, edges: np.ndarray, at: np.ndarray, gram: np.ndarray, doc: np.ndarray):
    """Passages of some documents, with all their pairs at once."""
    many = block.first[gram + 1] - block.first[gram]
    each = np.repeat(np.arange(len(at)), many)
    posting = np.arange(len(each)) - np.repeat(np.cumsum(many) - many, many) + block.first[gram][each]
    piece, place = block.piece[posting], block.place[posting]
    pair, inverse, counts = np.unique(doc[each] * len(block.ids) + piece, return_inverse=True, return_counts=True)
    good = counts[inverse] >= block.least[piece]
    inverse, place, each = inverse[good], place[good], each[good]
    if len(each):
        yield from _regions(block, codes, edges, pair, inverse, place, at[each] - edges[doc[each]] - place)


def _by_piece(block: Block, codes: np.ndarray, edges: np.ndarray, at: np.ndarray, gram: np.ndarray, row: int):
    """Passages of one document, a piece of the items at a time."""
    grams, times = np.unique(gram, return_counts=True)
    many = block.first[grams + 1] - block.first[grams]
    each = np.repeat(np.arange(len(grams)), many)
    posting = np.arange(len(each)) - np.repeat(np.cumsum(many) - many, many) + block.first[grams][each]
    order = np.argsort(block.piece[posting], kind="stable")
    each, posting = each[order], posting[order]
    borders = np.searchsorted(block.piece[posting], np.arange(len(block.ids) + 1))
    shared = np.bincount(block.piece[posting], weights=times[each], minlength=len(block.ids))
    text = codes[edges[row] : edges[row + 1]]
    for own in np.flatnonzero(shared >= np.maximum(block.least, 1)).tolist():
        if shared[own] > PAIRS:
            for j, diag in _bands(block, own, text):
                for hit in _verify(block, own, text, j, diag, dense=True):
                    yield row, own, hit
            continue
        mine = slice(int(borders[own]), int(borders[own + 1]))
        held, first, count = np.unique(each[mine], return_index=True, return_counts=True)
        places = block.place[posting[mine]]
        found = np.searchsorted(grams[held], gram)
        found[found == len(held)] = 0
        real = grams[held][found] == gram
        found, start = found[real], at[real] - edges[row]
        n = count[found]
        pair = np.repeat(np.arange(len(found)), n)
        place = places[np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n) + first[found][pair]]
        only, zero = np.array([row * len(block.ids) + own]), np.zeros(len(pair), np.int64)
        yield from _regions(block, codes, edges, only, zero, place, start[pair] - place)


def _bands(block: Block, own: int, text: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, diagonals) that the q-grams shared by a piece and a text have, for each band that reaches the bound."""
    item, gram = block.codes[own], block.gram
    reach, least = int(block.size[own]) - gram, int(block.least[own])
    wide = 2 * _BAND
    margin = np.full(len(item) + wide, _NOTHING, np.uint32)
    seen = np.lib.stride_tricks.sliding_window_view(np.concatenate([margin, text, margin]), len(item))
    for low in range(-len(item), len(text), _BAND):
        same = seen[low + len(margin) : low + len(margin) + wide] == item
        held = 1
        while held < gram:
            step = min(held, gram - held)
            same = same[:, : same.shape[1] - step] & same[:, step:]
            held += step
        j = np.flatnonzero(same.any(axis=0))
        if len(j) >= least and (j[least - 1 :] - j[: len(j) - least + 1] <= reach).any():
            yield j, np.flatnonzero(same.any(axis=1)) + low


def _regions(
    block: Block, codes: np.ndarray, edges: np.ndarray, pair: np.ndarray, inverse: np.ndarray, place: np.ndarray, diagonal: np.ndarray
) -> Iterator[tuple[int, int, tuple]]:
    """Verified passages of pairs of a document and a piece, from the shared grams' places and diagonals."""
    piece = pair[inverse] % len(block.ids)
    band = (diagonal + PIECE_CHARS) // _BAND
    # each diagonal lies in two bands of twice the step, so some band has a passage's grams together
    key = (np.concatenate([inverse, inverse]) << 42) | (np.concatenate([band, band - 1]) + 1 << 13) | np.concatenate([place, place])
    order = np.argsort(key, kind="stable")
    key = key[order]
    group, j = key >> 13, key & 8191
    diag = np.concatenate([diagonal, diagonal])[order]
    least = block.least[np.concatenate([piece, piece])[order]]
    reach = block.size[np.concatenate([piece, piece])[order]] - block.gram
    last = np.arange(len(key)) + least - 1
    fits = last < len(key)
    last = np.where(fits, last, 0)
    fits &= (group[last] == group) & (j[last] - j <= reach)
    for lo, hi in _runs(group, np.flatnonzero(fits), last):
        pair_id = int(pair[group[lo] >> 29])
        row, own = pair_id // len(block.ids), pair_id % len(block.ids)
        for hit in _verify(block, own, codes[edges[row] : edges[row + 1]], j[lo : hi + 1], diag[lo : hi + 1]):
            yield row, own, hit


def _runs(group: np.ndarray, starts: np.ndarray, last: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of hits that overlapping windows over the bound cover."""
    lo = hi = -1
    for s in starts.tolist():
        e = int(last[s])
        if lo >= 0 and group[s] == group[lo] and s <= hi + 1:
            hi = max(hi, e)
        else:
            if lo >= 0:
                yield lo, hi
            lo, hi = s, e
    if lo >= 0:
        yield lo, hi


def _verify(
    block: Block, own: int, text: np.ndarray, j: np.ndarray, diag: np.ndarray, dense: bool = False
) -> list[tuple]:
    """The region's passages (doc start, end, item start, end, edits, shared): exact runs and aligned windows.

    Of a dense region most windows lie in exact runs, so that those left are few before they are counted again.
    """
    item, size, most = block.codes[own], int(block.size[own]), int(block.edits[own])
    low, high = int(diag.min()), int(diag.max())
    rows = np.arange(max(0, int(j.min()) + block.gram - size), min(len(item) - size, int(j.max())) + 1)
    grams = np.unique(j)
    shared = len(grams)
    shares = np.searchsorted(grams, rows + size - block.gram, side="right") - np.searchsorted(grams, rows)
    rows = rows[shares >= block.least[own]]
    if not dense:
        rows = _near(item, text, rows, low - most, high + most, size, most)
    if not len(rows):
        return []
    out = []
    for start, place, length in _exact_runs(item, text, low, high, size):
        out.append((place, place + length, start, start + length, 0, shared))
        rows = rows[(rows < start) | (rows + size > start + length)]
    if dense:
        rows = _near(item, text, rows, low - most, high + most, size, most)
    if not len(rows):
        return out
    windows = item[rows[:, None] + np.arange(size)]
    edits = window_edits(windows, text, rows, low - most, high + most)
    fine, edits = rows[edits <= most], edits[edits <= most]
    # windows that overlap or touch are one passage
    cuts = np.flatnonzero(np.diff(fine) > size) + 1
    for part, cost in zip(np.split(fine, cuts), np.split(edits, cuts), strict=True):
        if len(part):
            begin, last = int(part[0]), int(part[-1])
            start = _first_place(item, text, begin, size, low - most, high + most)
            end = _last_place(item, text, last, size, low - most, high + most)
            out.append((max(0, start), min(len(text), end), begin, last + size, int(cost.min()), shared))
    return out


def _merge(regions: list) -> Iterator[tuple]:
    """Regions of one document and item, sorted; those that overlap in both are one, with the fewest edits of them.

    Ends overlap by the edits that windows may have, so an overlap is at least half a window or half of a region.
    """
    held: list[tuple] = []
    for r in regions:
        yield from (h for h in held if h[1] < r[0])
        held, rest = [], [h for h in held if h[1] >= r[0]]
        while rest:
            h = rest.pop()
            least = min(WINDOW, h[1] - h[0], r[1] - r[0], h[3] - h[2], r[3] - r[2]) // 2
            if min(min(h[1], r[1]) - max(h[0], r[0]), min(h[3], r[3]) - max(h[2], r[2])) >= least:
                r = (min(h[0], r[0]), max(h[1], r[1]), min(h[2], r[2]), max(h[3], r[3]), min(h[4], r[4]), max(h[5], r[5]))
                rest, held = rest + held, []
            else:
                held.append(h)
        held.append(r)
    yield from held


def _short_hits(block: Block, codes: np.ndarray, edges: np.ndarray, kept: np.ndarray) -> list:
    """All whole-word places of items too short for a q-gram."""
    hits = []
    for row in range(len(edges) - 1):
        text = " " + codes[edges[row] : edges[row + 1]].astype("<u4").tobytes().decode("utf-32-le") + " "
        for item, form in block.short:
            place = text.find(f" {form} ")
            while place >= 0:
                first = int(kept[edges[row]])
                start = int(kept[edges[row] + place])
                end = int(kept[edges[row] + place + len(form) - 1]) + 1
                hits.append((row, item, start - first, end - first, 0, len(form), 0, 0))
                place = text.find(f" {form} ", place + 1)
    return hits


def benchmark_blocks(items: DataFrame, key: str = "item_id", text: str = "text", most: int = BLOCK_CHARS) -> Iterator[list]:
    """Items in lists of about `most` characters; an item longer than that is cut in overlapping parts."""
    overlap = 4 * WINDOW  # of the text as it is, whose normal form is not longer
    cut = items.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).select(
        "key",
        "text",
        F.explode(F.sequence(F.lit(0), F.greatest((F.length("text") - 1) / (most - overlap), F.lit(0)).cast("int"))).alias("n"),
    )
    parts = cut.select("key", F.expr(f"substring(text, n * {most - overlap} + 1, {most})").alias("text"), "n")
    total = parts.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-total * 2 // most) if total > most else 1
    dealt = parts.withColumn("block", F.pmod(F.xxhash64("key", "n"), F.lit(blocks)))
    for b in range(blocks):
        rows = dealt.where(F.col("block") == b).select("key", "text").collect()
        yield sorted(((r["key"], r["text"]) for r in rows), key=lambda r: (str(r[0]), r[1]))


def benchmark_hits(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """A row for each passage of an item in a document; documents without one give no row."""
    schema = T.StructType(
        [T.StructField(key, docs.schema[key].dataType), T.StructField(item_key, items.schema[item_key].dataType)]
        + [T.StructField(n, T.LongType()) for n in ("doc_start", "doc_end", "item_start", "item_end", "edits", "shared_grams")]
    )
    bounded_batches(docs.sparkSession)
    out = None
    for rows in benchmark_blocks(items, item_key, item_text):
        found = docs.select(key, text).mapInArrow(_hit_rows(make_block(rows), schema, text), schema)
        out = found if out is None else out.union(found)
    return out


def _hit_rows(block: Block, schema: T.StructType, text: str):
    kinds = [to_arrow_type(f.dataType) for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, text):
                hits = scan(block, part.column(text).to_pylist())
                ids = part.column(0).take(pa.array([h[0] for h in hits], pa.int64()))
                rest = [pa.array([h[i] for h in hits], kinds[i]) for i in range(1, 8)]
                yield pa.RecordBatch.from_arrays([ids, *rest], names=schema.names)

    return run


def without_benchmark(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """Rows of `docs`, with their own columns, that hold no passage of an item."""
    inner = [f"c{i}" for i in range(len(docs.columns))]
    own = inner[docs.columns.index(text)]
    out = docs.toDF(*inner)
    for rows in benchmark_blocks(items, item_key, item_text):
        block = make_block(rows)

        def mark(texts: list[str | None], block: Block = block) -> dict[str, Any]:
            leaked = {h[0] for h in scan(block, texts)}
            return {"leaked": [i in leaked for i in range(len(texts))]}

        out = map_texts(out, mark, "leaked boolean", inner, own).where("NOT leaked").select(*inner)
    return out.toDF(*docs.columns)


def benchmark_in_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages of every document."""
    return benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

"""SimHash fingerprints, their links within a Hamming distance, and the groups the links make.

Fingerprints are compared by BK-trees. A tree's children are keyed by their integer Hamming distance
to the parent, so a search follows only the edges within the radius of the distance found. Trees of
all fingerprints would grow with the corpus and may not be broadcast; instead the 64 bits are cut in
blocks such that two fingerprints within the radius agree in some blocks, and each choice of those
blocks deals the distinct fingerprints to shards: one small tree for each shard, in the task that the
shuffle gives the shard to. A shard over SHARD_ROWS is cut in chunks, and each pair of chunks (one
tree, one set of searches) is a unit of its own. A unit gives a spanning forest of its links, never
all pairs.

Nulls: a null or blank text has the fingerprint zero, linked like any other. A row without an id has
its fingerprint; its group's id is the smallest id present, null if there is none. A bit that half of the
hashes have is not set. Very long texts are hashed whole, batch by batch. Repeated rows
give repeated results. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from typing import Any

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.llm.common import map_texts, table
from feedloom.llm.components import components
from feedloom.session import cut_lineage

SHINGLE = 4
RADIUS = 4
SEED = 42
# Distinct fingerprints of one tree at most.
SHARD_ROWS = 2048
# Expected chance rows of a shard at most; more blocks agree the more fingerprints there are.
SHARD_MEAN = 8
_ALL = (1 << 64) - 1


def shingle_hashes(text: str | None, words: int = SHINGLE) -> np.ndarray:
    """XXH64 of each run of `words` words of the text in lower case (A-Z only), repeats included."""
    parts = (text or "").encode().lower().split()  # of bytes: ASCII letters and ASCII white space
    if not parts:
        return np.zeros(0, np.uint64)
    if len(parts) <= words:
        return np.array([xxhash.xxh64_intdigest(b" ".join(parts), SEED)], np.uint64)
    runs = map(b" ".join, zip(*[parts[i:] for i in range(words)], strict=False))
    made = (xxhash.xxh64_intdigest(r, SEED) for r in runs)
    return np.fromiter(made, np.uint64, len(parts) - words + 1)


def fingerprint(hashes: np.ndarray) -> int:
    """The 64 bits that are set in over half the hashes; zero for none."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def with_fingerprints(
    docs: DataFrame, words: int = SHINGLE, keep: list[str] | None = None, text: str = "text"
) -> DataFrame:
    """`docs` with `bits`, the fingerprint as a long of the same 64 bits."""

    def compute(texts: list[str | None]) -> dict[str, Any]:
        return {"bits": [signed(fingerprint(shingle_hashes(t, words))) for t in texts]}

    return map_texts(docs, compute, "bits bigint", keep, text)


def as_hex(bits: Column) -> Column:
    return F.lpad(F.lower(F.hex(bits)), 16, "0")


class BKTree:
    """Integers under the Hamming distance; children are keyed by their distance to the parent."""

    def __init__(self) -> None:
        self.root: tuple[int, dict[int, Any]] | None = None

    def add(self, value: int) -> None:
        if self.root is None:
            self.root = (value, {})
            return
        node = self.root
        while True:
            apart = (node[0] ^ value).bit_count()
            if apart == 0:
                return
            child = node[1].get(apart)
            if child is None:
                node[1][apart] = (value, {})
                return
            node = child

    def within(self, value: int, radius: int) -> Iterator[int]:
        """Stored values at `radius` or less; |d(parent) - edge| bounds what a subtree may hold."""
        stack = [self.root] if self.root else []
        while stack:
            held, children = stack.pop()
            apart = (held ^ value).bit_count()
            if apart <= radius:
                yield held
            if children:
                for edge in range(max(apart - radius, 1), apart + radius + 1):
                    child = children.get(edge)
                    if child is not None:
                        stack.append(child)


class _Forest:
    """Which values are joined already, so that only joining links are told."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        parent = self.parent
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, x: int, y: int) -> bool:
        a, b = self.find(x), self.find(y)
        if a == b:
            return False
        self.parent[b] = a
        return True


def spanning_links(stored: list[int], asked: list[int] | None, radius: int) -> list[tuple[int, int]]:
    """Links that join what all links within the radius join: among `stored`, or from `asked` to it."""
    if asked is None and len(stored) == 2:
        x, y = stored
        return [(x, y)] if (x ^ y).bit_count() <= radius else []
    tree, forest, found = BKTree(), _Forest(), []
    if asked is not None:
        for x in stored:
            tree.add(x)
    for x in stored if asked is None else asked:
        found += [(x, y) for y in tree.within(x, radius) if forest.join(x, y)]
        if asked is None:
            tree.add(x)
    return found


def agreeing_masks(radius: int, blocks: int) -> list[int]:
    """Bit masks such that two values within the radius agree under one of them at least."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    block = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:], strict=False)]
    return [sum(c) for c in combinations(block, blocks - radius)]


def block_count(values: int, radius: int, mean: int = SHARD_MEAN) -> int:
    """Fewest blocks, two over the radius at least, whose shards hold `mean` chance rows at most."""
    blocks = radius + 2
    while blocks < 16 and values > mean * 2.0 ** (64 * (blocks - radius) // blocks):
        blocks += 1
    return blocks


_OUT = pa.schema([("mask", pa.int32()), ("part", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])


def _unit_links(radius: int, most: int):
    """Links of each shard, from rows sorted by (mask, part); a shard over `most` is passed on (b null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key: tuple[int, int] | None = None
        held: list[int] = []
        passing = False

        def close(out: list[tuple]) -> None:
            if key is not None and not passing and len(held) > 1:
                for x, y in spanning_links([v & _ALL for v in held], None, radius):
                    out.append((key[0], key[1], signed(x), signed(y)))

        for batch in batches:
            out: list[tuple] = []
            mask, part, bits = (batch.column(i).to_numpy() for i in range(3))
            new = np.flatnonzero((mask[1:] != mask[:-1]) | (part[1:] != part[:-1])) + 1
            edges = [0, *new.tolist(), len(mask)] if len(mask) else []
            for lo, hi in zip(edges, edges[1:], strict=False):
                here = (int(mask[lo]), int(part[lo]))
                if here != key:
                    close(out)
                    key, held, passing = here, [], False
                rows = bits[lo:hi].tolist()
                if not passing and len(held) + len(rows) > most:
                    rows, held, passing = held + rows, [], True
                if passing:
                    out += [(*here, r, None) for r in rows]
                else:
                    held += rows
            yield _rows(out)
        last: list[tuple] = []
        close(last)
        yield _rows(last)

    return run


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(_OUT)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, _OUT, strict=True)], schema=_OUT
    )


def _chunk_links(radius: int):
    """Links of one pair of chunks: the tree of the lower chunk, searched by the upper one's values."""

    def run(key: tuple, part: pa.Table) -> pa.Table:
        low, high = key[2].as_py(), key[3].as_py()
        own = part.column("own").to_numpy()
        values = part.column("bits").to_numpy()
        stored = [int(v) & _ALL for v in values[own == low]]
        asked = None if low == high else [int(v) & _ALL for v in values[own == high]]
        found = spanning_links(stored, asked, radius)
        return pa.table(
            {"a": pa.array([signed(x) for x, _ in found], pa.int64()), "b": pa.array([signed(y) for _, y in found], pa.int64())}
        )

    return run


def hamming_links(
    values: DataFrame, radius: int = RADIUS, shard_rows: int = SHARD_ROWS, blocks: int | None = None
) -> DataFrame:
    """Links (a, b) between distinct `bits` of `values` that join what all links within `radius` join."""
    blocks = blocks or block_count(values.count(), radius)
    masks = agreeing_masks(radius, blocks)
    shards = values.select(
        "bits",
        F.explode(
            F.array(*[F.struct(F.lit(i).alias("mask"), F.col("bits").bitwiseAND(signed(m)).alias("part")) for i, m in enumerate(masks)])
        ).alias("s"),
    ).select("s.mask", "s.part", "bits")
    dealt = shards.repartition("mask", "part").sortWithinPartitions("mask", "part", "bits")
    first = cut_lineage(
        dealt.mapInArrow(_unit_links(radius, shard_rows), "mask int, part bigint, a bigint, b bigint")
    )
    links = first.where("b IS NOT NULL").select("a", "b")
    large = first.where("b IS NULL").select("mask", "part", F.col("a").alias("bits"))
    if large.isEmpty():
        return links.distinct()
    counts = large.groupBy("mask", "part").agg(F.ceil(F.count("*") / shard_rows).cast("int").alias("chunks"))
    cut = large.join(counts, ["mask", "part"]).withColumn("own", F.expr("int(pmod(xxhash64(bits), chunks))"))
    units = cut.select(
        "mask", "part", "bits", "own", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    ).select(
        "mask", "part", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "bits"
    )
    more = units.groupBy("mask", "part", "low", "high").applyInArrow(_chunk_links(radius), "a bigint, b bigint")
    return links.union(more).distinct()


def simhash_groups(
    docs: DataFrame,
    words: int = SHINGLE,
    radius: int = RADIUS,
    key: str = "doc_id",
    text: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """Rows of `docs` with `bits`, `component_bits` and `component_id`, the smallest id its links reach.

    `keep` are further columns to carry; texts are better left out and joined later.
    """
    marked = cut_lineage(with_fingerprints(docs, words, [key, *(keep or [])], text))
    values = marked.groupBy("bits").agg(F.min(key).alias("smallest"))
    groups = components(hamming_links(values.select("bits"), radius))
    linked = groups.join(values, groups["node"] == values["bits"]).select("node", "root", "smallest")
    least = linked.groupBy("root").agg(F.min("smallest").alias("reached"))
    reached = linked.join(least, "root").select(F.col("node").alias("bits"), "root", "reached")
    # written out, so that the join below has a plain shuffle on both sides and splits hot fingerprints
    ids = cut_lineage(
        values.join(reached, "bits", "left").select(
            "bits",
            F.coalesce("root", "bits").alias("component_bits"),
            F.coalesce("reached", "smallest").alias("component_id"),
        )
    )
    return marked.join(ids, "bits")


def simhash_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of every document."""
    out = simhash_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", as_hex(F.col("bits")).alias("fingerprint"), "component_id")


def keep_one_of_each_group(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of `docs` for each SimHash group: that with the smallest id, its own columns unchanged.

    Rows with the same id are told apart by a hash of all columns; of rows alike in all one stays.
    """
    hashed = [f.name for f in docs.schema.fields if not _has_map(f.dataType)]
    inner = docs.withColumn("row_alike", F.xxhash64(*[F.col(c) for c in hashed]))
    groups = simhash_groups(inner, key=key, text=text, keep=["row_alike"])
    order = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("id"), F.col("row_alike").alias("hash"))
    best = groups.groupBy("component_bits").agg(F.min(order).alias("w"))
    winners = best.select(F.col("w.id").alias("won_id"), F.col("w.hash").alias("won_hash")).distinct()
    kept = inner.join(
        winners, inner[key].eqNullSafe(winners["won_id"]) & (inner["row_alike"] == winners["won_hash"]), "left_semi"
    )
    return kept.dropDuplicates([key, "row_alike"]).select(*docs.columns)


def _has_map(kind: T.DataType) -> bool:
    return "map<" in kind.simpleString() or "variant" in kind.simpleString()

"""Exact top-k by inner product, with bounds from segment means and deviations, coarse to fine.

Vectors become whole numbers, floor(64 * x). The inner product of two segments of m components is
at most m (mean mean' + deviation deviation'), by the inequality of Cauchy and Schwarz about the
means; the sum over the segments bounds the score from above, which for given lengths of the vectors
bounds their distance from below. A level of short segments is tighter and dearer than one of long
segments. A query and a candidate whose bound at some level is under the query's k-th best score so far
part there; the exact scores of the survivors decide. Nothing is sampled: the result is exact.

Candidates are packed in chunks of rows and queries in blocks, and the two meet in the cells of a
grid: a group of query blocks goes to each group of chunks and the reverse, so that a task holds a
few blocks and chunks whatever the size of the table, and each pair meets once. A task tells the best
of its cells for each query; a window picks the best of all.

Nulls: vectors that are null or hold a null or non-finite component take no part; a null id is never a
query's, and as a candidate it comes after its ties. Ties go to the smaller id. A query is left out of its own
candidates once, so a repeated row is a candidate of its twin, and each of repeated queries has its
rows. Of vectors of different lengths the shorter counts as ended by zeros; an empty vector scores
0. Whole numbers and scores beyond the range of a long are held at its ends. Fewer candidates than k
give all; an empty table gives no rows. A column of the input that has the name of another does no
harm, as only the id and the vector are read. There are no texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.numbering import shuffle_partitions
from feedloom.llm.common import bounded_batches, table
from feedloom.session import cut_lineage

K = 20
EVERY = 20
SCALE = 64
# Components of a segment, by level.
LEVELS = (64, 16, 4, 2)
# Rows of a chunk of candidates and of a block of queries, and numbers in either at most.
CHUNK = 2048
BLOCK = 1024
NUMBERS = 1 << 20
# Blocks and chunks that meet in a cell of the grid: 64 blocks of the best so far are some 20 MB.
BLOCKS_A_CELL = 64
CHUNKS_A_CELL = 2048
# Survivors under this share are scored one by one, others as a matrix.
SPARSE = 1 / 16
# Float arithmetic of whole numbers is exact up to here.
EXACT = float(1 << 53)
_LOW, _HIGH = -(1 << 63), (1 << 63) - 1

_PACKED = "part long, width int, ids array<long>, numbers binary"


def whole_numbers(vectors: DataFrame, key: str, vector: str, scale: float = SCALE) -> DataFrame:
    """(id, numbers) of the vectors that take part."""
    finite = lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf")))
    held = F.lit(float(1 << 63))

    def whole(x: Column) -> Column:
        made = F.lit(float(scale)) * x.cast("double")
        return F.when(made >= held, F.lit(_HIGH)).when(made < -held, F.lit(_LOW)).otherwise(F.floor(made))

    return vectors.where(F.col(vector).isNotNull() & F.forall(vector, finite)).select(
        F.col(key).cast("long").alias("id"), F.transform(vector, whole).alias("numbers")
    )


def _width(size: int) -> int:
    return 1 << max(size - 1, 1).bit_length()


def pack(rows: DataFrame, most: int) -> DataFrame:
    """(id, numbers) rows as matrices of up to `most` rows, ordered by id; `part` names a matrix.

    Rows of like length share a matrix, ended by zeros up to a power of two.
    """
    schema = T.StructType.fromDDL(_PACKED)

    def matrix(width: int, held: list[tuple]) -> tuple:
        held.sort(key=lambda r: (r[0] is None, r[0] or 0))
        numbers = np.zeros((len(held), width), np.int64)
        for row, (_, n) in zip(numbers, held, strict=True):
            row[: len(n)] = n
        return 0, width, [r[0] for r in held], numbers.astype("<i8").tobytes()

    def rows_of(batch: pa.RecordBatch) -> Iterator[tuple]:
        numbers = batch.column("numbers")
        flat, edges = numbers.values.to_numpy(zero_copy_only=False), numbers.offsets.to_numpy()
        for i, key in enumerate(batch.column("id").to_pylist()):
            yield key, flat[edges[i] : edges[i + 1]].copy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        give = lambda made: pa.RecordBatch.from_pylist(
            [dict(zip(schema.names, made, strict=True))],
            pa.schema([("part", pa.int64()), ("width", pa.int32()), ("ids", pa.list_(pa.int64())), ("numbers", pa.binary())]),
        )
        for batch in batches:
            for row in rows_of(batch):
                width = _width(len(row[1]))
                own = held.setdefault(width, [])
                own.append(row)
                if len(own) == most or len(own) * width >= NUMBERS:
                    yield give(matrix(width, held.pop(width)))
        for width, own in held.items():
            yield give(matrix(width, own))

    packed = rows.mapInArrow(run, schema)
    # Numbers of matrices and their order inside a cell do not change the result, but a retry must see the same.
    return cut_lineage(packed.withColumn("part", F.monotonically_increasing_id()))


def unpack(numbers: bytes, width: int) -> np.ndarray:
    return np.frombuffer(numbers, "<i8").reshape(-1, width)


def segments(matrix: np.ndarray, size: int) -> np.ndarray:
    """Means and deviations of each row's segments, each times the root of the segment's size."""
    parts = matrix.reshape(len(matrix), -1, size)
    mean = parts.mean(axis=2)
    deviation = parts.std(axis=2)
    return np.concatenate([mean, deviation], axis=1) * np.sqrt(size)


@dataclass
class Side:
    """A matrix and its segment statistics by level, made when first needed."""

    whole: np.ndarray

    def __post_init__(self) -> None:
        self.real = self.whole.astype(np.float64)
        self.top = float(np.abs(self.real).max(initial=0.0))
        self._levels: dict[int, np.ndarray] = {}

    def level(self, size: int) -> np.ndarray:
        if size not in self._levels:
            self._levels[size] = segments(self.real, size)
        return self._levels[size]

    def cut(self, width: int) -> Side:
        return self if self.whole.shape[1] == width else Side(np.ascontiguousarray(self.whole[:, :width]))


def exact_scores(q: Side, c: Side, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Inner products of all `rows` of q with all `cols` of c as whole numbers."""
    width = q.whole.shape[1]
    if q.top * c.top * width < EXACT:
        return (q.real[rows] @ c.real[cols].T).astype(np.int64)
    wide = q.whole[rows].astype(object) @ c.whole[cols].astype(object).T
    return np.clip(wide, _LOW, _HIGH).astype(np.int64)


def paired_scores(q: Side, c: Side, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Inner products of the pairs (rows[i], cols[i])."""
    out = [np.zeros(0, np.int64)]
    step = max(1, NUMBERS // q.whole.shape[1])
    for at in range(0, len(rows), step):
        r, k = rows[at : at + step], cols[at : at + step]
        if q.top * c.top * q.whole.shape[1] < EXACT:
            out.append(np.einsum("ij,ij->i", q.real[r], c.real[k]).astype(np.int64))
        else:
            out.append(np.clip((q.whole[r].astype(object) * c.whole[k]).sum(axis=1), _LOW, _HIGH).astype(np.int64))
    return np.concatenate(out)


def survivors(q: Side, c: Side, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, cols, mask): pairs whose bound reaches the query's `least` at every level."""
    width = q.whole.shape[1]
    rows, cols = np.arange(len(q.whole)), np.arange(len(c.whole))
    mask = np.ones((len(rows), len(cols)), bool)
    # rounding of sums of this size
    slack = 1e-9 * (1 + q.top * c.top * width)
    for size in LEVELS:
        if size > width or not len(rows) or not len(cols) or np.isneginf(least[rows]).all():
            continue
        bound = q.level(size)[rows] @ c.level(size)[cols].T
        mask &= bound >= (least[rows] - slack)[:, None]
        live_rows, live_cols = mask.any(axis=1), mask.any(axis=0)
        if not (live_rows.all() and live_cols.all()):
            rows, cols, mask = rows[live_rows], cols[live_cols], mask[np.ix_(live_rows, live_cols)]
    return rows, cols, mask


@dataclass
class Best:
    """The best candidates so far of each query of a block: flat, by query and then best first."""

    k: int
    count: int
    row: np.ndarray
    score: np.ndarray
    id: np.ndarray
    bare: np.ndarray  # the id is null

    @staticmethod
    def none(k: int, count: int) -> Best:
        return Best(k, count, *[np.zeros(0, np.int64) for _ in range(3)], np.zeros(0, bool))

    def least(self) -> np.ndarray:
        """The k-th best score of each query; minus infinity while it has fewer."""
        out = np.full(self.count, -np.inf)
        full = np.bincount(self.row, minlength=self.count) == self.k
        last = np.flatnonzero(np.append(self.row[1:] != self.row[:-1], True))[: len(self.row)]
        at = last[full[self.row[last]]]
        out[self.row[at]] = self.score[at]
        return out

    def add(self, row: np.ndarray, score: np.ndarray, key: np.ndarray, bare: np.ndarray) -> None:
        row, score = np.append(self.row, row), np.append(self.score, score)
        key, bare = np.append(self.id, key), np.append(self.bare, bare)
        # ~score grows as the score falls, for every long
        order = np.lexsort((key, bare, ~score, row))
        row = row[order]
        first = np.searchsorted(row, np.arange(self.count))
        order = order[np.arange(len(row)) - first[row] < self.k]
        self.row, self.score = np.sort(row)[np.arange(len(row)) - first[row] < self.k], score[order]
        self.id, self.bare = key[order], bare[order]


def _first(scores: np.ndarray, mask: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k highest scores of each row, ties to the smaller column; pairs off the mask come last."""
    wide = scores.shape[1]
    if wide <= k:
        return np.broadcast_to(np.arange(wide), scores.shape)
    if int(scores.max()) < (1 << 62) // wide and int(scores.min()) > -(1 << 62) // wide:
        alone = scores * wide + np.arange(wide - 1, -1, -1)
        return np.argpartition(np.where(mask, -alone, _HIGH), k - 1, axis=1)[:, :k]
    return np.argsort(np.where(mask, ~scores, _HIGH), axis=1, kind="stable")[:, :k]


def meet(best: Best, q: Side, c: Side, ids: np.ndarray, bare: np.ndarray) -> None:
    """Add to `best` what the candidates c, ordered by id, have for the queries q."""
    width = min(q.whole.shape[1], c.whole.shape[1])
    q, c = q.cut(width), c.cut(width)
    rows, cols, mask = survivors(q, c, best.least())
    if not mask.any():
        return
    if mask.mean() < SPARSE:
        i, j = np.nonzero(mask)
        best.add(rows[i], paired_scores(q, c, rows[i], cols[j]), ids[cols[j]], bare[cols[j]])
        return
    scores = exact_scores(q, c, rows, cols)
    order = _first(scores, mask, best.k)
    good = np.take_along_axis(mask, order, axis=1)
    i = np.broadcast_to(np.arange(len(rows))[:, None], order.shape)[good]
    j = order[good]
    best.add(rows[i], scores[i, j], ids[cols[j]], bare[cols[j]])


def _cells(blocks: DataFrame, chunks: DataFrame) -> DataFrame:
    """Each block beside each chunk, by way of a grid of cells."""
    spark = blocks.sparkSession
    tall = max(1, -(-blocks.count() // BLOCKS_A_CELL))
    found = chunks.count()
    wide = max(-(-found // CHUNKS_A_CELL), min(found, -(-shuffle_partitions(blocks) // tall)), 1)
    cell = lambda own, other: F.explode(F.sequence(F.lit(0), F.lit(other - 1))).alias(own)
    left = blocks.select(
        F.col("part").alias("block"), F.col("width").alias("q_width"), F.col("ids").alias("q_ids"),
        F.col("numbers").alias("q_numbers"), F.pmod(F.xxhash64("part"), F.lit(tall)).cast("int").alias("r"), cell("c", wide),
    )
    right = chunks.select("width", "ids", "numbers", F.pmod(F.xxhash64("part"), F.lit(wide)).cast("int").alias("c"), cell("r", tall))
    bounded_batches(spark)
    return left.join(right, ["r", "c"]).drop("r", "c")


def best_of_cells(cells: DataFrame, k: int) -> DataFrame:
    """(block, place, query_id, own, score, id): a query's best in a task's cells; `own` is its score with itself."""
    schema = T.StructType.fromDDL("block long, place long, query_id long, own long, score long, id long")

    def told(block: int, side: Side, ids: np.ndarray, best: Best) -> pa.RecordBatch:
        every = np.arange(len(ids))
        own = paired_scores(side, side, every, every)
        made = [np.full(len(best.row), block), best.row, ids[best.row], own[best.row], best.score]
        return pa.RecordBatch.from_arrays(
            [*map(pa.array, made), pa.array(best.id, mask=best.bare)], names=schema.names
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[Side, np.ndarray, Best]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                if row["block"] not in held:
                    if len(held) == BLOCKS_A_CELL:
                        yield from (told(block, *kept) for block, kept in held.items())
                        held.clear()
                    side = Side(unpack(row["q_numbers"], row["q_width"]))
                    held[row["block"]] = side, np.array(row["q_ids"], np.int64), Best.none(k, len(side.whole))
                side, _, best = held[row["block"]]
                bare = np.array([x is None for x in row["ids"]], bool)
                ids = np.array([0 if x is None else x for x in row["ids"]], np.int64)
                meet(best, side, Side(unpack(row["numbers"], row["width"])), ids, bare)
        yield from (told(block, *kept) for block, kept in held.items())

    return cells.mapInArrow(run, schema)


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = K,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: float = SCALE,
) -> DataFrame:
    """query_id, rank, vec_id, score: the `k` best other rows of each row for which `is_query` holds."""
    asked = vectors.where(is_query & F.col(key).isNotNull())
    blocks = pack(whole_numbers(asked, key, vector, scale), BLOCK)
    chunks = pack(whole_numbers(vectors, key, vector, scale), CHUNK)
    # one more than k, as a query finds itself
    told = best_of_cells(_cells(blocks, chunks), k + 1)
    query = Window.partitionBy("block", "place")
    order = query.orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    found = told.withColumn("at", F.row_number().over(order)).where(F.col("at") <= k + 1)
    itself = (F.col("id") == F.col("query_id")) & (F.col("score") == F.col("own"))
    found = found.withColumn("gone", F.coalesce(F.min(F.when(itself, F.col("at"))).over(query), F.lit(k + 1)))
    others = found.where(F.col("at") != F.col("gone"))
    rank = F.col("at") - F.when(F.col("at") > F.col("gone"), 1).otherwise(0)
    return others.select("query_id", rank.cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")


def top_k_of_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best of all embeddings for each whose id is divisible by 20."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0)


ORACLE = f"""
WITH whole AS (
  SELECT vec_id, row_number() OVER () AS n,
         list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.n, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.n <> c.n WHERE q.vec_id % {EVERY} = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM scored)
WHERE rank <= {K}"""

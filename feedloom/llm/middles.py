"""Fill-in-middle transformation: texts cut at two line ranks, found in an indexable skip list.

The units of a text are its lines (`[^\\n]*\\n|[^\\n]+`). Over them stands a skip list: the lowest lane
links each unit to the next, a higher lane links the units that a hash of their rank lifts there, and
every link carries how many units and how many code points it passes. Descending from the top lane,
a cut rank is reached by adding up unit widths, and the code points passed on the way are the place
of the cut, exactly. A text becomes `<P>`prefix`<S>`suffix`<M>`middle (psm) or
`<S>`suffix`<P>`prefix`<M>`middle (spm); `restored` gives the text back.

The ranks and the form follow from a hash of the seed and the id, so that reruns agree. Texts go to
numpy in pieces of some megabytes; lanes are built for all texts of a piece at once.

Nulls: a null text is the empty text; a null id counts as the empty id. An empty text has no units
and stays plain, as does one that holds a marker. Repeated rows give repeated results; rows alike in
id and text are cut alike. A very long text is a piece of its own, read in stretches; it is cut whole.
An empty table gives no rows. A column of the input that has the name of a result column is replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.llm.common import bounded_batches, pieces, table, without

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKERS = (PREFIX, SUFFIX, MIDDLE)
SEED = 7
# Of 100: how many texts are transformed, and how many of those have the suffix first.
RATE = 100
SPM = 50
# One in 2**LIFT units of a lane stands in the lane above it.
LIFT = 2
# Code points that are looked through for line ends at once.
STRETCH = 1 << 20

RESULT = "n long, form string, prefix_chars long, middle_chars long, output string"


@dataclass
class Lane:
    """Links of one lane, all texts of a piece after one another."""

    units: np.ndarray  # units that a link passes
    chars: np.ndarray  # code points that it passes
    below: np.ndarray  # link of the lane below that begins at the same unit
    first: np.ndarray  # first link of each text


def line_widths(text: str) -> np.ndarray:
    """Code points of each line, its end included."""
    ends = [np.zeros(1, np.int64)]
    for at in range(0, len(text), STRETCH):
        codes = np.frombuffer(text[at : at + STRETCH].encode("utf-32-le", "surrogatepass"), "<u4")
        ends.append(np.flatnonzero(codes == 10) + (at + 1))
    if text and not text.endswith("\n"):
        ends.append(np.array([len(text)]))
    return np.diff(np.concatenate(ends))


def _lifted(rank: np.ndarray, lane: int) -> np.ndarray:
    """Whether the hash of a rank lifts its unit above `lane`, given that it stands there."""
    mixed = rank.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    mixed ^= mixed >> np.uint64(31)
    return (mixed >> np.uint64(LIFT * lane % 64)) & np.uint64((1 << LIFT) - 1) == 0


def build_lanes(widths: list[np.ndarray]) -> list[Lane]:
    """Lanes over the units of texts that have some; the first unit of a text stands in every lane."""
    count = np.array([len(w) for w in widths])
    first = np.cumsum(count) - count
    rank = np.arange(int(count.sum())) - np.repeat(first, count)
    lanes = [Lane(np.ones(len(rank), np.int64), np.concatenate(widths), np.arange(len(rank)), first)]
    while len(rank) > len(widths):
        up = np.flatnonzero((rank == 0) | _lifted(rank, len(lanes) - 1))
        low, rank = lanes[-1], rank[up]
        lanes.append(
            Lane(
                np.add.reduceat(low.units, up),
                np.add.reduceat(low.chars, up),
                up,
                np.flatnonzero(rank == 0),
            )
        )
    return lanes


def descend(lanes: list[Lane], text: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Code points before the unit of each `rank` in each `text`, by the widths passed on the way down."""
    units, chars = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
    link = lanes[-1].first[text]
    for lane in reversed(lanes):
        going = np.flatnonzero(units < rank)
        while len(going):
            at = link[going]
            going = going[units[going] + lane.units[at] <= rank[going]]
            at = link[going]
            units[going] += lane.units[at]
            chars[going] += lane.chars[at]
            link[going] += 1
            going = going[units[going] < rank[going]]
        left = units < rank
        link[left] = lane.below[link[left]]
    return chars


def _draws(seed: int, key: str | None) -> tuple[int, ...]:
    text = hashlib.sha256(f"{seed}:{key or ''}".encode()).hexdigest()
    return tuple(int(text[i : i + 8], 16) for i in (0, 8, 16, 24))


def transform(
    keys: list[str | None], texts: list[str], seed: int = SEED, rate: int = RATE, spm: int = SPM
) -> dict[str, list]:
    """Units, form, lengths and output of each text."""
    widths = [line_widths(t) for t in texts]
    count = np.array([len(w) for w in widths], np.int64)
    draws = [_draws(seed, k) for k in keys]
    some = np.flatnonzero(count)
    cuts = np.zeros((2, len(texts)), np.int64)
    if len(some):
        drawn = np.array([draws[i][:2] for i in some], np.int64).T % (count[some] + 1)
        lanes = build_lanes([widths[i] for i in some])
        at = np.arange(len(some))
        for row, rank in enumerate((drawn.min(axis=0), drawn.max(axis=0))):
            cuts[row, some] = descend(lanes, at, rank)
    out: dict[str, list] = {k: [] for k in ("n", "form", "prefix_chars", "middle_chars", "output")}
    for i, text in enumerate(texts):
        a, b = int(cuts[0, i]), int(cuts[1, i])
        _, _, third, fourth = draws[i]
        plain = not text or third % 100 >= rate or any(m in text for m in MARKERS)
        form = "plain" if plain else "spm" if fourth % 100 < spm else "psm"
        prefix, middle, suffix = text[:a], text[a:b], text[b:]
        if form == "psm":
            made = f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
        elif form == "spm":
            made = f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
        else:
            made = text
        out["n"].append(int(count[i]))
        out["form"].append(form)
        out["prefix_chars"].append(None if plain else a)
        out["middle_chars"].append(None if plain else b - a)
        out["output"].append(made)
    return out


def fill_in_middle(
    docs: DataFrame,
    seed: int = SEED,
    rate: int = RATE,
    spm: int = SPM,
    key: str = "doc_id",
    text: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """The kept columns of `docs` with n, form, prefix_chars, middle_chars and output."""
    added = T.StructType.fromDDL(RESULT)
    kept = [c for c in (docs.columns if keep is None else keep) if c in without(docs, added.names)]
    inner = [f"c{i}" for i in range(len(kept))]
    schema = T.StructType(
        [T.StructField(n, docs.schema[c].dataType) for n, c in zip(inner, kept, strict=True)] + added.fields
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "_text"):
                made = transform(
                    part.column("_key").to_pylist(), part.column("_text").to_pylist(), seed, rate, spm
                )
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in inner]
                    + [pa.array(v, pa.string() if k in ("form", "output") else pa.int64()) for k, v in made.items()],
                    names=schema.names,
                )

    bounded_batches(docs.sparkSession)
    read = docs.select(
        *[F.col(f"`{c}`").alias(n) for n, c in zip(inner, kept, strict=True)],
        F.col(key).cast("string").alias("_key"),
        F.coalesce(F.col(text), F.lit("")).alias("_text"),
    )
    return read.mapInArrow(run, schema).toDF(*kept, *added.names)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of; it holds no marker unless it is plain."""
    parts = F.split(output, "<[PSM]>", -1)
    return (
        F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
        .when(form == "spm", F.concat(parts[2], parts[3], parts[1]))
        .otherwise(output)
    )


def middles_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms, lengths and digests of all documents' outputs, and of the texts rebuilt from them."""
    made = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


ORACLE = f"""
WITH whole AS (
  SELECT doc_id, coalesce(text, '') AS text,
         sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
lined AS (
  SELECT *, length(text) - length(replace(text, chr(10), ''))
            + CASE WHEN text = '' OR right(text, 1) = chr(10) THEN 0 ELSE 1 END AS n,
         list_transform(string_split(text, chr(10)), lambda x: length(x) + 1) AS widths
  FROM whole),
drawn AS (
  SELECT *, CAST('0x' || h[1:8] AS BIGINT) % (n + 1) AS a, CAST('0x' || h[9:16] AS BIGINT) % (n + 1) AS b,
         CASE WHEN text = '' OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}')
                   OR contains(text, '{MIDDLE}') OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= {RATE} THEN 'plain'
              WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < {SPM} THEN 'spm' ELSE 'psm' END AS form
  FROM lined),
cut AS (
  SELECT *, least(coalesce(CAST(list_sum(widths[:least(a, b)]) AS BIGINT), 0), length(text)) AS first,
         least(coalesce(CAST(list_sum(widths[:greatest(a, b)]) AS BIGINT), 0), length(text)) AS second
  FROM drawn),
parts AS (
  SELECT *, substring(text, 1, first) AS prefix, substring(text, first + 1, second - first) AS middle,
         substring(text, second + 1) AS suffix
  FROM cut)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN first END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN second - first END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '{PREFIX}' || prefix || '{SUFFIX}' || suffix || '{MIDDLE}' || middle
                        ELSE '{SUFFIX}' || suffix || '{PREFIX}' || prefix || '{MIDDLE}' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts"""

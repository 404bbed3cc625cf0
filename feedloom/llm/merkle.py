"""Merkle manifest of a dataset: leaves by group, subroots, a root, and a proof for every row.

A row's leaf is the hash of its fields. In each group the leaves ascend by key and every FANOUT
consecutive nodes become their hash, level by level, until the group's subroot is left; the subroots
make the root in the same way. A proof holds what stands left and right of a row's node at each level.

The levels above BLOCK leaves are made by a butterfly exchange. Aligned blocks of a group's leaves climb
their own levels; then, round by round, each block swaps its subtree's root with blocks of the FANOUT - 1
sibling subtrees and hashes the ancestor itself, as all blocks below that ancestor do. After the last
round every block holds the subroot and its own upper proof, and nothing has to come down. Where the last
subtree is smaller than its siblings, their blocks are dealt over the blocks that it has. The subroots are
swapped in the same way.

Leaves are numbered by one range sort that splits hot groups, a block is FANOUT**DEPTH leaves at most, and
the exchange moves one short row a block. Rows of a block meet once, when they are packed.

Nulls: a null field counts as null in the leaf; null groups are one group, the first; null keys come first
in theirs, and a null key counts as the empty text where a key is hashed by itself. Keys that tie go by
leaf; repeated rows have the same leaf at places next to each other. Very long texts are hashed whole, and
only their hash goes on. An empty table gives no rows. Extra columns are not read, so their names may
clash with the result's.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import reduce
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from feedloom.functions.numbering import number_rows, shuffle_partitions
from feedloom.llm.common import bounded_batches, fold, table
from feedloom.session import cut_lineage

FANOUT = 3
# Levels inside a block: 3**6 leaves are some 100 KB.
DEPTH = 6
# Blocks of a group that share one row of its size or its subroot's proof.
SHARED = 4096
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field_text(field: Column) -> Column:
    """`-` for null, else the UTF-8 byte count, a colon and the value."""
    text = field.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field_text(f) for f in fields]), 256)


def climb(nodes: list[str], depth: int | None) -> list[list[str]]:
    """Levels of nodes above `nodes`, themselves first: `depth` of them, or until one node is left."""
    levels = [nodes]
    while len(levels) <= depth if depth is not None else len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([sha("".join(low[i : i + FANOUT])) for i in range(0, len(low), FANOUT)])
    return levels


def own_levels(leaves: list[str], block: int, depth: int) -> list[list[str]]:
    """Levels inside a block. A first block that is not full is all of its group and ends at the subroot."""
    alone = block == 0 and len(leaves) < FANOUT**depth
    return climb(leaves, None if alone else depth)


def beside(levels: list[list[str]], at: int) -> list[dict[str, str]]:
    """What stands left and right of node `at` and its ancestors, below the top level."""
    out = []
    for level in levels[:-1]:
        run = at - at % FANOUT
        out.append({"left": "".join(level[run:at]), "right": "".join(level[at + 1 : run + FANOUT])})
        at //= FANOUT
    return out


def positions(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add `_at` = 0..n-1 within `_group` in `order`; rows are range-sorted, so a hot group is split.

    The sorted rows are written once: borders of the ranges come from a sample, and a retry must see the same.
    Rows that tie in all of `order` are spread by their number in the input, else one range would hold them all.
    """
    salted = rows.withColumn("_salt", F.monotonically_increasing_id())
    ranged = salted.repartitionByRange(shuffle_partitions(rows), "_group", *order, "_salt")
    placed = ranged.sortWithinPartitions("_group", *order, "_salt").drop("_salt")
    fixed = cut_lineage(placed.withColumn("_id", F.monotonically_increasing_id()))
    numbered = number_rows(
        fixed, ["_id"], ["_group"], F.shiftright("_id", 33), out="_at"
    )
    return numbered.drop("_id")


def _tops(packed: DataFrame, hashes: str, depth: int) -> DataFrame:
    """Add `_top`, the block's subtree root."""
    schema = T.StructType([*packed.schema.fields, T.StructField("_top", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(hashes).to_pylist(), batch.column("_block").to_pylist(), strict=True)
            tops = [own_levels(leaves, block, depth)[-1][0] for leaves, block in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tops, pa.string())], names=schema.names)

    return packed.mapInArrow(run, schema)


def pack_blocks(numbered: DataFrame, hashes: str, carried: Sequence[str], depth: int) -> DataFrame:
    """A row for each block: _group, _block, its leaves and carried columns as lists, and its _top."""
    size = FANOUT**depth
    members = F.sort_array(F.collect_list(F.struct("_at", hashes, *carried)))
    blocks = numbered.groupBy("_group", F.floor(F.col("_at") / size).cast("long").alias("_block")).agg(
        members.alias("_members")
    )
    return _tops(blocks.select("_group", "_block", *[F.col("_members")[c].alias(c) for c in (hashes, *carried)]), hashes, depth)


def _for_blocks(groups: DataFrame) -> DataFrame:
    """A row of a group once for each SHARED of its blocks, so that no join meets a whole group on one key."""
    last = F.floor((F.col("_blocks") - 1) / SHARED).cast("long")
    return groups.withColumn("_share", F.explode(F.sequence(F.lit(0).cast("long"), last)))


def _share() -> Column:
    return F.floor(F.col("_block") / SHARED).cast("long")


def exchange(blocks: DataFrame) -> DataFrame:
    """Butterfly rounds over (_group, _block, _top): adds _blocks, _left and _right; _top becomes the subroot.

    In round r a block asks one block of each sibling subtree of FANOUT**r blocks for its root. A row goes through as
    many rounds as its own group needs, and each round is written, as the next one reads it FANOUT times.
    """
    sizes = blocks.groupBy("_group").agg((F.max("_block") + 1).alias("_blocks"))
    empty = F.array().cast("array<string>")
    state = cut_lineage(
        blocks.withColumn("_share", _share())
        .join(_for_blocks(sizes), ["_group", "_share"])
        .select("_group", "_block", "_blocks", "_top", empty.alias("_left"), empty.alias("_right"))
    )
    most = state.agg(F.max("_blocks")).first()[0] or 0
    done, reach = [state.where("_blocks = 1")], 1
    active = state.where("_blocks > 1")
    while reach < most:
        active = cut_lineage(_round(active, reach))
        reach *= FANOUT
        done.append(active.where(F.col("_blocks") <= reach))
        active = active.where(F.col("_blocks") > reach)
    return reduce(DataFrame.unionByName, done)


def _round(state: DataFrame, reach: int) -> DataFrame:
    node = F.floor(F.col("_block") / reach).cast("long")
    digit = node % FANOUT
    out = state
    found = state.select("_group", F.col("_block").alias("_partner"), F.col("_top").alias("_told"))
    for step in range(1, FANOUT):
        sibling = node - digit + (digit + step) % FANOUT
        first = sibling * reach
        size = F.least(F.lit(reach).cast("long"), F.col("_blocks") - first)
        partner = F.when(first < F.col("_blocks"), first + F.col("_block") % reach % size)
        other = found.withColumnRenamed("_told", f"_told{step}")
        out = out.withColumn("_partner", partner).join(other, ["_group", "_partner"], "left").drop("_partner")
    nodes = [(F.lit(0), F.col("_top"))] + [
        ((digit + s) % FANOUT - digit, F.col(f"_told{s}")) for s in range(1, FANOUT)
    ]
    told = F.array_sort(F.filter(F.array(*[F.struct(o.cast("int").alias("o"), t.alias("t")) for o, t in nodes]), lambda x: x["t"].isNotNull()))
    out = out.withColumn("_told", told)
    text = lambda keep: F.array_join(F.transform(F.filter("_told", keep), lambda x: x["t"]), "")
    return out.select(
        "_group",
        "_block",
        "_blocks",
        F.sha2(text(lambda x: F.lit(True)), 256).alias("_top"),
        F.concat("_left", F.array(text(lambda x: x["o"] < 0))).alias("_left"),
        F.concat("_right", F.array(text(lambda x: x["o"] > 0))).alias("_right"),
    )


_PROOF = T.ArrayType(T.StructType([T.StructField("left", T.StringType()), T.StructField("right", T.StringType())]))


def unpack_proofs(
    blocks: DataFrame, hashes: str, carried: Sequence[str], kept: Sequence[str], depth: int
) -> DataFrame:
    """A row for each leaf of the packed blocks, with `proof`: levels inside the block, then _left and _right."""
    fields = [blocks.schema[c] for c in kept]
    lists = [T.StructField(c, blocks.schema[c].dataType.elementType) for c in (hashes, *carried)]
    schema = T.StructType([*fields, *lists, T.StructField("proof", _PROOF)])
    kinds = [to_arrow_type(f.dataType) for f in schema.fields]

    def rows(row: dict[str, Any]) -> Iterator[list]:
        levels = own_levels(row[hashes], row["_block"], depth)
        upper = [{"left": a, "right": b} for a, b in zip(row["_left"], row["_right"], strict=True)]
        for at in range(len(row[hashes])):
            yield [*[row[c] for c in kept], *[row[f.name][at] for f in lists], beside(levels, at) + upper]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                made = list(zip(*rows(batch.slice(i, 1).to_pylist()[0]), strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, t) for v, t in zip(made, kinds, strict=True)], names=schema.names
                )

    return blocks.mapInArrow(run, schema)


def manifest(
    leaves: DataFrame, group: str, key: str, leaf: str, carried: Sequence[str] = (), depth: int = DEPTH
) -> DataFrame:
    """Columns `key`, `leaf`, the carried ones, subroot, root and proof of each row of `leaves`.

    `depth` levels are climbed inside a block; the result is the same whatever it is.
    """
    bounded_batches(leaves.sparkSession)
    rows = leaves.select(
        F.struct(F.col(group).alias("group")).alias("_group"),
        F.col(key).alias("_key"),
        F.col(leaf).alias("_leaf"),
        *carried,
    )
    numbered = positions(cut_lineage(rows), ["_key", "_leaf"])
    packed = cut_lineage(pack_blocks(numbered, "_leaf", ["_key", *carried], depth))
    own = exchange(packed.select("_group", "_block", "_top"))

    # the subroots are the leaves of one more tree
    subroots = own.where("_block = 0").select(
        F.struct(F.lit(0).alias("group")).alias("_group"),
        F.col("_group").alias("_of"),
        F.col("_blocks").alias("_own"),
        F.col("_top").alias("_subroot"),
    )
    over = cut_lineage(pack_blocks(positions(subroots, ["_of"]), "_subroot", ["_of", "_own"], depth))
    upper = exchange(over.select("_group", "_block", "_top"))
    proofs = unpack_proofs(
        over.drop("_top").join(upper.drop("_blocks"), ["_group", "_block"]),
        "_subroot", ["_of", "_own"], ["_block", "_top"], depth,
    ).select(
        F.col("_of").alias("_group"),
        F.col("_own").alias("_blocks"),
        F.col("_top").alias("root"),
        F.col("proof").alias("_above"),
    )
    shared = _for_blocks(proofs).drop("_blocks")
    held = own.withColumn("_share", _share()).join(shared, ["_group", "_share"]).select(
        "_group",
        "_block",
        F.col("_top").alias("subroot"),
        "root",
        F.concat("_left", F.col("_above.left")).alias("_left"),
        F.concat("_right", F.col("_above.right")).alias("_right"),
    )
    out = unpack_proofs(
        packed.drop("_top").join(held, ["_group", "_block"]),
        "_leaf", ["_key", *carried], ["subroot", "root"], depth,
    )
    return out.select(F.col("_key").alias(key), F.col("_leaf").alias(leaf), *carried, "subroot", "root", "proof")


def proof_hash(proof: Column) -> Column:
    """Hash of all siblings, level by level and left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda p: F.concat(p["left"], p["right"])), ""), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof give."""
    return F.aggregate(proof, leaf, lambda h, p: F.sha2(F.concat(p["left"], h, p["right"]), 256))


def manifest_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of `documents`, and what a text that lost its line ends does to the proofs of every second id."""
    docs = table(spark, sf_dir, "documents").select(*FIELDS)
    bare = [F.replace("text", F.lit("\n"), F.lit("")) if f == "text" else F.col(f) for f in FIELDS]
    touched = (fold(F.col("doc_id"), 2) == 0) & F.col("text").contains("\n")
    leaves = docs.select(
        "source", "doc_id", leaf_hash([F.col(f) for f in FIELDS]).alias("leaf"), F.when(touched, leaf_hash(bare)).alias("other")
    )
    made = manifest(leaves, "source", "doc_id", "leaf", ["other"])
    made = made.withColumn("folded_root", folded(F.coalesce("other", "leaf"), F.col("proof")))
    return made.select(
        "doc_id", "leaf", "subroot", "root", proof_hash(F.col("proof")).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def _oracle_field(field: str) -> str:
    text = f"CAST({field} AS VARCHAR)"
    return f"coalesce(CAST(strlen({text}) AS VARCHAR) || ':' || {text}, '-')"


_FIELDS_SQL = " || ".join(map(_oracle_field, FIELDS))
_PATH_SQL = """array_to_string(nodes[pos // pow3 - pos // pow3 % 3 + 1 : pos // pow3], '') || '|' ||
         array_to_string(nodes[pos // pow3 + 2 : pos // pow3 - pos // pow3 % 3 + 3], '')"""
ORACLE = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, source, sha256({_FIELDS_SQL}) AS leaf,
         sha256({_FIELDS_SQL.replace("CAST(text AS VARCHAR)", "replace(text, chr(10), '')")}) AS other,
         list_transform(range(1, length(coalesce(CAST(doc_id AS VARCHAR), '')) + 1),
                        lambda i: ord(substr(CAST(doc_id AS VARCHAR), CAST(i AS INTEGER), 1))) AS bytes
  FROM documents),
placed AS (
  SELECT doc_id, source, leaf, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         CASE WHEN xor(list_reduce(
           list_concat([CAST(4294967295 AS BIGINT)],
                       flatten(list_transform(bytes, lambda b: [CAST(b AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
           lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) ELSE xor(c >> 1, (c & 1) * 3988292384) END), 4294967295) % 2 = 0
         THEN other ELSE leaf END AS shown
  FROM leaves),
tree AS (
  SELECT source, 1 AS pow3, list(leaf ORDER BY pos) AS nodes FROM placed GROUP BY source
  UNION ALL
  SELECT source, pow3 * 3, list_transform(range(0, len(nodes), 3), lambda i: sha256(array_to_string(nodes[i + 1 : i + 3], '')))
  FROM tree WHERE len(nodes) > 1),
subroots AS (
  SELECT source, nodes[1] AS subroot, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS pos
  FROM tree WHERE len(nodes) = 1),
over_all AS (
  SELECT 1 AS pow3, list(subroot ORDER BY pos) AS nodes FROM subroots
  UNION ALL
  SELECT pow3 * 3, list_transform(range(0, len(nodes), 3), lambda i: sha256(array_to_string(nodes[i + 1 : i + 3], '')))
  FROM over_all WHERE len(nodes) > 1),
steps AS (
  SELECT p.source, p.pos, 0 AS part, pow3, {_PATH_SQL} AS step
  FROM placed p JOIN tree t ON p.source IS NOT DISTINCT FROM t.source WHERE len(nodes) > 1),
upper_steps AS (
  SELECT source, pow3, {_PATH_SQL} AS step FROM subroots, over_all WHERE len(nodes) > 1),
own AS (SELECT source, pos, list(step ORDER BY pow3) AS steps FROM steps GROUP BY source, pos),
above AS (SELECT source, list(step ORDER BY pow3) AS steps FROM upper_steps GROUP BY source),
proofs AS (
  SELECT p.*, s.subroot, list_concat(coalesce(o.steps, []), coalesce(a.steps, [])) AS steps
  FROM placed p JOIN subroots s ON p.source IS NOT DISTINCT FROM s.source
  LEFT JOIN own o ON p.source IS NOT DISTINCT FROM o.source AND p.pos = o.pos
  LEFT JOIN above a ON p.source IS NOT DISTINCT FROM a.source),
folded AS (
  SELECT *, list_reduce(list_concat([shown], steps),
                        lambda h, s: sha256(split_part(s, '|', 1) || h || split_part(s, '|', 2))) AS folded_root
  FROM proofs)
SELECT doc_id, leaf, subroot, (SELECT nodes[1] FROM over_all WHERE len(nodes) = 1) AS root,
       sha256(replace(array_to_string(steps, ''), '|', '')) AS proof_sha256, folded_root,
       folded_root = (SELECT nodes[1] FROM over_all WHERE len(nodes) = 1) AS verified
FROM folded"""

"""SimHash groups against all pairs, on the smallest tables and on planted rows."""

import random

import pytest

from feedloom.llm.simhash import (
    BKTree,
    as_hex,
    block_count,
    fingerprint,
    hamming_links,
    keep_one_of_each_group,
    shingle_hashes,
    signed,
    simhash_groups,
    simhash_of_documents,
)

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def brute_groups(bits, radius=4):
    """Smallest index reachable, by comparing all pairs."""
    group = list(range(len(bits)))
    changed = True
    while changed:
        changed = False
        for i, x in enumerate(bits):
            for j, y in enumerate(bits):
                if (x ^ y).bit_count() <= radius and group[j] < group[i]:
                    group[i], changed = group[j], True
    return group


def test_documents_against_all_pairs(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    ids = sorted(texts)
    bits = [fingerprint(shingle_hashes(texts[i])) for i in ids]
    want = {i: (f"{b:016x}", ids[g]) for i, b, g in zip(ids, bits, brute_groups(bits), strict=True)}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash_of_documents(spark, sf).collect()}
    assert got == want


def test_hash_is_sparks(spark):
    row = spark.sql("SELECT hex(xxhash64('a b c d')) AS h, hex(xxhash64('é')) AS e").first()
    assert f"{int(shingle_hashes('A b  C\td')[0]):016X}" == row.h.rjust(16, "0")
    assert f"{int(shingle_hashes('é')[0]):016X}" == row.e.rjust(16, "0")
    assert len(shingle_hashes("a b c d a b c d")) == 5
    assert fingerprint(shingle_hashes(" \x0b ")) == 0 == fingerprint(shingle_hashes(None))


def test_tree_finds_what_a_scan_finds():
    rng = random.Random(3)
    values = [rng.getrandbits(16) for _ in range(400)]
    tree = BKTree()
    for v in values:
        tree.add(v)
    for q in values[:50]:
        assert set(tree.within(q, 3)) == {v for v in values if (v ^ q).bit_count() <= 3}


@pytest.mark.parametrize("shard_rows,blocks", [(2048, None), (8, None), (3, 5), (8, 8)])
def test_links_join_what_all_links_join(spark, shard_rows, blocks):
    """Chains, a large group about one value, and chance values; small shards are cut in chunks."""
    rng = random.Random(5)
    values = {rng.getrandbits(64) for _ in range(60)}
    centre = rng.getrandbits(64)
    values |= {centre ^ (1 << i) ^ (1 << j) for i in range(9) for j in range(i)}
    step = rng.getrandbits(64)
    for i in range(0, 60, 4):
        step ^= 0b1111 << i
        values.add(step)
    values = sorted(values)
    frame = spark.createDataFrame([(signed(v),) for v in values], "bits bigint")
    found = hamming_links(frame, 4, shard_rows, blocks).collect()
    place = {signed(v): i for i, v in enumerate(values)}
    assert all((values[place[r.a]] ^ values[place[r.b]]).bit_count() <= 4 for r in found)
    group = list(range(len(values)))
    for _ in values:
        for r in found:
            x, y = place[r.a], place[r.b]
            group[x] = group[y] = min(group[x], group[y])
    assert group == brute_groups(values)


def test_more_values_take_more_blocks():
    assert block_count(10, 4) == 6
    assert block_count(10**12, 4) > 6


def test_odd_rows(spark):
    rows = [
        (5, None, "en", "a", 0),
        (3, "", None, None, None),
        (None, " \n", "en", "a", 1),
        (7, "one two three four five", "en", "a", 1),
        (7, "one two three four five", "en", "a", 1),
        (9, "ONE two three four five", "en", "b", 1),
        (None, "alone in the world today", "en", "b", 1),
        (11, "x " * 200_000, "en", "b", 1),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = sorted((str(r.doc_id), str(r.component_id)) for r in simhash_groups(docs).collect())
    want = [("5", 3), ("3", 3), (None, 3), ("7", 7), ("7", 7), ("9", 7), (None, None), ("11", 11)]
    assert got == sorted((str(a), str(b)) for a, b in want)
    more = docs.selectExpr("*", "1 AS bits", "2 AS component_id", "'x' AS fingerprint")
    kept = keep_one_of_each_group(more)
    assert kept.columns == more.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["11", "3", "7", "None"]
    assert keep_one_of_each_group(docs.limit(0)).count() == 0
    assert docs.limit(0).select(as_hex(docs.doc_id)).count() == 0

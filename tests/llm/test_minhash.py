import random

import numpy as np
import pytest

from dialoom.llm import minhash
from dialoom.llm.components import components

from .helpers import documents, edge_texts, words


def brute(texts, percent):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(texts)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [(len(sets[k]), find(k), find(k) == k) for k in range(len(texts))]


@pytest.mark.parametrize("percent", [80, 85])
def test_equals_brute_force(spark, percent):
    rng = random.Random(percent)
    texts = edge_texts() + ["One two three", "one TWO three", "one two three four five", "É b c d e f", "é b c d e f"]
    for _ in range(12):
        base = words(rng, 120).split()
        for _ in range(rng.randint(1, 8)):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = "new"
            texts.append(" ".join(copy))
    got = {r["doc_id"]: r for r in minhash.near_duplicates(documents(spark, texts, extra=True), percent).collect()}
    assert [(got[k]["n_shingles"], got[k]["component_id"], got[k]["kept"]) for k in range(len(texts))] == brute(texts, percent)


def test_large_family_in_blocks(spark):
    rng = random.Random(5)
    base = words(rng, 100).split()
    texts = []
    for _ in range(160):
        copy = list(base)
        for _ in range(rng.randint(0, 6)):
            copy[rng.randrange(100)] = f"n{rng.randrange(1000)}"
        texts.append(" ".join(copy))
    minhash.BLOCK, before = 16, minhash.BLOCK
    try:
        got = {r["doc_id"]: r for r in minhash.near_duplicates(documents(spark, texts)).collect()}
    finally:
        minhash.BLOCK = before
    assert [(got[k]["n_shingles"], got[k]["component_id"], got[k]["kept"]) for k in range(len(texts))] == brute(texts, 85)


def test_block_links_over_parts():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**64, 300, dtype=np.uint64)
    sets = [np.unique(np.r_[base[: 300 - 5 * k], rng.integers(0, 2**64, 5 * k, dtype=np.uint64)]) for k in range(6)]
    signatures = np.array([(minhash.minima(s) >> np.uint64(32)).astype(np.uint8) for s in sets])
    minhash.PART_ITEMS, before = 100, minhash.PART_ITEMS
    try:
        few = minhash.block_links(list(range(6)), signatures, sets, None, 85)
    finally:
        minhash.PART_ITEMS = before
    assert few == minhash.block_links(list(range(6)), signatures, sets, None, 85) and few


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 9), (20, 10), (10, 30), (7, 7), *((100, 200 + k) for k in range(50)), *((500 + k, 501 + k) for k in range(40))]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {got[x] for x in (1, 2, 3, 9)} == {1} and {got[x] for x in (10, 20, 30)} == {10} and 7 not in got
    assert {got[200 + k] for k in range(50)} == {100} and {got[500 + k] for k in range(41)} == {500}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_repeated_rows_null_ids_empty(spark):
    df = documents(spark, ["a b c d e f", "a b c d e f", "x"])
    rows = minhash.near_duplicates(df.union(df).union(df.selectExpr("cast(null as long)", "text", "lang", "source", "n_chars"))).collect()
    assert sorted((r["doc_id"], r["component_id"], r["kept"]) for r in rows if r["doc_id"] is not None) == sorted([(0, 0, True), (1, 0, False), (2, 2, True)] * 2)
    assert sorted(r["component_id"] for r in rows if r["doc_id"] is None) == [0, 0, 2]
    assert minhash.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("percent", [80, 85])
def test_whole_table_with_many_near_copies(spark, percent):
    """All documents of the smallest table and copies of them with words changed, so that many pairs lie near the threshold."""
    rng = random.Random(percent)
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()]
    for text in texts[:80]:
        words_ = (text or "").split()
        for _ in range(3 if len(words_) > 30 else 0):
            copy = list(words_)
            for _ in range(rng.randint(0, max(1, len(copy) // 25))):
                copy[rng.randrange(len(copy))] = f"new{rng.randrange(50)}"
            texts.append(" ".join(copy))
    got = {r["doc_id"]: r for r in minhash.near_duplicates(documents(spark, texts), percent).collect()}
    want = brute(texts, percent)
    linked = sum(not kept for _, _, kept in want)
    found = sum(not r["kept"] for r in got.values())
    print(f"documents linked to an earlier one at {percent}: {found} of {linked}")
    assert linked > 60 and [(got[k]["n_shingles"], got[k]["component_id"], got[k]["kept"]) for k in range(len(texts))] == want


def test_members_of_a_bucket_that_only_link_with_each_other(spark):
    """Pairs whose bucket's head is no link of theirs are found through labels, in one bucket or many."""
    rng = random.Random(12)
    texts = []
    for _ in range(6):
        base = words(rng, 150, 5000).split()
        for spread in (26, 26, 26):  # siblings of a hidden base: alike enough for shared buckets, no links
            cousin = list(base)
            for at in rng.sample(range(150), spread // 5):
                cousin[at] = f"c{rng.randrange(9999)}"
            for _ in range(3):  # near copies of each sibling
                copy = list(cousin)
                copy[rng.randrange(150)] = f"d{rng.randrange(9999)}"
                texts.append(" ".join(copy))
    rng.shuffle(texts)
    got = {r["doc_id"]: r for r in minhash.near_duplicates(documents(spark, texts)).collect()}
    want = brute(texts, 85)
    assert len({c for _, c, _ in want}) > 8 and [(got[k]["n_shingles"], got[k]["component_id"], got[k]["kept"]) for k in range(len(texts))] == want

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from dialoom.llm import suffixdedup
from dialoom.llm.suffixsort import common_prefix, deep_shallow_sort

from .helpers import documents, edge_texts


def test_sort_and_common_prefixes():
    rng = random.Random(1)
    for t in range(150):
        base = bytes(rng.choice(b"ab") for _ in range(60))
        s = [base[: rng.choice([0, 1, 5, 30, 45, 60])] + bytes(rng.choice(b"ab\0") for _ in range(rng.randint(0, 20))) for _ in range(rng.randint(0, 40))]
        g = np.array([rng.randint(0, 3) for _ in s]) if t % 2 and s else None
        order, common = deep_shallow_sort(s, g)
        keys = [(0 if g is None else g[k], s[k]) for k in order]
        assert keys == sorted(keys)
        for a, b, c in zip(order, order[1:], common[1:]):
            assert c == (-1 if g is not None and g[a] != g[b] else common_prefix(s[a], s[b]))


def brute(texts, length):
    raws = [(t or "").encode() for t in texts]
    seen = {}
    for r in raws:
        for k in range(len(r) - length + 1):
            seen[r[k : k + length]] = seen.get(r[k : k + length], 0) + 1
    out = []
    for r in raws:
        mark = [False] * len(r)
        for k in range(len(r) - length + 1):
            if seen[r[k : k + length]] > 1:
                mark[k : k + length] = [True] * length
        kept = bytes(b for b, m in zip(r, mark) if not m)
        spans = sum(m and (k == 0 or not mark[k - 1]) for k, m in enumerate(mark))
        out.append((len(r), sum(mark), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(2, 6)))
    passage = " ".join(word() for _ in range(60))
    texts = edge_texts() + ["ab" * 200, "x" * 250, passage, passage]
    for _ in range(60):
        a, b = sorted(rng.randrange(len(passage)) for _ in range(2))
        part = passage[a:b]
        if rng.random() < 0.4 and part:
            k = rng.randrange(len(part))
            part = part[:k] + "#" + part[k + 1 :]
        texts.append(" ".join(word() for _ in range(rng.randint(0, 20))) + part + " ".join(word() for _ in range(rng.randint(0, 20))))
    got = {r["doc_id"]: r for r in suffixdedup.remove_repeats(documents(spark, texts, extra=True), length=40, gram=16).collect()}
    assert [(got[k]["n_bytes"], got[k]["n_removed"], got[k]["n_spans"], got[k]["kept_sha256"]) for k in range(len(texts))] == brute(texts, 40)


def test_large_group_in_blocks(spark):
    rng = random.Random(9)
    passage = "".join(rng.choice("abcdefgh") for _ in range(45))
    texts = ["".join(rng.choice("abcdefgh") for _ in range(30)) + passage + "".join(rng.choice("abcdefgh") for _ in range(30)) for _ in range(150)]
    suffixdedup.BLOCK, before = 20, suffixdedup.BLOCK
    try:
        got = {r["doc_id"]: r for r in suffixdedup.remove_repeats(documents(spark, texts), length=40, gram=16).collect()}
    finally:
        suffixdedup.BLOCK = before
    assert [(got[k]["n_bytes"], got[k]["n_removed"], got[k]["n_spans"], got[k]["kept_sha256"]) for k in range(len(texts))] == brute(texts, 40)


def test_repeated_rows_and_empty(spark):
    df = documents(spark, ["q" + "abcdefghij" * 5, "other"])
    rows = suffixdedup.remove_repeats(df.union(df), length=40, gram=16, with_text=True).collect()
    assert sorted((r["doc_id"], r["n_removed"], r["kept_text"]) for r in rows) == [(0, 51, ""), (0, 51, ""), (1, 0, "other"), (1, 0, "other")]
    assert suffixdedup.remove_repeats(df.limit(0)).count() == 0


def test_contexts_of_one_group_equal_brute_force():
    rng = random.Random(1)
    piece = lambda n, letters=b"ab": bytes(rng.choice(letters) for _ in range(n))
    for _ in range(200):
        n, base = rng.randint(2, 40), piece(40)
        group = np.sort(np.array([rng.randrange(3) for _ in range(n)]))
        lefts = [piece(rng.randint(0, 6)) + base[rng.randint(0, 10) : 12] for _ in range(n)]
        rights = [base[12 : 20 + rng.randint(0, 12)] + piece(rng.randint(0, 8)) for _ in range(n)]
        counts = np.array([rng.choice([1, 1, 1, 2]) for _ in range(n)])
        l, r = suffixdedup.match_contexts(group, counts, lefts, rights, 18, 8)
        for i in np.flatnonzero(counts == 1):
            met = [(common_prefix(lefts[i][::-1], lefts[j][::-1]), common_prefix(rights[i], rights[j])) for j in range(n) if j != i and group[i] == group[j]]
            met = [(a, b) for a, b in met if a + b >= 18]
            assert (l[i], r[i]) == (max((a for a, _ in met), default=-1), max((b for _, b in met), default=-1))


@pytest.mark.parametrize(("block", "most"), [(2, 0), (2, 9), (suffixdedup.BLOCK, 8)])
def test_whole_table(spark, block, most):
    """Every gram with several contexts by windows, then by pairs of small blocks, then each in one block."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id")
    docs = df.select("doc_id", "text").collect()
    before = suffixdedup.BLOCK, suffixdedup.MOST_BLOCKS
    suffixdedup.BLOCK, suffixdedup.MOST_BLOCKS = block, most
    try:
        got = {r["doc_id"]: r for r in suffixdedup.op7_suffix_array_dedup(spark, "/root/testdata/sf0.001").collect()}
    finally:
        suffixdedup.BLOCK, suffixdedup.MOST_BLOCKS = before
    assert [tuple(got[d["doc_id"]][1:5]) for d in docs] == brute([d["text"] for d in docs], 200)


def test_very_many_repeated_rows_send_their_contexts_once(spark):
    rng = random.Random(3)
    piece = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    shared = piece(60)
    rows = [(1, piece(20) + shared + piece(20))] * 1500 + [(2, piece(20) + shared + piece(20)), (None, piece(20) + shared)] + [(None, "other " * 3)] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"] or 0, r["n_bytes"], r["n_removed"]) for r in suffixdedup.remove_repeats(df, length=40, gram=16).collect()))
    want = sorted((d or 0, n, m) for (d, _), (n, m, _, _) in zip(rows, brute([t for _, t in rows], 40), strict=True))
    assert got == want
    batch = lambda docs: pa.RecordBatch.from_pylist([{"doc_id": d, "t": d, "text": t, "wanted": []} for d, t in docs])
    once = list(suffixdedup._each_once([batch([(1, "a"), (1, "a"), (2, "b")]), batch([(2, "b"), (3, "c")])]))
    assert [[raw for raw, _ in part] for part in once] == [[b"a", b"b"], [b"c"]]

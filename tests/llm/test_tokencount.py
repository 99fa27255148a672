import random
import tracemalloc

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from dialoom.llm import bpe, tokencount

from .helpers import documents, edge_texts

PIECES = ["a", " ", "  ", "\n", "'", "'s", "'re", "the", " foo", "é", "12", "!", "<|endoftext|>", "<|end", "ß", "日本", "😀", "\t", "՘", " ", "ll"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=9).map("".join))
def test_every_prefix(text):
    encode = bpe.library().encode
    want = [len(encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]
    assert tokencount.counter().prefix_counts(text).tolist() == want


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=60))
def test_totals_and_fast_encoder(text):
    ids = bpe.library().encode(text, add_special_tokens=False).ids
    assert tokencount.counter().total(text) == len(ids)
    assert bpe.fast_encoder().encode(text, allowed_special="all") == ids


def test_budget():
    c = tokencount.counter()
    text = "one two three four five six"
    for budget in range(8):
        n = c.fitting_prefix(text, budget)
        assert c.total(text[:n]) <= budget and (n == len(text) or c.prefix_counts(text)[n] >= budget)


def test_long_single_words():
    rng = random.Random(4)
    c, encode = tokencount.counter(), bpe.library().encode
    for letters in ("etaoinshr", "ab", "東京都é😀", "0123456789", "=-+", " ", "\n"):
        text = "".join(rng.choice(letters) for _ in range(700))
        assert c.total(text) == len(encode(text, add_special_tokens=False).ids)
        want = [len(encode(text[:i], add_special_tokens=False).ids) for i in range(0, 701, 7)]
        assert c.prefix_counts(text)[::7].tolist() == want
    tracemalloc.start()
    text = "".join(rng.choice("etaoinshrdlu") for _ in range(1_000_000))
    n = c.total(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == len(encode(text, add_special_tokens=False).ids) and peak < 500e6


def test_very_long_white_space():
    encode = bpe.library().encode
    for head in ("", "a", "<|endoftext|>", "a\n"):
        for run in (" " * 10_000, "\n" * 10_001, "\u3000" * 12_000, " \t" * 6_000):
            for tail in ("", "x", " x", "!", "<|endoftext|>y", "'s"):
                text = head + run + tail
                ids = encode(text, add_special_tokens=False).ids
                assert bpe.encode(text).tolist() == ids and tokencount.counter().total(text) == len(ids)
    assert len(bpe.encode(" " * 2_000_000)) == tokencount.counter().total(" " * 2_000_000) == 2_000_000


def test_rows(spark):
    texts = edge_texts()
    rows = {r["doc_id"]: r for r in tokencount.count_tokens(documents(spark, texts, extra=True), limit=10).collect()}
    for k, t in enumerate(texts):
        n = len(bpe.library().encode(t or "", add_special_tokens=False).ids)
        assert (rows[k]["n_bytes"], rows[k]["n_tokens"], rows[k]["over_limit"]) == (len((t or "").encode()), n, n > 10)


def test_whole_table(spark):
    got = {r["doc_id"]: r["n_tokens"] for r in tokencount.op6_token_counts(spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert got == {r["doc_id"]: len(bpe.library().encode(r["text"] or "", add_special_tokens=False).ids) for r in docs}
    assert np.mean(list(got.values())) > 0

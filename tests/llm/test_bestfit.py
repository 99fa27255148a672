import random
import struct
import zlib
from collections import Counter

import pytest

from dialoom.llm import bestfit, bpe

from .helpers import documents, edge_texts


@pytest.mark.parametrize("capacity", [1, 5, 50, 2048])
def test_plans_hold_every_length_once(capacity):
    rng = random.Random(capacity)
    for n in (0, 1, 3, 40, 3000):
        h = Counter(rng.randint(1, capacity) for _ in range(n))
        plan = bestfit.pack_histogram(dict(h), capacity)
        held: Counter = Counter()
        for count, content in plan.rows:
            assert count > 0 and sum(a * b for a, b in content) <= capacity
            for length, copies in content:
                held[length] += copies * count
        assert +held == +h
        least = -(-sum(k * v for k, v in h.items()) // capacity)
        assert plan.sequences <= max(least, int(1.5 * least) + 1) if capacity > 5 else True
        spots = set()
        for length, m in h.items():
            for rank in range(m):
                sequence, offset = plan.place(length, rank)
                assert 0 <= sequence < plan.sequences and offset + length <= capacity
                spots.add((sequence, offset))
        assert len(spots) == n


def test_near_the_bound():
    rng = random.Random(1)
    h = Counter(min(2048, int(rng.lognormvariate(6, 0.8)) + 1) for _ in range(20000))
    plan = bestfit.pack_histogram(dict(h), 2048)
    assert plan.sequences <= 1.005 * sum(k * v for k, v in h.items()) / 2048 + 1


def test_configurations_cover_the_demand():
    used = bestfit.configurations([1200, 900, 700, 500], [10, 20, 30, 40], 2048)
    for k, want in enumerate([10, 20, 30, 40]):
        assert abs(sum(p[k] * a for p, a in used) - want) < 1e-6
    for pattern, _ in used:
        assert sum(s * n for s, n in zip([1200, 900, 700, 500], pattern)) <= 2048


def test_pieces_and_places(spark):
    texts = edge_texts()
    df = documents(spark, texts, extra=True)
    rows = bestfit.pack_documents(df, 64).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for k, t in enumerate(texts):
        ids = [*bpe.library().encode(t or "", add_special_tokens=False).ids, 0]
        at = 0
        for r in sorted(by_doc[k], key=lambda r: r["piece"]):
            part = ids[at : at + r["length"]]
            assert r["start"] == at and r["length"] <= 64 and (r["piece"] == 0 or r["length"] == 64)
            assert r["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
            at += r["length"]
        assert at == len(ids)
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 64


def test_repeated_rows_and_empty_table(spark):
    df = documents(spark, ["a b c", "d"])
    assert bestfit.pack_documents(df.union(df), 16).count() == 4
    assert bestfit.pack_documents(df.limit(0), 16).count() == 0


def _fewest(lengths, capacity):
    """The least number of sequences, by trying every place for every length."""
    best = len(lengths)

    def go(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(lengths):
            best = len(rooms)
            return
        for room in sorted(set(r for r in rooms if r >= lengths[k])):
            rest = list(rooms)
            rest.remove(room)
            go(k + 1, [*rest, room - lengths[k]])
        go(k + 1, [*rooms, capacity - lengths[k]])

    go(0, [])
    return best


def test_against_the_optimum():
    rng = random.Random(8)
    over = 0
    for _ in range(60):
        lengths = sorted((rng.randint(5, 70) for _ in range(rng.randint(1, 9))), reverse=True)
        fewest, got = _fewest(lengths, 100), bestfit.pack_histogram(dict(Counter(lengths)), 100).sequences
        assert fewest <= got <= fewest + 1
        over += got - fewest
    assert over <= 3


def test_whole_table_and_very_long_texts(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in df.collect()}
    texts |= {-1: " " * 2_000_000, -2: "x" + "\n" * 300_000 + "y", -3: "ab" * 300_000}
    more = spark.createDataFrame([(k, texts[k]) for k in (-1, -2, -3)], "doc_id long, text string")
    rows = bestfit.pack_documents(df.select("doc_id", "text").union(more)).collect()
    pieces = {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
    assert pieces.keys() == texts.keys()
    for k, t in texts.items():
        ids = [*bpe.library().encode(t, add_special_tokens=False).ids, 0]
        got = sorted(pieces[k], key=lambda r: r["piece"])
        assert [r["start"] for r in got] == [sum(r["length"] for r in got[:n]) for n in range(len(got))]
        assert sum(r["length"] for r in got) == len(ids)
        for r in got:
            part = ids[r["start"] : r["start"] + r["length"]]
            assert r["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
    least = -(-sum(r["length"] for r in rows) // 2048)
    assert len({r["sequence_id"] for r in rows}) <= least + 1

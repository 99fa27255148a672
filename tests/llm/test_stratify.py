import zlib
from collections import Counter

from pyspark.sql import functions as F

from dialoom.llm import stratify

from .helpers import documents, edge_texts


def test_shards(spark):
    n = 997
    df = documents(spark, [f"t{k}" for k in range(n)], extra=True)
    rows = stratify.interleave_shards(df, 7, bucket_rows=50).collect()
    counts = Counter(r["shard"] for r in rows)
    assert len(rows) == n and max(counts.values()) - min(counts.values()) <= 1 and set(counts) == set(range(7))
    for s in range(7):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(counts[s]))
        for source in ("s0", "s1", "s2"):
            mine = sum(r["source"] == source for r in rows if r["shard"] == s)
            assert abs(mine - n / 21) <= 2
    again = {(r["doc_id"], r["shard"], r["slot"]) for r in stratify.interleave_shards(df, 7, bucket_rows=300).collect()}
    assert again == {(r["doc_id"], r["shard"], r["slot"]) for r in rows}


def test_edges(spark):
    texts = edge_texts()
    df = documents(spark, texts)
    rows = {r["doc_id"]: r for r in stratify.interleave_shards(df.withColumn("source", F.lit(None).cast("string")), 40).collect()}
    for k, t in enumerate(texts):
        raw = (t or "").encode()
        assert (rows[k]["size"], rows[k]["text_crc32"]) == (len(raw) + 16, zlib.crc32(raw))
    assert stratify.interleave_shards(df.limit(0), 4).count() == 0
    assert stratify.interleave_shards(df.union(df), 4).count() == 2 * len(texts)


def test_plan_is_native(spark):
    plan = stratify.op5_stratified_shards(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def _brute(rows, n_shards):
    """Shard and slot of ``(doc_id, source, text)`` rows by sorting them all."""
    import hashlib

    none = lambda x: (x is not None, x or 0)
    by_source = {}
    for doc, source, text in rows:
        raw = (text or "").encode()
        u = int(hashlib.md5(f"17:{'null' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        by_source.setdefault("-" if source is None else "+" + source, []).append((u, none(doc), zlib.crc32(raw), len(raw)))
    placed = []
    for key, members in by_source.items():
        for rank, (_, doc, crc, n) in enumerate(sorted(members), 1):
            placed.append(((2 * rank - 1) / (2 * len(members)), key, doc, crc, n))
    placed.sort()
    out = []
    for pos, (_, _, doc, crc, n) in enumerate(placed):
        shard = pos * n_shards // len(placed)
        out.append((doc[1] if doc[0] else None, n + 16, crc, shard, pos - -(-shard * len(placed) // n_shards)))
    return sorted(out, key=str)


def test_many_sources_null_ids_and_repeats(spark):
    rows = [(k, f"s{k}", f"t{k}") for k in range(20_000)]  # one fraction for all of them
    rows += [(None, "hot", f"t{k}") for k in range(6_000)] + [(None, "hot", "same")] * 3_000 + [(7, None, None)] * 50
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    seen = []

    def watched(*args, keep=stratify._parted):
        seen.append(keep(*args))
        sizes = [r["count"] for r in seen[-1].groupBy("_part").count().collect()]
        assert sum(sizes) == len(rows) and len(sizes) > 40 and max(sizes) < 4 * 500
        return seen[-1]

    keep, stratify._parted = stratify._parted, watched
    try:
        got = stratify.interleave_shards(df, 40, bucket_rows=500).collect()
    finally:
        stratify._parted = keep
    assert len(seen) == 2
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in got), key=str) == _brute(rows, 40)

from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from dialoom.llm import bestfit, minhash, suffixdedup, toxicity
from dialoom.llm.common import table

from .helpers import DOCS, documents, edge_texts, rng, words
from .test_suffixdedup import brute

DIR = "/root/testdata/sf0.01"


def test_stages_take_effect(spark):
    docs = table(spark, DIR, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "repeated_passages", "mixing", "packing"]
    lexicon = toxicity.fit(docs, toxicity.training_labels(table(spark, DIR, "labels")))
    bad = {r["doc_id"] for r in toxicity.score_documents(docs, lexicon).where("predicted = 1").collect()}
    clean = corpus_pipeline.drop_toxic(spark, docs, DIR).cache()
    assert clean.columns == list(corpus_pipeline.COLUMNS)
    assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in docs.collect()} - bad and bad
    single = corpus_pipeline.drop_near_duplicates(spark, clean, DIR).cache()
    kept = {r["doc_id"] for r in minhash.near_duplicates(clean, 80).where("kept").collect()}
    assert {r["doc_id"] for r in single.collect()} == kept and len(kept) < clean.count()
    cut = corpus_pipeline.drop_repeated_passages(spark, single, DIR).cache()
    rows = single.orderBy("doc_id").collect()
    want = {r["doc_id"]: b for r, b in zip(rows, brute([r["text"] for r in rows], suffixdedup.LENGTH))}
    assert {r["doc_id"] for r in cut.collect()} == {k for k, b in want.items() if b[1] == 0 or b[1] < b[0]}
    assert any(b[1] for b in want.values())
    mixed = corpus_pipeline.mix_domains(spark, cut, DIR).cache()
    copies = Counter(r["doc_id"] for r in mixed.collect())
    assert mixed.columns == list(corpus_pipeline.COLUMNS) and set(copies) <= {r["doc_id"] for r in cut.collect()} and max(copies.values()) >= 2
    packed = corpus_pipeline.pack(spark, mixed, DIR).collect()
    assert Counter(r["doc_id"] for r in packed if r["piece"] == 0) == copies
    assert max(r["offset"] + r["length"] for r in packed) <= 2048


def test_edge_tables(spark):
    docs = documents(spark, edge_texts(), extra=True)
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, docs, DIR).collect()
        assert stage(spark, docs.limit(0), DIR).count() == 0


def test_one_row_of_copies_stays(spark):
    random = rng(5)
    long, other, lone = (words(random, 80) for _ in range(3))
    near = long + " one more"
    rows = [(7, long), (7, long), (None, long), (3, near), (None, other), (None, other), (5, lone), (5, other + " " + lone), (None, None), (9, "")]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in rows], DOCS)
    single = corpus_pipeline.drop_near_duplicates(spark, docs, DIR)
    got = sorted(((r["doc_id"], r["text"]) for r in single.collect()), key=repr)
    assert got == sorted([(3, near), (None, other), (5, lone), (5, other + " " + lone), (None, None), (9, "")], key=repr)
    copies = single.where(F.col("text").isin(near, other))
    cut = corpus_pipeline.drop_repeated_passages(spark, copies, DIR)
    assert {r["text"] for r in cut.collect()} == {near, other}

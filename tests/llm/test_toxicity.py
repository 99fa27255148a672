import random
import time

from pyspark.sql import functions as F

from dialoom.llm import toxicity
from dialoom.llm.common import fold_of

from .helpers import documents, edge_texts

DIR = "/root/testdata/sf0.1"


def test_fold():
    assert toxicity.fold("You 1d10t!") == " you idiot "
    assert toxicity.fold("mоrоn") == " moron "
    assert toxicity.fold("ｔｒａsh") == " trash "
    assert toxicity.fold("cl​own 3 x2 2nd") == " clown 3 x2 2nd "
    assert toxicity.fold("") == "  "
    assert toxicity.fold("i\u0336d\u0336i\u0336o\u0336t\u0336 \u00edd\u00edot \u00fcber \ud55c\uae00") == " idiot idiot uber \ud55c\uae00 "


def test_matches_and_exceptions():
    lex = toxicity.Lexicon({" bad ": 2.0, " vile": 1.0}, ["vileplume", "bad apple"])
    assert lex.matches(toxicity.fold("bad badly vilest")) == [2.0, 1.0]
    assert lex.matches(toxicity.fold("vileplume, a bad apple")) == []
    assert lex.matches(toxicity.fold("")) == []


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{DIR}/labels.parquet").selectExpr("doc_id as i", "toxic")
    rows = toxicity.op2_toxicity_lexicon(spark, DIR).where("held_out").join(labels, F.col("doc_id") == F.col("i")).collect()
    hit = sum(r["predicted"] == 1 and r["toxic"] == 1 for r in rows)
    toxic, said = sum(r["toxic"] for r in rows), sum(r["predicted"] for r in rows)
    assert hit / toxic > 0.9 and hit / said > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_edges(spark):
    df = documents(spark, edge_texts(), extra=True)
    none = toxicity.fit(df, spark.createDataFrame([], "doc_id long, toxic int"))
    got = toxicity.score_documents(df, none).collect()
    assert len(got) == len(edge_texts()) and all(r["predicted"] == 0 for r in got)
    nulls = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, toxic int")
    assert toxicity.fit(df, nulls).weights == {}
    assert toxicity.score_documents(df.limit(0), none).count() == 0
    folds = spark.range(100).select(fold_of("id", 5).alias("f")).distinct().count()
    assert folds == 5


def test_sweep_equals_its_definition_and_is_quick():
    rng = random.Random(2)
    lex = toxicity.Lexicon({" bad ": 2.0, " vil": 1.0, " a ": 0.5}, ["bad apple", "vile a bad", "vilest", "a a"])
    for _ in range(300):
        folded = toxicity.fold(" ".join(rng.choice(["bad", "apple", "vile", "vilest", "a", "x"]) for _ in range(rng.randint(0, 14))))
        starts = {}
        for term, w in lex.weights.items():
            for at in range(len(folded)):
                if folded.startswith(term, at):
                    starts[at] = max(w, starts.get(at, 0))
        spans = [(at, at + len(e) - 1) for e in lex.exceptions for at in range(len(folded)) if folded.startswith(e, at)]
        assert lex.hits(folded) == {s: w for s, w in starts.items() if not any(a <= s < b for a, b in spans)}
    long = " ".join(["bad", "bad apple"] * 50_000)
    before = time.perf_counter()
    assert len(lex.matches(toxicity.fold(long))) == 50_000
    assert time.perf_counter() - before < 5


def test_phrases_are_learned(spark):
    rng = random.Random(3)
    rows, labels = [], []
    for k in range(400):
        toxic = k % 4 == 0
        said = "you killer" if toxic else rng.choice(["killer whale", *["a sunny day"] * 5])
        rows.append(f"{' '.join(rng.choice(['one', 'two', 'six', 'ten']) for _ in range(12))} {said} {rng.choice(['now', 'then'])}")
        labels.append((k, int(toxic)))
    lex = toxicity.fit(documents(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert " killer whale " in lex.exceptions
    assert lex.matches(toxicity.fold("see a killer whale")) == [] and lex.matches(toxicity.fold("what a killer"))


def test_labels_outside_the_two_values(spark):
    df = documents(spark, ["you fool"] * 40 + ["a good day"] * 40)
    labels = [(k, (2 if k % 2 else 1) if k < 40 else (-1 if k % 2 else 0)) for k in range(80)]
    lex = toxicity.fit(df, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert lex.score("you fool") > 0.5 > lex.score("a good day")

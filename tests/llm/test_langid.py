import pytest
from pyspark.sql import functions as F

from dialoom.llm import langid

from .helpers import documents, edge_texts

DIR = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    truth = spark.read.parquet(f"{DIR}/documents.parquet").selectExpr("doc_id as i", "lang")
    rows = langid.op9_language_id(spark, DIR).where("held_out").join(truth, F.col("doc_id") == F.col("i")).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows) > 0.99
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_edges(spark):
    df = documents(spark, edge_texts(), extra=True)
    model = langid.fit(df)
    got = {r["doc_id"]: r for r in langid.identify(df, model).collect()}
    assert [k for k in got if got[k]["lang_pred"] == "und"] == [0, 1, 2, 7]
    assert all(got[k]["lang_pred"] == "en" for k in (3, 5, 8))
    assert langid.identify(df.limit(0), model).count() == 0
    empty = langid.fit(df.where("lang = 'xx'"))
    assert {r["lang_pred"] for r in langid.identify(df, empty).collect()} == {"und"}


def test_rejects_what_is_far(spark):
    texts = ["the cat sat on the mat with the hat " * 3, "der hund und die katze sind nicht hier " * 3] * 20
    df = documents(spark, texts).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "en").otherwise("de"))
    model = langid.fit(df)
    near, far = model.predict(["the cat and the hat sat with the cat", "ぬるぽ がっ"])
    assert near[0] == "en" and far[2]


def test_numerals_are_no_letters(spark):
    model = langid.fit(documents(spark, ["the cat sat on the mat", "a dog in the fog"] * 10))
    assert [r[0] for r in model.predict(["²½", "①", "Ⅳ", "१२३", "12 ½", "½a", "ª"])] == ["und"] * 5 + ["en"] * 2


def test_many_languages_are_one_pass_and_too_many_an_error(spark):
    rows = [(k, f"{chr(0x4E00 + k % 40) * 3} {chr(97 + k % 26)}{chr(97 + k % 7)} x", f"l{k % 40}") for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df, dimensions=1 << 10)
    assert len(model.languages) == 40
    langid.MAX_LANGUAGES, before = 39, langid.MAX_LANGUAGES
    try:
        with pytest.raises(ValueError, match="40 languages"):
            langid.fit(df, dimensions=1 << 10)
    finally:
        langid.MAX_LANGUAGES = before

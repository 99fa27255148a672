import unicodedata

import pytest
from pyspark.sql import functions as F

from dialoom.functions import text


def values(spark, items, fn):
    df = spark.createDataFrame([(k, x) for k, x in enumerate(items)], "k int, x string")
    return [r["y"] for r in df.select("k", fn(F.col("x")).alias("y")).orderBy("k").collect()]


def test_collapse_equals_python(spark):
    items = ["  a \t b\u00a0c\u3000", "\u200bx\u200b y", "", "\x1c a\x1fb ", "\u2028p\u2029q"]
    assert values(spark, items, text.collapse) == [" ".join(x.replace("\u200b", "").split()) for x in items]


def test_casefold_equals_python(spark):
    items = ["Straße", "ΣΊΣΥΦΟΣ", "ﬁne ﬄ", "İI", "ABC ẞ", "ſ µ", "ŉ"]
    assert values(spark, items, text.casefold) == [x.casefold() for x in items]


def test_nfc_only_where_needed(spark):
    items = ["plain", "e\u0301", "\u1112\u1161\u11ab", "é", "\u212b", None]
    df = spark.createDataFrame([(k, x) for k, x in enumerate(items)], "k int, text string")
    got = [r["text"] for r in text.normalise_column(df, "text").orderBy("k").collect()]
    assert got == [None if x is None else unicodedata.normalize("NFC", x) for x in items]


def test_nfc_of_every_letter(spark):
    """Letters that normalisation changes, alone and between others."""
    changed = [c for c in map(chr, (*range(0xD800), *range(0xE000, 0x110000))) if unicodedata.normalize("NFC", c) != c]
    df = spark.createDataFrame([(c, f"x{c}y") for c in changed], "c string, text string").repartition(4)
    wrong = [r["c"] for r in text.normalise_column(df, "text").collect() if r["text"] != " ".join(unicodedata.normalize("NFC", f"x{r['c']}y").split())]
    assert len(changed) > 1000 and wrong == []


def test_sentence_count(spark):
    assert values(spark, ["하나. 둘! 셋?", "…", "끝", "a.. b"], text.sentence_count) == [3, 0, 1, 2]


def test_bigrams(spark):
    got = values(spark, ["가나다 라", "가", "", "가나 가나"], text.bigrams)
    assert [sorted(x) for x in got] == [["가나", "나다"], [], [], ["가나"]]
    assert text.bigrams_of("가나다 라") == {"가나", "나다"}


def test_stems_match_word_beginnings_only(spark):
    assert values(spark, ["멍청이 왔다", "안멍청", "새끼곰"], lambda x: text.begins_with_stem(x, ["멍청", "개새"])) == [True, False, False]


def test_in_scope(spark):
    fn = lambda x: text.in_scope(x, ["가나", "나다"], 2, 10, 1)
    assert values(spark, ["가나", "마바", "abc", "가나다라마바사아자차카"], fn) == [True, False, False, False]


@pytest.mark.parametrize(
    "raw,want",
    [
        ("U: a\nA: b", "U: a\nA: b"),
        ("noise\nu: a\nA: \"b\"", "U: a\nA: b"),
        ("A: x\nU: a\nU: b\nA: c\nU: d", "U: a b\nA: c"),
        ("U:\nA: b", ""),
        ("U: a", ""),
        ("", ""),
        (None, ""),
    ],
)
def test_parse_and_repair(spark, raw, want):
    assert values(spark, [raw], lambda x: text.render_dialogue(text.repair_dialogue(text.parse_dialogue(x)))) == [want]


def test_reply_text(spark):
    assert values(spark, ["A: 안녕\n둘째", None, "\n \"좋아\" ", "pet : x"], text.reply_text) == ["안녕", "", "좋아", "x"]


def test_language_names(spark):
    assert values(spark, ["ko", "xx"], text.language_name) == ["한국어", "xx"]


def test_case_folding_of_every_letter(spark):
    """Of all code points that have a case in Python's Unicode; the JVM's may be younger and know more of them."""
    every = [chr(k) for k in (*range(0x20, 0xD800), *range(0xE000, 0x1F000)) if unicodedata.normalize("NFC", chr(k)) == chr(k)]
    df = spark.createDataFrame([(k, f"x{c}y") for k, c in enumerate(every)], "k int, t string").repartition(4)
    rows = df.select("k", text.casefold(F.col("t")).alias("f")).collect()
    cased = [(every[r["k"]], r["f"]) for r in rows if not every[r["k"]].casefold() == every[r["k"]] == every[r["k"]].lower()]
    assert [c for c, f in cased if f != f"x{c}y".casefold()] == [] and len(cased) > 1400

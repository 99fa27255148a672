from pyspark.sql import functions as F

from dialoom.operators import gate, ledger, schema, stages

S = "id string, source string, scenario string, license string, generator array<string>, turns array<struct<role:string,text:string>>, _pos long"
GOOD = [("user", "안녕"), ("assistant", "응 좋아")]


def rows(spark, *turns, **kw):
    return spark.createDataFrame([(f"s{k}", "x", None, "l", ["m"], t, k) for k, t in enumerate(turns)], S)


def outcomes(df):
    return [(r["_outcome"], r["_reasons"]) for r in df.orderBy("_pos").collect()]


def test_order_of_judgement(spark):
    df = rows(spark, GOOD, [("user", " 안녕 "), ("assistant", "응\u200b 좋아")], GOOD[:1], [("user", "안녕"), ("assistant", "😀")], [("user", "안녕"), ("assistant", "😀")])
    out = ledger.ledger(df, schema.SESSIONS, gate.gate(F.col("turns"), {"이모지": "금지"}))
    assert outcomes(out) == [
        ("kept", []),
        ("duplicate", ["duplicate"]),
        ("rejected_by_schema", ["schema:too_short"]),
        ("rejected_by_gate", ["emoji"]),
        ("duplicate", ["duplicate"]),
    ]
    assert ledger.yield_rate(out).first().asDict() | {"yield_rate": None} == {"produced": 1, "rejected": 2, "duplicates": 2, "yield_rate": None}


def test_stage_rejects_hide_nothing(spark):
    df = rows(spark, GOOD, GOOD).withColumn("_stage_reject", F.when(F.col("_pos") == 0, F.array(F.lit("no"))))
    assert outcomes(ledger.ledger(df, schema.SESSIONS)) == [("rejected_by_stage", ["no"]), ("kept", [])]


def test_schema_errors(spark):
    bad = [None, [], GOOD + GOOD[:1], [("assistant", "a"), ("user", "b")], [("user", ""), ("assistant", "b")], [("user", "a"), ("bot", "b")]]
    got = outcomes(ledger.ledger(rows(spark, *bad), schema.SESSIONS))
    assert [r[1][0] for r in got] == ["schema:turns", "schema:too_short", "schema:even", "schema:role", "schema:text", "schema:role"]
    df = rows(spark, GOOD).withColumn("id", F.lit(" "))
    assert outcomes(ledger.ledger(df, schema.SESSIONS))[0][1] == ["schema:id"]


def test_utterances(spark):
    d = [("a", " Hi ", "s", "EN", "l", None, 0), ("b", "hi", "t", "en", "l", None, 1), ("c", "x", "s", "eng", "l", None, 2), ("d", "x", "s", "en", "", None, 3)]
    df = spark.createDataFrame(d, "id string, text string, source string, language string, license string, url string, _pos long")
    assert outcomes(ledger.ledger(df, schema.UTTERANCES)) == [("kept", []), ("duplicate", ["duplicate"]), ("rejected_by_schema", ["schema:language"]), ("rejected_by_schema", ["schema:license"])]


def test_empty_table(spark):
    out = ledger.ledger(spark.createDataFrame([], S), schema.SESSIONS)
    assert out.count() == 0 and ledger.yield_rate(out).first()["yield_rate"] is None


def test_numbered(spark):
    df = spark.range(0, 1000, 3).select((F.col("id") * 7).alias("_pos"), (F.col("id") % 2).alias("g"))
    got = ledger.numbered(df, "n", ["g"], block=64).orderBy("g", "_pos").collect()
    for g in (0, 1):
        assert [r["n"] for r in got if r["g"] == g] == list(range(sum(r["g"] == g for r in got)))
    assert [r["n"] for r in ledger.numbered(df, "n", block=100).orderBy("_pos").collect()] == list(range(334))


def test_overuse(spark):
    line = lambda t: [("user", "u"), ("assistant", t)]
    df = rows(spark, line("a"), line("a"), line("a"), line("b"), line("b") + line("b"))
    assert sorted(r["_pos"] for r in stages.overused(df, 2).collect()) == [2, 4]


def test_draw_shortfall_split(spark):
    pool = spark.createDataFrame([(f"d{k}", "dialogue", "dialogue", k) for k in range(10)] + [(f"r{k}", "respond", "respond", 10 + k) for k in range(2)], "id string, source string, bucket string, _pos long")
    ratios = {"dialogue": 0.5, "respond": 0.5}
    assert [tuple(r) for r in stages.shortfall(pool, stages.bucket_targets(spark, ratios, 8)).collect()] == [("respond", 2)]
    drawn = stages.draw(pool, ratios, 8, 1)
    assert {r["bucket"]: r["count"] for r in drawn.groupBy("bucket").count().collect()} == {"dialogue": 4, "respond": 2}
    split = stages.split_sessions(drawn, {"train": 0.5, "val": 0.25, "test": 0.25}, 1)
    assert {r["split"]: r["count"] for r in split.groupBy("split").count().collect()} == {"train": 4, "val": 1, "test": 1}
    again = stages.split_sessions(stages.draw(pool, ratios, 8, 1), {"train": 0.5, "val": 0.25, "test": 0.25}, 1)
    assert sorted(split.select("id", "split").collect()) == sorted(again.select("id", "split").collect())


def test_draw_equals_sorting_each_bucket(spark):
    import hashlib

    rows = [(f"d{k % 700}", "ab"[k % 3 == 0], k) for k in range(2000)]
    pool = spark.createDataFrame(rows, "id string, bucket string, _pos long").union(spark.createDataFrame([("x", "other", 5000)], "id string, bucket string, _pos long"))
    got = {(r["bucket"], r["_pos"]) for r in stages.draw(pool, {"a": 0.5, "b": 0.5}, 1000, 7).collect()}
    want = set()
    for bucket in "ab":
        order = sorted((hashlib.sha256(f"7:{i}".encode()).hexdigest(), p) for i, b, p in rows if b == bucket)
        want |= {(bucket, p) for _, p in order[:500]}
    assert got == want
    assert stages.draw(pool, {"a": 0.0, "c": 1.0}, 10, 7).count() == 0

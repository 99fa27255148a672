import json
import random

import pytest
from pyspark.sql import functions as F

from dialoom.sources import extractors, formats, sinks


def got(spark, path, kind, fields, extractor="field", settings=None):
    rows = formats.read(spark, kind, str(path), fields)
    out = extractors.extract(rows, extractor, fields, settings, kind in formats.JSON_CELLS)
    return [r["text"] for r in out.orderBy("_row", "_field", "_item").collect()]


def test_tsv_and_csv(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("\ufeffinformal\tchat\tformal\n안녕\t하이\t안녕하세요\n\t뭐 해\tx\n\"q\tz\"\tw\tv\n", encoding="utf-8")
    assert got(spark, tmp_path / "a.tsv", "tsv", ["informal", "chat"]) == ["안녕", "하이", "뭐 해", "q\tz", "w"]
    (tmp_path / "a.csv").write_text('informal,chat\n"a, b",c\n"line\nbreak",d\n', encoding="utf-8")
    assert got(spark, tmp_path / "a.csv", "csv", ["informal"]) == ["a, b", "line\nbreak"]


def test_jsonl(spark, tmp_path):
    lines = [{"text": "<usr> 안녕 <bot> 응 <usr>뭐 해", "n": 1}, {"conv": [{"role": "User", "content": "u"}, {"role": "bot", "content": "b"}, {"content": "none"}]}, {"text": " plain "}]
    body = "\n".join(json.dumps(x, ensure_ascii=False) for x in lines)
    (tmp_path / "a.jsonl").write_text(body + "\n\n[1]\n", encoding="utf-8")
    path = tmp_path / "a.jsonl"
    assert got(spark, path, "jsonl", ["text"]) == ["<usr> 안녕 <bot> 응 <usr>뭐 해", "plain"]
    assert got(spark, path, "jsonl", ["n"]) == []
    pattern = {"pattern": r"<usr>\s*(.*?)\s*(?=<bot>|<usr>|$)"}
    assert got(spark, path, "jsonl", ["text"], "regex", pattern) == ["안녕", "뭐 해"]
    assert got(spark, path, "jsonl", ["conv"], "conversation", {"exclude_roles": ["BOT"]}) == ["u", "none"]
    assert got(spark, path, "jsonl", ["conv"], "conversation", {"include_roles": [""]}) == ["none"]
    (tmp_path / "bad.jsonl").write_text('{"text": "a"}\n{bad\n', encoding="utf-8")
    with pytest.raises(formats.SourceError):
        formats.read(spark, "jsonl", str(tmp_path / "bad.jsonl"), ["text"])


def test_json_lists(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"n": 1, "data": [{"dialog": ["a", "b", "c"]}, {"dialog": ["d"]}, 5]}), encoding="utf-8")
    path = tmp_path / "a.json"
    assert got(spark, path, "json", ["dialog"], "list", {"keep": "even"}) == ["a", "c", "d"]
    assert got(spark, path, "json", ["dialog"], "list", {"keep": "odd"}) == ["b"]
    with pytest.raises(formats.SourceError):
        got(spark, path, "json", ["dialog"], "list", {"keep": "some"})


def test_text_and_parquet(spark, tmp_path):
    (tmp_path / "a.txt").write_text("\ufeff one \n\n two\n", encoding="utf-8")
    assert got(spark, tmp_path / "a.txt", "text", ["line"]) == ["one", "two"]
    spark.createDataFrame([("a", "b")], "instruction string, output string").write.parquet(str(tmp_path / "p"))
    rows = formats.read(spark, "parquet", str(tmp_path / "p"), ["instruction"])
    assert rows.columns == ["_row", "instruction"]
    for fields in (["nope"],):
        with pytest.raises(formats.SourceError):
            formats.read(spark, "parquet", str(tmp_path / "p"), fields)
    with pytest.raises(formats.SourceError):
        formats.read(spark, "parquet", str(tmp_path / "missing"), ["x"])


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "나", None, 1), (0, "가", "x", 0)], "k int, a string, b string, _pos long")
    assert sinks.write_jsonl(df, tmp_path / "o.jsonl") == 2
    assert (tmp_path / "o.jsonl").read_text(encoding="utf-8") == '{"k":0,"a":"가","b":"x"}\n{"k":1,"a":"나","b":null}\n'
    sinks.write_table(df, str(tmp_path / "t"))
    with pytest.raises(Exception):
        sinks.write_table(df.selectExpr("raise_error('no') as x"), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
    assert sorted(p.name for p in tmp_path.iterdir()) == ["o.jsonl", "t"]


def test_positions_are_unique_and_in_order(spark, tmp_path):
    """Long lists, many fields, many partitions and many sources, against brute force."""
    from dialoom.operators import ledger, stages

    rng = random.Random(6)
    sources, raw = {}, None
    for rank in range(20):
        rows = [{f"f{k}": [f"t{rng.randrange(300)} of" for _ in range(600 if rank == 0 and row == 0 else rng.randint(0, 2))] for k in range(20 if rank < 2 else 1)} for row in range(3 if rank else 2)]
        sources[f"s{rank}"] = rows
        path = tmp_path / f"s{rank}.jsonl"
        path.write_text("\n".join(json.dumps(r) for r in rows), encoding="utf-8")
        fields = sorted({f for r in rows for f in r}, key=lambda f: int(f[1:]))
        texts = extractors.extract(formats.read(spark, "jsonl", str(path), fields), "list", fields, {"keep": "all"}, True)
        part = extractors.utterances(texts, f"s{rank}", "en", "cc0", None, rank)
        raw = part if raw is None else raw.unionByName(part)
    raw = raw.drop("_row", "_field", "_item")
    want = {}
    for name, rows in sources.items():
        for r in rows:
            for f in sorted(r, key=lambda f: int(f[1:])):
                want.setdefault(name, []).extend(r[f])
    rows = raw.orderBy("_pos").collect()
    assert [(r["source"], r["text"]) for r in rows] == [(n, t) for n, ts in want.items() for t in ts]
    assert len({tuple(r["_pos"]) for r in rows}) == len(rows)
    distinct = stages.distinct_utterances(stages.clean_utterances(raw, "en", 1, 60)).withColumn("_verdict", F.lit("in_scope"))
    got = stages.utterance_records(distinct, keep_index=True).orderBy("_pos").collect()
    assert [(r["source"], r["text"], r["_index"]) for r in got] == [(n, t, k) for n, ts in want.items() for k, t in enumerate(dict.fromkeys(ts))]


def test_positions_over_many_partitions(spark):
    from dialoom.operators import stages

    df = spark.range(0, 4000, 1, 200).select(F.monotonically_increasing_id().alias("_row"), F.lit(0).alias("_field"), F.lit(0).alias("_item"), F.concat(F.lit("t"), (F.col("id") % 900).cast("string")).alias("text"))
    both = extractors.utterances(df, "a", "en", "l", None, 0).unionByName(extractors.utterances(df, "b", "en", "l", None, 1))
    records = stages.utterance_records(stages.distinct_utterances(both).withColumn("_verdict", F.lit("in_scope")))
    rows = records.orderBy("_pos").collect()
    assert [(r["id"], r["text"]) for r in rows] == [(f"{s}-{k:06d}", f"t{k}") for s in "ab" for k in range(900)]


def test_a_failed_publication_keeps_the_old_table(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "k int")
    sinks.write_table(df, str(tmp_path / "t"))
    sinks.write_table(df.union(df), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_json_files_of_different_shapes(spark, tmp_path):
    (tmp_path / "many").mkdir()
    for name, value in (("b.json", {"n": [], "rows": [{"t": "never"}]}), ("a.json", [{"t": "one"}, {"t": "two"}, {"u": 1}]), ("c.json", {"meta": {"x": 1}, "rows": [{"t": "three"}]})):
        (tmp_path / "many" / name).write_text(json.dumps(value), encoding="utf-8")
    rows = formats.read(spark, "json", str(tmp_path / "many"), ["t"])
    assert got(spark, tmp_path / "many", "json", ["t"]) == ["one", "two", "three"]  # the first array of b is empty
    assert rows.select("_row").distinct().count() == rows.count() == 4
    (tmp_path / "none.json").write_text('{"a": 1}', encoding="utf-8")
    with pytest.raises(formats.SourceError):
        formats.read(spark, "json", str(tmp_path / "none.json"), ["t"])


def test_numbers_are_no_texts(spark, tmp_path):
    spark.createDataFrame([("a", 5, 1.5)], "s string, n int, x double").write.parquet(str(tmp_path / "p"))
    assert got(spark, tmp_path / "p", "parquet", ["n", "s", "x"]) == ["a"]
    assert got(spark, tmp_path / "p", "parquet", ["n"]) == []

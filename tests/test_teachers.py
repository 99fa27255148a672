import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from dialoom.operators import export, gate
from dialoom.sources import fetch, teachers
from dialoom.streaming.incremental import publish_stream

S = "id string, source string, scenario string, license string, generator array<string>, turns array<struct<role:string,text:string>>, _pos long"
GOOD = [("user", "안녕"), ("assistant", "응 좋아")]


class Endpoint(BaseHTTPRequestHandler):
    calls: dict = {}

    def log_message(self, *_):
        pass

    def _send(self, code, body):
        self.send_response(code)
        self.end_headers()
        self.wfile.write(json.dumps(body).encode())

    def do_GET(self):
        self._send(200, {"data": [{"id": "m"}]})

    def do_POST(self):
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        user = body["messages"][1]["content"]
        self.calls[user] = self.calls.get(user, 0) + 1
        if user == "missing":
            self._send(404, {})
        elif user == "flaky" and self.calls[user] == 1:
            self._send(500, {})
        else:
            self._send(200, {"choices": [{"message": {"content": f" {user}! "}}], "usage": {"completion_tokens": 3}})


@pytest.fixture
def endpoint():
    Endpoint.calls = {}
    server = HTTPServer(("127.0.0.1", 0), Endpoint)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def test_endpoint(spark, endpoint):
    t = teachers.ChatEndpoint(endpoint, "m", concurrency=3, api_key="k")
    t.check()
    with pytest.raises(ValueError):
        teachers.ChatEndpoint(endpoint, "other").check()
    asked = spark.createDataFrame([(x, "s", x) for x in ("a", "flaky", "missing")], "key string, system string, user string")
    got = {r["key"]: (r["text"], r["completion_tokens"]) for r in t.generate(asked).collect()}
    assert got == {"a": ("a!", 3), "flaky": ("flaky!", 3), "missing": (None, 0)}
    assert Endpoint.calls["missing"] == 1


def test_echo(spark):
    asked = spark.createDataFrame([("d", "", "상황: 첫 만남\n흐름: x\n길이: 친구 2번, 펫 2번"), ("t", "", "hello"), ("r", "", "놀자"), ("e", "", "")], "key string, system string, user string")
    got = {r["key"]: r["text"] for r in teachers.echo(asked).collect()}
    assert got["d"].count("U:") == 2 and got["d"].splitlines()[-1].startswith("A:")
    assert got["t"] == "같이 놀자, 5번째 말이야." and got["r"] == "응, 놀자 좋아."


def test_translate(spark):
    rows = [("hi", "s", "en", 0), ("안녕", "s", "ko", 1), ("gone", "s", "en", 2)]
    df = spark.createDataFrame(rows, "text string, source string, language string, _pos long")
    answer = lambda r: r.select("key", F.when(F.col("user") != "gone", F.upper("user")).alias("text"))
    got = [tuple(r) for r in teachers.translate(df, answer, "ko").orderBy("_pos").select("text", "language", "original_text", "original_language").collect()]
    assert got == [("HI", "ko", "hi", "en"), ("안녕", "ko", None, None), (None, "ko", "gone", "en")]


def test_fetch(tmp_path):
    (tmp_path / "a.csv").write_text("x\n1\n", encoding="utf-8")
    url = (tmp_path / "a.csv").as_uri()
    got = fetch.fetch("n", None, url, tmp_path / "cache")
    assert got.endswith("n.csv")
    (tmp_path / "a.csv").unlink()
    assert fetch.fetch("n", None, url, tmp_path / "cache") == got
    assert fetch.fetch("m", None, url, tmp_path / "cache") is None
    assert fetch.fetch("p", tmp_path / "none", None, tmp_path / "cache") is None


def test_length_report(spark):
    df = spark.createDataFrame([(k,) for k in range(1, 101)], "n int")
    r = export.length_report(df, "n").first()
    assert (r["count"], r["p50"], r["p95"], r["p99"], r["max"], r["cutoff_len"]) == (100, 50, 95, 99, 100, 99)
    assert export.length_report(df, "n", "tokens").first()["cutoff_len"] == 256
    empty = export.length_report(df.limit(0), "n").first()
    assert (empty["count"], empty["p99"], empty["cutoff_len"]) == (0, 0, 1)
    assert export.token_lengths(spark.createDataFrame([("a",)], "x string"), "x", "/nowhere.json") is None


def test_stream(spark, tmp_path):
    rows = [("a", "x", None, "l", ["m"], GOOD, 0), ("b", "x", None, "l", ["m"], GOOD, 1), ("c", "x", None, "l", ["m"], GOOD[:1], 2)]
    spark.createDataFrame(rows, S).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(S).parquet(str(tmp_path / "in"))
    publish_stream(stream, gate.gate(F.col("turns"), {}), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(60)
    assert [r["id"] for r in spark.read.parquet(str(tmp_path / "out/kept")).collect()] == ["a"]
    assert spark.read.parquet(str(tmp_path / "out/rejected")).count() == 2


def test_translation_is_asked_as_such(spark, endpoint):
    t = teachers.ChatEndpoint(endpoint, "m")
    rows = [("hello", "s", "en", 0), ("gone", "s", "ja", 1), ("안녕", "s", "ko", 2), ("empty", "s", "en", 3)]
    df = spark.createDataFrame(rows, "text string, source string, language string, _pos long")
    asked = []

    def answer(requests):
        asked.extend(requests.collect())
        said = F.when(F.col("user") == "hello", F.lit('\n A: "안녕 친구" \n설명: 인사')).when(F.col("user") == "empty", F.lit(' "" '))
        return requests.select("key", said.alias("text"), F.lit(1).alias("completion_tokens"))

    got = {r["_pos"]: (r["text"], r["original_text"], r["original_language"], r["language"]) for r in teachers.translate(df, answer, "ko").collect()}
    assert got == {0: ("안녕 친구", "hello", "en", "ko"), 1: (None, "gone", "ja", "ko"), 2: ("안녕", None, None, "ko"), 3: (None, "empty", "en", "ko")}
    systems = {r["user"]: r["system"] for r in asked}
    assert "영어" in systems["hello"] and "일본어" in systems["gone"] and all("한국어" in x for x in systems.values())
    over_http = teachers.translate(df, t.generate, "ko").where("original_text = 'hello'").first()
    assert over_http["text"] == "hello!"


def test_failures_are_told_apart(spark):
    from dialoom.operators import stages

    teacher = teachers.FakeTeacher({"a": "A: 응", "b": None, "c": ' "" '}, "U: 안녕\nA: 응")
    said = spark.createDataFrame([(k, "s", k) for k in "abcd"], "key string, system string, user string")
    answers = teacher.generate(said)
    users = spark.createDataFrame([(k,) for k in "abcde"], "id string")
    counts = stages.call_counts(stages.response_outcomes(users, answers)).first().asDict()
    assert counts == {"calls": 5, "teacher_error": 2, "unparseable": 0, "empty_reply": 1, "completion_tokens": 4 + 4 + 10}
    beats = said.select("key", F.lit(0).alias("beat_index"), F.lit("x").alias("beat"), F.lit(0).alias("n")).join(answers, "key")
    counts = stages.call_counts(stages.dialogue_outcomes(beats)).first().asDict()
    assert (counts["calls"], counts["teacher_error"], counts["unparseable"]) == (4, 1, 2)


def test_stream_drops_copies_of_earlier_batches(spark, tmp_path):
    turns = [[("user", f"u{k}"), ("assistant", f"a{k % 3}")] for k in range(4)]
    rows = [[("x0", "s", "c", "l", ["m"], turns[0], 0), ("x1", "s", "c", "l", ["m"], turns[1], 1)], [("x2", "s", "c", "l", ["m"], turns[1], 2), ("x3", "s", "c", "l", ["m"], turns[2], 3)]]
    for k, part in enumerate(rows):
        spark.createDataFrame(part, S).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        query = publish_stream(spark.readStream.schema(S).parquet(str(tmp_path / "in")), F.array().cast("array<string>"), str(tmp_path / "out"), str(tmp_path / "c"))
        query.awaitTermination()
    kept = spark.read.parquet(str(tmp_path / "out" / "kept"))
    assert sorted(r["id"] for r in kept.collect()) == ["x0", "x1", "x3"]
    lost = spark.read.parquet(str(tmp_path / "out" / "rejected")).collect()
    assert [(r["id"], r["_reject_reasons"]) for r in lost] == [("x2", ["duplicate"])]

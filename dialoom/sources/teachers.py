"""Teachers answer requests ``key, system, user`` with ``key, text, completion_tokens``.

The offline teacher is a column expression. The HTTP teacher runs inside mapInPandas with a bounded
thread pool per task; its answers are written once and read back, because a retried task would ask again.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import language_name, reply_text, strip

ANSWER = "key string, text string, completion_tokens int"

# How requests for dialogues begin and state their length; what the offline teacher says.
SITUATION_MARK = "상황:"
LENGTH_PATTERN = r"길이:\s*\S+\s+(\d+)번"
ECHO_QUESTION, ECHO_ANSWER = "{} 어때?", "응, {} 좋아."


def echo(requests: DataFrame) -> DataFrame:
    """A deterministic teacher for smoke runs: dialogues of the asked length, else one short line."""
    requests = requests.withColumn("_lines", F.filter(F.transform(F.split(F.col("user"), r"\R"), strip), lambda x: x != ""))
    lines = F.col("_lines")
    first, last = F.coalesce(F.get(lines, F.lit(0)), F.lit("")), F.coalesce(F.get(lines, F.size(lines) - 1), F.lit(""))
    situation = strip(F.regexp_replace(first, f"^{SITUATION_MARK}", ""))
    head = F.substring(situation, 1, 12)
    times = F.regexp_extract("user", LENGTH_PATTERN, 1).cast("int")
    turn = lambda i: F.concat(F.lit("U: "), head, F.lit(" "), i.cast("string"), F.lit("번째 어때?\nA: 응, "), head, F.lit(" "), i.cast("string"), F.lit("번째 좋아."))
    dialogue = F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(times, F.lit(1))), turn), "\n")
    translation = F.concat(F.lit("같이 놀자, "), F.char_length(last).cast("string"), F.lit("번째 말이야."))
    reply = F.concat(F.lit("응, "), F.substring(last, 1, 12), F.lit(" 좋아."))
    text = F.when(first.startswith(SITUATION_MARK) & (times > 0), dialogue).when(~last.rlike("[가-힣]"), translation).otherwise(reply)
    return requests.select("key", text.alias("text"), F.lit(8).alias("completion_tokens"))


class FakeTeacher:
    """Answers from a table of texts by request key, or one default; for tests of stages. A text of None is a failure."""

    def __init__(self, replies: Mapping[str, str | None] | None = None, default: str | None = ""):
        self.replies, self.default, self.checked = dict(replies or {}), default, False

    def check(self) -> None:
        self.checked = True

    def generate(self, requests: DataFrame) -> DataFrame:
        said = requests.sparkSession.createDataFrame(list(self.replies.items()) or [("", None)], "_key string, _text string")
        joined = requests.join(said, F.col("key") == F.col("_key"), "left")
        text = F.when(F.col("_key").isNotNull(), F.col("_text")).otherwise(F.lit(self.default))
        return joined.select("key", text.alias("text"), F.coalesce(F.char_length(text), F.lit(0)).alias("completion_tokens"))


class ChatEndpoint:
    """An endpoint that speaks the chat-completions protocol."""

    def __init__(self, base_url: str, model: str, timeout: float = 60.0, retries: int = 2, concurrency: int = 8, max_tokens: int = 512, temperature: float = 0.8, top_p: float = 0.95, api_key: str | None = None):
        self.base_url, self.model, self.timeout = base_url.rstrip("/"), model, timeout
        self.retries, self.concurrency, self.max_tokens, self.temperature = retries, concurrency, max_tokens, temperature
        self.top_p, self.api_key = top_p, api_key

    def _call(self, path: str, body: dict | None = None) -> dict:
        data = json.dumps(body).encode() if body is not None else None
        headers = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {self.api_key}"} if self.api_key else {})
        request = urllib.request.Request(f"{self.base_url}{path}", data, headers)
        with urllib.request.urlopen(request, timeout=self.timeout) as answer:
            return json.load(answer)

    def check(self) -> None:
        """On the driver, before anything is generated: the endpoint must list the model."""
        names = [m.get("id") for m in self._call("/v1/models").get("data", [])]
        if self.model not in names:
            raise ValueError(f"the endpoint has no model {self.model!r}; it lists {names}")

    def ask(self, system: str, user: str) -> tuple[str | None, int]:
        """Text and completion tokens; null text after the last failed attempt. A 404 is final."""
        messages = [{"role": "system", "content": system}, {"role": "user", "content": user}]
        for attempt in range(self.retries + 1):
            try:
                got = self._call("/v1/chat/completions", {"model": self.model, "messages": messages, "max_tokens": self.max_tokens, "temperature": self.temperature, "top_p": self.top_p})
                return got["choices"][0]["message"]["content"].strip(), int(got.get("usage", {}).get("completion_tokens", 0))
            except urllib.error.HTTPError as e:
                if e.code == 404:
                    return None, 0
            except (OSError, ValueError, KeyError, IndexError, AttributeError):
                pass
            if attempt < self.retries:
                time.sleep(1 + attempt)
        return None, 0

    def generate(self, requests: DataFrame) -> DataFrame:
        """Answers in a lazy plan; write them before use."""

        def run(batches: Iterator) -> Iterator:
            with ThreadPoolExecutor(self.concurrency) as pool:
                for pdf in batches:
                    got = list(pool.map(self.ask, pdf["system"], pdf["user"]))
                    yield pdf[["key"]].assign(text=[t for t, _ in got], completion_tokens=[n for _, n in got])

        return requests.select("key", "system", "user").mapInPandas(run, ANSWER)


def translate_system(source: Column, target: Column) -> Column:
    """What a translating teacher is told, by language codes."""
    return F.format_string("%s 문장을 %s 구어체로 자연스럽게 옮긴다.\n뜻만 옮기고 한 줄만 쓴다. 설명, 따옴표, 역할 표기는 쓰지 않는다.", language_name(source), language_name(target))


def translate_user(text: Column) -> Column:
    return text


def translate(utterances: DataFrame, answer, target: str) -> DataFrame:
    """Texts of other languages through the teacher: ``text`` replaced, the original kept; failed ones null.

    ``answer`` takes requests and gives answers. The system message names both languages; of the answer the first
    line counts, without role label and quotes. Rows already in the target language pass by.
    """
    foreign = utterances.where(F.col("language") != target).withColumn("_key", F.concat_ws(":", "source", F.col("_pos").cast("string")))
    system = translate_system(F.col("language"), F.lit(target))
    asked = foreign.select(F.col("_key").alias("key"), system.alias("system"), translate_user(F.col("text")).alias("user"))
    got = answer(asked).select(F.col("key").alias("_of"), reply_text(F.col("text")).alias("_new"))
    got = got.withColumn("_new", F.when(F.col("_new") != "", F.col("_new")))
    done = foreign.join(got, F.col("_key") == F.col("_of"), "left")
    done = done.withColumn("original_text", F.col("text")).withColumn("original_language", F.col("language")).withColumn("text", F.col("_new")).withColumn("language", F.lit(target))
    own = utterances.where(F.col("language") == target).withColumn("original_text", F.lit(None).cast("string")).withColumn("original_language", F.lit(None).cast("string"))
    return own.unionByName(done.drop("_key", "_of", "_new"))

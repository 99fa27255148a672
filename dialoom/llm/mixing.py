"""Mixing by soft membership: domain posteriors, and document rates that meet domain token totals.

A classifier learned from the labelled table gives every document a probability for each domain. With
``t`` tokens and posterior ``p``, a document kept at rate ``r`` adds ``r * t * p[d]`` expected tokens to
domain ``d``. The rates are the non-negative ones nearest to 1, in the metric of the documents' tokens,
whose expected totals are the targets; where no rates meet them, those of the least squares
``sum_d (expected[d] - target[d])**2 / target[d]``. They have the form ``max(0, 1 + p . dual)`` with one
vector of as many numbers as there are domains. Newton's method finds it: each step is one distributed
sum, and no rate is ever stored or sent to the driver. It goes on until every total is within the
tolerance of its target, or the duality gap proves the sum of squares least (to 1e-3 of it at worst),
which warns; it raises if neither is reached.
"""

from __future__ import annotations

import math
import re
import warnings

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_schema, map_arrow, materialise, struct_of, table, texts

#: Domains are the combinations of the labels; the weights are the wanted shares of tokens.
DOMAINS = ("good_clean", "poor_clean", "good_toxic", "poor_toxic")
TARGET_WEIGHTS = (0.90, 0.08, 0.015, 0.005)
#: Labelled rows to learn from at most, chosen by a hash of the id.
SAMPLE_ROWS = 8_000
#: Passes at most, and how far an expected total may be off as a share of its target.
STEPS, TOLERANCE = 60, 1e-3
#: Targets below this share of all tokens count as this share when a miss is weighed.
LEAST_SHARE = 1e-6
#: Where the weight of the rates' distance from 1 ends; the rounding of numbers bounds it.
LEAST_WEIGHT = 1e-12
HASHED = 256

_WORD = re.compile(r"[^\W\d_]+")


def features_of(text: str) -> np.ndarray:
    """Shape of a text and a hashed profile of its words' letter pairs; length does not enter it directly."""
    words = text.split()
    n, chars = max(1, len(words)), max(1, len(text))
    lines = text.split("\n")
    letters = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    pairs = (letters[:-1] * np.uint64(0x9E3779B97F4A7C15) + letters[1:] * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(40)
    profile = np.bincount((pairs & np.uint64(HASHED - 1)).astype(np.int64), minlength=HASHED).astype(np.float64)
    profile = np.sqrt(profile / max(1, len(pairs)))
    alphabetic = sum(map(len, _WORD.findall(text)))
    shape = [
        alphabetic / chars,
        sum(map(str.isdigit, text)) / chars if any(c in text for c in "0123456789") else 0.0,
        len(set(words)) / n,
        chars / n / 10,
        len(set(lines)) / len(lines),
        math.log1p(n) / 10,
        math.log1p(chars / len(lines)) / 10,
        float(text.isupper()),
    ]
    return np.concatenate([[1.0], shape, profile])


class Softmax:
    """Linear classifier with one weight row per domain."""

    def __init__(self, weights: np.ndarray, centre: np.ndarray, scale: np.ndarray):
        self.weights, self.centre, self.scale = weights, centre, scale

    def posteriors(self, x: np.ndarray) -> np.ndarray:
        z = ((x - self.centre) / self.scale) @ self.weights.T
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def _train(x: np.ndarray, y: np.ndarray, k: int, ridge: float = 1e-3, rounds: int = 300) -> Softmax:
    """Multinomial logistic regression by accelerated gradient descent."""
    centre, scale = x.mean(axis=0), x.std(axis=0)
    centre[0], scale[0] = 0.0, 1.0
    scale[scale < 1e-9] = 1.0
    model = Softmax(np.zeros((k, x.shape[1])), centre, scale)
    z = (x - centre) / scale
    wanted = np.eye(k)[y]
    rate = 1.0 / (0.5 * np.linalg.norm(z, 2) ** 2 / len(z) + ridge)
    look, before = model.weights.copy(), model.weights.copy()
    for step in range(rounds):
        s = z @ look.T
        p = np.exp(s - s.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        now = look - rate * ((p - wanted).T @ z / len(z) + ridge * look)
        look = now + step / (step + 3) * (now - before)
        before = now
    model.weights = before
    return model


SAMPLE = T.StructType([T.StructField("domain", T.IntegerType()), T.StructField("x", T.BinaryType())])


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Softmax:
    """Learn domain posteriors from ``labels`` (doc_id, quality, toxic); rows with nulls teach nothing."""
    domain = (F.when(F.col("quality") > 0, 0).otherwise(1) + F.when(F.col("toxic") > 0, 2).otherwise(0)).cast("int")
    chosen = labels.where("doc_id is not null and quality is not null and toxic is not null").select(F.col("doc_id").alias("_id"), domain.alias("domain"))
    chosen = chosen.orderBy(F.xxhash64("_id", F.lit(31)), "_id").limit(sample_rows)
    sample = docs.select(F.col("doc_id").alias("_doc"), F.col("text").cast("string").alias("text"))
    sample = sample.join(F.broadcast(chosen), F.col("_doc") == F.col("_id")).select("domain", "text")  # sample_rows rows of two numbers

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        cols = [batch.column("domain"), pa.array([features_of(t).astype(np.float32).tobytes() for t in texts(batch)], pa.binary())]
        return pa.RecordBatch.from_arrays(cols, schema=arrow_schema(SAMPLE))

    got = sorted((r["domain"], bytes(r["x"])) for r in map_arrow(sample, run, SAMPLE).collect())
    if not got:
        size = len(features_of(""))
        return Softmax(np.zeros((len(DOMAINS), size)), np.zeros(size), np.ones(size))
    x = np.frombuffer(b"".join(b for _, b in got), np.float32).reshape(len(got), -1).astype(np.float64)
    return _train(x, np.array([d for d, _ in got]), len(DOMAINS))


MEMBERSHIP = struct_of("doc_id long, row long, tokens long, posterior array<double>")
SUMS = struct_of("value array<double>")


def memberships(docs: DataFrame, model: Softmax) -> DataFrame:
    """``doc_id, row, tokens, posterior`` of every row; tokens are white-space words of the whole text."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = texts(batch)
        p = model.posteriors(np.array([features_of(t) for t in rows]))
        cols = [batch.column("doc_id"), batch.column("row"), pa.array([len(t.split()) for t in rows]), pa.array(list(p), pa.list_(pa.float64()))]
        return pa.RecordBatch.from_arrays(cols, schema=arrow_schema(MEMBERSHIP))

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "row", F.col("text").cast("string").alias("text")), run, MEMBERSHIP)


def _matrix(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    p = batch.column("posterior").flatten().to_numpy().reshape(batch.num_rows, -1)
    return batch.column("tokens").to_numpy().astype(float), p


def _rates(p: np.ndarray, dual: np.ndarray) -> np.ndarray:
    return np.maximum(0.0, 1.0 + p @ dual)


def _total(member: DataFrame, fn) -> tuple[np.ndarray, np.ndarray]:
    """Sum and maximum of a vector that ``fn`` makes of each batch, found on the executors."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([fn(*_matrix(batch)).ravel().tolist()], pa.list_(pa.float64()))], schema=arrow_schema(SUMS))

    parts = map_arrow(member.select("tokens", "posterior"), run, SUMS)
    rows = parts.select(F.posexplode("value").alias("k", "v")).groupBy("k").agg(F.sum("v").alias("v"), F.max("v").alias("most")).collect()  # one row a number of the vector
    rows.sort(key=lambda r: r["k"])
    return np.array([r["v"] for r in rows]), np.array([r["most"] for r in rows])


def _measure(member: DataFrame, dual: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """At these rates: expected totals, their derivative, and the largest ``p . dual`` of a document with tokens."""
    k = len(dual)

    def fn(t: np.ndarray, p: np.ndarray) -> np.ndarray:
        r = _rates(p, dual)
        return np.concatenate([(t * r) @ p, ((p * (t * (r > 0))[:, None]).T @ p).ravel(), [np.max(p @ dual, initial=-math.inf, where=t > 0)]])

    sums, most = _total(member, fn)
    if not len(sums):
        return np.zeros(k), np.zeros((k, k)), 0.0
    return sums[:k], sums[k : k + k * k].reshape(k, k), float(most[-1])


def solve_rates(member: DataFrame, weights: tuple[float, ...], steps: int = STEPS, tolerance: float = TOLERANCE, relative: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vector that gives the rates, expected totals at these rates, and the targets.

    Warns if no rates meet the targets; raises if ``steps`` passes settle neither.
    """
    k = len(weights)
    dual = np.zeros(k)
    now, slope, most = _measure(member, dual)
    n = now.sum()
    if n <= 0:
        return dual, np.zeros(k), np.zeros(k)
    share = np.array(weights) * (now if relative else 1.0)
    target = share / share.sum()
    floor = np.maximum(target, LEAST_SHARE)
    scale = 1 / np.sqrt(floor)
    now, slope = now / n, slope / n
    # the dual of: a weight times the squared distance of the rates from 1, plus the least squares
    weight, passes = 1e-2, 1
    while True:
        miss = (now - target) / floor
        if np.abs(miss).max() < tolerance:
            break
        # no rates have a sum of squares below this bound, as p . bound is not negative for any document
        bound = weight * (max(0.0, most) - dual)
        squares = 0.5 * (floor * miss * miss).sum()
        if squares + 0.5 * (floor * bound * bound).sum() + bound @ target <= max(0.5 * tolerance**2 * floor.min(), (tolerance**2 if weight > LEAST_WEIGHT else tolerance) * squares):
            warnings.warn(f"no rates meet the targets {(target * n).tolist()}; the nearest expected totals are {(now * n).tolist()}", stacklevel=2)
            break
        slant = now - target + weight * floor * dual
        if math.sqrt((slant * slant / floor).sum()) < 0.1 * math.sqrt((floor * miss * miss).sum()):
            weight = max(weight / 10, LEAST_WEIGHT)
            slant = now - target + weight * floor * dual
        way = -scale * np.linalg.solve(scale[:, None] * slope * scale + weight * np.eye(k), scale * slant)
        length = 1.0
        while True:
            if passes >= steps:
                raise RuntimeError(f"rates not settled after {steps} passes: expected totals {(now * n).tolist()}, targets {(target * n).tolist()}")
            ahead = dual + length * way
            now, slope, most = _measure(member, ahead)
            passes += 1
            now, slope = now / n, slope / n
            # convex: uphill at the end of the step means that it went too far; its slope has no cancellation, unlike its value
            uphill, downhill = (now - target + weight * floor * ahead) @ way, -(slant @ way)
            if uphill <= 0.5 * downhill:
                break
            length *= max(0.1, downhill / (downhill + uphill))
        dual = ahead
    return dual, now * n, target * n


RATED = struct_of("doc_id long, row long, tokens long, domain string, posterior array<double>, rate double")


def mix(docs: DataFrame, labels: DataFrame, weights: tuple[float, ...] = TARGET_WEIGHTS, relative: bool = False) -> DataFrame:
    """``doc_id, row, tokens, domain, posterior, rate, copies`` of every row of ``docs`` (doc_id, row, text).

    ``weights`` are the domains' shares of the tokens or, if ``relative``, factors of their present shares.
    ``copies`` is the rate rounded down or up by a seeded hash of the id, so that its expectation is the
    rate. Null and empty texts have no tokens and get the rate of their posterior; repeated rows and ties are
    rated alike, and rows of one id, or of none, are rounded alike; with an empty table there is no row; with no
    usable label all domains are equally likely. Texts of any length are read whole; columns other than the
    three named are not read, so names that clash do no harm.
    """
    member = materialise(memberships(docs, fit(docs, labels)), "mix-members")
    dual, _, _ = solve_rates(member, weights, relative=relative)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        _, p = _matrix(batch)
        names = pa.array([DOMAINS[k] for k in p.argmax(axis=1)])
        cols = [*(batch.column(c) for c in ("doc_id", "row", "tokens")), names, batch.column("posterior"), pa.array(_rates(p, dual))]
        return pa.RecordBatch.from_arrays(cols, schema=arrow_schema(RATED))

    draw = F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(-1)), F.lit(41)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return map_arrow(member, run, RATED).withColumn("copies", F.floor(F.col("rate") + draw).cast("int"))


def op8_soft_mixing(spark, sf_dir: str) -> DataFrame:
    """``mix`` of ``documents`` to the targets above, a row a document; cases as stated there."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.lit(0).cast("long").alias("row"), "text")
    out = mix(docs, table(spark, sf_dir, "labels"))
    return out.select("doc_id", "tokens", "domain", *(F.col("posterior")[k].alias(f"p_{n}") for k, n in enumerate(DOMAINS)), "rate", "copies")

"""Language identification by nearest centroid over character n-grams.

A text's vector holds TF-IDF weights of its hashed letter n-grams (lengths 1 to 3, word edges marked),
scaled to length one. Each language has several centroids, found by spherical k-means over its part of a
bounded, seeded training sample. A text goes to the language of the centroid with the highest cosine; it
is marked as rejected if even that one is farther away than training texts of the language lie.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, discard, fold_of, map_arrow, materialise, struct_of, table, texts

#: Hash space of n-grams, centroids a language, and training texts a language (chosen by a hash of the id).
DIMENSIONS = 1 << 13
CENTROIDS = 3
SAMPLE_PER_LANGUAGE = 1500
#: With more languages than this, fitting fails: the model that every executor gets has 100 kB a language.
MAX_LANGUAGES = 2000
#: A text is rejected below this quantile of its centroid's training cosines, less a margin.
REJECT_QUANTILE, REJECT_MARGIN = 0.005, 0.05
UNKNOWN = "und"

_NOT_LETTERS = re.compile(r"[\W\d_]+")


def gram_counts(text: str, dimensions: int = DIMENSIONS) -> np.ndarray | None:
    """Counts of hashed n-grams of the text's words; None without a letter (numerals such as Ⅳ, ½ or ① are none)."""
    words = _NOT_LETTERS.sub(" ", text.lower()).strip()
    if not any(map(str.isalpha, words)):
        return None
    codes = np.frombuffer(f" {words} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    out = np.zeros(dimensions, np.float32)
    space = codes == 32
    mask = np.uint64(dimensions - 1)
    key = np.zeros(len(codes), np.uint64)
    for n in (1, 2, 3):
        key = key[: len(codes) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1 :] + np.uint64(n)
        if n == 1:
            use = key[~space]
        else:
            use = key if n == 2 else key[~space[1:-1]]  # no n-gram reaches over a word's edge
        mixed = use ^ (use >> np.uint64(29))
        mixed = (mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(32)
        out += np.bincount((mixed & mask).astype(np.int64), minlength=dimensions)
    return out


class Centroids:
    """IDF weights, unit centroids with their language, and each one's rejection bound."""

    def __init__(self, languages: list[str], idf: np.ndarray, centres: np.ndarray, owner: np.ndarray, bound: np.ndarray):
        self.languages, self.idf, self.centres, self.owner, self.bound = languages, idf, centres, owner, bound

    def vectors(self, counts: list[np.ndarray]) -> np.ndarray:
        x = np.log1p(np.array(counts)) * self.idf
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)

    def predict(self, texts_: list[str]) -> list[tuple[str, float, bool]]:
        """Language, score and whether it is rejected; ``und``, 0 and true without a letter."""
        out: list[tuple[str, float, bool]] = [(UNKNOWN, 0.0, True)] * len(texts_)
        for first in range(0, len(texts_), 64):
            part = [(k, c) for k in range(first, min(first + 64, len(texts_))) if (c := gram_counts(texts_[k], len(self.idf))) is not None]
            if not part or not self.languages:
                continue
            cosine = self.vectors([c for _, c in part]) @ self.centres.T
            best = cosine.argmax(axis=1)
            for row, (k, _) in enumerate(part):
                b = int(best[row])
                top = float(min(1.0, max(0.0, cosine[row, b])))
                out[k] = (self.languages[self.owner[b]], top, bool(cosine[row, b] < self.bound[b]))
        return out


def _k_means(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 20) -> np.ndarray:
    """Unit centroids of unit rows by spherical k-means with farthest-first seeds."""
    centres = [x[int(rng.integers(len(x)))]]
    while len(centres) < min(k, len(x)):
        nearest = (x @ np.array(centres).T).max(axis=1)
        if nearest.min() > 1 - 1e-6:
            break
        centres.append(x[int(nearest.argmin())])
    c = np.array(centres)
    for _ in range(rounds):
        label = (x @ c.T).argmax(axis=1)
        new = np.array([x[label == j].sum(axis=0) if (label == j).any() else c[j] for j in range(len(c))])
        new /= np.maximum(np.linalg.norm(new, axis=1, keepdims=True), 1e-12)
        if np.allclose(new, c):
            break
        c = new
    return c


COUNTED = struct_of("lang string, counts binary")
PRESENCE = struct_of("present array<long>")
CENTRE = struct_of("lang string, centre binary, bound double")


def _sample(docs: DataFrame, per_language: int) -> DataFrame:
    """``text, lang``: about ``per_language`` texts of each language, or all, chosen by a hash of the id."""
    usable = docs.where("lang is not null and text is not null and doc_id is not null").select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    sizes = usable.groupBy(F.col("lang").alias("_lang")).agg((F.lit(float(per_language)) / F.count("*")).alias("share"))
    sizes = materialise(sizes, "langid-sizes")
    if (n := sizes.count()) > MAX_LANGUAGES:
        raise ValueError(f"{n} languages; at most {MAX_LANGUAGES} can be learned")
    draw = F.pmod(F.xxhash64("doc_id", F.lit(23)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # a row a language: MAX_LANGUAGES bounds what is broadcast
    return usable.join(F.broadcast(sizes), F.col("lang") == F.col("_lang")).where(draw < F.col("share")).select("text", "lang")


def _language_centres(idf: np.ndarray, k: int):
    """Centroids of one language's sample and their rejection bounds."""

    def run(group: pa.Table) -> pa.Table:
        got = sorted(group.column("counts").to_pylist())
        x = np.frombuffer(b"".join(got), np.float16).reshape(len(got), len(idf)).astype(np.float32) * idf
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
        centres = _k_means(x, k, np.random.default_rng(5))
        cosine = x @ centres.T
        label = cosine.argmax(axis=1)
        bounds = []
        for j in range(len(centres)):
            own = cosine[label == j, j]
            bounds.append(float(np.quantile(own, REJECT_QUANTILE)) - REJECT_MARGIN if len(own) else 0.0)
        out = [[group.column("lang")[0].as_py()] * len(centres), [c.astype(np.float32).tobytes() for c in centres], bounds]
        schema = arrow_schema(CENTRE)
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)

    return run


def fit(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, k: int = CENTROIDS, dimensions: int = DIMENSIONS) -> Centroids:
    """Learn from ``doc_id, text, lang``; rows without an id, a language or a letter teach nothing.

    The sample of a language is one task's group, ``per_language`` vectors; the driver gets the centroids alone.
    """
    if dimensions & (dimensions - 1):
        raise ValueError("dimensions must be a power of two")

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [(x, c) for t, x in zip(texts(batch), batch.column("lang").to_pylist(), strict=True) if (c := gram_counts(t, dimensions)) is not None]
        cols = [pa.array([x for x, _ in rows], pa.string()), pa.array([np.log1p(c).astype(np.float16).tobytes() for _, c in rows], pa.binary())]
        return pa.RecordBatch.from_arrays(cols, schema=arrow_schema(COUNTED))

    def present(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = np.frombuffer(b"".join(batch.column("counts").to_pylist()), np.float16).reshape(batch.num_rows, dimensions)
        sums = np.r_[batch.num_rows, (x > 0).sum(axis=0)].astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array([sums], pa.list_(pa.int64()))], schema=arrow_schema(PRESENCE))

    counted = materialise(map_arrow(_sample(docs, per_language), count, COUNTED), "langid-sample")
    sums = map_arrow(counted, present, PRESENCE).select(F.posexplode("present").alias("at", "n")).groupBy("at").agg(F.sum("n").alias("n"))
    found = {r["at"]: r["n"] for r in sums.collect()}  # a number a dimension
    if not found:
        discard(counted)
        return Centroids([], np.ones(dimensions, np.float32), np.zeros((0, dimensions)), np.zeros(0, int), np.zeros(0))
    presence = np.array([found[j + 1] for j in range(dimensions)], float)
    idf = (np.log((1 + found[0]) / (1 + presence)) + 0.1).astype(np.float32)
    centres = counted.groupBy("lang").applyInArrow(_language_centres(idf, k), CENTRE).collect()
    centres.sort(key=lambda r: (r["lang"], bytes(r["centre"])))
    discard(counted)
    languages = sorted({r["lang"] for r in centres})
    vectors = np.array([np.frombuffer(r["centre"], np.float32) for r in centres])
    return Centroids(languages, idf, vectors, np.array([languages.index(r["lang"]) for r in centres]), np.array([r["bound"] for r in centres]))


PREDICTED = struct_of("doc_id long, lang_pred string, score double, rejected boolean")


def identify(docs: DataFrame, model: Centroids) -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` for every row from its whole text.

    Null texts and texts without a letter are ``und`` with score 0; of centroids with the same cosine the first
    language in the alphabet counts. Repeated rows are answered each; an empty table gives none; columns other
    than doc_id and text are not read, so names that clash do no harm; texts of any length are read whole.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # MAX_LANGUAGES * CENTROIDS * DIMENSIONS numbers at most

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        got = shared.value.predict(texts(batch))
        cols = [batch.column("doc_id"), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got]), pa.array([g[2] for g in got])]
        return pa.RecordBatch.from_arrays(cols, schema=arrow_schema(PREDICTED))

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), run, PREDICTED)


def op9_language_id(spark, sf_dir: str) -> DataFrame:
    """``identify`` for ``documents`` with a model of the training folds; cases as stated there and at ``fit``."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(fold_of("doc_id", 4) != 2).select("doc_id", "text", "lang"))
    out = identify(docs, model)
    return out.select("doc_id", (fold_of("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")

"""Toxicity by a weighted lexicon: folding, Aho-Corasick, exception phrases, length normalisation.

Text is folded (case, compatibility forms, combining marks, homoglyphs, digits and signs inside words),
then one automaton finds all lexicon terms. Terms are anchored at word starts: whole words, and
beginnings of longer words, which catches families of words that share a stem. An exception, a word or a
phrase of two words, that covers a match cancels it. The weights of the remaining matches are summed and
normalised by the text's length; a logistic curve turns sum, density and count into a score.

Terms, weights, exceptions and curve are learned from a bounded, seeded sample of labelled rows, SAMPLE_ROWS;
nothing else limits the lexicon but the evidence a term needs. All documents are scored over their whole text.
"""

from __future__ import annotations

import functools
import math
import re
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, fold_of, map_arrow, struct_of, table, texts

#: At most this many labelled rows are learned from, chosen by a hash of the id.
SAMPLE_ROWS = 12_000
#: A term needs this many documents and this much evidence (a log-likelihood ratio).
LEAST_DOCS, LEAST_EVIDENCE = 3, 16.0
#: Lengths of word beginnings that may be terms.
STEM_MIN, STEM_MAX = 3, 10

# Letters of other scripts that look like Latin ones, and digits or signs used for letters.
HOMOGLYPHS = dict(zip("авеԁіјкӏмһорԛгѕтуѵԝхсαβεικνορτυχωᴏ", "abedijklmhopqrstyvwxcabeiknoptuxwo", strict=True))
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}

_HOMOGLYPH_TABLE = str.maketrans(HOMOGLYPHS)
_HOMOGLYPH = re.compile(f"[{''.join(HOMOGLYPHS)}]")
_DIGIT_TABLE = str.maketrans(DIGITS)
#: Substitutes inside a word, at its start before a letter, and digits at its end after one.
_LEET = re.compile(r"(?<=[^\W\d_])[\d@$!]+(?=[^\W_])|(?<![^\W_])[\d@$!]+(?=[^\W\d_])|(?<=[^\W\d_])\d+")
_BREAK = re.compile(r"[\W_]+")
_HIDDEN = regex.compile("[\u00ad\u200b-\u200f\u2060\ufeff\\p{Mn}]+")


def fold(text: str) -> str:
    """The text as lower-case words between single spaces, with disguises undone."""
    if not text.isascii():
        # marks go, on whatever letter they stand; what is no mark, as Hangul, is put together again
        text = unicodedata.normalize("NFC", _HIDDEN.sub("", unicodedata.normalize("NFKD", text)))
        if _HOMOGLYPH.search(text.lower()):
            text = text.lower().translate(_HOMOGLYPH_TABLE)
    text = text.lower()
    if any(c in text for c in DIGITS):
        text = _LEET.sub(lambda m: m[0].translate(_DIGIT_TABLE), text)
    return f" {_BREAK.sub(' ', text).strip()} "


def features_of(folded: str) -> set[str]:
    """Whole words (`` word ``) and proper word beginnings (`` wor``) of a folded text."""
    out = set()
    for word in set(folded.split()):
        out.add(f" {word} ")
        for n in range(STEM_MIN, min(STEM_MAX, len(word) - 1) + 1):
            out.add(f" {word[:n]}")
    return out


def _evidence(toxic: int, clean: int, n_toxic: int, n_clean: int) -> float:
    """Signed log-likelihood ratio of a term's document counts in the two classes."""
    total, share = toxic + clean, n_toxic / (n_toxic + n_clean)
    expected = total * share
    g = 2 * sum(o * math.log(o / e) for o, e in ((toxic, expected), (clean, total - expected)) if o and e)
    return g if toxic > expected else -g


class Lexicon:
    """Terms with weights, exception phrases, and the curve from sums to scores."""

    def __init__(self, weights: dict[str, float], exceptions: list[str] = (), curve: list[float] | None = None):
        self.weights = dict(weights)
        self.exceptions = [f" {e.strip()} " for e in exceptions]
        self.curve = curve
        self._automaton = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_automaton": None}

    def _build(self):
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            automaton.add_word(term, (len(term), weight))
        for phrase in self.exceptions:  # a phrase that is also a term cancels it
            automaton.add_word(phrase, (len(phrase), None))
        if len(automaton):
            automaton.make_automaton()
        self._automaton = automaton
        return automaton

    def matches(self, folded: str) -> list[float]:
        """Weights of the words hit, the heaviest term of each word, without what exceptions cover."""
        return list(self.hits(folded).values())

    def hits(self, folded: str) -> dict[int, float]:
        """The same by the place of the space before the word."""
        automaton = self._automaton if self._automaton is not None else self._build()
        if not len(automaton):
            return {}
        hits: dict[int, float] = {}
        covered: list[tuple[int, int]] = []
        for end, (size, weight) in automaton.iter(folded):
            start = end - size + 1
            if weight is None:
                covered.append((start, end))
            elif weight > hits.get(start, 0.0):
                hits[start] = weight
        if covered and hits:
            covered.sort()
            end, k, left = -1, 0, {}
            for s in sorted(hits):  # one sweep: the furthest end of the phrases that begin at or before this place
                while k < len(covered) and covered[k][0] <= s:
                    end = max(end, covered[k][1])
                    k += 1
                if s >= end:
                    left[s] = hits[s]
            hits = left
        return hits

    def features(self, text: str) -> list[float]:
        folded = fold(text)
        found = self.matches(folded)
        words = max(1, folded.count(" ") - 1)
        return [math.log1p(sum(found)), math.sqrt(sum(found) / words), math.log1p(len(found)), max(found, default=0.0)]

    def score(self, text: str) -> float:
        c = self.curve or [-3.0, 1.0, 1.0, 1.0, 0.0]
        z = c[0] + sum(a * b for a, b in zip(c[1:], self.features(text), strict=True))
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 60) -> list[float]:
    """Ridge logistic regression by Newton steps; slopes of evidence for toxicity do not go below zero."""
    x = np.c_[np.ones(len(x)), x]
    b = np.zeros(x.shape[1])
    active = np.ones(x.shape[1], bool)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -40, 40)))
        g = x.T @ (y - p) - ridge * np.r_[0, b[1:]]
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag(np.r_[1e-6, np.full(len(b) - 1, ridge)])
        step = np.zeros(len(b))
        step[active] = np.linalg.solve(h[np.ix_(active, active)], g[active])
        b = b + step
        low = np.r_[False, b[1:] < 0]
        b[low] = 0
        active &= ~low
        if np.abs(step).max() < 1e-8:
            break
    return b.tolist()


COUNTS = struct_of("term string, toxic long, clean long")
POINT = struct_of("toxic int, f0 double, f1 double, f2 double, f3 double")


def phrases_of(folded: str, hits: dict[int, float]) -> set[str]:
    """The words hit, each with the word before and with the word after."""
    out = set()
    for at in hits:
        end = folded.index(" ", at + 1)
        if at:
            out.add(folded[folded.rindex(" ", 0, at) : end + 1])
        if end + 1 < len(folded):
            out.add(folded[at : folded.index(" ", end + 1) + 1])
    return out


def _counts(sample: DataFrame, features) -> DataFrame:
    """In how many toxic and clean texts of the sample each of a text's features is: ``term, toxic, clean``."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        both = (Counter(), Counter())
        for text, toxic in zip(texts(batch), batch.column("toxic").to_pylist(), strict=True):
            both[1 - toxic].update(features(fold(text)))
        terms = list(both[0].keys() | both[1].keys())
        cols = [pa.array(terms, pa.string()), *(pa.array([c[t] for t in terms], pa.int64()) for c in both)]
        return pa.RecordBatch.from_arrays(cols, schema=arrow_schema(COUNTS))

    return map_arrow(sample, count, COUNTS).groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Lexicon:
    """Learn a lexicon from the rows of ``labels`` (doc_id, toxic), all of which may be used; toxic is a number over 0.

    Rows with a null id or label teach nothing. Without a label of either kind the lexicon is empty. Which rows
    are learned from, and what from them, does not depend on the order of the tables.
    """
    chosen = labels.where("doc_id is not null and toxic is not null").select(F.col("doc_id").alias("_id"), F.when(F.col("toxic") > 0, 1).otherwise(0).alias("toxic"))
    chosen = chosen.orderBy(F.xxhash64("_id", F.lit(11)), "_id", "toxic").limit(sample_rows)
    n_toxic, n_clean = (chosen.agg(F.count_if(F.col("toxic") == k).alias("n")).first()["n"] for k in (1, 0))
    if not n_toxic or not n_clean:
        return Lexicon({})
    # sample_rows rows of two numbers: small by the parameter
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sample = sample.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("text", "toxic")
    sample = sample.repartition(max(1, min(64, sample_rows // 200)))
    counts = _counts(sample, features_of)
    # more toxic documents than the class's share lets expect: only these may carry weight
    lean = counts.where(F.col("toxic") >= LEAST_DOCS).where(F.col("toxic") * n_clean > F.col("clean") * n_toxic * 2)
    rate = F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("clean") + 0.5) / (n_clean + 1))
    found = {r["term"]: (r["toxic"], r["clean"], r["lift"]) for r in lean.withColumn("lift", rate).collect()}  # terms of sample_rows texts, LEAST_DOCS of them or more
    weights = {t: w for t, (a, b, w) in found.items() if _evidence(a, b, n_toxic, n_clean) >= LEAST_EVIDENCE}
    # a stem stands for a family of words; one that mostly comes from a single word would only hit its neighbours
    alone = {}
    for word, (toxic, _, _) in found.items():
        if word.endswith(" "):
            for n in range(STEM_MIN + 1, len(word) - 1):
                alone[word[:n]] = max(alone.get(word[:n], 0), toxic)
    weights = {t: w for t, w in weights.items() if t.endswith(" ") or 2 * alone.get(t, 0) < found[t][0]}
    # a stem that says no more than a shorter one is left out
    slim = {t: w for t, w in sorted(weights.items()) if t.endswith(" ") or t[:-1] not in weights or found[t][:2] != found[t[:-1]][:2]}
    mild = (F.col("clean") >= 2) & (F.col("toxic") * n_clean <= F.col("clean") * n_toxic * 1.5)
    # whole words that a stem term would hit but clean documents use: exceptions
    stems = [t for t in slim if not t.endswith(" ")]
    exceptions = set()
    if stems:
        heads = docs.sparkSession.createDataFrame([(x,) for x in stems], "stem string")  # no more than the lexicon's terms
        begins = F.explode(F.transform(F.sequence(F.lit(STEM_MIN + 1), F.lit(STEM_MAX + 1)), lambda n: F.col("term").substr(F.lit(1), n)))
        used = counts.where(F.col("term").endswith(" ")).where(mild).select("term", begins.alias("stem"))
        used = used.join(F.broadcast(heads), "stem", "left_semi").select("term").distinct()
        exceptions = {r["term"] for r in used.collect()}
    lexicon = Lexicon(slim, sorted(exceptions))
    # and phrases in which clean documents use a word that is hit
    if slim:
        used = _counts(sample, lambda folded, lexicon=lexicon: phrases_of(folded, lexicon.hits(folded)))
        exceptions |= {r["term"] for r in used.where(F.col("clean") >= LEAST_DOCS).where(mild).collect()}
        lexicon = Lexicon(slim, sorted(exceptions))

    def points(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [lexicon.features(t) for t in texts(batch)]
        cols = [batch.column("toxic"), *(pa.array([r[k] for r in rows]) for k in range(4))]
        return pa.RecordBatch.from_arrays(cols, schema=arrow_schema(POINT))

    got = np.array([tuple(r) for r in map_arrow(sample, points, POINT).collect()], float)  # sample_rows rows of five numbers
    if not len(got):  # no labelled document is in the table
        return Lexicon({})
    got = got[np.lexsort(got.T)]
    lexicon.curve = _logistic(got[:, 1:], got[:, 0])
    return lexicon


SCORES = struct_of("doc_id long, score double, predicted int")


def score_documents(docs: DataFrame, lexicon: Lexicon, carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, score, predicted`` for every row, from its text alone; ``carry`` passes columns on.

    Null and empty texts get the score of a text without a match; a score of just 0.5 counts as toxic. Repeated
    rows are scored each; an empty table gives none; other columns, whatever their names, are only passed on if
    named in ``carry``. Time grows with a text's length, however many words are hit.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *(c for c in carry if c != "text"))
    schema = type(SCORES)([*SCORES.fields, *(rows.schema[c] for c in carry)])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = [lexicon.score(t) for t in texts(batch)]
        made = [pa.array(scores), pa.array([int(s >= 0.5) for s in scores], pa.int32())]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *made, *(batch.column(c) for c in carry)], schema=arrow_schema(schema))

    return map_arrow(rows, run, schema)


def training_labels(labels: DataFrame) -> DataFrame:
    """The labelled rows of the training folds."""
    return labels.where(fold_of("doc_id", 5) != 0).select("doc_id", "toxic")


def op2_toxicity_lexicon(spark, sf_dir: str) -> DataFrame:
    """``score_documents`` for ``documents`` with a lexicon of the training folds; cases as stated there and at ``fit``."""
    docs = table(spark, sf_dir, "documents")
    lexicon = fit(docs, training_labels(table(spark, sf_dir, "labels")))
    out = score_documents(docs, lexicon)
    return out.select("doc_id", (fold_of("doc_id", 5) == 0).alias("held_out"), "score", "predicted")

"""Small tables and brute-force versions."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, start=0, extra=False):
    rows = [(start + k, t, "en", f"s{k % 3}", len(t or "")) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCS)
    if extra:  # columns whose names clash with results and with names used inside
        for name in ("shard", "slot", "score", "component_id", "h", "t", "row", "length", "_key", "n_bytes", "posterior", "position"):
            df = df.withColumn(name, df.text)
    return df


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(n))


def edge_texts():
    """Null, empty, blank, repeated, tied, non-Latin, special and very long texts."""
    return [None, "", " \n\t ", "a", "a", "Straße 東京 😀", "<|endoftext|> x", "!!! ...", "z" * 5000, "same words again and again here", "same words again and again here", " ".join(f"v{k}" for k in range(4000))]


def rng(seed=0):
    return random.Random(seed)

"""The corpus pipeline: toxicity, near duplicates, repeated passages, mixing, packing.

Every stage takes ``(spark, docs, sf_dir)`` with the columns of ``documents`` and works on all that its
predecessor kept; all but the last return those columns. In every stage null texts count as empty, null ids,
sources and languages pass, repeated rows are rows, an empty table gives an empty table, texts of any length
are read whole, and columns beyond those of ``documents`` are neither read nor returned, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.llm import bestfit, minhash, mixing, suffixdedup, toxicity
from dialoom.llm.common import materialise, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


#: Factors of the domains' present shares of tokens: poor text loses a fifth, toxic-looking text half,
#: and good text fills up. Fixed shares would ask for toxic text that an earlier stage has taken out.
MIX_FACTORS = (1.0, 0.8, 0.5, 0.5)


def _documents(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        F.char_length("text").cast("long").alias("n_chars"),
    )


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the learned lexicon scores at 0.5 or more go; without usable labels none does. Copies share a score."""
    labels = toxicity.training_labels(table(spark, sf_dir, "labels"))
    lexicon = toxicity.fit(docs, labels)
    scored = toxicity.score_documents(docs, lexicon, carry=("text", "lang", "source"))
    return _documents(scored.where("predicted = 0").drop("score", "predicted"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near duplicates (five words, similarity 0.8) one row stays, that with the least id.

    Rows are compared one by one: repeated rows of one id and rows without an id are copies like any other,
    and an id goes before none. Rows without words are in no group.
    """
    rows = materialise(_documents(docs).withColumn("_row", F.monotonically_increasing_id()), "pipeline-near")
    groups = minhash.near_duplicates(rows, percent=80, id_col="_row").select(F.col("doc_id").alias("_key"), "component_id")
    ids = rows.select("_row", "doc_id").join(groups, F.col("_row") == F.col("_key"))
    first = ids.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row")).alias("first"))
    kept = first.select(F.col("first._row").alias("_kept"))
    return rows.join(kept, F.col("_row") == F.col("_kept"), "left_semi").select(*COLUMNS)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes covered by a 200-byte string that starts elsewhere too go, of every copy; emptied documents go with them.

    Texts that were empty before stay, as nothing was taken from them.
    """
    cut = suffixdedup.remove_repeats(docs, with_text=True, carry=("lang", "source"))
    whole = (F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_bytes"))
    return _documents(cut.where(whole).withColumnRenamed("kept_text", "text"))


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row appears as often as its rate, rounded by a seeded draw of its id, says; rows of one id are drawn alike."""
    rows = materialise(_documents(docs).withColumn("row", F.monotonically_increasing_id()), "pipeline-mix")
    rated = mixing.mix(rows, table(spark, sf_dir, "labels"), MIX_FACTORS, relative=True).where("copies > 0")
    times = rated.select(F.col("row").alias("_row"), "copies")
    out = rows.join(times, F.col("row") == F.col("_row")).withColumn("_copy", F.explode(F.expr("sequence(1, copies)")))
    return out.select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens; one row a piece, an empty text being the piece of its end mark."""
    return bestfit.pack_documents(docs, 2048)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", drop_repeated_passages),
    ("mixing", mix_domains),
    ("packing", pack),
]

#: Learned scores, suffix sorting and packing have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

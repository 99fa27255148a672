"""Dataset stages between sources and export: ingest, overuse, assemble, generation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import HANGUL_SYLLABLES, begins_with_stem, casefold, in_scope, normalise_column, parse_dialogue, repair_dialogue, reply_text
from .ledger import first_wins, numbered

# Word beginnings that make a human text unsafe, unless a configuration names its own.
BLOCKED_STEMS = (
    "씨발", "시발", "개새", "병신", "좆", "존나", "지랄", "썅", "니미",
    "미친년", "미친놈", "야동", "섹스", "강간",
)


def hash_order(seed: object, *columns: str | Column) -> Column:
    """A seeded order that is the same on every cluster: SHA-256 of the seed and the columns."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), *columns), 256)


def top_by_hash(df: DataFrame, by: list[str], limit: Column | int, seed: object, key: str, tie: str) -> DataFrame:
    """At most ``limit`` rows of each group, those with the least hashes.

    With a constant limit Spark prunes every task to ``limit`` rows a group before the shuffle.
    """
    order = Window.partitionBy(*by).orderBy(hash_order(seed, F.col(key)), tie)
    return df.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= limit).drop("_rank")


# -- ingest ---------------------------------------------------------------------


def clean_utterances(raw: DataFrame, target: str, min_chars: int, max_chars: int) -> DataFrame:
    """Normalised texts of allowed length; texts to be translated may be twice as long."""
    df = normalise_column(raw.where("text is not null"), "text")
    ceiling = F.when(F.col("language") == target, max_chars).otherwise(2 * max_chars)
    return df.where(F.char_length("text").between(F.lit(min_chars), ceiling))


def _text_key() -> Column:
    """Equal for equal case-folded texts of one source."""
    # a source's name and a text cannot run into each other: the separator occurs in no normalised text
    return F.sha2(F.concat(F.col("source"), F.lit("\u0001"), casefold(F.col("text"))), 256)


def distinct_utterances(df: DataFrame) -> DataFrame:
    """The first of equal case-folded texts in each source."""
    return first_wins(df, _text_key()).where(~F.col("_later")).drop("_later")


def mark_distinct(raw: DataFrame, target: str, min_chars: int, max_chars: int) -> DataFrame:
    """All of ``raw``, texts normalised, with ``_distinct``: of allowed length and the first of its kind in its source.

    The same rows as ``clean_utterances`` and ``distinct_utterances`` leave, without losing the others, so that
    one plan serves the records and the counts.
    """
    df = normalise_column(raw, "text")
    ceiling = F.when(F.col("language") == target, max_chars).otherwise(2 * max_chars)
    df = df.withColumn("_sound", F.coalesce(F.char_length("text").between(F.lit(min_chars), ceiling), F.lit(False)))
    df = first_wins(df, F.when(F.col("_sound"), _text_key()))
    return df.withColumn("_distinct", F.col("_sound") & ~F.col("_later")).drop("_sound", "_later")


def sample_sources(df: DataFrame, limit: int | None, seed: object) -> DataFrame:
    """Before anything costly: at most ``limit`` texts of each source."""
    return df if not limit else top_by_hash(df, ["source"], limit, seed, "text", "_pos")


def judge_topics(
    df: DataFrame,
    signal: Sequence[str],
    min_chars: int,
    max_chars: int,
    min_hits: int,
    stems: Sequence[str] = BLOCKED_STEMS,
    letters: str = HANGUL_SYLLABLES,
) -> DataFrame:
    """``_verdict``: unsafe (judged first), off_topic, or in_scope; null for a null text, one whose translation failed."""
    text = F.col("text")
    verdict = F.when(begins_with_stem(text, stems, letters), "unsafe").when(~in_scope(text, signal, min_chars, max_chars, min_hits, letters), "off_topic")
    return df.withColumn("_verdict", F.when(text.isNotNull(), verdict.otherwise("in_scope")))


def utterance_records(judged: DataFrame, keep_index: bool = False) -> DataFrame:
    """Records in scope with ids that count per source from 0 in input order; ``keep_index`` leaves the count."""
    rows = numbered(judged.where("_verdict = 'in_scope'"), "_index", ["source"])
    rows = rows.withColumn("id", F.format_string("%s-%06d", "source", "_index")).drop("_verdict")
    return rows if keep_index else rows.drop("_index")


def source_stats(marked: DataFrame, judged: DataFrame | None = None) -> DataFrame:
    """``source, raw, distinct, sampled, translated, translation_failed, in_scope, unsafe, off_topic``.

    ``marked`` has every row with ``_distinct``. ``judged`` are the sampled rows with their verdicts; without it all
    distinct rows were judged, in ``marked`` itself, and one aggregate counts everything.
    """
    if judged is None:
        counted = marked.groupBy("source").agg(F.count("*").alias("raw"), F.count_if("_distinct").alias("distinct"), *_verdict_counts(marked, F.col("_distinct")))
    else:
        counted = marked.groupBy("source").agg(F.count("*").alias("raw"), F.count_if("_distinct").alias("distinct"))
        later = judged.groupBy(F.col("source").alias("_source")).agg(*_verdict_counts(judged, F.lit(True)))
        counted = counted.join(later, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    return counted.select("source", *(F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in ("raw", "distinct", *COUNTS)))


COUNTS = ("sampled", "translated", "translation_failed", "in_scope", "unsafe", "off_topic")


def _verdict_counts(df: DataFrame, used: Column) -> list[Column]:
    foreign = F.col("original_text").isNotNull() if "original_text" in df.columns else F.lit(False)
    marks = {"sampled": F.lit(True), "translated": foreign & F.col("text").isNotNull(), "translation_failed": foreign & F.col("text").isNull()}
    marks |= {v: F.col("_verdict") == v for v in COUNTS[3:]}
    return [F.count_if(used & marks[n]).alias(n) for n in COUNTS]


# -- overuse --------------------------------------------------------------------


def assistant_lines(sessions: DataFrame) -> DataFrame:
    """``_pos, _turn, text`` of every assistant turn."""
    rows = sessions.select("_pos", F.posexplode("turns").alias("_turn", "_t"))
    return rows.where("_t.role = 'assistant'").select("_pos", "_turn", F.col("_t.text").alias("text"))


def overused(sessions: DataFrame, limit: int) -> DataFrame:
    """``_pos`` of sessions in which an assistant line is said for more than the ``limit``-th time.

    Occurrences count in input order, in dropped sessions and inside one session too. Only the place of
    each line's ``limit``-th occurrence is needed, a top-k that tasks prune before the shuffle; lines
    after it are found by a join that adaptive execution splits on common lines.
    """
    lines = assistant_lines(sessions)
    place = F.struct("_pos", "_turn")
    order = Window.partitionBy("text").orderBy("_pos", "_turn")
    last = lines.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") == limit)
    last = last.select(F.col("text").alias("_text"), place.alias("_last"))
    return lines.join(last, F.col("text") == F.col("_text")).where(place > F.col("_last")).select("_pos").distinct()


def mark_overused(sessions: DataFrame, limit: int) -> DataFrame:
    """``_stage_reject`` for the ledger."""
    over = overused(sessions, limit).select(F.col("_pos").alias("_over"))
    reason = F.when(F.col("_over").isNotNull(), F.array(F.lit("assistant_line_overused")))
    return sessions.join(over, F.col("_pos") == F.col("_over"), "left").withColumn("_stage_reject", reason).drop("_over")


# -- assemble -------------------------------------------------------------------


def bucket_targets(spark: SparkSession, ratios: Mapping[str, float], max_sessions: int) -> DataFrame:
    """``bucket, want``: shares of the maximum, rounded half to even."""
    table = spark.createDataFrame(list(ratios.items()), "bucket string, ratio double")
    return table.select("bucket", F.bround(F.col("ratio") * max_sessions).cast("long").alias("want"))


def hash_places(df: DataFrame, by: list[str], seed: object, below: Column | None = None) -> DataFrame:
    """``_place``: each row's rank from 0 in the seeded order of the ids, in each value of ``by`` or over all.

    The rank comes from 4,096 hash buckets and a small table of their counts, so no task sorts a group. With ``below``
    only rows whose place is under it are wanted: buckets that lie above go before anything is sorted.
    """
    df = df.withColumn("_hash", hash_order(seed, F.col("id"))).withColumn("_cut", F.substring("_hash", 1, 3))
    counts = df.groupBy(*by, "_cut").agg(F.count("*").alias("_n"))
    order = Window.partitionBy(*by).orderBy("_cut") if by else Window.orderBy("_cut")  # 4096 rows a group
    names = {k: f"_of_{k}" for k in (*by, "_cut")}
    before = counts.select(*(F.col(k).alias(v) for k, v in names.items()), (F.sum("_n").over(order) - F.col("_n")).alias("_before"))
    same = F.lit(True)
    for k, v in names.items():
        same = same & F.col(k).eqNullSafe(F.col(v))
    df = df.join(before, same)
    if below is not None:
        df = df.where(F.col("_before") < below)
    inside = F.row_number().over(Window.partitionBy(*by, "_cut").orderBy("_hash", "_pos")) - 1
    df = df.withColumn("_place", F.col("_before") + inside).drop("_hash", "_cut", "_before", *names.values())
    return df if below is None else df.where(F.col("_place") < below)


def draw(pool: DataFrame, ratios: Mapping[str, float], max_sessions: int, seed: object) -> DataFrame:
    """The wanted number of sessions from each bucket, in seeded hash order."""
    wants = {b: round(max_sessions * r) for b, r in ratios.items()}  # rounds half to even too
    want = F.create_map(*(F.lit(x) for pair in wants.items() for x in pair))[F.col("bucket")]
    return hash_places(pool.where(F.col("bucket").isin(*wants)), ["bucket"], seed, want).drop("_place")


def shortfall(pool: DataFrame, targets: DataFrame) -> DataFrame:
    """``bucket, shortfall`` of buckets that cannot give what is wanted; never balanced by others."""
    have = pool.groupBy(F.col("bucket").alias("_bucket")).agg(F.count("*").alias("_n"))
    short = F.col("want") - F.coalesce("_n", F.lit(0))
    return targets.join(have, F.col("bucket") == F.col("_bucket"), "left").where(short > 0).select("bucket", short.alias("shortfall"))


def split_sessions(drawn: DataFrame, split: Mapping[str, float], seed: object) -> DataFrame:
    """``split``: the first ``int(n * val)`` sessions in a seeded order, then the test part, the rest train."""
    n = drawn.count()
    n_val, n_test = int(n * split["val"]), int(n * split["test"])
    place = F.col("_place")
    name = F.when(place < n_val, "val").when(place < n_val + n_test, "test").otherwise("train")
    return hash_places(drawn, [], f"{seed}:split").withColumn("split", name).drop("_place")


def selected_counts(sessions: DataFrame) -> DataFrame:
    name = F.coalesce("bucket", "source", F.lit("unknown"))
    return sessions.groupBy(name.alias("name")).agg(F.count("*").alias("n"))


# -- generation -----------------------------------------------------------------


def dialogue_requests(beats: DataFrame, per_situation: int, turns: Sequence[int], flows: Sequence[str], seed: object) -> DataFrame:
    """``key, beat_index, beat, n, turns, flow``: every beat times ``per_situation``, choices by seeded hash."""
    rows = beats.withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(per_situation - 1)))) if per_situation else beats.withColumn("n", F.lit(0)).limit(0)
    key = F.format_string("%s:%d", "beat", "n")

    def choose(options: Sequence, salt: str) -> Column:
        number = F.conv(F.substring(hash_order(f"{seed}:{salt}", key), 1, 8), 16, 10).cast("long")
        return F.get(F.array(*map(F.lit, options)), F.pmod(number, F.lit(len(options))).cast("int"))

    return rows.select(key.alias("key"), "beat_index", "beat", "n", choose(turns, "turns").alias("turns"), choose(flows, "flow").alias("flow"))


def dialogue_outcomes(answers: DataFrame) -> DataFrame:
    """``answers`` (``beat_index, beat, n, text``) with ``turns`` and ``_failure``: teacher_error, unparseable or null."""
    df = answers.withColumn("turns", repair_dialogue(parse_dialogue(F.coalesce("text", F.lit("")))))
    return df.withColumn("_failure", F.when(F.col("text").isNull(), "teacher_error").when(F.size("turns") == 0, "unparseable"))


def response_outcomes(utterances: DataFrame, answers: DataFrame) -> DataFrame:
    """Every utterance with its ``_reply`` and ``_failure``: teacher_error (no answer), empty_reply or null."""
    replies = answers.select("key", F.col("text").alias("_said"), *(c for c in ("completion_tokens",) if c in answers.columns))
    joined = utterances.join(replies, F.col("id") == F.col("key"), "left").withColumn("_reply", reply_text(F.col("_said")))
    return joined.withColumn("_failure", F.when(F.col("_said").isNull(), "teacher_error").when(F.col("_reply") == "", "empty_reply"))


def call_counts(outcomes: DataFrame) -> DataFrame:
    """One row: calls, failures of the teacher, completion tokens, and answers of no use."""
    tokens = F.sum(F.when(F.col("_failure").isNull() | (F.col("_failure") != "teacher_error"), F.col("completion_tokens"))) if "completion_tokens" in outcomes.columns else F.lit(0)
    failed = F.col("_failure")
    return outcomes.agg(
        F.count("*").alias("calls"),
        F.count_if(failed == "teacher_error").alias("teacher_error"),
        F.count_if(failed == "unparseable").alias("unparseable"),
        F.count_if(failed == "empty_reply").alias("empty_reply"),
        F.coalesce(tokens, F.lit(0)).cast("long").alias("completion_tokens"),
    )


def dialogue_sessions(answers: DataFrame, model: str) -> DataFrame:
    """Answers as sessions; those that failed give none."""
    df = dialogue_outcomes(answers).withColumn("_pos", F.col("beat_index").cast("long") * (1 << 32) + F.col("n"))
    good = numbered(df.where("_failure is null"), "_index")
    return good.select(
        F.format_string("dialogue-%06d", "_index").alias("id"),
        F.lit("dialogue").alias("source"),
        F.col("beat").alias("scenario"),
        F.lit("synthetic").alias("license"),
        F.array(F.lit(model)).alias("generator"),
        "turns",
        "_pos",
    )


def response_sessions(utterances: DataFrame, answers: DataFrame, model: str) -> DataFrame:
    """Utterances with the teacher's reply (``key, text``) as sessions of two turns.

    Utterances without a usable reply give none; provenance columns come along.
    """
    joined = response_outcomes(utterances, answers).where("_failure is null")
    turn = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("text"))
    return joined.select(
        F.concat(F.lit("respond-"), "id").alias("id"),
        F.lit("respond").alias("source"),
        F.concat(F.lit("source:"), "source").alias("scenario"),
        "license",
        F.array(F.lit(model)).alias("generator"),
        F.array(turn("user", F.col("text")), turn("assistant", F.col("_reply"))).alias("turns"),
        F.col("id").alias("utterance_id"),
        F.col("source").alias("source_dataset"),
        F.col("url").alias("source_url"),
        F.col("original_language") if "original_language" in utterances.columns else F.lit(None).cast("string").alias("original_language"),
        F.col("translator") if "translator" in utterances.columns else F.lit(None).cast("string").alias("translator"),
        "_pos",
    )

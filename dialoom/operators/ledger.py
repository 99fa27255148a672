"""The ledger: every record of a stage gets one outcome and its reasons, in one plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .schema import RecordKind

OUTCOMES = ("rejected_by_stage", "rejected_by_schema", "duplicate", "rejected_by_gate", "kept")


def first_wins(df: DataFrame, key: Column, position: str = "_pos") -> DataFrame:
    """``_later``: whether an earlier row has the same key; rows with a null key are never duplicates.

    The first position of each key is a partial aggregate joined back, not a window, so a key that a
    third of all rows share is summed before the shuffle and its join partition can be split. Only keys
    that occur twice are joined: where they are few, adaptive execution broadcasts them and no row moves.
    Positions are unique longs or structs.
    """
    # the row number keeps predicates on the key above it: pushed down they would compute the key again
    keyed = df.withColumn("_key", F.when(F.monotonically_increasing_id() >= 0, key))
    first = keyed.where("_key is not null").groupBy("_key").agg(F.min(position).alias("_first"), F.count("*").alias("_times"))
    first = first.where("_times > 1").select(F.col("_key").alias("_of"), "_first")
    joined = keyed.join(first, F.col("_key") == F.col("_of"), "left")
    return joined.withColumn("_later", F.coalesce(F.col(position) > F.col("_first"), F.lit(False))).drop("_of", "_first", "_key")


def ledger(records: DataFrame, kind: RecordKind, reasons: Column | None = None, position: str = "_pos") -> DataFrame:
    """``records`` plus ``_outcome`` and ``_reasons``.

    Order of judgement: the stage's own reject (``_stage_reject array<string>``, if present), the schema,
    first-wins duplication, the gate. Records that the stage or the schema rejects hide no later copy; one
    that the gate rejects does. ``_pos`` must be unique and give the order of the input.
    """
    if "_stage_reject" not in records.columns:
        records = records.withColumn("_stage_reject", F.lit(None).cast("array<string>"))
    df = kind.normalise(records)
    staged = F.size(F.coalesce("_stage_reject", F.array().cast("array<string>"))) > 0
    sound = ~staged & F.col("_schema_error").isNull()
    df = first_wins(df, F.when(sound, kind.fingerprint()), position)
    gated = reasons if kind.gated and reasons is not None else F.array().cast("array<string>")
    df = df.withColumn("_gate", F.when(sound & ~F.col("_later"), gated))
    outcome = (
        F.when(staged, OUTCOMES[0])
        .when(F.col("_schema_error").isNotNull(), OUTCOMES[1])
        .when(F.col("_later"), OUTCOMES[2])
        .when(F.size("_gate") > 0, OUTCOMES[3])
        .otherwise(OUTCOMES[4])
    )
    why = (
        F.when(staged, F.col("_stage_reject"))
        .when(F.col("_schema_error").isNotNull(), F.array("_schema_error"))
        .when(F.col("_later"), F.array(F.lit("duplicate")))
        .otherwise(F.col("_gate"))
    )
    return df.withColumn("_outcome", outcome).withColumn("_reasons", why).drop("_stage_reject", "_schema_error", "_later", "_gate")


def kept(entries: DataFrame) -> DataFrame:
    return entries.where(F.col("_outcome") == "kept").drop("_outcome", "_reasons")


def rejected(entries: DataFrame) -> DataFrame:
    """Everything not kept, duplicates included, with ``_reject_reasons``."""
    return entries.where(F.col("_outcome") != "kept").drop("_outcome").withColumnRenamed("_reasons", "_reject_reasons")


def outcome_counts(entries: DataFrame) -> DataFrame:
    return entries.groupBy(F.col("_outcome").alias("outcome")).agg(F.count("*").alias("n"))


def reason_counts(entries: DataFrame) -> DataFrame:
    return entries.select(F.explode("_reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def yield_rate(entries: DataFrame, extra_rejected: int = 0) -> DataFrame:
    """One row: produced, rejected (without duplicates), duplicates, and the rate to four places."""
    is_in = F.col("_outcome")
    sums = entries.agg(
        F.count_if(is_in == "kept").alias("produced"),
        (F.count_if(is_in.startswith("rejected")) + F.lit(extra_rejected)).alias("rejected"),
        F.count_if(is_in == "duplicate").alias("duplicates"),
    )
    total = F.col("produced") + F.col("rejected")
    return sums.withColumn("yield_rate", F.when(total > 0, F.bround(F.col("produced") / total, 4)))


def sample(entries: DataFrame, n: int = 200, seed: int = 0) -> DataFrame:
    """A seeded sample of the kept records: the least hashes of the ids."""
    return kept(entries).orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id")), 256), "id").limit(n)


def stage_seed(seed: int, stage: str) -> int:
    return seed + sum(map(ord, stage))


def numbered(df: DataFrame, name: str, by: list[str] | None = None, position: str = "_pos", block: int = 1 << 16, then: tuple[str, ...] = ()) -> DataFrame:
    """``name`` counts rows from 0 by ``position``, and ``then`` by other columns, inside each value of ``by`` (or overall).

    Positions are longs, unique together with ``then``, or the structs of source texts. Windows only number the rows of one block, a range
    of longs or what one scan task read of a source; a small table of block counts gives the offsets, so neither
    a large group nor the whole input meets in one task.
    """
    keys = list(by or [])
    if isinstance(df.schema[position].dataType, StructType):
        # row numbers come from the scan: the task's number in the upper bits, so a block is a task's rows
        where = F.struct(F.col(position)["rank"].alias("rank"), F.shiftright(F.col(position)["row"], 33).alias("task"))
    else:
        where = F.floor(F.col(position) / block)
    df = df.withColumn("_block", where)
    counts = df.groupBy(*keys, "_block").agg(F.count("*").alias("_n"))
    order = Window.partitionBy(*keys).orderBy("_block") if keys else Window.orderBy("_block")  # a row a block
    before = counts.select(*(F.col(k).alias(f"_of_{k}") for k in keys), F.col("_block").alias("_of_block"), (F.sum("_n").over(order) - F.col("_n")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(*keys, "_block").orderBy(position, *then)) - 1
    same = F.col("_block") == F.col("_of_block")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    joined = df.withColumn("_in", inside).join(before, same)
    return joined.withColumn(name, F.col("_before") + F.col("_in")).drop("_block", "_of_block", "_before", "_in", *(f"_of_{k}" for k in keys))


__all__ = ["first_wins", "kept", "ledger", "numbered", "outcome_counts", "reason_counts", "rejected", "sample", "stage_seed", "yield_rate"]

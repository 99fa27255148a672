"""Sharding by proportional stratified interleaving, in DataFrame functions only.

Rows of each source are ranked in a seeded shuffle, all rows are ordered by the fractional rank
``(2 * rank - 1) / (2 * rows of the source)``, and the order is cut into shards of equal row counts,
so every shard holds each source in its share of the whole, up to one row a source.

Neither ranking uses a window over a whole source or over all rows. Rows are dealt by range of the whole
sort key, row number last, so parts are even whatever ties or repeats there are: one source with a third
of all rows, a million sources of one row each, ids that are null. Windows number the rows of one part; a
small table of part counts gives each part's first rank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialise

#: Aim for this many rows in a part; beyond MAX_PARTS parts grow instead (sorts spill).
PART_ROWS = 4096
MAX_PARTS = 20_000


def _uniform(seed: int, *columns: Column) -> Column:
    """A 32-bit uniform number (as long) from the seed and the columns."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *columns).cast("binary")), 1, 8), 16, 10).cast("long")


def _parted(rows: DataFrame, parts: int, order: list[str], name: str) -> DataFrame:
    """The rows with ``_part``, parts following each other in the order; written, since a second look could differ."""
    return materialise(rows.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), name)


def interleave_shards(
    docs: DataFrame,
    n_shards: int,
    seed: int = 17,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    bucket_rows: int = PART_ROWS,
) -> DataFrame:
    """Return ``doc_id, source, size, text_crc32, fraction, shard, slot`` for every row of ``docs``.

    ``size`` is the UTF-8 bytes of the text (null: none) plus 16. Shard counts differ by one at most;
    ``slot`` counts from 0 inside a shard. Null sources form one source of their own, null ids sort
    first, null texts count as empty, repeated rows each get a place, an empty table gives no rows.
    Equal fractions follow each other by source, then id, then text. Texts are only measured, whole.
    Only the three named columns are read, so further columns of any name do not matter. ``bucket_rows`` is
    how many rows a part aims for; it has no influence on the result.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be positive")
    key = F.when(F.col(source_col).isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col(source_col).cast("string")))
    uniform = _uniform(seed, F.coalesce(F.col(id_col).cast("string"), F.lit("null")))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        key.alias("_key"),
        uniform.alias("_u"),
        F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)).cast("long").alias("_bytes"),
        F.crc32(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    # all that the texts are needed for; what is alike in every column is interchangeable, the number only splits it
    rows = materialise(rows.withColumn("_row", F.monotonically_increasing_id()), "interleave-rows")
    total = rows.count()
    parts = max(1, min(MAX_PARTS, -(-total // bucket_rows)))
    shuffled = ["_u", "doc_id", "text_crc32", "_bytes", "_row"]
    by_key = _parted(rows, parts, ["_key", *shuffled], "interleave-by-key")
    discard(rows)
    counts = by_key.groupBy("_key", "_part").agg(F.count("*").alias("_n"))
    of_key = Window.partitionBy("_key")  # a row a part
    firsts = counts.select("_key", "_part", (F.sum("_n").over(of_key.orderBy("_part")) - F.col("_n")).alias("_before"), F.sum("_n").over(of_key).alias("_of"))
    inside = F.row_number().over(Window.partitionBy("_key", "_part").orderBy(*shuffled))
    rank = F.col("_before") + F.col("_in")
    fraction = (F.lit(2) * rank - F.lit(1)).cast("double") / (F.lit(2) * F.col("_of")).cast("double")
    ranked = by_key.withColumn("_in", inside).join(firsts, ["_key", "_part"]).withColumn("fraction", fraction)
    order = ["fraction", "_key", "doc_id", "text_crc32", "_bytes", "_row"]
    ranked = ranked.select("source", *order)
    placed = _parted(ranked, parts, order, "interleave-ranked")
    discard(by_key)
    cuts = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    # one row a part: at most MAX_PARTS rows meet in this window
    cuts = cuts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    at = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return (
        placed.withColumn("_at", at)
        .join(cuts, "_part")
        .withColumn("_pos", F.col("_before") + F.col("_at") - F.lit(1))
        .withColumn("shard", F.expr(f"_pos * {n_shards} div {max(1, total)}").cast("int"))
        .withColumn("slot", F.col("_pos") - F.expr(f"(shard * {total}L + {n_shards - 1}) div {n_shards}"))
        .select("doc_id", "source", (F.col("_bytes") + F.lit(16)).alias("size"), "text_crc32", "fraction", "shard", "slot")
    )


OP5_SHARDS = 40


def op5_stratified_shards(spark, sf_dir: str) -> DataFrame:
    """``interleave_shards`` of ``documents`` into 40 shards under the law ``rows``; cases as stated there."""
    from .common import table

    out = interleave_shards(table(spark, sf_dir, "documents"), OP5_SHARDS)
    return out.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
    )


#: CRC-32 by its table, built from the polynomial; the other steps are plain windows over whole tables.
OP5_SQL = """
WITH RECURSIVE steps(i, k, c) AS (
  SELECT i::BIGINT, 0, i::BIGINT FROM range(256) t(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE k < 8
),
crc AS (SELECT list(c ORDER BY i) AS tab FROM steps WHERE k = 8),
bytes AS (
  SELECT doc_id, source, coalesce(strlen(text), 0) AS n,
         list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(coalesce(text, '')), '..'), lambda h: ('0x' || h)::BIGINT)) AS b
  FROM documents
),
rows_ AS (
  SELECT doc_id, source, n,
         xor(list_reduce(b, lambda x, y: xor(x >> 8, tab[(xor(x, y) & 255) + 1])), 4294967295) AS text_crc32,
         CASE WHEN source IS NULL THEN '-' ELSE '+' || source END AS key,
         ('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT AS u
  FROM bytes, crc
),
ranked AS (
  SELECT *, (2 * row_number() OVER (PARTITION BY key ORDER BY u, doc_id NULLS FIRST, text_crc32, n) - 1)::DOUBLE
            / (2 * count(*) OVER (PARTITION BY key))::DOUBLE AS fraction
  FROM rows_
),
placed AS (
  SELECT *, row_number() OVER (ORDER BY fraction, key, doc_id NULLS FIRST, text_crc32, n) - 1 AS pos, count(*) OVER () AS total
  FROM ranked
)
SELECT doc_id, (n + 16)::BIGINT AS size, text_crc32, 'rows' AS law, ((pos * 40) // total)::INTEGER AS shard,
       (pos - ((((pos * 40) // total) * total + 39) // 40))::BIGINT AS slot, NULL::INTEGER AS grown_shard, source
FROM placed
"""

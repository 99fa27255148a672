"""The ledger over a stream of sessions: stateless judgement, publication by batch.

The engine's work is batch work; this is the same gate for sessions that keep arriving. Every micro-batch is
judged by the batch ledger, then against the fingerprints of what earlier batches published: a copy of a
kept session is a duplicate in whatever batch it comes. Output goes under the batch's number, so a batch
that is run again replaces its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..operators.ledger import kept, ledger, rejected
from ..operators.schema import SESSIONS


def publish_stream(sessions: DataFrame, reasons: Column, path: str, checkpoint: str) -> StreamingQuery:
    """``sessions`` streams SESSION columns with a unique ``_pos``."""

    def publish(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        entries = ledger(batch, SESSIONS, reasons).withColumn("fingerprint", SESSIONS.fingerprint())
        files = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/kept")
        if files.getFileSystem(spark._jsc.hadoopConfiguration()).exists(files):
            # hashes of kept sessions, one each; the batch is the small side
            known = spark.read.parquet(f"{path}/kept").where(F.col("batch") != number).select(F.col("fingerprint").alias("_known")).distinct()
            copy = F.col("_known").isNotNull() & (F.col("_outcome") == "kept")
            entries = entries.join(known, F.col("fingerprint") == F.col("_known"), "left")
            entries = entries.withColumn("_reasons", F.when(copy, F.array(F.lit("duplicate"))).otherwise(F.col("_reasons")))
            entries = entries.withColumn("_outcome", F.when(copy, "duplicate").otherwise(F.col("_outcome"))).drop("_known")
        for part, name in ((kept(entries), "kept"), (rejected(entries), "rejected")):
            part.write.mode("overwrite").parquet(f"{path}/{name}/batch={number}")

    return sessions.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

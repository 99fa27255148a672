"""Shared helpers of the training-data operators: shared-folder tables, scans, Arrow limits."""

from __future__ import annotations

import gc
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows and bytes of one Arrow batch; a Python worker holds one batch in and one out.
BATCH_ROWS = 500
BATCH_BYTES = 32 * 1024 * 1024

_local_dir: str | None = None
_shipped: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which all executors and the driver share.

    Only where the setting is absent (tests, local mode) a folder on this machine stands in.
    """
    global _local_dir
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if _local_dir is None:
        _local_dir = f"file://{tempfile.mkdtemp(prefix='dialoom-')}"
    return _local_dir


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop shuffle files whose DataFrames are gone."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    schema = df.schema
    del df
    release(spark)
    out = spark.read.schema(schema).parquet(path)
    out._stored_at = path
    return out


def discard(stored: DataFrame) -> None:
    """Delete a materialised table that no later step reads."""
    spark = stored.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(stored._stored_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch holds, so very long texts do not pile up in a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def map_arrow(
    df: DataFrame,
    fn: Callable[[pa.RecordBatch], pa.RecordBatch | None],
    schema: T.StructType,
) -> DataFrame:
    """``mapInArrow`` of a batch-to-batch function; empty batches are passed over."""
    ship(df.sparkSession)
    bounded_batches(df.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


_TYPES = {
    "long": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "string": T.StringType(),
    "binary": T.BinaryType(),
}


def ship(spark: SparkSession) -> None:
    """Give the executors this package, wherever the driver imported it from."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="dialoom-ship-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for path in sorted(package.rglob("*.py")):
            z.write(path, path.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def map_groups(df: DataFrame, keys: list[str], fn: Callable[[pa.Table], pa.RecordBatch | None], schema: T.StructType, rows: int = 8192) -> DataFrame:
    """Deal rows by ``keys`` and give ``fn`` tables of whole groups, sorted by key, many groups at once.

    A table has about ``rows`` rows, or one larger group; callers bound their groups.
    """
    ship(df.sparkSession)
    bounded_batches(df.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, aim = 0, rows
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size < aim:
                continue
            whole = pa.Table.from_batches(held)
            last = whole.slice(size - 1)
            same = None
            for key in keys:
                part = pc.equal(whole.column(key), last.column(key)[0])
                same = part if same is None else pc.and_(same, part)
            tail = pc.sum(same).as_py() or 1  # sorted: the rows of the last key are the last rows
            held, rest = whole.slice(size - tail).combine_chunks().to_batches(), whole.slice(0, size - tail)
            size, aim = tail, tail + rows
            if rest.num_rows and (out := fn(rest)) is not None and out.num_rows:
                yield out
        if size and (out := fn(pa.Table.from_batches(held))) is not None and out.num_rows:
            yield out

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def struct_of(ddl: str) -> T.StructType:
    """``"a long, b array<int>"`` as a schema; needs no session."""
    fields = []
    for part in ddl.split(", "):
        name, kind = part.split(" ")
        inner = kind.removeprefix("array<").removesuffix(">")
        fields.append(T.StructField(name, T.ArrayType(_TYPES[inner]) if inner != kind else _TYPES[kind]))
    return T.StructType(fields)


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The column as Python strings; null reads as the empty text."""
    return [x or "" for x in batch.column(column).to_pylist()]


def fold_of(column: F.Column | str, parts: int) -> F.Column:
    """crc32 of the id written as text, modulo ``parts`` (null ids count as the text ``null``)."""
    c = F.col(column) if isinstance(column, str) else column
    return F.pmod(F.crc32(F.coalesce(c.cast("string"), F.lit("null")).cast("binary")), F.lit(parts))

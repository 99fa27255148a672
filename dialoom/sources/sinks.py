"""Sinks: JSON lines with explicit nulls, published whole or not at all."""

from __future__ import annotations

import hashlib
import json
import os
import shutil
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Write beside the target and rename: a failing job leaves the previous output as it was.

    The previous output is moved aside, not deleted, until the new one is in its place.
    """
    spark = df.sparkSession
    staged = f"{path}.tmp-{uuid.uuid4().hex}"
    writer = df.write.format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        writer.save(staged)
        previous = f"{path}.old-{uuid.uuid4().hex}"
        replaces = fs.exists(hadoop(path))
        if replaces and not fs.rename(hadoop(path), hadoop(previous)):
            raise OSError(f"could not move {path} aside")
        if not fs.rename(hadoop(staged), hadoop(path)):
            if replaces:
                fs.rename(hadoop(previous), hadoop(path))
            raise OSError(f"could not publish {path}")
        if replaces:
            fs.delete(hadoop(previous), True)
    finally:
        if fs.exists(hadoop(staged)):
            fs.delete(hadoop(staged), True)


def json_lines(df: DataFrame, order: str = "_pos") -> DataFrame:
    """``value``: each row as JSON with its nulls, underscore columns left out."""
    names = [c for c in df.columns if not c.startswith("_")]
    return df.select(order, F.to_json(F.struct(*names), {"ignoreNullFields": "false"}).alias("value"))


def write_jsonl(df: DataFrame, path: str | Path, order: str = "_pos") -> int:
    """One ordered file on the driver's disk, row by row, for datasets of export size; atomic."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    staged = path.with_name(f"{path.name}.tmp-{uuid.uuid4().hex}")
    n = 0
    try:
        with staged.open("w", encoding="utf-8", newline="\n") as out:
            for row in json_lines(df, order).orderBy(order).select("value").toLocalIterator():
                out.write(row["value"] + "\n")
                n += 1
        os.replace(staged, path)
    finally:
        staged.unlink(missing_ok=True)
    return n


def file_sha256(path: str | Path) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def write_json(value: object, path: str | Path) -> None:
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    staged = path.with_name(f"{path.name}.tmp-{uuid.uuid4().hex}")
    staged.write_text(json.dumps(value, ensure_ascii=False, indent=2) + "\n", encoding="utf-8")
    os.replace(staged, path)


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stage's table; malformed lines fail. ``_pos`` follows the file."""
    return spark.read.schema(schema).json(path, mode="FAILFAST").withColumn("_pos", F.monotonically_increasing_id())


def publish_folder(staged: Path, path: Path) -> None:
    """Put a finished folder in the place of an older one."""
    previous = path.with_name(f"{path.name}.old-{uuid.uuid4().hex}")
    replaces = path.exists()
    if replaces:
        os.replace(path, previous)
    os.replace(staged, path)
    if replaces:
        shutil.rmtree(previous)

"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..session import shared_dir

# Bytes of text that one vectorised step handles; longer single texts go alone.
STEP_BYTES = 4 << 20
BATCH_ROWS = 1000

_SENT: dict[str, tempfile.TemporaryDirectory] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole input table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Make this package importable in the tasks, and keep Arrow batches small.

    The package is added once per application with ``addPyFile`` (Spark sends
    it to every executor); small batches keep a task's memory independent of
    the number of rows.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    context, package = spark.sparkContext, Path(__file__).resolve().parents[1]
    if context.applicationId not in _SENT:
        # The driver serves the archive for as long as the application runs.
        staging = tempfile.TemporaryDirectory()
        archive = Path(staging.name, f"{package.name}.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(package.rglob("*.py")):
                out.write(source, source.relative_to(package.parent))
        context.addPyFile(str(archive))
        _SENT[context.applicationId] = staging


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage with files every executor can read: a lost executor
    recomputes only what comes after, and ids drawn before are frozen.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark, purpose)}/data"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_column(column: pa.Array) -> pa.LargeStringArray:
    """A text column with 64-bit offsets, nulls as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def steps(batch: pa.RecordBatch, column: str, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch holding about ``limit`` bytes of ``column`` (one row at least)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = total = 0
    for row, size in enumerate(sizes):
        if row > start and total + size > limit:
            yield batch.slice(start, row - start)
            start, total = row, 0
        total += size
    if start < len(sizes):
        yield batch.slice(start)

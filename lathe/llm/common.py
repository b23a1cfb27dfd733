"""Helpers shared by the training-data operators.

Operators take any DataFrame with the columns they name and first project to
their own column names, so extra columns (also clashing ones) never matter.
Intermediate tables are written to the session's shared checkpoint folder and
read again: lineage is cut, later passes read only the columns they need, and a
lost executor costs a re-read, not a recomputation.
"""

from __future__ import annotations

import atexit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lathe.session import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: ASCII white space as the contracts have it: [\x20\x09-\x0D].
SPACE = " \t\n\x0b\x0c\r"

_SCRATCH: list[tuple[SparkSession, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back; ``options`` of the Parquet writer."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**{"compression": "zstd"} | options).parquet(path)
    _SCRATCH.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete scratch tables that nothing will read again."""
    for df in tables:
        _delete(df.sparkSession, df.scratch)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@atexit.register
def _clean() -> None:
    """Delete this process's scratch tables when it ends with its session still open."""
    for spark, path in _SCRATCH:
        if spark.sparkContext._jsc is not None:
            _delete(spark, path)


def pieces(batches, rows: int = 256):
    """Arrow batches in slices, so Python never holds a whole batch's texts as objects."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)
    pa.default_memory_pool().release_unused()       # the worker lives on; what its task held goes back


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only (other letters stay)."""
    return F.translate(c, UPPER, LOWER)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))

"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

A_Z, a_z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def crc_fold(column: str, modulus: int) -> Column:
    """Remainder of the CRC-32 of an id's decimal text."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(modulus).cast("long"))


class Scratch:
    """Tables written once in the folder that all executors share.

    The folder is the session's ``spark.checkpoint.dir``; a temporary one is taken only
    where none is set and Spark runs on this machine alone (tests). A written table cuts the lineage and outlives executors.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
        if not root:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            root = tempfile.mkdtemp(prefix="wardline-")
            spark.sparkContext.setCheckpointDir(root)
        self.root = f"{root.rstrip('/')}/wardline-{uuid.uuid4().hex}"
        self.taken = 0

    def save(self, df: DataFrame) -> DataFrame:
        self.taken += 1
        path = f"{self.root}/{self.taken}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._wardline_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Remove tables that no later plan reads."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for t in tables:
            path = jvm.org.apache.hadoop.fs.Path(t._wardline_path)
            path.getFileSystem(conf).delete(path, True)


def slices(batches: Iterator[pa.RecordBatch], *columns: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of the batches whose texts take about ``most`` bytes (one row at least), so that a task holds few of them as Python objects.

    After the last one the worker, which Spark keeps for later tasks, gives its free memory back.
    """
    for b in batches:
        size = np.zeros(b.num_rows, np.int64)
        for c in columns:
            size += pc.fill_null(pc.binary_length(b.column(c)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        cuts = np.flatnonzero(np.diff(np.cumsum(size) // most)) + 1
        for lo, hi in pairwise([0, *cuts.tolist(), b.num_rows]):
            if lo < hi:
                yield b.slice(lo, hi - lo)
    give_back()


def give_back() -> None:
    """Return free memory of Arrow's pool and of the C heap to the system, where the platform can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def input_bytes(df: DataFrame, column: str = "text") -> int:
    """UTF-8 bytes of a text column, over all rows."""
    return df.agg(F.coalesce(F.sum(F.octet_length(F.col(column))), F.lit(0))).first()[0]

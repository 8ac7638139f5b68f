"""Tables written once in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame


def saved(df: DataFrame) -> DataFrame:
    """The rows of a plan, written and read again, so that later plans do not run it a second time.

    The folder is the session's ``spark.checkpoint.dir``; a temporary one is taken only where none is set and Spark runs on this machine alone.
    """
    spark = df.sparkSession
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="wardline-")
        spark.sparkContext.setCheckpointDir(root)
    path = f"{root.rstrip('/')}/wardline-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._wardline_saved = True
    return out


def once(df: DataFrame) -> DataFrame:
    """``saved``, unless the table is one already."""
    return df if getattr(df, "_wardline_saved", False) else saved(df)

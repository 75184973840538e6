"""Folders that the driver and all executors see."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session. Where that is unset, a session on one machine (a test) gets a temporary folder; a
    cluster's executors couldn't see one, so there it is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is not set: it has to name a folder that the driver and all executors see")
        found = tempfile.mkdtemp(prefix="lettermill-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def scratch(spark: SparkSession, label: str) -> str:
    """A new name in the shared folder; what is written there goes when the driver ends."""
    path = os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def stored(df: DataFrame, label: str) -> DataFrame:
    """df as Parquet in the shared folder, read back: what several plans start from is computed once."""
    path = scratch(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

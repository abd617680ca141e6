"""Writers: plain Parquet tables with keyed semantics, JSON, clean-up."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share: below spark.checkpoint.dir, which only a session in one process may leave unset."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = tempfile.mkdtemp(prefix="strandline-")
    return f"{at.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def observations(df: DataFrame, path: str, mode: str = "append") -> None:
    """A folder for each collection, so that readers of one see nothing of the others; sorted by time for skipping. Dealt by id too, so that no user's rows are one task's."""
    df.repartition("collection", F.pmod(F.xxhash64("user_id", "id"), F.lit(64))).sortWithinPartitions("collection", "issued").write.mode(mode).partitionBy("collection").parquet(path)


def replace_partitions(df: DataFrame, path: str, by: str) -> None:
    """Replaces the partitions that the frame has rows of, and no others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def swap(df: DataFrame, path: str, version: int) -> str:
    """Writes a new version of a table beside the old ones and returns its folder; readers take that folder, which is complete once this returns."""
    at = f"{path}/v={version}"
    df.write.mode("overwrite").parquet(at)
    return at


def json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def keyed_by_position(df: DataFrame, array: str) -> DataFrame:
    """key and value: an array's entries by their index."""
    return df.select(F.posexplode(array).alias("key", "value"))


def keyed_by_name(df: DataFrame, record: str) -> DataFrame:
    return df.select(F.explode(record).alias("key", "value"))


def remove(df: DataFrame, path_col: str = "path") -> int:
    """Removes the objects whose paths a (small) frame of processed files has; returns how many. Paths come to the driver partition by partition."""
    spark = df.sparkSession
    conf, jvm, n = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm, 0
    for row in df.select(path_col).distinct().toLocalIterator():
        at = jvm.org.apache.hadoop.fs.Path(row[0])
        n += bool(at.getFileSystem(conf).delete(at, False))
    return n

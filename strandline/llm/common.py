"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import atexit
import ctypes
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from functools import cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one block handed to Python code holds, unless one text is longer.
BLOCK_BYTES = 8 << 20
#: Rows of an Arrow batch at most. Texts are long: Spark's default of 10,000 rows would hold tens of MB, several times over, in each task.
ARROW_ROWS = 2_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def short_batches(spark: SparkSession) -> None:
    """Lowers the session's rows per Arrow batch to ARROW_ROWS, for later queries too; a lower setting stays. Spark has no such setting for one query."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **more: str) -> DataFrame:
    """Only the named columns, as doc_id, text and the names in ``more``; others can't clash."""
    short_batches(df.sparkSession)
    cols = {"doc_id": id_col, "text": text_col} | more
    return df.select(*(F.col(f"`{c}`").alias(n) for n, c in cols.items()))


def trim() -> None:
    """Gives memory that is free again back to the system, as Python workers stay for later tasks."""
    pa.default_memory_pool().release_unused()
    give_back = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if give_back:
        give_back(0)


def gathered(df: DataFrame, least_rows: int) -> DataFrame:
    """The frame, with small partitions read together, so that they have about ``least_rows`` rows each. No shuffle; counts the rows."""
    return df.coalesce(max(1, -(-df.count() // least_rows)))


def blocks(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that no block has more than ``limit`` bytes in ``column`` (one row at least)."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start, size = 0, 0
        for i, n in enumerate(lengths):
            if i > start and size + n > limit:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if start < len(lengths):
            yield batch.slice(start)
    trim()


def strings(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The column's values; null counts as empty."""
    return [x or "" for x in batch.column(column).to_pylist()]


def fold(doc_id: str | Column) -> Column:
    """0 to 4: crc32 of the id as text, modulo 5; rows at 0 are held out of every fit."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % 5


class Codes(dict):
    """Gives each new key the next number."""

    def __missing__(self, key):
        n = self[key] = len(self)
        return n


@cache
def _own_dir() -> str:
    path = tempfile.mkdtemp(prefix="strandline-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only a session in one process may leave it unset; it then gets a folder of its own."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = _own_dir()
    return at.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes a frame as Parquet below the shared folder and reads it back, which cuts its lineage: a lost executor costs no recomputation."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Removes what ``materialize`` wrote."""
    for df in frames:
        spark = df.sparkSession
        for path in {re.sub(r"/part-[^/]*$", "", f) for f in df.inputFiles()}:
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)

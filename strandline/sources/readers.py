"""Readers of tables, archives, files and change feeds."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.functions.scalars import archive_collection, archive_user, last_segment


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A Parquet table of a directory; times without a zone are read as UTC instants."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    plain = [f.name for f in df.schema if f.dataType.typeName() == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in plain}) if plain else df


def typed(spark: SparkSession, path: str, schema: str, fmt: str = "parquet", **options) -> DataFrame:
    """Fails on a value that doesn't fit the schema; drops fields that it doesn't name."""
    return spark.read.format(fmt).schema(schema).options(mode="FAILFAST", **options).load(path)


def with_envelope(df: DataFrame, id_col: str, path, last_update=None) -> DataFrame:
    """id, path, last_update and the record itself as ``content``."""
    update = F.lit(None).cast("timestamp") if last_update is None else last_update
    return df.select(F.col(id_col).alias("id"), path.alias("path"), update.alias("last_update"), F.struct(*df.columns).alias("content"))


def record(df: DataFrame, key: str, value) -> DataFrame:
    """The record of a key; the filter reaches the scan."""
    return df.where(F.col(key) == value).limit(1)


def collections_of(observations: DataFrame) -> DataFrame:
    """user_id and collection: names of the collections that each user has. A filter on user_id reaches the scan."""
    return observations.select("user_id", "collection").distinct()


def compressed(text: Column) -> Column:
    """Texts as zstd archives."""

    def pack(contents: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import pyarrow as pa

        for series in contents:
            yield series.map(lambda x: None if x is None else pa.compress(x.encode(), codec="zstd", asbytes=True))

    return F.pandas_udf(pack, T.BinaryType())(text)


def decompress(contents: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """zstd to text, streamed; null where the bytes are no zstd or no UTF-8."""
    import pyarrow as pa

    def one(data: bytes | None) -> str | None:
        if data is None:
            return None
        try:
            with pa.CompressedInputStream(pa.BufferReader(data), "zstd") as stream:
                return stream.read().decode("utf-8")
        except (OSError, UnicodeDecodeError, pa.ArrowInvalid):
            return None

    for series in contents:
        yield series.map(one)


def objects(spark: SparkSession, path: str, pattern: str = "*.json.zstd") -> DataFrame:
    """path and content of stored objects below a folder."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path).select("path", "content")


def archives(files: DataFrame) -> DataFrame:
    """Each archive with user_id, file, collection, rows (variant) and status; files whose path is no archive's are left out.

    status: bad_file and not_an_array (the file stays), empty (it may go), unknown_name (it
    stays), ok. One file is one row of one task; nothing else gathers its rows.
    """
    unpack = F.pandas_udf(decompress, T.StringType())
    named = files.withColumns({"user_id": archive_user(F.col("path")), "file": last_segment(F.col("path"))}).where("user_id is not null")
    parsed = named.withColumn("_json", F.try_parse_json(unpack("content"))).drop("content")
    kind = F.coalesce(F.expr("schema_of_variant(_json)"), F.lit(""))
    collection = archive_collection(F.col("file"))
    status = (
        F.when(F.col("_json").isNull(), "bad_file")
        .when(~kind.startswith("ARRAY"), "not_an_array")
        .when(F.coalesce(F.size(F.expr("try_variant_get(_json, '$', 'array<variant>')")), F.lit(0)) == 0, "empty")
        .when(collection.isNull(), "unknown_name")
        .otherwise("ok")
    )
    return parsed.select("path", "user_id", "file", collection.alias("collection"), F.col("_json").alias("rows"), status.alias("status"))


def archive_samples(read: DataFrame) -> DataFrame:
    """user_id, collection, id, json: the valid rows of good archives, the last of equal ids in a file."""
    each = read.where("status = 'ok'").select("path", "user_id", "collection", F.posexplode(F.expr("try_variant_get(rows, '$', 'array<variant>')")).alias("pos", "row"))
    valid = each.where(F.expr("schema_of_variant(row) LIKE 'OBJECT%' AND schema_of_variant(try_variant_get(row, '$.id', 'variant')) = 'STRING'"))
    keyed = valid.select("path", "user_id", "collection", "pos", F.expr("try_variant_get(row, '$.id', 'string')").alias("id"), F.to_json("row").alias("json")).where("id <> ''")
    return keyed.groupBy("path", "user_id", "collection", "id").agg(F.max_by("json", "pos").alias("json")).drop("path")


def json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of files that hold a JSON array each."""
    return spark.read.option("multiLine", True).option("mode", "FAILFAST").schema(schema).json(path)


def json_record(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """key and value of files that hold a JSON object of records each."""
    text = spark.read.option("wholetext", True).text(path)
    return text.select(F.explode(F.from_json("value", f"map<string,struct<{schema}>>", {"mode": "FAILFAST"})).alias("key", "value"))


def csv_rows(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    return spark.read.option("multiLine", True).option("escape", '"').option("header", header).csv(path)


def cached(spark: SparkSession, path: str, strategy: str, compute: Callable[[], DataFrame]) -> DataFrame:
    """Strategies: read_or_compute, compute_and_store, read_only, compute_only."""
    from pyspark.errors import AnalysisException

    if strategy in ("read_or_compute", "read_only"):
        try:
            return spark.read.parquet(path)
        except AnalysisException:
            if strategy == "read_only":
                raise
    df = compute()
    if strategy == "compute_only":
        return df
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)

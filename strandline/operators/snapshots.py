"""History of documents: debounced snapshots and change records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions.scalars import content_hash

WINDOW_MS = 120_000


def without_keys(content: Column, keys: list[str]) -> Column:
    """A map without volatile keys and null values."""
    return F.map_filter(content, lambda k, v: ~k.isin(*keys) & v.isNotNull())


def debounced(versions: DataFrame, content: Column, key: str = "user_id", time: str = "t", order: str = "seq", window_ms: int = WINDOW_MS) -> DataFrame:
    """The snapshots that are left of a document's versions.

    A version equal to the one before it is no change. A changed version within
    ``window_ms`` whole milliseconds (inclusive) of the last snapshot replaces it and moves its time; a later
    one is a new snapshot. As the last snapshot always holds the last changed version, this
    is: drop equal neighbours, cut where the gap is longer than the window, keep the last of
    each run. One sort by key, no state.
    """
    by = Window.partitionBy(key).orderBy(time, order)
    changed = versions.withColumn("_c", content).withColumn("_before", F.lag("_c").over(by)).withColumn("_n", F.row_number().over(by)).where((F.col("_n") == 1) | ~F.col("_c").eqNullSafe(F.col("_before")))
    gap = F.unix_millis(time) - F.unix_millis(F.lag(time).over(by))
    runs = changed.withColumn("_run", F.sum(F.when(gap > window_ms, 1).otherwise(0)).over(by))
    last = Window.partitionBy(key, "_run").orderBy(F.desc(time), F.desc(order))
    return runs.withColumn("_l", F.row_number().over(last)).where("_l = 1").drop("_c", "_before", "_n", "_run", "_l")


def changes(before: DataFrame, after: DataFrame, key: str, json: str) -> DataFrame:
    """key, before, after: two versions of a table, side by side."""
    b, a = before.select(key, F.col(json).alias("before")), after.select(key, F.col(json).alias("after"))
    return b.join(a, key, "full_outer")


def change_records(rows: DataFrame, path: str = "path", before: str = "before", after: str = "after", time: str | None = None) -> DataFrame:
    """path, type (created, updated, deleted), before, data: of changes that change something. JSON that differs in the order of keys is equal."""
    b, a = F.col(before), F.col(after)
    real = rows.where(F.col(path).isNotNull() & ~content_hash(b).eqNullSafe(content_hash(a)))
    kind = F.when(b.isNull(), "created").when(a.isNull(), "deleted").otherwise("updated")
    return real.select(F.col(path), kind.alias("type"), b.alias("before"), a.alias("data"), *([F.col(time).alias("date")] if time else []))

"""Structured Streaming jobs around the batch transforms."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from strandline.operators.snapshots import WINDOW_MS

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def changes(spark: SparkSession, path: str, schema: str, fmt: str = "json", per_trigger: int | None = None) -> DataFrame:
    """A change feed from files that arrive in a folder."""
    reader = spark.readStream.format(fmt).schema(schema)
    return (reader.option("maxFilesPerTrigger", per_trigger) if per_trigger else reader).load(path)


def replayed(spark: SparkSession, folder: str, name: str, schema) -> DataFrame:
    """A stored Parquet table as a feed."""
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def last_state(result: DataFrame, sink: str, checkpoint: str):
    """Writes the whole result of an aggregation after each epoch in place of the one before."""
    return result.writeStream.outputMode("complete").foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(sink)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def each_batch(feed: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None = None):
    """Runs a batch transform over each epoch; ``work`` must be idempotent by key, as an epoch may be run again."""
    return feed.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def score_feed(feed: DataFrame, score: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str):
    """Scores new and changed responses; deletions have no ``after`` and are passed over. An epoch that is run again overwrites its own folder."""

    def work(batch: DataFrame, epoch: int) -> None:
        live = batch.where("after is not null")
        score(live).write.mode("overwrite").parquet(f"{sink}/epoch={epoch}")

    return each_batch(feed, work, checkpoint)


def once_each(feed: DataFrame, keys: list[str], time: str, within: str = "48 hours") -> DataFrame:
    """The first row of each key within a watermark: enqueueing again within that time changes nothing. A later repeat comes through; ``deletion.enqueue`` against the stored queue drops it."""
    return feed.withWatermark(time, within).dropDuplicatesWithinWatermark(keys)


def late_matches(requests: DataFrame, samples: DataFrame, within: str = "48 hours") -> DataFrame:
    """Deletion requests with the sample they name, if it arrives in time; else with nulls. requests: user_id, collection, id, requested_at; samples: the same keys, arrived_at."""
    r = requests.withWatermark("requested_at", within).alias("r")
    s = samples.withWatermark("arrived_at", within).alias("s")
    same = F.expr(f"r.user_id = s.user_id AND r.collection = s.collection AND r.id = s.id AND s.arrived_at BETWEEN r.requested_at - INTERVAL {within} AND r.requested_at + INTERVAL {within}")
    return r.join(s, same, "leftOuter").select("r.user_id", "r.collection", "r.id", "r.requested_at", "s.arrived_at")


SNAPSHOT_SCHEMA = "user_id string, snapshot long, content string, captured_ms long"


class Debounce(StatefulProcessor):
    """The state machine of debounced snapshots: emits each state of each snapshot; the last one of a snapshot number holds."""

    def __init__(self, window_ms: int = WINDOW_MS):
        self.window_ms = window_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "snapshot long, content string, captured_ms long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        arrived = pd.concat(list(rows)).sort_values(["t_ms", "seq"], kind="stable")
        held = self.last.get() if self.last.exists() else None
        out = []
        for t, content in zip(arrived["t_ms"].tolist(), arrived["content"].tolist(), strict=True):
            if held is not None and held[1] == content:
                continue
            number = 0 if held is None else held[0] if t - held[2] <= self.window_ms else held[0] + 1
            held = (number, content, t)
            out.append((key[0], *held))
        if out:
            self.last.update(held)
            yield pd.DataFrame(out, columns=["user_id", "snapshot", "content", "captured_ms"])

    def close(self) -> None:
        pass


def debounce(versions: DataFrame, window_ms: int = WINDOW_MS) -> DataFrame:
    """Streaming snapshots of user_id, t_ms, seq, content. Needs the RocksDB state store."""
    return versions.groupBy("user_id").transformWithStateInPandas(
        statefulProcessor=Debounce(window_ms), outputStructType=SNAPSHOT_SCHEMA, outputMode="Append", timeMode="None"
    )


def windowed_counts(events: DataFrame, time: str, key: str, every: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    return events.withWatermark(time, late).groupBy(F.window(time, every), key).agg(F.count("*").alias("n"))

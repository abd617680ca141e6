"""Soft deletion of samples and the queue that retries it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions import vocab
from strandline.functions.scalars import backoff, percent

MAX_RETRIES = 3
BATCH = 500
DELETED = "entered-in-error"


def request_error(user: Column, collection: Column, ids: Column, most: int = 50_000) -> Column:
    """'invalid-argument' for a request without user, collection or ids, with an empty id or with more than ``most``; else null."""
    named = (F.coalesce(user, F.lit("")) != "") & (F.coalesce(collection, F.lit("")) != "")
    listed = F.coalesce(F.size(ids), F.lit(0)).between(1, most) & F.coalesce(F.forall(ids, lambda x: F.coalesce(x, F.lit("")) != ""), F.lit(False))
    return F.when(~(named & listed), "invalid-argument")


def check_request(user_id: str, collection: str, ids: list[str], most: int = 50_000) -> None:
    """Raises ValueError for a request that isn't valid."""
    if not user_id or not collection:
        raise ValueError("user and collection must not be empty")
    if not 1 <= len(ids) <= most or not all(ids):
        raise ValueError(f"1 to {most} ids, none empty")


def mark(requests: DataFrame, observations: DataFrame, keys: tuple[str, ...] = ("user_id", "collection", "id")) -> DataFrame:
    """outcome of each request: 'marked' where the sample exists, else 'queued'. ``observations`` needs the keys only."""
    there = observations.select(*keys).distinct().withColumn("_there", F.lit(True))
    return requests.join(there, list(keys), "left").withColumn("outcome", F.when(F.col("_there"), "marked").otherwise("queued")).drop("_there")


def with_deleted(observations: DataFrame, marked: DataFrame, keys: tuple[str, ...] = ("user_id", "collection", "id")) -> DataFrame:
    hit = marked.select(*keys).distinct().withColumn("_hit", F.lit(True))
    return observations.join(hit, list(keys), "left").withColumn("status", F.when(F.col("_hit"), DELETED).otherwise(F.col("status"))).drop("_hit")


def summary(outcomes: DataFrame) -> DataFrame:
    """Counts by outcome and the share that was marked."""
    n = lambda x: F.count_if(F.col("outcome") == x)
    return outcomes.agg(
        n("marked").alias("total_marked"), n("skipped").alias("total_skipped"), n("failed").alias("total_failed"), n("queued").alias("total_queued"), percent(n("marked"), F.count("*")).alias("success_rate")
    )


def queued(outcomes: DataFrame, job_id: str, requested_by: str, now: Column, reason: str = "NOT_FOUND") -> DataFrame:
    """Queue rows for what wasn't marked; the first try comes after the base delay."""
    rows = outcomes.where("outcome = 'queued'")
    return rows.select(
        "user_id", F.concat_ws("__", "collection", "id").alias("queue_id"), F.col("user_id").alias("userId"), "collection", F.col("id").alias("documentId"), F.lit(job_id).alias("jobId"),
        F.lit(requested_by).alias("requestingUserId"), F.lit(reason).alias("reason"), F.lit("UNKNOWN_ERROR").alias("lastError"), F.lit(0).alias("retryCount"), now.alias("createdAt"), backoff(now, F.lit(0)).alias("nextRetryAt"),
    )


def enqueue(queue: DataFrame, new: DataFrame, keys: tuple[str, ...] = ("user_id", "queue_id")) -> DataFrame:
    """Adds what isn't queued yet; rows that are keep their retry state."""
    fresh = new.dropDuplicates(list(keys)).join(queue.select(*keys), list(keys), "left_anti")
    return queue.unionByName(fresh)


def due_items(queue: DataFrame, now: Column, order: str = "queue_id", limit: int = BATCH) -> DataFrame:
    """The items of one run: the longest due first. The limit is the run's size; later runs take the rest."""
    return queue.where(F.col("nextRetryAt") <= now).orderBy("nextRetryAt", order).limit(limit)


def path_owner(path: Column) -> Column:
    """The owner in users/{owner}/pendingHealthSampleDeletions/{id}; null for any other path."""
    p = F.split(path, "/")
    return F.when((F.size(p) == 4) & (p[0] == "users") & (p[2] == "pendingHealthSampleDeletions") & (p[1] != "") & (p[3] != ""), p[1])


def item_error(owner: Column) -> Column:
    """What is wrong with a queue item, by the first check that fails; null if nothing is."""
    doc = F.coalesce("documentId", F.lit(""))

    def says(fault: str, column: str, *more: Column) -> Column:
        parts = [F.coalesce(F.col(column).cast("string"), F.lit("undefined")), *more]
        texts = vocab.QUEUE_ERRORS[fault]
        return F.concat(F.lit(texts[0]), *(x for part, text in zip(parts, texts[1:], strict=True) for x in (part, F.lit(text))))

    return (
        F.when(~F.col("userId").eqNullSafe(owner), says("owner", "userId", owner))
        .when(~F.coalesce(F.col("collection").rlike(vocab.COLLECTION_PATTERN), F.lit(False)), says("collection", "collection"))
        .when((doc == "") | doc.contains("/"), says("document", "documentId"))
        .when(F.coalesce(F.col("retryCount") < 0, F.lit(True)), says("retries", "retryCount"))
        .when(~F.coalesce(F.col("reason").isin(*vocab.RETRY_REASONS), F.lit(False)), says("reason", "reason"))
    )


def tick(items: DataFrame, observations: DataFrame, now: Column, owner: Column | None = None) -> DataFrame:
    """One run over due items: each with error, outcome (succeeded, requeued, dead-lettered, skipped), newRetryCount, newNextRetryAt."""
    owner = F.col("user_id") if owner is None else owner
    there = observations.select(F.col("user_id").alias("_u"), F.col("collection").alias("_c"), F.col("id").alias("_i")).distinct().withColumn("_there", F.lit(True))
    rows = items.withColumn("error", item_error(owner))
    rows = rows.join(there, (F.col("user_id") == F.col("_u")) & (F.col("collection") == F.col("_c")) & (F.col("documentId") == F.col("_i")), "left").drop("_u", "_c", "_i")
    count = F.col("retryCount") + 1
    outcome = F.when(F.col("error").isNotNull(), "skipped").when(F.col("_there"), "succeeded").when(count >= MAX_RETRIES, "dead-lettered").otherwise("requeued")
    rows = rows.withColumn("outcome", outcome).drop("_there")
    again = F.col("outcome") == "requeued"
    return rows.withColumns({"newRetryCount": F.when(again, count), "newNextRetryAt": F.when(again, backoff(now, count))})


def after_tick(queue: DataFrame, done: DataFrame, keys: tuple[str, ...] = ("user_id", "queue_id")) -> DataFrame:
    """The queue after a run: requeued items with their new state, items that weren't due as they were, all others gone."""
    state = done.select(*keys, F.col("outcome").alias("_o"), F.col("newRetryCount").alias("_n"), F.col("newNextRetryAt").alias("_t"))
    rows = queue.join(state, list(keys), "left").where(F.col("_o").isNull() | (F.col("_o") == "requeued"))
    return rows.withColumns({"retryCount": F.coalesce("_n", "retryCount"), "nextRetryAt": F.coalesce("_t", "nextRetryAt"), "lastError": F.when(F.col("_o").isNotNull(), "NOT_FOUND").otherwise(F.col("lastError"))}).drop("_o", "_n", "_t")


def run_summary(done: DataFrame) -> DataFrame:
    n = lambda x: F.count_if(F.col("outcome") == x)
    return done.agg(F.count("*").alias("processed"), n("succeeded").alias("succeeded"), n("requeued").alias("requeued"), n("dead-lettered").alias("dead_lettered"), n("skipped").alias("skipped"))

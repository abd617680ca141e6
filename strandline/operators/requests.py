"""Requests as rows: request_id, caller (null if not signed in), data (JSON). Each entry gives a response a request, and the rows to be written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions.codecs import Codec
from strandline.functions.scalars import iso_time
from strandline.operators import accounts, deletion

NOTHING = Codec("unused string")
WAITLIST = Codec("region string, email string", ["region", "email"])
DELETION = Codec("userId string, collection string, documentIds array<string>", ["userId", "collection", "documentIds"])
PROFILE = "displayName string, email string, phoneNumber string, photoURL string"
INFORMATION = Codec(f"userId string, data struct<auth:struct<{', '.join(f.strip().replace(' ', ':', 1) for f in PROFILE.split(','))}>>", ["userId", "data"])


def validated(requests: DataFrame, codec: Codec) -> DataFrame:
    """Requests with ``input``, the decoded data, and ``error``: 'invalid-argument' where it doesn't fit."""
    rows = requests.withColumn("input", codec.decode(F.coalesce("data", F.lit("{}"))))
    return rows.withColumn("error", F.when(F.col("input").isNull(), "invalid-argument"))


def caller_error(target: Column | None = None) -> Column:
    """'unauthenticated' without a caller, 'permission-denied' where the target isn't the caller."""
    missing = F.coalesce("caller", F.lit("")) == ""
    found = F.when(missing, "unauthenticated")
    return found if target is None else found.when(~target.eqNullSafe(F.col("caller")), "permission-denied")


def join_waitlist(requests: DataFrame, regions: list[str], now: Column) -> tuple[DataFrame, DataFrame]:
    """(request_id, error) and the rows of the waitlist, one a region and address. Needs no caller."""
    rows = validated(requests, WAITLIST).select("request_id", "error", "input.region", "input.email", now.alias("createdAt"))
    answers = rows.select("request_id", F.coalesce("error", F.when(accounts.waitlist_error(regions).isNotNull(), "invalid-argument")).alias("error"))
    return answers, accounts.waitlisted(rows.where("error is null"), regions)


def mark_account(requests: DataFrame, users: DataFrame, action: str, now: Column) -> tuple[DataFrame, DataFrame]:
    """(request_id, error, marked_at) and the callers as they are after it. action: delete, withdraw or reenroll.

    Of several requests of one caller the first by id is answered by the state of the user, and the
    others by the state after it.
    """
    rows = validated(requests, NOTHING).select("request_id", "caller", F.coalesce("error", caller_error()).alias("error"))
    good = rows.where("error is null")
    first = good.groupBy(F.col("caller").alias("user_id")).agg(F.min("request_id").alias("_first"), F.col("user_id").alias("requested_by"))
    after = accounts.transition(users, first, action, now)
    state = after.select(F.col("user_id").alias("caller"), "_first", F.col("error").alias("_error"))
    again = {"delete": "already-exists", "withdraw": "already-exists", "reenroll": "failed-precondition"}[action]
    error = F.coalesce("error", "_error", F.when(F.col("request_id") != F.col("_first"), again))
    answers = rows.join(state, "caller", "left").select("request_id", error.alias("error"), F.when(error.isNull(), iso_time(now)).alias("marked_at"))
    return answers, after.where("error is null").drop("_first", "requested_by", "error")


def delete_samples(requests: DataFrame, users: DataFrame, observations: DataFrame, now: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Responses (request_id, error, status and counts), the samples to be marked, and the rows for the queue.

    A job is named by its request. Ids are counted as often as a request names them and marked once.
    """
    rows = validated(requests, DELETION)
    error = F.coalesce("error", deletion.request_error(F.col("input.userId"), F.col("input.collection"), F.col("input.documentIds")), caller_error(F.col("input.userId")))
    rows = rows.withColumn("error", error)
    gone = users.where("hasWithdrawnFromStudy").select(F.col("user_id").alias("_gone")).distinct()
    rows = rows.join(gone, F.col("input.userId") == F.col("_gone"), "left")
    rows = rows.withColumn("error", F.coalesce("error", F.when(F.col("_gone").isNotNull(), "failed-precondition")))
    each = rows.where("error is null").select("request_id", "caller", F.col("input.userId").alias("user_id"), F.col("input.collection").alias("collection"), F.explode("input.documentIds").alias("id"))
    outcomes = deletion.mark(each, observations)
    n = lambda x: F.count_if(F.col("outcome") == x)
    counts = outcomes.groupBy("request_id").agg(F.count("*").alias("total_samples"), n("marked").alias("total_marked"), n("queued").alias("total_queued"))
    answers = rows.select("request_id", "error").join(counts, "request_id", "left")
    answers = answers.select("request_id", "error", F.when(F.col("error").isNull(), "accepted").alias("status"), "total_samples", "total_marked", "total_queued")
    marked = outcomes.where("outcome = 'marked'").select("user_id", "collection", "id").distinct()
    waiting = deletion.queued(outcomes, F.concat(F.lit("del_"), F.col("request_id").cast("string")), F.col("caller"), now)
    return answers, marked, waiting.dropDuplicates(["user_id", "queue_id"])


def update_information(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(request_id, error) and the profile fields that callers set for themselves; of several requests the last by id holds."""
    rows = validated(requests, INFORMATION)
    rows = rows.withColumn("error", F.coalesce("error", caller_error(F.col("input.userId"))))
    good = rows.where("error is null")
    last = good.groupBy(F.col("input.userId").alias("user_id")).agg(F.max_by("input.data.auth", "request_id").alias("auth"))
    return rows.select("request_id", "error"), last.select("user_id", "auth.*")

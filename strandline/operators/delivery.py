"""Delivery of due notifications: backlog to history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.operators.accounts import overwrite
from strandline.operators.nudges import true


def deliverable() -> Column:
    return F.col("timeZone").isNotNull() & ~true("disabled") & ~true("hasWithdrawnFromStudy")


def due(backlog: DataFrame, users: DataFrame, now: Column) -> DataFrame:
    """Due rows of deliverable users, with fcmToken."""
    ready = users.where(deliverable()).select("user_id", "fcmToken")
    return backlog.where(F.col("timestamp") <= now).join(ready, "user_id")


def archived(due_rows: DataFrame, now: Column, outcome: DataFrame | None = None, no_token: str = "no token") -> DataFrame:
    """History rows: timestamp becomes originalTimestamp; status and error are added; all else passes through.

    outcome (user_id, id, ok, error) has what sending gave; without it, rows with a token
    count as sent.
    """
    rows = due_rows
    if outcome is not None:
        rows = rows.join(outcome.select("user_id", "id", "ok", "error"), ["user_id", "id"], "left")
        ok, error = F.coalesce("ok", F.lit(False)), F.col("error")
    else:
        ok, error = F.lit(True), F.lit(None).cast("string")
    has = F.coalesce("fcmToken", F.lit("")) != ""
    status = F.when(has & ok, "sent").otherwise("failed")
    message = F.when(~has, F.lit(no_token)).when(~ok, error)
    out = rows.withColumns({"status": status, "errorMessage": message, "processedTimestamp": now}).withColumnRenamed("timestamp", "originalTimestamp").drop("fcmToken", "ok", "error")
    flag = F.coalesce("isLLMGenerated", F.lit(False)) if "isLLMGenerated" in out.columns else F.lit(False)
    return out.withColumn("isLLMGenerated", flag)


def remaining(backlog: DataFrame, delivered: DataFrame) -> DataFrame:
    """The backlog without what was delivered, whether or not sending succeeded."""
    return backlog.join(delivered.select("user_id", "id").distinct(), ["user_id", "id"], "left_anti")


def delivered(backlog: DataFrame, history: DataFrame, users: DataFrame, now: Column, outcome: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """History and backlog after one delivery. History is written by key before the backlog loses its rows, so a run that broke off between
    the two can simply be run again: the same rows are due, and take the place of those it wrote."""
    sent = archived(due(backlog, users, now), now, outcome)
    return overwrite(history, sent, ["user_id", "id"]), remaining(backlog, sent)


def counters(backlog: DataFrame, users: DataFrame, now: Column, delivered: DataFrame) -> DataFrame:
    """total_processed (rows of deliverable users), total_due (sent or failed), total_sent."""
    seen = backlog.join(users.where(deliverable()).select("user_id"), "user_id", "left_semi").agg(F.count("*").alias("total_processed"))
    done = delivered.agg(F.count("*").alias("total_due"), F.count_if(F.col("status") == "sent").alias("total_sent"))
    return seen.crossJoin(done)  # one row each

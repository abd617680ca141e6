"""Texts and rows for people: feedback reports, messages, heart-rate series for tests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions.scalars import fill_template, shifted


def feedback_report(feedback: DataFrame, fields: list[str], subject: str, head: str) -> DataFrame:
    """id, subject and text: a line for each field that isn't null. Templates take @0 for the id."""
    lines = F.array_compact(F.array(*(F.when(F.col(f).isNotNull(), F.concat(F.lit(f"{f}: "), F.col(f).cast("string"))) for f in fields)))
    return feedback.select("id", fill_template(F.lit(subject), F.col("id")).alias("subject"), F.concat_ws("\n", fill_template(F.lit(head), F.col("id")), F.array_join(lines, "\n")).alias("text"))


def messages(users: DataFrame, templates: list[dict], created: Column) -> DataFrame:
    """Every user with every template: type, title, description (texts with @0 for the name), action, dismissible, due_days. The templates are a fixed list, exploded per row."""
    rows = F.array(
        *(
            F.struct(
                F.lit(t["type"]).alias("type"), F.lit(t["title"]).alias("title"), F.lit(t["description"]).alias("description"), F.lit(t.get("action")).cast("string").alias("action"),
                F.lit(bool(t.get("dismissible"))).alias("isDismissible"), F.lit(t.get("due_days")).cast("int").alias("due"),
            )
            for t in templates
        )
    )
    each = users.withColumn("m", F.explode(rows))
    name = F.coalesce(F.col("displayName"), F.lit("Patient"))
    return each.select(
        "user_id", created.alias("creationDate"), F.when(F.col("m.due").isNotNull(), F.timestamp_micros(F.unix_micros(created) + F.col("m.due").cast("long") * 86_400_000_000)).alias("dueDate"), F.col("m.type").alias("type"),
        F.create_map(F.lit("en"), fill_template(F.col("m.title"), name)).alias("title"), F.create_map(F.lit("en"), fill_template(F.col("m.description"), name)).alias("description"), F.col("m.action").alias("action"), "m.isDismissible",
    )


def heart_rate_series(users: DataFrame, numbers: list[int], now: Column) -> DataFrame:
    """60 + 40 n for each of the numbers, one a day going back."""
    each = users.select("user_id", F.posexplode(F.array(*map(F.lit, numbers))).alias("day", "n"))
    return each.select("user_id", (F.lit(60) + F.col("n") * 40).cast("double").alias("value"), F.timestamp_micros(F.unix_micros(now) - F.col("day").cast("long") * 86_400_000_000).alias("date"), shifted(now).alias("issued"))

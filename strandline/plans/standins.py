"""The driver's tables in the roles of the study's tables, for Spark and (as SQL) for DuckDB."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.sources.readers import table

NOW_TEXT = "2024-03-07 08:00:00"  # a few days before clocks change in the US


def now() -> Column:
    return F.to_timestamp(F.lit(NOW_TEXT))


def stamp(c: Column) -> Column:
    """As text, so that no engine's own time type takes part in a comparison."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    every = lambda n, r=0: (k % n) == r
    zone = F.when(every(37), None).when(every(5), "America/New_York").when(every(5, 1), "America/Los_Angeles").when(every(5, 2), "Europe/London").when(every(5, 3), "Asia/Tokyo").otherwise("Australia/Sydney")
    clock = F.when(every(4), "07:30").when(every(4, 1), "18:15").when(every(4, 2), "  ")
    at = lambda days: F.timestamp_micros(F.unix_micros(now()) - days.cast("long") * 86_400_000_000 - F.lit(3_600_000_000))
    return table(spark, sf_dir, "customer").select(
        k.alias("user_id"),
        zone.alias("timeZone"),
        (k % 3).cast("int").alias("participantGroup"),
        at(k % 30).alias("dateOfEnrollment"),
        every(20).alias("disabled"),
        every(23).alias("hasWithdrawnFromStudy"),
        (~every(11)).alias("didOptInToTrial"),
        F.when(every(17), "consent").otherwise("finalStep").alias("mostRecentOnboardingStep"),
        every(50).alias("triggerNudgeGeneration"),
        clock.alias("preferredNotificationTime"),
        F.when(every(13), None).otherwise(~every(7)).alias("extendedActivityNudgesOptIn"),
        at(k % 19).alias("lastActiveDate"),
        F.when(every(9), "").when(every(9, 1), None).otherwise(F.concat(F.lit("token"), k.cast("string"))).alias("fcmToken"),
        F.when(every(29), F.expr("array(named_struct('action', 'withdrawn', 'timestamp', timestamp'2024-01-01 00:00:00', 'requestedBy', 'x'))")).alias("studyEnrollmentHistory"),
        every(31).alias("toBeDeleted"),
        F.col("c_name"),
        F.col("c_mktsegment"),
    )


USERS_SQL = """users AS (
  SELECT c_custkey AS user_id,
    CASE WHEN c_custkey % 37 = 0 THEN NULL WHEN c_custkey % 5 = 0 THEN 'America/New_York' WHEN c_custkey % 5 = 1 THEN 'America/Los_Angeles'
      WHEN c_custkey % 5 = 2 THEN 'Europe/London' WHEN c_custkey % 5 = 3 THEN 'Asia/Tokyo' ELSE 'Australia/Sydney' END AS zone,
    CAST(c_custkey % 3 AS INTEGER) AS grp,
    TIMESTAMP '2024-03-07 08:00:00' - to_hours(CAST((c_custkey % 30) * 24 + 1 AS INTEGER)) AS enrolled,
    c_custkey % 20 = 0 AS disabled, c_custkey % 23 = 0 AS withdrawn, c_custkey % 11 <> 0 AS opted,
    CASE WHEN c_custkey % 17 = 0 THEN 'consent' ELSE 'finalStep' END AS step, c_custkey % 50 = 0 AS manual,
    CASE WHEN c_custkey % 4 = 0 THEN '07:30' WHEN c_custkey % 4 = 1 THEN '18:15' WHEN c_custkey % 4 = 2 THEN '  ' END AS clock,
    CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_custkey % 7 <> 0 END AS extended,
    TIMESTAMP '2024-03-07 08:00:00' - to_hours(CAST((c_custkey % 19) * 24 + 1 AS INTEGER)) AS active,
    CASE WHEN c_custkey % 9 = 0 THEN '' WHEN c_custkey % 9 = 1 THEN NULL ELSE 'token' || c_custkey END AS token,
    c_custkey % 29 = 0 AS has_history, c_custkey % 31 = 0 AS doomed, c_name, c_mktsegment,
    CASE WHEN coalesce(trim(CASE WHEN c_custkey % 4 = 0 THEN '07:30' WHEN c_custkey % 4 = 1 THEN '18:15' ELSE '' END), '') = '' THEN TIME '09:00:00'
      WHEN c_custkey % 4 = 0 THEN TIME '07:30:00' ELSE TIME '18:15:00' END AS wall
  FROM customer
)"""


def backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open orders, moved into the weeks around now."""
    o = table(spark, sf_dir, "orders").where("o_orderstatus = 'O'")
    k = F.col("o_orderkey")
    return o.select(
        F.col("o_custkey").alias("user_id"),
        k.alias("id"),
        F.col("o_orderpriority").alias("title"),
        F.concat(F.lit("body "), k.cast("string")).alias("body"),
        F.timestamp_micros(F.unix_micros(now()) + (k % 41 - 20).cast("long") * 3_600_000_000 * 6).alias("timestamp"),
        F.when(k % 2 == 0, "posttrial").otherwise("trial").alias("category"),
        F.when(k % 3 == 0, True).alias("isLLMGenerated"),
    )


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filled orders; every fifth has the id of an open one."""
    o = table(spark, sf_dir, "orders").where("o_orderstatus <> 'O'")
    k = F.col("o_orderkey")
    return o.select(
        F.col("o_custkey").alias("user_id"),
        k.alias("id"),
        F.concat(F.lit("sent "), k.cast("string")).alias("body"),
        F.timestamp_micros(F.unix_micros(now()) - (k % 53).cast("long") * 3_600_000_000 * 5 - k.cast("long") * 1_000_000).alias("originalTimestamp"),
        F.when(k % 2 == 0, "posttrial").otherwise("trial").alias("category"),
    )


BACKLOG_SQL = """backlog AS (
  SELECT o_custkey AS user_id, o_orderkey AS id, o_orderpriority AS title, 'body ' || o_orderkey AS body,
    TIMESTAMP '2024-03-07 08:00:00' + to_hours(CAST((o_orderkey % 41 - 20) * 6 AS INTEGER)) AS ts,
    CASE WHEN o_orderkey % 2 = 0 THEN 'posttrial' ELSE 'trial' END AS category, o_orderkey % 3 = 0 AS generated
  FROM orders WHERE o_orderstatus = 'O'
)"""
HISTORY_SQL = """history AS (
  SELECT o_custkey AS user_id, o_orderkey AS id, 'sent ' || o_orderkey AS body,
    TIMESTAMP '2024-03-07 08:00:00' - to_hours(CAST((o_orderkey % 53) * 5 AS INTEGER)) - to_seconds(CAST(o_orderkey AS INTEGER)) AS ts,
    CASE WHEN o_orderkey % 2 = 0 THEN 'posttrial' ELSE 'trial' END AS category
  FROM orders WHERE o_orderstatus <> 'O'
)"""


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a user as versions of the user's document."""
    e = table(spark, sf_dir, "events")
    return e.select("user_id", F.col("ts").alias("t"), F.col("event_id").alias("seq"), F.concat_ws("|", "event_type", F.floor(F.col("value") / 25).cast("string")).alias("content"), "props")


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as answers; a line number that occurs twice in an order doesn't count."""
    line = table(spark, sf_dir, "lineitem")
    return line.select(
        F.col("l_orderkey").alias("response_id"),
        F.col("l_linenumber").cast("string").alias("link_id"),
        (F.col("l_linestatus") == "O").alias("value_boolean"),
        (F.col("l_quantity").cast("int") % 6).alias("points"),
    )


ANSWERS_SQL = """answers AS (
  SELECT l_orderkey AS response_id, l_linenumber AS link, any_value(l_linestatus) = 'O' AS yes, CAST(any_value(l_quantity) AS INTEGER) % 6 AS points
  FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) = 1
)"""

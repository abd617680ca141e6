"""Registered queries over the driver's tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions import scalars, vocab
from strandline.operators import accounts, deletion, delivery, nudges, observation, questionnaire, reports, snapshots
from strandline.plans import standins as S
from strandline.plans.standins import ANSWERS_SQL, BACKLOG_SQL, HISTORY_SQL, USERS_SQL, now, stamp
from strandline.sources import readers, writers
from strandline.sources.readers import collections_of, table
from strandline.streaming import jobs

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}
NOW_SQL = "TIMESTAMP '2024-03-07 08:00:00'"


def query(sql: str | None = None):
    def register(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# --- scores ---

CATEGORY_OF_LINE = {str(i): c for i, c in enumerate(vocab.DIET_QUESTIONS, 1)}
_SUMS = ", ".join(f"CAST(coalesce(count(*) FILTER (WHERE yes AND link = {i}), 0) AS BIGINT) AS {c}" for i, c in CATEGORY_OF_LINE.items())


def _diet(spark: SparkSession, sf_dir: str) -> DataFrame:
    responses = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("response_id"))
    return questionnaire.diet_score(responses, questionnaire.unique_leaves(S.answers(spark, sf_dir), ("response_id",)), categories=CATEGORY_OF_LINE)


_DIET_SQL = f"""diet AS (
  SELECT o_orderkey AS response_id, CAST(count(*) FILTER (WHERE yes) AS BIGINT) AS total_points, {_SUMS}
  FROM orders LEFT JOIN answers ON o_orderkey = response_id GROUP BY o_orderkey
)"""


@query(f"WITH {ANSWERS_SQL}, {_DIET_SQL} SELECT * FROM diet")
def diet_score(spark, sf_dir):
    return _diet(spark, sf_dir)


@query(f"WITH {ANSWERS_SQL} SELECT response_id, count(*) AS n_answered, CAST(sum(points) AS BIGINT) AS total_points FROM answers GROUP BY 1 HAVING count(*) >= 5")
def who5_score(spark, sf_dir):
    return questionnaire.who5_score(questionnaire.unique_leaves(S.answers(spark, sf_dir), ("response_id",)), points=F.col("points"))


PRIORITY_SCORE = {"1-URGENT": 4, "2-HIGH": 3, "3-MEDIUM": 2, "4-NOT SPECIFIED": 1}


@query("SELECT * FROM (SELECT o_orderkey AS response_id, CASE o_orderpriority WHEN '1-URGENT' THEN 4 WHEN '2-HIGH' THEN 3 WHEN '3-MEDIUM' THEN 2 WHEN '4-NOT SPECIFIED' THEN 1 END AS score FROM orders) WHERE score IS NOT NULL")
def nicotine_score(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("response_id"), "o_orderpriority")
    return questionnaire.nicotine_score(rows, F.col("o_orderpriority"), PRIORITY_SCORE).select("response_id", "score")


@query("""
SELECT p_partkey AS id, coalesce(CASE WHEN p_partkey % 5 = 0 THEN p_retailprice END, CASE WHEN p_partkey % 5 = 1 THEN CAST(p_size AS DOUBLE) END,
  TRY_CAST(nullif(regexp_extract(CASE WHEN p_partkey % 3 = 0 THEN p_size || ' mg/dL' ELSE p_name END, '^\\s*([+-]?(?:\\d+\\.?\\d*|\\.\\d+))', 1), '') AS DOUBLE)) AS value
FROM part
""")  # fmt: skip
def ldl_parse(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    text = F.when(k % 3 == 0, F.concat(F.col("p_size").cast("string"), F.lit(" mg/dL"))).otherwise(F.col("p_name"))
    value = questionnaire.ldl_value(F.when(k % 5 == 0, F.col("p_retailprice")), F.when(k % 5 == 1, F.col("p_size").cast("double")), F.lit(None).cast("double"), text)
    return p.select(k.alias("id"), value.alias("value"))


@query(f"""WITH {ANSWERS_SQL}, w AS (SELECT response_id FROM answers GROUP BY 1 HAVING count(*) >= 5)
SELECT o_orderkey AS response_id, (o_orderpriority <> '5-LOW' OR o_orderkey IN (SELECT response_id FROM w)) AS handled FROM orders""")
def any_handled(spark, sf_dir):
    responses = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("response_id"))
    done = questionnaire.run_handlers({"who5": who5_score(spark, sf_dir).withColumnRenamed("total_points", "value"), "nicotine": nicotine_score(spark, sf_dir).withColumnRenamed("score", "value")})
    return questionnaire.any_handled(responses, done.select("response_id", F.lit(True).alias("handled")))


@query("""
WITH n AS (SELECT l_orderkey, l_linenumber, count(*) AS n, min(l_linestatus) AS s FROM lineitem GROUP BY 1, 2)
SELECT l_orderkey AS response_id, CAST(l_linenumber AS VARCHAR) AS link_id, s = 'O' AS value_boolean FROM n WHERE n = 1 AND l_linenumber < 7
UNION ALL
SELECT l_orderkey, 'nested-7', s = 'O' FROM n WHERE n = 1 AND l_linenumber = 7
""")
def leaf_items(spark, sf_dir):
    """Responses built as nested JSON and flattened again: line 7 lies two levels down, and a link that occurs twice counts as unanswered."""
    line = table(spark, sf_dir, "lineitem")
    answer = F.array(F.struct((F.col("l_linestatus") == "O").alias("valueBoolean")))
    flat = F.to_json(F.struct(F.col("l_linenumber").cast("string").alias("linkId"), answer.alias("answer"), F.expr("CAST(array() AS array<string>)").alias("item")))
    deep = F.to_json(F.struct(F.lit("group").alias("linkId"), F.array(F.struct(F.lit("inner").alias("linkId"), F.array(F.struct(F.lit("nested-7").alias("linkId"), answer.alias("answer"))).alias("item"))).alias("item")))
    built = line.select("l_orderkey", F.when(F.col("l_linenumber") == 7, deep).otherwise(flat).alias("j")).groupBy(F.col("l_orderkey").alias("id")).agg(F.concat(F.lit("["), F.array_join(F.collect_list("j"), ","), F.lit("]")).alias("item_json"))
    items = questionnaire.flatten_items(built.withColumn("user_id", F.lit("u")))
    rows = questionnaire.answers(items)
    return questionnaire.unique_leaves(rows, ("response_id",)).select("response_id", "link_id", "value_boolean")


@query(f"""WITH {ANSWERS_SQL}, {_DIET_SQL}
SELECT sha256('diet|' || (response_id % 100) || '|' || response_id) AS id, 'final' AS status, 'user/' || (response_id % 100) AS subject, 'diet' AS code, '{vocab.UCUM}' AS unit_system, '{{count}}' AS unit_code,
  CAST(total_points AS DOUBLE) AS value, 'QuestionnaireResponse/' || response_id AS derived_from, 'UTC' AS extension FROM diet""")
def score_to_observation(spark, sf_dir):
    scores = _diet(spark, sf_dir).withColumns({"user_id": F.col("response_id") % 100, "date": now()})
    config = observation.ScoreConfig("diet", "Diet score", "urn:scores")
    rows = observation.score_to_observation(scores, config, now(), {"urn:zone": "UTC"}, value="total_points")
    return rows.select(
        "id", "status", F.col("subject.reference").alias("subject"), F.col("code.coding")[0]["code"].alias("code"), F.col("valueQuantity.system").alias("unit_system"), F.col("valueQuantity.code").alias("unit_code"),
        F.col("valueQuantity.value").alias("value"), F.col("derivedFrom")[0]["reference"].alias("derived_from"), F.col("extension")[0]["valueString"].alias("extension"),
    )


# --- planning ---

_REASON_SQL = """CASE WHEN step <> 'finalStep' THEN 'onboarding' WHEN grp = 0 THEN 'missing_group' WHEN zone IS NULL THEN 'missing_zone_or_enrollment' WHEN disabled THEN 'disabled'
  WHEN withdrawn THEN 'withdrawn' WHEN NOT opted THEN 'not_opted_in' ELSE 'eligible' END"""
_DAYS_SQL = f"CAST(floor(epoch_us({NOW_SQL} - enrolled) / 86400000000) AS BIGINT)"
_ARM_SQL = f"""CASE WHEN manual THEN 'generated' WHEN grp = 1 AND {_DAYS_SQL} = 7 THEN 'predefined' WHEN grp = 1 AND {_DAYS_SQL} = 14 THEN 'generated'
  WHEN grp = 2 AND {_DAYS_SQL} = 7 THEN 'generated' WHEN grp = 2 AND {_DAYS_SQL} = 14 THEN 'predefined' END"""
_POST_SQL = f"""CASE WHEN NOT coalesce(extended, false) THEN 'opted_out' WHEN step <> 'finalStep' THEN 'onboarding' WHEN disabled THEN 'disabled' WHEN withdrawn THEN 'withdrawn'
  WHEN NOT opted THEN 'not_opted_in' WHEN zone IS NULL THEN 'missing_zone_or_enrollment' WHEN {_DAYS_SQL} < 21 THEN 'too_early' WHEN active < {NOW_SQL} - INTERVAL 14 DAY THEN 'inactive' ELSE 'eligible' END"""
_TODAY_SQL = f"CAST(timezone(zone, timezone('UTC', {NOW_SQL})) AS DATE)"
_AT = lambda day: f"timezone('UTC', timezone(zone, {_TODAY_SQL} + CAST({day} AS INTEGER) + wall))"


@query(f"WITH {USERS_SQL} SELECT {_REASON_SQL} AS reason, count(*) AS n FROM users GROUP BY 1")
def eligibility_reason(spark, sf_dir):
    return nudges.reason_counts(S.users(spark, sf_dir), nudges.trial_reason())


@query(f"WITH {USERS_SQL} SELECT user_id, {_DAYS_SQL} AS days, {_ARM_SQL} AS arm FROM users WHERE {_ARM_SQL} IS NOT NULL")
def arm_assignment(spark, sf_dir):
    days = scalars.elapsed_days(F.col("dateOfEnrollment"), now())
    return S.users(spark, sf_dir).select("user_id", days.alias("days"), nudges.trial_arm(F.col("participantGroup"), days, F.col("triggerNudgeGeneration")).alias("arm")).where("arm is not null")


@query(f"""WITH {USERS_SQL} SELECT user_id, d AS day, 'title ' || d AS title, strftime({_AT("d")}, '%Y-%m-%d %H:%M:%S') AS at, {_ARM_SQL} = 'generated' AND user_id % 4 <> 0 AS generated,
  CASE WHEN d = 0 THEN 'prompt' END AS prompt
FROM users, (SELECT unnest(range(7)) AS d) WHERE {_REASON_SQL} = 'eligible' AND {_ARM_SQL} IS NOT NULL""")
def nudge_schedule(spark, sf_dir):
    people = S.users(spark, sf_dir)
    texts = F.transform(F.sequence(F.lit(0), F.lit(6)), lambda i: F.struct(F.concat(F.lit("title "), i.cast("string")).alias("title"), F.lit("body").alias("body")))
    made = people.select("user_id", F.when(F.col("user_id") % 4 != 0, texts).alias("messages"))
    chosen = people.where(nudges.trial_reason() == "eligible")
    arm = nudges.trial_arm(F.col("participantGroup"), scalars.elapsed_days(F.col("dateOfEnrollment"), now()), F.col("triggerNudgeGeneration"))
    rows = chosen.withColumn("arm", arm).where("arm is not null").join(made, "user_id", "left")
    own = (F.col("arm") == "generated") & F.col("messages").isNotNull()
    plan = nudges.schedule(rows.withColumn("m", F.when(own, F.col("messages")).otherwise(texts)), F.col("m"), now(), "trial", own, {"prompt": F.lit("prompt")})
    return plan.select("user_id", F.col("day").cast("long").alias("day"), "title", stamp(F.col("timestamp")).alias("at"), F.col("isLLMGenerated").alias("generated"), "prompt")


_NEXT_SQL = f"CASE WHEN {_AT(0)} <= {NOW_SQL} THEN {_AT(1)} ELSE {_AT(0)} END"


@query(f"WITH {USERS_SQL} SELECT user_id, strftime({_NEXT_SQL}, '%Y-%m-%d %H:%M:%S') AS at, CAST({_TODAY_SQL} AS VARCHAR) AS today FROM users WHERE zone IS NOT NULL")
def next_occurrence(spark, sf_dir):
    clock = scalars.blank_to_default(F.col("preferredNotificationTime"), "09:00")
    return S.users(spark, sf_dir).where("timeZone is not null").select("user_id", stamp(scalars.next_occurrence(now(), clock, F.col("timeZone"))).alias("at"), scalars.local_date(now(), F.col("timeZone")).cast("string").alias("today"))


@query(f"WITH {USERS_SQL} SELECT {_POST_SQL} AS reason, count(*) AS n FROM users GROUP BY 1")
def posttrial_eligible(spark, sf_dir):
    return nudges.reason_counts(S.users(spark, sf_dir), nudges.posttrial_reason(now()))


@query(f"""WITH {USERS_SQL}, {BACKLOG_SQL}, t AS (SELECT user_id, zone, {_NEXT_SQL} AS target FROM users WHERE {_POST_SQL} = 'eligible'),
q AS (SELECT DISTINCT t.user_id, CAST(timezone(t.zone, timezone('UTC', b.ts)) AS DATE) AS day FROM backlog b JOIN t USING (user_id) WHERE category = 'posttrial')
SELECT user_id, strftime(target, '%Y-%m-%d %H:%M:%S') AS at FROM t WHERE NOT EXISTS (SELECT 1 FROM q WHERE q.user_id = t.user_id AND q.day = CAST(timezone(zone, timezone('UTC', target)) AS DATE))""")
def posttrial_dedup(spark, sf_dir):
    targets = nudges.posttrial_targets(S.users(spark, sf_dir), now())
    return nudges.without_same_local_day(targets, S.backlog(spark, sf_dir), "posttrial").select("user_id", stamp(F.col("target")).alias("at"))


@query(f"""WITH {USERS_SQL}, {BACKLOG_SQL}, {HISTORY_SQL},
h AS (SELECT * FROM (SELECT user_id, id, ts, body, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, id) AS r FROM history WHERE category = 'posttrial') WHERE r <= 9),
v AS (SELECT user_id, id, ts, body, 0 AS p FROM h UNION ALL SELECT user_id, id, ts, body, 1 FROM backlog WHERE category = 'posttrial'),
u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, id ORDER BY p) AS k FROM v WHERE ts < {NOW_SQL}) WHERE k = 1),
l AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, p, id) AS r FROM u)
SELECT user_id, string_agg(body, '|' ORDER BY r DESC) AS bodies FROM l WHERE r <= 3 GROUP BY user_id""")
def recent_bodies(spark, sf_dir):
    before = S.users(spark, sf_dir).select("user_id", now().alias("before"))
    return nudges.recent_bodies(S.backlog(spark, sf_dir), S.history(spark, sf_dir), before, "posttrial").select("user_id", F.array_join("bodies", "|").alias("bodies"))


@query("""WITH t AS (SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, coalesce(text, '') DESC) AS r FROM conversations)
SELECT conv_id, string_agg(coalesce(text, ''), '|' ORDER BY r DESC) AS texts FROM t WHERE r <= 3 GROUP BY conv_id""")
def last_turns(spark, sf_dir):
    """The last three turns of each conversation, oldest first."""
    turns = table(spark, sf_dir, "conversations")
    top = F.slice(F.sort_array(F.collect_list(F.struct("turn", F.coalesce("text", F.lit("")).alias("text"))), asc=False), 1, 3)
    return turns.groupBy("conv_id").agg(F.array_join(F.transform(F.reverse(top), lambda x: x["text"]), "|").alias("texts"))


@query(f"""WITH {USERS_SQL}, {BACKLOG_SQL}, p AS (SELECT user_id, min({_NEXT_SQL}) AS target FROM users WHERE {_POST_SQL} = 'eligible' GROUP BY user_id)
SELECT user_id, strftime(target - INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS at, 'Welcome' AS title FROM p""")
def welcome_rows(spark, sf_dir):
    targets = nudges.posttrial_targets(S.users(spark, sf_dir), now())
    return nudges.welcome_rows(targets, "Welcome", "back").select("user_id", stamp(F.col("timestamp")).alias("at"), "title")


AVAILABLE = ("other", "AUTOMOBILE", "BUILDING", "FURNITURE")


@query("""WITH t AS (SELECT c_custkey, CASE WHEN c_custkey % 6 = 0 THEN '' WHEN c_custkey % 6 = 1 THEN 'other' WHEN c_custkey % 6 = 2 THEN ' other , ' || c_mktsegment
    WHEN c_custkey % 6 = 3 THEN 'AUTOMOBILE,BUILDING,FURNITURE,other' ELSE c_mktsegment || ', ,' END AS s FROM customer),
a AS (SELECT *, list_filter(list_transform(string_split(s, ','), lambda x: trim(x)), lambda x: x <> '') AS items FROM t),
b AS (SELECT *, list_filter(items, lambda x: x <> 'other') AS sel, list_filter(['AUTOMOBILE', 'BUILDING', 'FURNITURE'], lambda x: NOT list_contains(items, x)) AS rest FROM a)
SELECT c_custkey AS user_id, CASE WHEN s = '' THEN 'none' WHEN NOT list_contains(items, 'other') THEN 'listed' WHEN len(sel) = 0 THEN 'other_only' WHEN len(rest) > 0 THEN 'other_more' ELSE 'other_all' END AS kind,
  CASE WHEN len(sel) > 0 THEN array_to_string(sel, ', ') ELSE 'various activities' END AS selected, array_to_string(rest, ', ') AS others FROM b""")
def workout_context(spark, sf_dir):
    k, seg = F.col("c_custkey"), F.col("c_mktsegment")
    text = F.when(k % 6 == 0, "").when(k % 6 == 1, "other").when(k % 6 == 2, F.concat(F.lit(" other , "), seg)).when(k % 6 == 3, "AUTOMOBILE,BUILDING,FURNITURE,other").otherwise(F.concat(seg, F.lit(", ,")))
    rows = table(spark, sf_dir, "customer").select(k.alias("user_id"), text.alias("s"))
    return rows.select("user_id", nudges.workout_context(F.col("s"), AVAILABLE).alias("w")).select("user_id", "w.*")


# --- delivery ---

_DUE_SQL = f"due AS (SELECT b.*, u.token FROM backlog b JOIN users u USING (user_id) WHERE zone IS NOT NULL AND NOT disabled AND NOT withdrawn AND ts <= {NOW_SQL})"


@query(f"""WITH {USERS_SQL}, {BACKLOG_SQL}, {_DUE_SQL}
SELECT user_id, id, CASE WHEN coalesce(token, '') <> '' AND id % 10 <> 0 THEN 'sent' ELSE 'failed' END AS status,
  CASE WHEN coalesce(token, '') = '' THEN 'no token' WHEN id % 10 = 0 THEN 'refused' END AS error, strftime(ts, '%Y-%m-%d %H:%M:%S') AS original, generated FROM due""")
def due_delivery(spark, sf_dir):
    ready = delivery.due(S.backlog(spark, sf_dir), S.users(spark, sf_dir), now())
    outcome = ready.select("user_id", "id", (F.col("id") % 10 != 0).alias("ok"), F.lit("refused").alias("error"))
    done = delivery.archived(ready, now(), outcome)
    return done.select("user_id", "id", "status", F.col("errorMessage").alias("error"), stamp(F.col("originalTimestamp")).alias("original"), F.col("isLLMGenerated").alias("generated"))


@query(f"WITH {USERS_SQL}, {BACKLOG_SQL}, {_DUE_SQL} SELECT user_id, id, category FROM backlog WHERE id NOT IN (SELECT id FROM due)")
def backlog_remaining(spark, sf_dir):
    rows = S.backlog(spark, sf_dir)
    return delivery.remaining(rows, delivery.due(rows, S.users(spark, sf_dir), now())).select("user_id", "id", "category")


# --- deletion ---


@query("""SELECT CAST(count(d.doc_id) AS BIGINT) AS total_marked, CAST(0 AS BIGINT) AS total_skipped, CAST(0 AS BIGINT) AS total_failed, CAST(count(*) - count(d.doc_id) AS BIGINT) AS total_queued,
  printf('%.2f%%', count(d.doc_id) * 100.0 / count(*)) AS success_rate
FROM labels l LEFT JOIN (SELECT DISTINCT doc_id FROM documents WHERE source <> 'src3') d USING (doc_id)""")
def mark_deleted(spark, sf_dir):
    there = table(spark, sf_dir, "documents").where("source <> 'src3'").select("doc_id")
    return deletion.summary(deletion.mark(table(spark, sf_dir, "labels").select("doc_id"), there, ("doc_id",)))


@query("SELECT event_id, user_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at FROM (SELECT * FROM events WHERE event_type = 'error' AND ts <= TIMESTAMP '2024-01-20 00:00:00' ORDER BY ts, event_id LIMIT 500)")
def queue_select(spark, sf_dir):
    """One run of the queue takes the 500 items that are longest due; the limit is the operator's."""
    e = table(spark, sf_dir, "events").where("event_type = 'error'").withColumnRenamed("ts", "nextRetryAt")
    return deletion.due_items(e, F.to_timestamp(F.lit("2024-01-20 00:00:00")), "event_id").select("event_id", "user_id", stamp(F.col("nextRetryAt")).alias("at"))


def _queue(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events").where("event_type IN ('error', 'signup')")
    k = F.col("event_id")
    return e.select(
        F.col("user_id").cast("string").alias("user_id"), F.when(k % 13 == 0, "someone").otherwise(F.col("user_id").cast("string")).alias("userId"), F.when(k % 7 == 0, "users").otherwise("HealthObservations_Steps").alias("collection"),
        F.when(k % 11 == 0, "a/b").otherwise((k - k % 3).cast("string")).alias("documentId"), F.when(k % 17 == 0, "WHY").otherwise("NOT_FOUND").alias("reason"), (k % 5 - 1).cast("int").alias("retryCount"), k.alias("queue_id"),
    )


@query(f"""WITH q AS (SELECT event_id, CAST(user_id AS VARCHAR) AS u, event_id % 13 = 0 AS other, event_id % 7 = 0 AS badc, CASE WHEN event_id % 11 = 0 THEN 'a/b' ELSE CAST(event_id - event_id % 3 AS VARCHAR) END AS doc,
    event_id % 17 = 0 AS badr, CAST(event_id % 5 - 1 AS INTEGER) AS n FROM events WHERE event_type IN ('error', 'signup')),
o AS (SELECT CAST(user_id AS VARCHAR) AS u, CAST(event_id AS VARCHAR) AS id FROM events WHERE event_type = 'view'),
e AS (SELECT *, CASE WHEN other THEN 'payload userId ''someone'' does not match path-derived owner ''' || u || '''' WHEN badc THEN 'collection ''users'' is not a permitted collection name'
    WHEN doc = 'a/b' THEN 'invalid documentId ''a/b''' WHEN n < 0 THEN 'invalid retryCount ''-1''' WHEN badr THEN 'invalid reason ''WHY''' END AS error FROM q),
r AS (SELECT e.*, CASE WHEN error IS NOT NULL THEN 'skipped' WHEN EXISTS (SELECT 1 FROM o WHERE o.u = e.u AND o.id = e.doc) THEN 'succeeded' WHEN n + 1 >= 3 THEN 'dead-lettered' ELSE 'requeued' END AS outcome FROM e)
SELECT event_id AS queue_id, outcome, error, CASE WHEN outcome = 'requeued' THEN n + 1 END AS retries,
  CASE WHEN outcome = 'requeued' THEN strftime({NOW_SQL} + to_hours(CAST(least(8 * pow(2, n + 1), 24) AS INTEGER)), '%Y-%m-%d %H:%M:%S') END AS next_retry FROM r""")
def queue_tick(spark, sf_dir):
    there = table(spark, sf_dir, "events").where("event_type = 'view'").select(F.col("user_id").cast("string").alias("user_id"), F.lit("HealthObservations_Steps").alias("collection"), F.col("event_id").cast("string").alias("id"))
    done = deletion.tick(_queue(spark, sf_dir), there, now())
    return done.select("queue_id", "outcome", "error", F.col("newRetryCount").alias("retries"), stamp(F.col("newNextRetryAt")).alias("next_retry"))


@query("""WITH old AS (SELECT user_id || '__' || event_id AS k, 2 AS n FROM events WHERE event_type = 'error' AND event_id % 2 = 0), new AS (SELECT DISTINCT user_id || '__' || event_id AS k, 0 AS n FROM events WHERE event_type = 'error')
SELECT k, n FROM old UNION ALL SELECT k, n FROM new WHERE k NOT IN (SELECT k FROM old)""")
def enqueue_idempotent(spark, sf_dir):
    e = table(spark, sf_dir, "events").where("event_type = 'error'")
    key = scalars.composite_key(F.col("user_id").cast("string"), F.col("event_id").cast("string"))
    old = e.where("event_id % 2 = 0").select(key.alias("k"), F.lit(2).alias("n"))
    new = e.select(key.alias("k"), F.lit(0).alias("n"))
    return deletion.enqueue(old, new.unionByName(new.where("k like '1%'")), ("k",))


# --- history ---


@query("""WITH v AS (SELECT user_id, ts, event_id, event_type || '|' || CAST(floor(value / 25) AS BIGINT) AS c FROM events),
d AS (SELECT *, lag(c) OVER w AS b, row_number() OVER w AS n FROM v WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
k AS (SELECT * FROM d WHERE n = 1 OR c <> b),
g AS (SELECT *, sum(CASE WHEN gap > 21600000000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM (SELECT *, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS gap FROM k))
SELECT user_id, event_id, c AS content, strftime(ts, '%Y-%m-%d %H:%M:%S') AS captured FROM (SELECT *, row_number() OVER (PARTITION BY user_id, run ORDER BY ts DESC, event_id DESC) AS l FROM g) WHERE l = 1""")
def debounce_snapshots(spark, sf_dir):
    rows = snapshots.debounced(S.versions(spark, sf_dir), F.col("content"), window_ms=6 * 3600 * 1000)
    return rows.select("user_id", F.col("seq").alias("event_id"), "content", stamp(F.col("t")).alias("captured"))


@query("""WITH a AS (SELECT user_id, arg_max(props, (ts, event_id)) AS j FROM events WHERE ts < TIMESTAMP '2024-01-02 00:00:00' GROUP BY 1), b AS (SELECT user_id, arg_max(props, (ts, event_id)) AS j FROM events WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND user_id % 9 <> 0 GROUP BY 1)
SELECT 'users/' || coalesce(a.user_id, b.user_id) AS path, CASE WHEN a.j IS NULL THEN 'created' WHEN b.j IS NULL THEN 'deleted' ELSE 'updated' END AS type, a.j AS before, b.j AS data FROM a FULL JOIN b ON a.user_id = b.user_id WHERE a.j IS DISTINCT FROM b.j""")
def cdc_history(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    day = lambda s: F.to_timestamp(F.lit(s))
    last = lambda df: df.groupBy(F.concat(F.lit("users/"), F.col("user_id").cast("string")).alias("path")).agg(F.max_by("props", F.struct("ts", "event_id")).alias("j"))
    before, after = last(e.where(F.col("ts") < day("2024-01-02"))), last(e.where((F.col("ts") >= day("2024-01-10")) & (F.col("user_id") % 9 != 0)))
    return snapshots.change_records(snapshots.changes(before, after, "path", "j"))


# --- paths, JSON, batches ---


@query(r"""WITH p AS (SELECT page_id, 'users/' || regexp_extract(url, '://([^/]*)', 1) || '/liveHealthSamples/' || CASE page_id % 4 WHEN 0 THEN 'com.apple.SensorKit.kind' || page_id || '_AB-12.json.zstd'
    WHEN 1 THEN 'HKQuantityTypeIdentifierStepCount_x.json.zstd' WHEN 2 THEN 'CustomIdentifierFoo.json.zstd' ELSE 'plain.json.zstd' END AS path FROM pages)
SELECT page_id, string_split(path, '/')[2] AS user_id, string_split(path, '/')[4] AS file, CASE WHEN regexp_extract(path, 'com\.apple\.SensorKit\.([^_]+)_[A-Fa-f0-9-]+\.json\.zstd$', 1) <> '' THEN 'SensorKitObservations_' || regexp_extract(path, 'com\.apple\.SensorKit\.([^_]+)_', 1)
  WHEN regexp_extract(string_split(path, '/')[4], '[A-Za-z]*Identifier[A-Za-z]*') <> '' THEN 'HealthObservations_' || regexp_extract(string_split(path, '/')[4], '[A-Za-z]*Identifier[A-Za-z]*') END AS collection FROM p""")
def path_parse(spark, sf_dir):
    k = F.col("page_id")
    name = F.when(k % 4 == 0, F.concat(F.lit("com.apple.SensorKit.kind"), k.cast("string"), F.lit("_AB-12.json.zstd"))).when(k % 4 == 1, "HKQuantityTypeIdentifierStepCount_x.json.zstd").when(k % 4 == 2, "CustomIdentifierFoo.json.zstd").otherwise("plain.json.zstd")
    rows = table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("users/"), F.regexp_extract("url", "://([^/]*)", 1), F.lit("/liveHealthSamples/"), name).alias("path"))
    file = scalars.last_segment(F.col("path"))
    return rows.select("page_id", scalars.archive_user(F.col("path")).alias("user_id"), file.alias("file"), scalars.archive_collection(file).alias("collection"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events WHERE json_extract(props, '$.k') IS NOT NULL AND event_id % 3 <> 0")
def json_explode(spark, sf_dir):
    """Events as arrays of JSON records, exploded as variants; records without a number k, here every third, are left out."""
    e = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 3 == 0, '{"other": 1}').otherwise(F.col("props")).alias("props"))
    rows = e.select("event_id", F.explode(F.expr("try_variant_get(try_parse_json(concat('[', props, ']')), '$', 'array<variant>')")).alias("r"))
    return rows.select("event_id", F.expr("try_variant_get(r, '$.k', 'bigint')").alias("k")).where("k is not null")


@query("SELECT o_custkey, o_orderkey, CAST(floor((row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) / 4) AS BIGINT) AS batch FROM orders")
def batch_pack_count(spark, sf_dir):
    return accounts.batch_numbers(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey"), "o_custkey", ["o_orderkey"], 4)


_FULL = "p.n >= 5 OR p.b + o.size > 200000"


@query(f"""WITH RECURSIVE o AS (SELECT o_custkey, o_orderkey, CAST(trunc(o_totalprice) AS BIGINT) AS size, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders),
p AS (SELECT o_custkey, o_orderkey, size, rn, 1 AS n, size AS b, CAST(0 AS BIGINT) AS batch FROM o WHERE rn = 1
  UNION ALL SELECT o.o_custkey, o.o_orderkey, o.size, o.rn, CASE WHEN {_FULL} THEN 1 ELSE p.n + 1 END, CASE WHEN {_FULL} THEN o.size ELSE p.b + o.size END, CASE WHEN {_FULL} THEN p.batch + 1 ELSE p.batch END
  FROM p JOIN o ON o.o_custkey = p.o_custkey AND o.rn = p.rn + 1)
SELECT o_custkey, o_orderkey, size, batch FROM p""")
def batch_pack_bytes(spark, sf_dir):
    """Rows of a user in batches of at most 5 rows and 200,000 in price."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.col("o_totalprice").cast("long").alias("size"))
    return accounts.packed_batches(o, "o_custkey", "o_orderkey", "size", 5, 200_000)


# --- measurements ---

_UNIT_OF = {"view": ("[lb_av]", "lbs", "kg"), "click": ("m", "meters", "miles"), "purchase": ("Cel", "celsius", "fahrenheit"), "signup": ("[degF]", "fahrenheit", "celsius"), "error": ("kg", "kg", "meters")}


@query("""SELECT * FROM (SELECT event_id, CASE event_type WHEN 'view' THEN 'kg' WHEN 'click' THEN 'miles' WHEN 'purchase' THEN 'fahrenheit' WHEN 'signup' THEN 'celsius' END AS target,
  CASE event_type WHEN 'view' THEN value * CAST(0.45359237 AS DOUBLE) WHEN 'click' THEN value / CAST(1609.344 AS DOUBLE) WHEN 'purchase' THEN value * 9 / 5 + 32 WHEN 'signup' THEN (value - 32) * 5 / 9 END AS converted
FROM events WHERE value <> 0) WHERE converted <> 0""")
def unit_convert(spark, sf_dir):
    pick = lambda i: scalars.lookup(F.col("event_type"), {k: v[i] for k, v in _UNIT_OF.items()})
    rows = table(spark, sf_dir, "events").select("event_id", "value", pick(0).alias("code"), pick(1).alias("unit"), pick(2).alias("target"))
    return observation.convert_units(rows, "code", "unit", "target", "value").select("event_id", "target", "converted")


@query("""SELECT CAST(event_id AS VARCHAR) AS id, CASE event_type WHEN 'view' THEN 'heartRate' WHEN 'click' THEN 'bodyWeight' WHEN 'purchase' THEN 'systolicBloodPressure' WHEN 'signup' THEN 'leanBodyMass' END AS accessor,
  CASE event_type WHEN 'click' THEN value * CAST(0.45359237 AS DOUBLE) ELSE value END AS value, CASE event_type WHEN 'view' THEN 'bpm' WHEN 'purchase' THEN 'mmHg' ELSE 'kg' END AS unit, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at
FROM events WHERE event_type IN ('view', 'click', 'purchase') AND value <> 0""")
def typed_measurement(spark, sf_dir):
    """Events as observations: pulse, weight in pounds, blood pressure in a component, and mass in a unit that has no conversion."""
    kinds = {"view": ("8867-4", "/min", "beats/minute"), "click": ("29463-7", "[lb_av]", "lbs"), "purchase": ("85354-9", "mm[Hg]", "mmHg"), "signup": ("91557-9", "m", "meters")}
    pick = lambda i: scalars.lookup(F.col("event_type"), {k: v[i] for k, v in kinds.items()})
    concept = lambda code: F.struct(F.array(F.struct(F.lit(vocab.LOINC).alias("system"), F.lit(None).cast("string").alias("version"), code.alias("code"), F.lit(None).cast("string").alias("display"))).alias("coding"), F.lit("").alias("text"))
    quantity = F.struct(pick(1).alias("code"), F.lit(vocab.UCUM).alias("system"), pick(2).alias("unit"), F.col("value").alias("value"))
    pressure = F.col("event_type") == "purchase"
    none = F.lit(None).cast("timestamp")
    rows = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("user_id"), F.col("event_id").cast("string").alias("id"), concept(pick(0)).alias("code"), F.when(~pressure, quantity).alias("valueQuantity"),
        F.when(pressure, F.array(F.struct(concept(F.lit("8480-6")).alias("code"), quantity.alias("valueQuantity")))).alias("component"), none.alias("effectiveDateTime"), none.alias("effectiveInstant"),
        F.struct(F.col("ts").alias("start"), none.alias("end")).alias("effectivePeriod"),
    )
    return observation.measurements(rows).select("id", "accessor", "value", "unit", stamp(F.col("date")).alias("at"))


# --- texts, dates, accounts ---


@query("SELECT n_nationkey, CASE n_nationkey % 4 WHEN 0 THEN 'de ' || n_name WHEN 1 THEN 'en-US ' || n_name WHEN 2 THEN 'en ' || n_name ELSE 'fr ' || n_name END AS text FROM nation")
def localized_text(spark, sf_dir):
    k, name = F.col("n_nationkey"), F.col("n_name")
    entry = lambda *langs: F.create_map(*(x for lang in langs for x in (F.lit(lang), F.concat(F.lit(lang + " "), name))))
    content = F.when(k % 4 == 0, entry("en", "de")).when(k % 4 == 1, entry("fr", "en-US")).when(k % 4 == 2, entry("fr", "en")).otherwise(entry("fr", "it"))
    return table(spark, sf_dir, "nation").select(k, scalars.localize(content, F.lit("de-AT")).alias("text"))


@query("SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS name FROM part")
def capitalize_words(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", scalars.capitalize_words(F.col("p_name")).alias("name"))


@query("""SELECT o_orderkey, CAST(2024 - year(o_orderdate) - CASE WHEN 3 < month(o_orderdate) OR (3 = month(o_orderdate) AND 7 < day(o_orderdate)) THEN 1 ELSE 0 END AS INTEGER) AS age FROM orders""")
def age_years(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", scalars.age_years(F.col("o_orderdate"), now()).cast("int").alias("age"))


@query("""WITH r AS (SELECT c_mktsegment AS region, CASE WHEN c_custkey % 3 = 0 THEN ' User' ELSE 'user' END || (c_custkey % 200) || '@Mail.example' || CASE WHEN c_custkey % 10 = 0 THEN '' ELSE '.org ' END AS email, c_custkey AS created FROM customer),
v AS (SELECT region, trim(email) AS email, created, region || '_' || lower(trim(email)) AS key FROM r WHERE region IN ('BUILDING', 'MACHINERY') AND email LIKE '%.%g%')
SELECT key, region, email, created FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY created DESC) AS n FROM v WHERE regexp_matches(email, '\\.org$')) WHERE n = 1""")
def waitlist_upsert(spark, sf_dir):
    k = F.col("c_custkey")
    email = F.concat(F.when(k % 3 == 0, " User").otherwise("user"), (k % 200).cast("string"), F.lit("@Mail.example"), F.when(k % 10 == 0, "1").otherwise(".org "))
    rows = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("region"), email.alias("email"), k.alias("created"))
    return accounts.waitlisted(rows, ["BUILDING", "MACHINERY"], "created")


@query(f"""WITH {USERS_SQL}, q AS (SELECT c_custkey * 2 AS user_id FROM customer WHERE c_custkey % 4 = 0)
SELECT q.user_id, CASE WHEN u.user_id IS NULL THEN 'not-found' WHEN disabled THEN 'permission-denied' WHEN withdrawn THEN 'already-exists' END AS error,
  CASE WHEN u.user_id IS NULL THEN NULL WHEN disabled THEN withdrawn ELSE true END AS withdrawn,
  CASE WHEN u.user_id IS NULL THEN 0 WHEN disabled OR withdrawn THEN CASE WHEN has_history THEN 1 ELSE 0 END ELSE CASE WHEN has_history THEN 2 ELSE 1 END END AS entries
FROM q LEFT JOIN users u USING (user_id)""")
def lifecycle_withdraw(spark, sf_dir):
    requests = table(spark, sf_dir, "customer").where("c_custkey % 4 = 0").select((F.col("c_custkey") * 2).alias("user_id"), F.lit("me").alias("requested_by"))
    done = accounts.transition(S.users(spark, sf_dir), requests, "withdraw", now())
    return done.select("user_id", "error", F.col("hasWithdrawnFromStudy").alias("withdrawn"), F.coalesce(F.cardinality("studyEnrollmentHistory"), F.lit(0)).alias("n")).select("user_id", "error", "withdrawn", F.greatest("n", F.lit(0)).alias("entries"))


@query(f"WITH {USERS_SQL} SELECT count(*) AS scanned, count(*) FILTER (WHERE extended IS NULL) AS updated, count(extended) AS skipped FROM users")
def backfill_missing(spark, sf_dir):
    return accounts.backfilled(S.users(spark, sf_dir), "extendedActivityNudgesOptIn", True)[1]


@query("""WITH l AS (SELECT user_id, max(ts) AS last FROM events GROUP BY 1)
SELECT c_custkey AS uid, strftime(last, '%Y-%m-%d %H:%M:%S') AS last FROM customer JOIN l ON c_custkey = user_id WHERE c_custkey % 3 <> 0 AND last < TIMESTAMP '2024-01-30 00:00:00'""")
def expired_accounts(spark, sf_dir):
    last = table(spark, sf_dir, "events").groupBy("user_id").agg(F.max("ts").alias("lastSignInTime"))
    claims = F.when(F.col("c_custkey") % 3 == 0, F.create_map(F.lit("type"), F.lit("staff")))
    auth = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("uid"), claims.alias("customClaims")).join(last, F.col("uid") == F.col("user_id"))
    return accounts.expired(auth, F.to_timestamp(F.lit("2024-01-31 00:00:00"))).select("uid", stamp(F.col("lastSignInTime")).alias("last"))


@query("""SELECT 'customer' AS name, count(*) AS n FROM customer WHERE c_custkey % 31 <> 0 UNION ALL SELECT 'orders', count(*) FROM orders WHERE o_custkey % 31 <> 0 UNION ALL SELECT 'events', count(*) FROM events WHERE user_id % 31 <> 0 OR user_id NOT IN (SELECT c_custkey FROM customer)""")
def cascade_delete(spark, sf_dir):
    doomed = S.users(spark, sf_dir).where("toBeDeleted")
    tables = {
        "customer": table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id")), "orders": table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("user_id")), "events": table(spark, sf_dir, "events").select("user_id"),
    }
    out = None
    for name, df in accounts.cascade(tables, doomed).items():
        n = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        out = n if out is None else out.unionByName(n)
    return out


# --- keyed writes ---


def _customers(spark, sf_dir):
    """Two versions of a table: the first without every seventh key, the second with every third changed or cleared."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    old = c.where(k % 7 != 0).select(k.alias("k"), F.col("c_name").alias("v"), F.col("c_mktsegment").alias("w"))
    new = c.where(k % 3 == 0).select(k.alias("k"), F.when(k % 2 == 0, F.concat(F.lit("new "), F.col("c_name"))).alias("v"), F.lit("W").alias("w"))
    return old, new


_WRITES_SQL = """old AS (SELECT c_custkey AS k, c_name AS v, c_mktsegment AS w FROM customer WHERE c_custkey % 7 <> 0),
new AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 0 THEN 'new ' || c_name END AS v, 'W' AS w FROM customer WHERE c_custkey % 3 = 0)"""


@query(f"WITH {_WRITES_SQL} SELECT * FROM new UNION ALL SELECT * FROM old WHERE k NOT IN (SELECT k FROM new)")
def keyed_overwrite(spark, sf_dir):
    return accounts.overwrite(*_customers(spark, sf_dir), ["k"])


@query(f"WITH {_WRITES_SQL} SELECT coalesce(o.k, n.k) AS k, coalesce(n.v, o.v) AS v, coalesce(n.w, o.w) AS w FROM old o FULL JOIN new n ON o.k = n.k")
def keyed_merge(spark, sf_dir):
    return accounts.merge(*_customers(spark, sf_dir), ["k"])


@query(f"WITH {_WRITES_SQL} SELECT * FROM old UNION ALL SELECT * FROM new WHERE k NOT IN (SELECT k FROM old)")
def keyed_create(spark, sf_dir):
    return accounts.create_if_absent(*_customers(spark, sf_dir), ["k"])


@query(f"""WITH {_WRITES_SQL} SELECT o.k, o.v, CASE WHEN n.k IS NULL THEN o.w ELSE n.w END AS w, false AS missing FROM old o LEFT JOIN new n ON o.k = n.k
UNION ALL SELECT k, NULL, w, true FROM new WHERE k NOT IN (SELECT k FROM old)""")
def keyed_update(spark, sf_dir):
    """Updates one field of the rows that are there; keys that aren't come out as missing."""
    old, new = _customers(spark, sf_dir)
    updated, missing = accounts.partial_update(old, new.select("k", "w"), ["k"])
    return updated.select("k", "v", "w", F.lit(False).alias("missing")).unionByName(missing.select("k", F.lit(None).cast("string").alias("v"), "w", F.lit(True).alias("missing")))


@query("SELECT o_custkey, o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS at FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) WHERE r = 1")
def latest_row(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")
    return accounts.latest(rows, "o_custkey", "o_orderdate", "o_orderkey").select("o_custkey", "o_orderkey", "o_orderstatus", stamp(F.col("o_orderdate")).alias("at"))


# --- more of planning, delivery and deletion ---


@query(f"""WITH {USERS_SQL}, {BACKLOG_SQL}, {_DUE_SQL}
SELECT (SELECT count(*) FROM backlog JOIN users USING (user_id) WHERE zone IS NOT NULL AND NOT disabled AND NOT withdrawn) AS total_processed, (SELECT count(*) FROM due) AS total_due, (SELECT count(*) FROM due WHERE coalesce(token, '') <> '') AS total_sent""")
def delivery_counters(spark, sf_dir):
    rows, people = S.backlog(spark, sf_dir), S.users(spark, sf_dir)
    return delivery.counters(rows, people, now(), delivery.archived(delivery.due(rows, people, now()), now()))


@query("""WITH q AS (SELECT event_id, event_id % 13 = 0 OR event_id % 7 = 0 OR event_id % 11 = 0 OR event_id % 17 = 0 OR event_id % 5 = 0 AS bad, CAST(user_id AS VARCHAR) AS u, CAST(event_id - event_id % 3 AS VARCHAR) AS doc, event_id % 5 - 1 AS n FROM events WHERE event_type IN ('error', 'signup')),
r AS (SELECT *, EXISTS (SELECT 1 FROM events v WHERE v.event_type = 'view' AND CAST(v.user_id AS VARCHAR) = q.u AND CAST(v.event_id AS VARCHAR) = q.doc) AS hit FROM q)
SELECT count(*) AS processed, count(*) FILTER (WHERE NOT bad AND hit) AS succeeded, count(*) FILTER (WHERE NOT bad AND NOT hit AND n + 1 < 3) AS requeued, count(*) FILTER (WHERE NOT bad AND NOT hit AND n + 1 >= 3) AS dead_lettered, count(*) FILTER (WHERE bad) AS skipped FROM r""")
def queue_run_summary(spark, sf_dir):
    there = table(spark, sf_dir, "events").where("event_type = 'view'").select(F.col("user_id").cast("string").alias("user_id"), F.lit("HealthObservations_Steps").alias("collection"), F.col("event_id").cast("string").alias("id"))
    return deletion.run_summary(deletion.tick(_queue(spark, sf_dir), there, now()))


_CONTEXT_AGE = "CAST(2024 - year(o_orderdate) - CASE WHEN 3 < month(o_orderdate) OR (3 = month(o_orderdate) AND 7 < day(o_orderdate)) THEN 1 ELSE 0 END AS INTEGER)"


@query(f"""SELECT o_orderkey AS user_id, {_CONTEXT_AGE} + 20 AS age, CASE WHEN {_CONTEXT_AGE} + 20 < 35 THEN 'under_35' WHEN {_CONTEXT_AGE} + 20 <= 50 THEN '35_to_50' WHEN {_CONTEXT_AGE} + 20 <= 65 THEN '51_to_65' ELSE 'over_65' END AS age_band,
  CASE o_orderkey % 3 WHEN 0 THEN 'Diabetes; Heart failure' WHEN 1 THEN '' END AS diseases, CASE o_orderkey % 4 WHEN 0 THEN 'Maintenance' WHEN 1 THEN 'Precontemplation' WHEN 2 THEN 'Action' END AS stage,
  CASE o_orderkey % 5 WHEN 0 THEN 'basic' WHEN 1 THEN 'advanced' WHEN 2 THEN 'basic' END AS reading_level, CASE WHEN o_orderkey % 6 = 0 THEN 'own words' WHEN o_orderkey % 7 = 0 THEN 'prefer not to state' WHEN o_orderkey % 7 = 5 THEN 'other' WHEN o_orderkey % 7 = 1 THEN 'male' WHEN o_orderkey % 7 = 2 THEN 'female' WHEN o_orderkey % 7 = 3 THEN 'trans female' WHEN o_orderkey % 7 = 4 THEN 'trans male' END AS gender,
  CASE WHEN o_orderkey % 2 = 0 THEN 'es' ELSE 'en' END AS language FROM orders""")
def personal_context(spark, sf_dir):
    """The order date, twenty years earlier, as date of birth; keys that no table knows fall to the defaults."""
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(
        k.alias("user_id"), F.col("o_orderdate").alias("dateOfBirth"), F.when(k % 3 == 0, F.create_map(F.lit("heartFailure"), F.lit("1"), F.lit("diabetes"), F.lit("1"), F.lit("hypertension"), F.lit("1"))).when(k % 3 == 1, F.create_map(F.lit("hypertension"), F.lit("1"))).alias("comorbidities"),
        F.when(k % 4 == 0, "B").when(k % 4 == 1, "c").when(k % 4 == 2, "f").otherwise("z").alias("stageOfChange"), F.when(k % 5 == 0, "vocationalTraining").when(k % 5 == 1, "master").when(k % 5 == 3, "associate").alias("educationUS"), F.when(k % 5 <= 2, "gradeSchool").alias("educationUK"),
        F.when(k % 6 == 0, "own words").alias("genderIdentity"), (k % 7).cast("int").alias("genderCode"), F.when(k % 2 == 0, "es").when(k % 4 == 1, "de").alias("userLanguage"),
    )
    parts = nudges.personal_context(F.to_timestamp(F.lit("2044-03-07 08:00:00")))
    return rows.select("user_id", *(c.cast("int").alias(n) if n == "age" else c.alias(n) for n, c in parts.items()))


TEMPLATES = [
    {"type": "vitals", "title": "Vitals", "description": "@0, please measure", "due_days": 1},
    {"type": "inactive", "title": "Inactive", "description": "We miss you, @0", "action": "open", "dismissible": True},
]


@query("""SELECT c_custkey AS user_id, t.type, t.title, replace(t.d, '@0', coalesce(CASE WHEN c_custkey % 4 <> 0 THEN c_name END, 'Patient')) AS description, t.action, t.dismissible, t.due
FROM customer, (VALUES ('vitals', 'Vitals', '@0, please measure', NULL, false, '2024-03-08 08:00:00'), ('inactive', 'Inactive', 'We miss you, @0', 'open', true, NULL)) t(type, title, d, action, dismissible, due)""")
def message_fanout(spark, sf_dir):
    people = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.when(F.col("c_custkey") % 4 != 0, F.col("c_name")).alias("displayName"))
    made = reports.messages(people, TEMPLATES, now())
    return made.select("user_id", "type", F.col("title")["en"].alias("title"), F.col("description")["en"].alias("description"), "action", F.col("isDismissible").alias("dismissible"), stamp(F.col("dueDate")).alias("due"))


@query("""SELECT CAST(doc_id AS VARCHAR) AS id, 'New ' || doc_id AS subject, 'From ' || doc_id || chr(10) || 'lang: ' || lang || CASE WHEN doc_id % 2 = 0 THEN chr(10) || 'source: ' || source ELSE '' END AS text FROM documents""")
def feedback_report(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), "lang", F.when(F.col("doc_id") % 2 == 0, F.col("source")).alias("source"))
    return reports.feedback_report(rows, ["lang", "source"], "New @0", "From @0")


@query(f"WITH {USERS_SQL} SELECT user_id, n * 40 + 60.0 AS value, strftime({NOW_SQL} - to_days(CAST(day AS INTEGER)), '%Y-%m-%d %H:%M:%S') AS at FROM users, (VALUES (0, 1), (1, 3), (2, 0)) t(day, n)")
def heart_rate_series(spark, sf_dir):
    return reports.heart_rate_series(S.users(spark, sf_dir), [1, 3, 0], now()).select("user_id", "value", stamp(F.col("date")).alias("at"))


@query("SELECT DISTINCT user_id, event_type AS collection FROM events")
def child_collections(spark, sf_dir):
    """The collections that each user has."""
    return collections_of(table(spark, sf_dir, "events").withColumnRenamed("event_type", "collection"))


@query("SELECT count(*) > 0 AS all_there FROM nation HAVING bool_and(n_regionkey IN (SELECT r_regionkey FROM region))")
def all_exist(spark, sf_dir):
    """Whether every file of a list is there: here every nation's region."""
    wanted = table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("file"))
    there = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("file"))
    return accounts.all_exist(wanted, there, "file")


@query(f"WITH {USERS_SQL} SELECT u.user_id, grp AS group FROM users u WHERE user_id % 5 = 0".replace("AS group", 'AS "group"'))
def enroll_absent(spark, sf_dir):
    """Requests of users of whom four fifths are enrolled already."""
    people = S.users(spark, sf_dir)
    requests = people.select("user_id").unionByName(people.select("user_id"))
    fresh = accounts.enroll(people.where("user_id % 5 <> 0"), requests, now(), F.col("user_id") % 3)
    return fresh.select("user_id", F.col("participantGroup").alias("group"))


# --- sources and sinks ---


@query("SELECT CAST(c_custkey AS VARCHAR) AS id, 'customers/' || c_custkey AS path, c_name AS name, c_mktsegment AS segment FROM customer")
def typed_envelope(spark, sf_dir):
    """Records read by a schema that names some of their fields, each with its id and path."""
    rows = readers.typed(spark, f"{sf_dir}/customer.parquet", "c_custkey bigint, c_name string, c_mktsegment string")
    key = F.col("c_custkey").cast("string")
    return readers.with_envelope(rows.withColumn("id", key), "id", F.concat(F.lit("customers/"), key)).select("id", "path", F.col("content.c_name").alias("name"), F.col("content.c_mktsegment").alias("segment"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey = 7")
def point_lookup(spark, sf_dir):
    """The record of one key; that it is one is the operator's feature."""
    return readers.record(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), "c_custkey", 7)


@query("""SELECT CAST(user_id AS VARCHAR) AS user_id, 'HealthObservations_StepIdentifier' AS collection, CAST(event_id AS VARCHAR) AS id, event_type AS kind FROM events WHERE event_id % 7 <> 0 AND user_id % 5 <> 0
UNION ALL SELECT CAST(user_id AS VARCHAR), 'SensorKitObservations_wrist', CAST(event_id AS VARCHAR), event_type FROM events WHERE event_id % 7 <> 0 AND user_id % 5 = 0""")
def archive_samples(spark, sf_dir):
    """Events of a user as a zstd archive of JSON records, read again; every seventh record has a number as id and isn't valid."""
    e = table(spark, sf_dir, "events")
    key = F.col("event_id").cast("string")
    record = F.when(F.col("event_id") % 7 == 0, F.to_json(F.struct(F.col("event_id").alias("id")))).otherwise(F.to_json(F.struct(key.alias("id"), F.col("event_type").alias("kind"))))
    text = F.concat(F.lit("["), F.array_join(F.collect_list(record), ","), F.lit("]"))
    name = F.when(F.col("user_id") % 5 == 0, "com.apple.SensorKit.wrist_AB-12.json.zstd").otherwise("StepIdentifier.json.zstd")
    files = e.groupBy("user_id").agg(text.alias("text")).select(F.concat(F.lit("users/"), F.col("user_id").cast("string"), F.lit("/liveHealthSamples/"), name).alias("path"), readers.compressed(F.col("text")).alias("content"))
    found = readers.archive_samples(readers.archives(files))
    return found.select("user_id", "collection", "id", F.get_json_object("json", "$.kind").alias("kind"))


@query("""SELECT CASE user_id % 5 WHEN 0 THEN 'bad_file' WHEN 1 THEN 'not_an_array' WHEN 2 THEN 'empty' WHEN 3 THEN 'unknown_name' ELSE 'ok' END AS status, count(*) AS n FROM (SELECT DISTINCT user_id FROM events) GROUP BY 1""")
def archive_status(spark, sf_dir):
    """What becomes of archives that can't be read, hold no array, no row, or have a name of no collection."""
    k = F.col("user_id") % 5
    text = F.when(k == 1, '{"id": "x"}').when(k == 2, "[]").otherwise('[{"id": "x"}]')
    content = F.when(k == 0, F.encode(F.lit("no zstd"), "utf-8")).otherwise(readers.compressed(text))
    name = F.when(k == 3, "plain.json.zstd").otherwise("StepIdentifier.json.zstd")
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    files = users.select(F.concat(F.lit("users/"), F.col("user_id").cast("string"), F.lit("/liveHealthSamples/"), name).alias("path"), content.alias("content"))
    return readers.archives(files).groupBy("status").agg(F.count("*").alias("n"))


@query("SELECT r_regionkey AS k, r_name AS name FROM region")
def json_files(spark, sf_dir):
    """A table written as JSON, read again by a schema."""
    at = writers.scratch(spark, "json")
    writers.json_lines(table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("name"), F.lit(1).alias("more")), at)
    return readers.typed(spark, at, "k bigint, name string", "json")


@query("SELECT n_nationkey AS k, n_name || ', \"x\"' || chr(10) || 'y' AS note FROM nation")
def csv_files(spark, sf_dir):
    """Texts with quotes, commas and line ends through a CSV file."""
    at = writers.scratch(spark, "csv")
    rows = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), F.concat("n_name", F.lit(', "x"\ny')).alias("note"))
    rows.write.option("header", True).option("escape", '"').option("quoteAll", True).csv(at)
    return readers.csv_rows(spark, at).select(F.col("k").cast("long").alias("k"), "note")


@query("SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'O' THEN 'new' ELSE 'old' END AS state, o_orderstatus FROM orders")
def replaced_collection(spark, sf_dir):
    """One collection of a stored table is replaced whole; the others stay as they were."""
    at = writers.scratch(spark, "orders")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.lit("old").alias("state"), "o_orderstatus")
    writers.replace_partitions(rows, at, "o_orderstatus")
    writers.replace_partitions(rows.where("o_orderstatus = 'O'").withColumn("state", F.lit("new")), at, "o_orderstatus")
    return spark.read.parquet(at)


@query("SELECT o_orderkey, i AS key, CASE i WHEN 0 THEN o_orderstatus ELSE o_orderpriority END AS value FROM orders, (SELECT unnest(range(2)) AS i)")
def seeded_by_position(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.array("o_orderstatus", "o_orderpriority").alias("entries"))
    return rows.select("o_orderkey", F.posexplode("entries").alias("key", "value")).select("o_orderkey", F.col("key").cast("long").alias("key"), "value")


@query("SELECT c_custkey, k AS key, CASE k WHEN 'name' THEN c_name ELSE c_mktsegment END AS value FROM customer, (VALUES ('name'), ('segment')) t(k) WHERE CASE k WHEN 'name' THEN c_name ELSE c_mktsegment END IS NOT NULL AND (k = 'name' OR c_custkey % 3 <> 0)")
def content_without_keys(spark, sf_dir):
    """Records as maps without a volatile key and without nulls."""
    content = F.create_map(F.lit("name"), F.col("c_name"), F.lit("segment"), F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")), F.lit("lastActive"), F.lit("now"))
    rows = table(spark, sf_dir, "customer").select("c_custkey", snapshots.without_keys(content, ["lastActive"]).alias("m"))
    return rows.select("c_custkey", F.explode("m").alias("key", "value"))


# --- requests, observations, formats ---


@query("""SELECT o_orderkey, CASE WHEN o_custkey % 5 = 0 OR o_custkey % 7 = 0 OR o_orderkey % 4 = 0 OR o_orderkey % 9 = 0 OR o_orderkey % 5 > 3 THEN 'invalid-argument' END AS error FROM orders""")
def deletion_requests(spark, sf_dir):
    """Requests without user or collection, without an id, with an empty one, or with too many."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    ids = F.when(k % 4 == 0, F.array().cast("array<string>")).when(k % 9 == 0, F.array(F.lit("a"), F.lit(""))).otherwise(F.transform(F.sequence(F.lit(0), (k % 5).cast("int")), lambda i: i.cast("string")))
    error = deletion.request_error(F.when(c % 5 != 0, "u"), F.when(c % 7 == 0, "").otherwise("HealthObservations_Steps"), ids, 4)
    return table(spark, sf_dir, "orders").select("o_orderkey", error.alias("error"))


@query("""SELECT event_id, CASE WHEN event_id % 6 > 1 AND event_id % 6 <> 5 THEN CAST(user_id AS VARCHAR) END AS owner FROM events""")
def queue_paths(spark, sf_dir):
    k, u = F.col("event_id") % 6, F.col("user_id").cast("string")
    path = F.when(k == 0, F.concat(F.lit("users/"), u, F.lit("/backlog/x"))).when(k == 1, F.concat(F.lit("users/"), u, F.lit("/pendingHealthSampleDeletions"))).when(k == 5, F.lit("users//pendingHealthSampleDeletions/x"))
    path = path.otherwise(F.concat(F.lit("users/"), u, F.lit("/pendingHealthSampleDeletions/x")))
    return table(spark, sf_dir, "events").select("event_id", deletion.path_owner(path).alias("owner"))


_CODES = {"view": "8867-4", "click": "29463-7", "purchase": "85354-9"}


@query(f"""SELECT event_id, event_type = 'view' AS by_code, event_type IN ('view', 'click') AND event_id % 2 = 0 AS by_version, CASE event_type WHEN 'view' THEN '8867-4' WHEN 'click' THEN '29463-7' WHEN 'purchase' THEN '85354-9' END AS code,
  '{vocab.UCUM}' AS unit_system, 'beats/minute' AS unit, value FROM events""")
def coded_observations(spark, sf_dir):
    """Events as plain observations, and whether they have a code, or any code of a version."""
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", F.col("ts").alias("date"), "value", scalars.lookup(F.col("event_type"), _CODES).alias("code"), "event_type")
    made = observation.simple_observation(rows.withColumn("user_id", F.struct("event_id", "event_type")), "bpm", {"8867-4": "Heart rate"})
    c = F.col("user_id.event_type")
    versioned = F.struct(F.transform("code.coding", lambda x: F.struct(x["system"].alias("system"), F.when(F.col("user_id.event_id") % 2 == 0, "2").alias("version"), F.when(c != "purchase", x["code"]).alias("code"))).alias("coding"))
    by_version = observation.has_coding(versioned, vocab.LOINC, version="2") & F.exists(versioned["coding"], lambda x: x["code"].isNotNull())
    return made.select(
        F.col("user_id.event_id").alias("event_id"), observation.has_coding(F.col("code"), vocab.LOINC, "8867-4").alias("by_code"), F.coalesce(by_version, F.lit(False)).alias("by_version"),
        F.col("code.coding")[0]["code"].alias("code"), F.col("valueQuantity.system").alias("unit_system"), F.col("valueQuantity.unit").alias("unit"), F.col("valueQuantity.value").alias("value"),
    )


@query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'effectivePeriod' WHEN 1 THEN 'effectiveDateTime' WHEN 2 THEN 'effectiveInstant' END AS effective, CASE WHEN event_id % 2 = 0 THEN event_type END AS status, event_id % 4 = 0 AS has_period FROM events""")
def encoded_observations(spark, sf_dir):
    """Observations as JSON: fields without a value are left out, and of three effective times one is there."""
    k, ts = F.col("event_id") % 4, F.col("ts")
    rows = table(spark, sf_dir, "events").select(
        "user_id", F.col("event_id").alias("id"), F.when(F.col("event_id") % 2 == 0, F.col("event_type")).alias("status"), F.when(k == 0, F.struct(ts.alias("start"), ts.alias("end"))).alias("effectivePeriod"),
        F.when(k <= 1, ts).alias("effectiveDateTime"), F.when(k <= 2, ts).alias("effectiveInstant"),
    )
    keys = F.json_object_keys("json")
    named = F.filter(keys, lambda x: x.startswith("effective"))
    made = observation.encoded(rows).select("id", "json", F.array_join(named, ",").alias("e"))
    return made.select(F.col("id").alias("event_id"), F.nullif("e", F.lit("")).alias("effective"), F.get_json_object("json", "$.status").alias("status"), F.array_contains(F.json_object_keys("json"), "effectivePeriod").alias("has_period"))


@query("""SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.' || lpad(CAST(CAST(epoch_us(ts) / 1000 AS BIGINT) % 1000 AS VARCHAR), 3, '0') || 'Z' AS iso, CASE WHEN event_id % 5 <> 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS parsed FROM (SELECT event_id, date_trunc('second', ts) AS ts FROM events)""")
def iso_times(spark, sf_dir):
    """Times as ISO texts and back; a text that is no time gives null."""
    rows = table(spark, sf_dir, "events").select("event_id", scalars.iso_time(F.date_trunc("second", "ts")).alias("iso"))
    text = F.when(F.col("event_id") % 5 == 0, F.lit("soon")).otherwise(F.col("iso"))
    return rows.select("event_id", "iso", stamp(scalars.parse_time(text)).alias("parsed"))


@query(f"WITH {USERS_SQL} SELECT user_id, strftime(timezone(coalesce(zone, 'UTC'), timezone('UTC', {NOW_SQL})), '%b %-d, %Y, %-I:%M:%S %p') AS at FROM users WHERE user_id % 6 <> 0 UNION ALL SELECT user_id, '2024-03-07T08:00:00.000Z' FROM users WHERE user_id % 6 = 0")
def human_times(spark, sf_dir):
    """Local times for people; a zone that no one knows gives the ISO form."""
    zone = F.when(F.col("user_id") % 6 == 0, F.lit("Mars/Base")).otherwise(F.col("timeZone"))
    return S.users(spark, sf_dir).select("user_id", scalars.human_time(now(), zone).alias("at"))


@query("SELECT c_custkey AS user_id, CAST(CAST('0x' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 8) AS UBIGINT) % 2 + 1 AS BIGINT) AS grp FROM customer")
def random_groups(spark, sf_dir):
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(k.alias("user_id"), scalars.random_group(k).alias("grp"))


@query("""SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'NOT_FOUND' WHEN 1 THEN 'UNAVAILABLE' WHEN 2 THEN 'GRPC_13' WHEN 3 THEN 'aborted' WHEN 4 THEN 'UNKNOWN_ERROR' ELSE 'ALREADY_EXISTS' END AS error FROM orders""")
def error_names(spark, sf_dir):
    k = F.col("o_orderkey") % 6
    code = F.when(k == 0, "5").when(k == 1, "unavailable").when(k == 2, "13").when(k == 3, "aborted").when(k == 5, "6")
    return table(spark, sf_dir, "orders").select("o_orderkey", scalars.error_name(code).alias("error"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 7 END AS messages, CASE WHEN o_orderkey % 4 = 0 THEN o_orderpriority END AS first_title FROM orders")
def generator_replies(spark, sf_dir):
    """Replies of a generator: seven messages with title and body, or six, or one without a title, or no JSON."""
    k = F.col("o_orderkey") % 4
    message = F.struct(F.col("o_orderpriority").alias("title"), F.lit("body").alias("body"))
    no_title = F.struct(F.lit(" ").alias("title"), F.lit("body").alias("body"))
    reply = F.when(k == 0, F.to_json(F.array_repeat(message, 7))).when(k == 1, F.to_json(F.array_repeat(message, 6))).when(k == 2, F.to_json(F.array_append(F.array_repeat(message, 6), no_title))).otherwise(F.lit("Sorry, no."))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", nudges.valid_reply(reply).alias("r"))
    return rows.select("o_orderkey", F.when(F.col("r").isNotNull(), F.size("r")).alias("messages"), F.col("r")[0]["title"].alias("first_title"))


@query(f"""WITH {USERS_SQL}, {BACKLOG_SQL}, {HISTORY_SQL}, {_DUE_SQL}, s AS (SELECT user_id, id, CASE WHEN coalesce(token, '') <> '' THEN 'sent' ELSE 'failed' END AS status FROM due)
SELECT 'history' AS place, user_id, id, status FROM s UNION ALL SELECT 'history', user_id, id, 'old' FROM history WHERE (user_id, id) NOT IN (SELECT user_id, id FROM s)
UNION ALL SELECT 'backlog', user_id, id, NULL FROM backlog WHERE id NOT IN (SELECT id FROM due)""")
def repeated_delivery(spark, sf_dir):
    """A delivery that is run again after it broke off before the backlog was written leaves each row in one place."""
    people, old = S.users(spark, sf_dir), S.history(spark, sf_dir).withColumn("status", F.lit("old"))
    rows = S.backlog(spark, sf_dir)
    first, _ = delivery.delivered(rows, old, people, now())
    again, left = delivery.delivered(rows, first, people, now())
    return again.select(F.lit("history").alias("place"), "user_id", "id", "status").unionByName(left.select(F.lit("backlog").alias("place"), "user_id", "id", F.lit(None).cast("string").alias("status")))


# --- streams, replayed from the stored tables ---


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS path, CASE o_orderpriority WHEN '1-URGENT' THEN 4 WHEN '2-HIGH' THEN 3 WHEN '3-MEDIUM' THEN 2 WHEN '4-NOT SPECIFIED' THEN 1 END AS score FROM orders WHERE o_orderpriority <> '5-LOW'""")
def streamed_scores(spark, sf_dir):
    """Orders as a change feed, scored batch by batch."""
    at = writers.scratch(spark, "scores")
    schema = spark.read.parquet(f"{sf_dir}/orders.parquet").schema
    feed = jobs.replayed(spark, sf_dir, "orders", schema).select(F.col("o_orderkey").cast("string").alias("path"), F.col("o_orderpriority").alias("after"))
    jobs.score_feed(feed, lambda df: questionnaire.nicotine_score(df, F.col("after"), PRIORITY_SCORE), f"{at}/out", f"{at}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{at}/out").select("path", "score")


@query("SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def streamed_counts(spark, sf_dir):
    """Counts by hour and type of a stream, whole at its end."""
    at = writers.scratch(spark, "counts")
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    feed = jobs.replayed(spark, sf_dir, "events", schema).withColumn("ts", F.col("ts").cast("timestamp"))
    counts = jobs.windowed_counts(feed, "ts", "event_type")
    jobs.last_state(counts, f"{at}/out", f"{at}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{at}/out").select(stamp(F.col("window.start")).alias("hour"), "event_type", "n")

import datetime as dt
import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strandline import schemas
from strandline.functions import scalars, vocab
from strandline.operators import accounts, deletion, delivery, nudges, observation, questionnaire, reports, snapshots

UTC = dt.UTC


def at(text):
    return F.to_timestamp(F.lit(text))


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def response(spark, items, id_="r", url="https://x/survey/dietScore"):
    return spark.createDataFrame([("u", id_, url, None, json.dumps(items))], schemas.RESPONSES)


def item(link, **answer):
    return {"linkId": link, "answer": [answer] if answer else []}


@pytest.mark.parametrize("yes", [0, 6, 15, 18, 21])
def test_diet_points(spark, yes):
    links = list(vocab.DIET_CATEGORY)
    r = response(spark, [item(link, valueBoolean=i < yes) for i, link in enumerate(links)])
    leaves = questionnaire.unique_leaves(questionnaire.answers(questionnaire.flatten_items(r)))
    got = questionnaire.diet_score(r.select(F.col("id").alias("response_id")), leaves).first()
    assert got["total_points"] == yes
    assert sum(got[c] for c in vocab.DIET_QUESTIONS) == yes


def test_no_answer_still_gives_a_score_and_a_link_that_occurs_twice_gives_none(spark):
    link = next(iter(vocab.DIET_CATEGORY))
    r = response(spark, [item(link, valueBoolean=True), {"linkId": "g", "item": [item(link, valueBoolean=True)]}])
    leaves = questionnaire.unique_leaves(questionnaire.answers(questionnaire.flatten_items(r)))
    assert questionnaire.diet_score(r.select(F.col("id").alias("response_id")), leaves).first()["total_points"] == 0


def test_nested_items_paths_and_leaves(spark):
    r = response(spark, [{"linkId": "a", "item": [{"linkId": "b", "item": []}, {"linkId": "c", "item": [item("d", valueInteger=3)]}]}, item("e", valueString="120 mg/dL")])
    rows = {tuple(x["path"]): x["is_leaf"] for x in questionnaire.flatten_items(r).collect()}
    assert rows == {("a",): False, ("a", "b"): True, ("a", "c"): False, ("a", "c", "d"): True, ("e",): True}
    assert questionnaire.items_at(questionnaire.flatten_items(r), ["a", "c", "d"]).count() == 1
    assert [x["link_id"] for x in questionnaire.flatten_items(r).orderBy("order").collect()] == ["a", "b", "c", "d", "e"]


def test_items_at_any_depth(spark):
    deep = item("leaf", valueInteger=4)
    for k in range(40):
        deep = {"linkId": f"g{k}", "item": [deep]}
    r = response(spark, [deep])
    rows = questionnaire.flatten_items(r).orderBy("order").collect()
    assert [x["link_id"] for x in rows] == [*(f"g{k}" for k in range(39, -1, -1)), "leaf"] and [x["is_leaf"] for x in rows] == [False] * 40 + [True]
    assert questionnaire.answers(questionnaire.flatten_items(r)).first()["value_integer"] == 4
    odd = spark.createDataFrame([("u", "1", None), ("u", "2", "no json"), ("u", "3", '{"linkId": "x"}'), ("u", "4", '[1, {"linkId": 5}]')], "user_id string, id string, item_json string")
    assert sorted((x["response_id"], x["link_id"]) for x in questionnaire.flatten_items(odd).collect() if x["link_id"]) == [("4", "5")]
    assert questionnaire.flatten_items(odd).count() == 2


@pytest.mark.parametrize("codes,total", [(["all-of-the-time"] * 5, 25), (["at-no-time"] * 5, 0), (["all-of-the-time", "nonsense", "some-of-the-time", "most-of-the-time", "at-no-time"], 10), (["all-of-the-time"] * 4, None)])
def test_who5(spark, codes, total):
    rows = spark.createDataFrame([("r", vocab.WHO5_LINKS[i], c) for i, c in enumerate(codes)], "response_id string, link_id string, code string")
    got = questionnaire.who5_score(rows).first()
    assert (got and got["total_points"]) == total


def test_nicotine_and_ldl(spark):
    rows = spark.createDataFrame([(s,) for s in [*vocab.NICOTINE_SCORE, "unknown", None]], "s string")
    assert [r["score"] for r in questionnaire.nicotine_score(rows, F.col("s")).collect()] == [0, 1, 2, 3, 4, 4, 4]
    none = F.lit(None).cast("double")
    value = lambda t: one(spark, questionnaire.ldl_value(none, none, none, F.lit(t)))
    assert [value(t) for t in ("120 mg/dL", " 99.5", "-3", ".5", "high", "", None)] == [120.0, 99.5, -3.0, 0.5, None, None, None]


def test_routing_gives_both_heart_risk_handlers(spark):
    r = response(spark, [], url="https://x/survey/heartRisk").unionByName(response(spark, [], "o", "https://x/other"))
    assert [x["handler"] for x in questionnaire.routed(r).orderBy("turn").collect()] == ["heart_risk_nicotine", "heart_risk_ldl"]


def test_first_number_takes_the_first_in_depth(spark):
    r = response(spark, [{"linkId": "g", "item": [item("n", valueCoding={"code": "7 days"})]}, item("n", valueCoding={"code": "9"})])
    assert questionnaire.first_number(questionnaire.answers(questionnaire.flatten_items(r))).first()["value"] == 7


def test_scalars(spark):
    assert one(spark, scalars.capitalize_words(F.lit("aB  cd é"))) == "AB  Cd É"
    assert one(spark, scalars.fill_template(F.lit("@0 and @1 and @0"), F.lit("x"), F.lit(3))) == "x and 3 and @0"
    assert one(spark, F.array_join(scalars.csv_items(F.lit(" a, ,b,")), "|")) == "a|b"
    assert [one(spark, scalars.error_name(F.lit(c).cast("string"))) for c in ("5", "not-found", "99", "odd", None)] == ["NOT_FOUND", "NOT_FOUND", "GRPC_99", "odd", "UNKNOWN_ERROR"]
    m = F.from_json(F.lit('{"de": "D", "en": "E", "fr": ""}'), "map<string,string>")
    assert [one(spark, scalars.localize(m, F.lit(x))) for x in ("de_AT", "it", "fr")] == ["D", "E", "E"]
    assert one(spark, scalars.canonical(F.lit('{"b": 1, "a": {"d": 1, "c": 2}}'))) == one(spark, scalars.canonical(F.lit('{"a": {"c": 2, "d": 1}, "b": 1}')))
    assert one(spark, scalars.percent(F.lit(1), F.lit(3))) == "33.33%"


def test_age_and_days(spark):
    age = lambda b, n: one(spark, scalars.age_years(at(b), at(n)))
    assert age("1992-02-29", "2026-02-28") == 33
    assert age("1992-02-29", "2026-03-01") == 34
    assert age("2000-06-15", "2026-06-15") == 26
    days = lambda s, n: one(spark, scalars.elapsed_days(at(s), at(n)))
    assert days("2026-01-01 12:00:00", "2026-01-08 11:59:59") == 6
    assert days("2026-01-01 12:00:00", "2026-01-08 12:00:00") == 7


@pytest.mark.parametrize("zone", ["America/New_York", "America/Los_Angeles", "Europe/London", "Asia/Tokyo", "Australia/Sydney"])
def test_schedule_keeps_the_local_hour_over_clock_changes(spark, zone):
    import zoneinfo

    now = at("2024-03-07 08:00:00")
    got = [r["x"].replace(tzinfo=None) for r in spark.range(40).select(scalars.scheduled(now, F.lit("09:30"), F.lit(zone), F.col("id").cast("int")).alias("x")).orderBy("id").collect()]
    local = [x.replace(tzinfo=UTC).astimezone(zoneinfo.ZoneInfo(zone)) for x in got]
    assert {(x.hour, x.minute) for x in local} == {(9, 30)}
    assert {(b - a).total_seconds() / 3600 for a, b in zip(got, got[1:], strict=False)} <= {23.0, 24.0, 25.0}


def test_next_occurrence_is_strictly_later(spark):
    x = lambda n: one(spark, scalars.next_occurrence(at(n), F.lit("09:00"), F.lit("UTC")))
    assert x("2024-05-01 08:59:59") == dt.datetime(2024, 5, 1, 9)
    assert x("2024-05-01 09:00:00") == dt.datetime(2024, 5, 2, 9)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from([1, 60_000, 119_999, 120_000, 120_001, 300_000]), st.sampled_from("abc")), max_size=14))
def test_debounce_equals_a_fold(spark, steps):
    t, rows, held, kept = 0, [], None, []
    for i, (gap, content) in enumerate(steps):
        t += gap
        rows.append(("u", dt.datetime(2024, 1, 1) + dt.timedelta(milliseconds=t), i, content))
        if held and held[1] == content:
            continue
        if held and t - held[0] <= 120_000:
            kept.pop()
        held = (t, content)
        kept.append((t, content))
    df = spark.createDataFrame(rows, "user_id string, t timestamp, seq long, content string")
    got = snapshots.debounced(df, F.col("content")).select(((F.unix_micros("t") - F.unix_micros(at("2024-01-01"))) / 1000).cast("long").alias("t"), "content").collect()
    assert sorted(map(tuple, got)) == kept


def test_change_records(spark):
    df = spark.createDataFrame([("p1", None, "{}"), ("p2", "{}", None), ("p3", '{"a":1,"b":2}', '{"b":2,"a":1}'), ("p4", '{"a":1}', '{"a":2}'), (None, None, "{}")], "path string, before string, after string")
    assert {r["path"]: r["type"] for r in snapshots.change_records(df).collect()} == {"p1": "created", "p2": "deleted", "p4": "updated"}


def queue(spark, **over):
    row = {"user_id": "u", "queue_id": "c__d", "userId": "u", "collection": "HealthObservations_X", "documentId": "d", "jobId": "j", "requestingUserId": "u", "reason": "NOT_FOUND", "lastError": "x", "retryCount": 0} | over
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} {'int' if k == 'retryCount' else 'string'}" for k in row))
    return df.withColumns({"createdAt": at("2024-01-01"), "nextRetryAt": at("2024-01-01 08:00:00")})


@pytest.mark.parametrize(
    "over,outcome,error",
    [
        ({}, "requeued", None),
        ({"retryCount": 2}, "dead-lettered", None),
        ({"documentId": "there"}, "succeeded", None),
        ({"userId": "v"}, "skipped", "payload userId 'v' does not match path-derived owner 'u'"),
        ({"collection": "users"}, "skipped", "collection 'users' is not a permitted collection name"),
        ({"documentId": "a/b"}, "skipped", "invalid documentId 'a/b'"),
        ({"retryCount": -1}, "skipped", "invalid retryCount '-1'"),
        ({"reason": "?"}, "skipped", "invalid reason '?'"),
    ],
)
def test_queue_tick(spark, over, outcome, error):
    there = spark.createDataFrame([("u", "HealthObservations_X", "there")], "user_id string, collection string, id string")
    q = queue(spark, **over)
    done = deletion.tick(deletion.due_items(q, at("2024-01-01 09:00:00")), there, at("2024-01-01 09:00:00"))
    row = done.first()
    assert (row["outcome"], row["error"]) == (outcome, error)
    after = deletion.after_tick(q, done)
    assert after.count() == (outcome == "requeued")
    if outcome == "requeued":
        assert after.first()["nextRetryAt"] == dt.datetime(2024, 1, 2, 1)


def test_queue_gives_up_after_48_hours(spark):
    q, now, hours = queue(spark), dt.datetime(2024, 1, 1), 0
    none = spark.createDataFrame([], "user_id string, collection string, id string")
    ticks = []
    while q.count():
        now = q.first()["nextRetryAt"]
        ticks.append((now - dt.datetime(2024, 1, 1)).total_seconds() / 3600)
        q = deletion.after_tick(q, deletion.tick(q, none, F.lit(now)))
        q = spark.createDataFrame(q.collect(), q.schema)
    assert ticks == [8, 24, 48]


def test_mark_and_enqueue(spark):
    there = spark.createDataFrame([("u", "c", "1", "final"), ("u", "c", "3", "final")], "user_id string, collection string, id string, status string")
    wanted = spark.createDataFrame([("u", "c", "1"), ("u", "c", "2")], "user_id string, collection string, id string")
    done = deletion.mark(wanted, there)
    assert deletion.summary(done).first()["success_rate"] == "50.00%"
    assert {r["id"]: r["status"] for r in deletion.with_deleted(there, done.where("outcome = 'marked'")).collect()} == {"1": "entered-in-error", "3": "final"}
    new = deletion.queued(done, "j", "u", at("2024-01-01"))
    assert new.first()["nextRetryAt"] == dt.datetime(2024, 1, 1, 8)
    kept = deletion.enqueue(new.withColumn("retryCount", F.lit(2)), new)
    assert [r["retryCount"] for r in kept.collect()] == [2]
    for bad in (("", "c", ["1"]), ("u", "c", []), ("u", "c", [""])):
        with pytest.raises(ValueError):
            deletion.check_request(*bad)
    assert one(spark, deletion.path_owner(F.lit("users/u/pendingHealthSampleDeletions/x"))) == "u"
    assert one(spark, deletion.path_owner(F.lit("users/u/other/x"))) is None


def user(spark, **over):
    row = dict(user_id="u", timeZone="UTC", participantGroup=1, dateOfEnrollment=dt.datetime(2024, 3, 1), disabled=None, hasWithdrawnFromStudy=None, didOptInToTrial=True, mostRecentOnboardingStep="finalStep", triggerNudgeGeneration=None, preferredNotificationTime=None, extendedActivityNudgesOptIn=True, lastActiveDate=dt.datetime(2024, 3, 7), fcmToken="t", studyEnrollmentHistory=None, toBeDeleted=None) | over
    return spark.createDataFrame([row], ", ".join(f for f in schemas.USERS.split(", ") if f.split()[0] in row))


@pytest.mark.parametrize(
    "over,reason",
    [({}, "eligible"), ({"mostRecentOnboardingStep": None}, "onboarding"), ({"participantGroup": 0, "disabled": True}, "missing_group"), ({"timeZone": None}, "missing_zone_or_enrollment"), ({"disabled": True}, "disabled"), ({"hasWithdrawnFromStudy": True}, "withdrawn"), ({"didOptInToTrial": None}, "not_opted_in")],
)
def test_trial_reasons(spark, over, reason):
    assert user(spark, **over).select(nudges.trial_reason().alias("r")).first()["r"] == reason


def test_trial_plan_uses_generated_texts_or_falls_back(spark):
    now = at("2024-03-08 08:00:00")
    fixed = F.array(*(F.struct(F.lit(f"p{i}").alias("title"), F.lit("b").alias("body")) for i in range(7)))
    made = spark.range(1).select(F.lit("u").alias("user_id"), F.transform(fixed, lambda x: F.struct(F.concat(F.lit("g"), x["title"]).alias("title"), x["body"].alias("body"))).alias("messages"))
    plan = lambda u, m: nudges.plan_trial(u, now, fixed, m, "trial").orderBy("day").collect()
    assert [r["title"] for r in plan(user(spark, participantGroup=2), made)] == [f"gp{i}" for i in range(7)]
    assert [r["title"] for r in plan(user(spark, participantGroup=2), made.where("false"))] == [f"p{i}" for i in range(7)]
    rows = plan(user(spark), made)
    assert [r["isLLMGenerated"] for r in rows] == [False] * 7 and rows[0]["timestamp"] == dt.datetime(2024, 3, 8, 9)
    assert plan(user(spark, dateOfEnrollment=dt.datetime(2024, 3, 3)), made) == []


def test_recent_bodies(spark):
    now = dt.datetime(2024, 3, 8, 12)
    t = lambda minutes: now + dt.timedelta(minutes=minutes)
    backlog = spark.createDataFrame([("u", "b1", "queued", t(-10), "p"), ("u", "b2", "later", t(60), "p"), ("u", "h1", "queued copy", t(-1), "p"), ("u", "x", "other", t(-1), "q"), ("u", "h3", "valid copy", t(-40), "p")], "user_id string, id string, body string, timestamp timestamp, category string")
    history = spark.createDataFrame([("u", "h1", "old", t(-60), "p"), ("u", "h2", "mid", t(-30), "p"), ("u", "h3", "", t(-5), "p"), ("u", "h4", "no time", None, "p")], "user_id string, id string, body string, originalTimestamp timestamp, category string")
    before = spark.createDataFrame([("u", now)], "user_id string, before timestamp")
    assert nudges.recent_bodies(backlog, history, before, "p").first()["bodies"] == ["valid copy", "mid", "queued"]
    assert nudges.recent_bodies(backlog, history, before, "p", 5).first()["bodies"] == ["old", "valid copy", "mid", "queued"]


def test_posttrial_target_day_and_welcome(spark):
    now = at("2024-04-08 10:00:00")
    u = user(spark, lastActiveDate=dt.datetime(2024, 4, 1))
    targets = nudges.posttrial_targets(u, now)
    assert targets.first()["target"] == dt.datetime(2024, 4, 9, 9)
    queued = spark.createDataFrame([("u", dt.datetime(2024, 4, 9, 23), "p")], "user_id string, timestamp timestamp, category string")
    assert nudges.without_same_local_day(targets, queued, "p").count() == 0
    assert nudges.without_same_local_day(targets, queued, "q").count() == 1
    assert nudges.welcome_rows(targets, "t", "b").first()["timestamp"] == dt.datetime(2024, 4, 9, 8)


def test_reply_must_be_seven(spark):
    good = [{"title": "t", "body": "b"}] * 7
    assert len(one(spark, nudges.valid_reply(F.lit(json.dumps(good))))) == 7
    for bad in (good[:6], [*good[:6], {"title": " ", "body": "b"}], {"a": 1}):
        assert one(spark, nudges.valid_reply(F.lit(json.dumps(bad)))) is None


def test_delivery(spark):
    now = at("2024-03-08 12:00:00")
    people = user(spark).unionByName(user(spark, user_id="v", fcmToken=None)).unionByName(user(spark, user_id="w", timeZone=None))
    rows = [(p, i, t) for p in "uvw" for i, t in (("due", dt.datetime(2024, 3, 8, 12)), ("later", dt.datetime(2024, 3, 8, 12, 0, 1)))]
    backlog = spark.createDataFrame(rows, "user_id string, id string, timestamp timestamp")
    done = delivery.archived(delivery.due(backlog, people, now), now)
    assert {(r["user_id"], r["id"]): (r["status"], r["errorMessage"]) for r in done.collect()} == {("u", "due"): ("sent", None), ("v", "due"): ("failed", "no token")}
    assert sorted(map(tuple, delivery.remaining(backlog, done).select("user_id", "id").collect())) == [("u", "later"), ("v", "later"), ("w", "due"), ("w", "later")]
    assert tuple(delivery.counters(backlog, people, now, done).first()) == (4, 2, 1)


def test_units(spark):
    rows = [("a", "[lb_av]", "lbs", "kg", 10.0), ("b", "Cel", "celsius", "fahrenheit", 37.0), ("c", "[degF]", "fahrenheit", "celsius", 32.0), ("d", "kg", "kg", "kg", 0.0), ("e", "kg", "kg", "meters", 1.0), ("f", "kg", "kg", "kg", 2.0)]
    df = spark.createDataFrame(rows, "id string, code string, unit string, target string, value double")
    assert {r["id"]: r["converted"] for r in observation.convert_units(df, "code", "unit", "target", "value").collect()} == {"a": 10 * 0.45359237, "b": 37.0 * 9 / 5 + 32, "f": 2.0}


def test_effective_time_precedence_and_encoding(spark):
    rows = spark.createDataFrame([("u", "i", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), (dt.datetime(2024, 1, 3), None))], "user_id string, id string, effectiveDateTime timestamp, effectiveInstant timestamp, effectivePeriod struct<start:timestamp,end:timestamp>")
    assert rows.select(observation.effective_time(F.col("effectiveDateTime"), F.col("effectiveInstant"), F.col("effectivePeriod")).alias("t")).first()["t"] == dt.datetime(2024, 1, 1)
    assert set(json.loads(observation.encoded(rows).first()["json"])) == {"id", "effectivePeriod"}


def test_transitions(spark):
    requests = spark.createDataFrame([("u", "u")], "user_id string, requested_by string")
    run = lambda action, **over: accounts.transition(user(spark, **over), requests, action, at("2024-01-01")).first()
    assert run("withdraw")["studyEnrollmentHistory"][0]["action"] == "withdrawn"
    assert [run(a, **o)["error"] for a, o in (("withdraw", {"hasWithdrawnFromStudy": True}), ("reenroll", {}), ("reenroll", {"hasWithdrawnFromStudy": True}), ("delete", {"toBeDeleted": True}), ("delete", {}), ("delete", {"disabled": True}), ("delete", {"user_id": "z"}))] == ["already-exists", "failed-precondition", None, "already-exists", None, "permission-denied", "not-found"]


def test_waitlist(spark):
    rows = [("US", "A@b.org", 1), ("US", " a@B.org ", 2), ("us", "a@b.org", 3), ("DE", "a@b.org", 4), ("US", "no", 5), ("US", None, 6)]
    got = accounts.waitlisted(spark.createDataFrame(rows, "region string, email string, createdAt int"), ["US", "DE"]).orderBy("key").collect()
    assert [(r["key"], r["createdAt"]) for r in got] == [("DE_a@b.org", 4), ("US_a@b.org", 2)]


def test_keyed_writes(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, w string")
    new = spark.createDataFrame([(2, "B", None), (3, "C", "z")], "k int, v string, w string")
    rows = lambda df: sorted(map(tuple, df.select("k", "v", "w").collect()))
    assert rows(accounts.overwrite(old, new, ["k"])) == [(1, "a", "x"), (2, "B", None), (3, "C", "z")]
    assert rows(accounts.merge(old, new, ["k"])) == [(1, "a", "x"), (2, "B", "y"), (3, "C", "z")]
    assert rows(accounts.create_if_absent(old, new, ["k"])) == [(1, "a", "x"), (2, "b", "y"), (3, "C", "z")]
    updated, missing = accounts.partial_update(old, new.select("k", "v"), ["k"])
    assert rows(updated) == [(1, "a", "x"), (2, "B", "y")] and missing.count() == 1
    assert rows(accounts.delete(old, new, ["k"])) == [(1, "a", "x")]


def test_reports(spark):
    df = spark.createDataFrame([("7", "fine", None)], "id string, message string, zone string")
    assert reports.feedback_report(df, ["message", "zone"], "Feedback @0", "New: @0").first()["text"] == "New: 7\nmessage: fine"
    people = spark.createDataFrame([("u", "Ann")], "user_id string, displayName string")
    made = reports.messages(people, [{"type": "vitals", "title": "Vitals", "description": "@0, please", "due_days": 1}], at("2024-01-01")).first()
    assert made["description"] == {"en": "Ann, please"} and made["dueDate"] == dt.datetime(2024, 1, 2)

"""Planning of notifications: who gets one, when, and with what."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions import vocab
from strandline.functions.scalars import age_years, blank_to_default, csv_items, deterministic_id, elapsed_days, local_date, lookup, next_occurrence, scheduled, shifted

DEFAULT_TIME = "09:00"
FINAL_STEP = "finalStep"
#: Fixed values, in the order in which they are shown.
WORKOUT_TYPES = ("other", "HIIT", "walk", "swim", "run", "sport", "strength", "bicycle", "yoga/pilates")


def true(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(False))


def trial_reason(onboarding: str = "mostRecentOnboardingStep", group: str = "participantGroup", zone: str = "timeZone", enrolled: str = "dateOfEnrollment") -> Column:
    """Why a user gets no plan in the trial, by the first check that fails; or 'eligible'. Group 0 counts as missing."""
    return (
        F.when(~F.col(onboarding).eqNullSafe(FINAL_STEP), "onboarding")
        .when(F.coalesce(F.col(group), F.lit(0)) == 0, "missing_group")
        .when(F.col(zone).isNull() | F.col(enrolled).isNull(), "missing_zone_or_enrollment")
        .when(true("disabled"), "disabled")
        .when(true("hasWithdrawnFromStudy"), "withdrawn")
        .when(~true("didOptInToTrial"), "not_opted_in")
        .otherwise("eligible")
    )


def trial_arm(group: Column, days: Column, manual: Column) -> Column:
    """'generated', 'predefined' or null: the crossover of two groups on days 7 and 14; by hand always generated."""
    return (
        F.when(F.coalesce(manual, F.lit(False)), "generated")
        .when((group == 1) & (days == 7), "predefined")
        .when((group == 1) & (days == 14), "generated")
        .when((group == 2) & (days == 7), "generated")
        .when((group == 2) & (days == 14), "predefined")
    )


def active_within(last: Column, now: Column, days: int = 14) -> Column:
    return F.coalesce(last >= shifted(now, days=-days), F.lit(False))


def posttrial_reason(now: Column, least_days: int = 21, active_days: int = 14) -> Column:
    return (
        F.when(~true("extendedActivityNudgesOptIn"), "opted_out")
        .when(~F.col("mostRecentOnboardingStep").eqNullSafe(FINAL_STEP), "onboarding")
        .when(true("disabled"), "disabled")
        .when(true("hasWithdrawnFromStudy"), "withdrawn")
        .when(~true("didOptInToTrial"), "not_opted_in")
        .when(F.col("timeZone").isNull() | F.col("dateOfEnrollment").isNull(), "missing_zone_or_enrollment")
        .when(elapsed_days(F.col("dateOfEnrollment"), now) < least_days, "too_early")
        .when(~active_within(F.col("lastActiveDate"), now, active_days), "inactive")
        .otherwise("eligible")
    )


def reason_counts(users: DataFrame, reason: Column) -> DataFrame:
    return users.groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


def schedule(users: DataFrame, messages: Column, now: Column, category: str, generated: Column, extra_first: dict[str, Column] | None = None) -> DataFrame:
    """One row per user and message: message k at the preferred time on the k-th local day from today. ``messages`` is an array of (title, body); columns of ``extra_first`` are set on the first row only."""
    clock = blank_to_default(F.col("preferredNotificationTime"), DEFAULT_TIME)
    rows = users.select("*", F.posexplode(messages).alias("day", "message"))
    return rows.select(
        "user_id",
        deterministic_id(F.col("user_id").cast("string"), F.lit(category), F.col("day").cast("string"), now.cast("string")).alias("id"),
        "day",
        F.col("message.title").alias("title"),
        F.col("message.body").alias("body"),
        scheduled(now, clock, F.col("timeZone"), F.col("day")).alias("timestamp"),
        F.lit(category).alias("category"),
        generated.alias("isLLMGenerated"),
        now.alias("generatedAt"),
        *(F.when(F.col("day") == 0, v).alias(k) for k, v in (extra_first or {}).items()),
    )


def plan_trial(users: DataFrame, now: Column, predefined: Column, generated: DataFrame, category: str) -> DataFrame:
    """The trial's backlog rows. generated: user_id, messages (array of seven, or null where generation failed; then the predefined ones stand in)."""
    chosen = users.where(trial_reason() == "eligible").withColumn("arm", trial_arm(F.col("participantGroup"), elapsed_days(F.col("dateOfEnrollment"), now), F.col("triggerNudgeGeneration"))).where("arm is not null")
    joined = chosen.join(generated.select("user_id", F.when(F.size("messages") == 7, F.col("messages")).alias("_made")), "user_id", "left")
    own = (F.col("arm") == "generated") & F.col("_made").isNotNull()
    return schedule(joined.withColumn("_messages", F.when(own, F.col("_made")).otherwise(predefined)), F.col("_messages"), now, category, own)


def merged_bodies(backlog: DataFrame, history: DataFrame, before: DataFrame, category: str, cap: int) -> DataFrame:
    """Queued and delivered texts before each user's instant, one per user and id, the delivered one first. Only valid rows mask others. Of the delivered ones the latest ``cap`` per user are looked at, as the store's query has it. before: user_id, before."""
    rank = Window.partitionBy("user_id").orderBy(F.desc("at"), "id")
    rows = lambda df, at, p: df.where((F.col("category") == category) & F.col(at).isNotNull()).select("user_id", "id", F.col(at).alias("at"), "body", F.lit(p).alias("priority"))
    latest = rows(history, "originalTimestamp", 0).withColumn("_r", F.row_number().over(rank)).where(F.col("_r") <= cap).drop("_r")
    both = latest.unionByName(rows(backlog, "timestamp", 1)).where(F.coalesce("body", F.lit("")) != "")
    valid = both.join(before, "user_id").where("at < before")
    first = Window.partitionBy("user_id", "id").orderBy("priority")
    return valid.withColumn("_p", F.row_number().over(first)).where("_p = 1").drop("_p", "before")


def recent_bodies(backlog: DataFrame, history: DataFrame, before: DataFrame, category: str, limit: int = 3) -> DataFrame:
    """user_id and bodies: the texts of the last ``limit`` before each user's instant, oldest first; of equal times the delivered one is the later."""
    rows = merged_bodies(backlog, history, before, category, 3 * limit)
    rank = Window.partitionBy("user_id").orderBy(F.desc("at"), "priority", "id")
    last = rows.withColumn("_r", F.row_number().over(rank)).where(F.col("_r") <= limit)
    return last.groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("_r")).alias("o"), "body"))), lambda x: x["body"]).alias("bodies"))


def without_same_local_day(targets: DataFrame, backlog: DataFrame, category: str) -> DataFrame:
    """Targets (user_id, timeZone, target) for whose local day nothing of the category is queued."""
    queued = backlog.where(F.col("category") == category).select(F.col("user_id").alias("_user"), "timestamp")
    zones = targets.select(F.col("user_id").alias("_user"), F.col("timeZone").alias("_zone")).distinct()
    days = queued.join(zones, "_user").select("_user", local_date(F.col("timestamp"), F.col("_zone")).alias("_day")).distinct()
    return targets.join(days, (targets["user_id"] == days["_user"]) & (local_date(targets["target"], targets["timeZone"]) == days["_day"]), "left_anti")


def posttrial_targets(users: DataFrame, now: Column) -> DataFrame:
    clock = blank_to_default(F.col("preferredNotificationTime"), DEFAULT_TIME)
    return users.where(posttrial_reason(now) == "eligible").withColumn("target", next_occurrence(now, clock, F.col("timeZone")))


def welcome_rows(planned: DataFrame, title: str, body: str) -> DataFrame:
    """One hour before a user's first planned row, once per user."""
    first = planned.where(~true("posttrialWelcomeNudgeScheduled") & true("didOptInToTrial")) if "posttrialWelcomeNudgeScheduled" in planned.columns else planned
    return first.groupBy("user_id").agg(F.min("target").alias("target")).select("user_id", shifted(F.col("target"), hours=-1).alias("timestamp"), F.lit(title).alias("title"), F.lit(body).alias("body"))


def workout_context(column: Column, available: tuple[str, ...] = WORKOUT_TYPES) -> Column:
    """(kind, selected, others): what a list of preferred activities says. Kinds: none, listed, other_only, other_more, other_all."""
    chosen = csv_items(column)
    selected = F.filter(chosen, lambda t: t != "other")
    other = F.array_contains(chosen, "other")
    rest = F.array_except(F.array(*(F.lit(t) for t in available if t != "other")), chosen)
    kind = (
        F.when(F.coalesce(column, F.lit("")) == "", "none")
        .when(~other, "listed")
        .when(F.size(selected) == 0, "other_only")
        .when(F.size(rest) > 0, "other_more")
        .otherwise("other_all")
    )
    shown = F.when(F.size(selected) > 0, F.array_join(selected, ", ")).otherwise("various activities")
    return F.struct(kind.alias("kind"), shown.alias("selected"), F.array_join(rest, ", ").alias("others"))


def personal_context(now: Column, gender_code: str = "genderCode") -> dict[str, Column]:
    """The parts of a prompt that depend on the user: age and its band, diseases, stage of change, reading level, gender, language. Texts around them are configuration."""
    age = age_years(F.col("dateOfBirth"), now)
    education = F.coalesce("educationUS", "educationUK")
    return {
        "age": age,
        "age_band": F.when(age < 35, "under_35").when(age <= 50, "35_to_50").when(age <= 65, "51_to_65").otherwise("over_65"),
        "diseases": F.array_join(F.filter(F.transform(F.array_sort(F.map_keys("comorbidities")), lambda k: lookup(k, vocab.COMORBIDITY)), lambda x: x.isNotNull()), "; "),
        "stage": lookup(F.lower("stageOfChange"), vocab.STAGE_OF_CHANGE),
        "reading_level": F.when(education.isin("didNotAttendSchool", "gradeSchool", "highSchool", "vocationalTraining"), "basic").when(
            education.isin("someCollege", "bachelor", "master", "doctoralDegree"), "advanced"
        ),
        "gender": F.coalesce(F.col("genderIdentity"), lookup(F.col(gender_code), vocab.GENDER)),
        "language": F.when(F.col("userLanguage") == "es", "es").otherwise("en"),
    }


def valid_reply(reply: Column) -> Column:
    """The seven (title, body) of a generator's JSON reply, or null if it isn't a list of seven with texts in both."""
    parsed = F.from_json(reply, "array<struct<title:string,body:string>>")
    good = (F.size(parsed) == 7) & F.forall(parsed, lambda x: (F.coalesce(F.trim(x["title"]), F.lit("")) != "") & (F.coalesce(F.trim(x["body"]), F.lit("")) != ""))
    return F.when(good, parsed)

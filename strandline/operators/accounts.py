"""Life cycle of accounts, waitlist, keyed writes."""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions import vocab
from strandline.functions.scalars import shifted, waitlist_key
from strandline.operators.nudges import true

EMAIL = vocab.EMAIL_PATTERN


# --- requests ---


def transition(users: DataFrame, requests: DataFrame, action: str, now: Column) -> DataFrame:
    """What a request does to its user. action: delete, withdraw or reenroll. requests: user_id, requested_by.

    Gives every requested user with ``error`` (null if the request holds) and the new
    values of toBeDeleted, hasWithdrawnFromStudy and studyEnrollmentHistory.
    """
    rows = requests.join(users.withColumn("_there", F.lit(True)), "user_id", "left")
    gone = true("hasWithdrawnFromStudy")
    checks = {
        "delete": F.when(true("toBeDeleted"), "already-exists"),
        "withdraw": F.when(gone, "already-exists"),
        "reenroll": F.when(~gone, "failed-precondition"),
    }
    error = F.when(F.col("_there").isNull(), "not-found").when(true("disabled"), "permission-denied").otherwise(checks[action])
    rows = rows.withColumn("error", error)
    ok = F.col("error").isNull()
    entry = F.struct(F.lit({"withdraw": "withdrawn", "reenroll": "reenrolled"}.get(action, action)).alias("action"), now.alias("timestamp"), F.col("requested_by").alias("requestedBy"))
    history = F.coalesce(F.col("studyEnrollmentHistory"), F.expr("CAST(array() AS array<struct<action:string,timestamp:timestamp,requestedBy:string>>)"))
    new = {}
    if action == "delete":
        new["toBeDeleted"] = F.when(ok, F.lit(True)).otherwise(F.col("toBeDeleted"))
    else:
        new["hasWithdrawnFromStudy"] = F.when(ok, F.lit(action == "withdraw")).otherwise(F.col("hasWithdrawnFromStudy"))
        new["studyEnrollmentHistory"] = F.when(ok, F.array_append(history, entry)).otherwise(F.col("studyEnrollmentHistory"))
    return rows.withColumns(new).drop("_there")


def enroll(users: DataFrame, requests: DataFrame, now: Column, group: Column) -> DataFrame:
    """Rows for requested users that have none yet."""
    fresh = requests.dropDuplicates(["user_id"]).join(users.select("user_id"), "user_id", "left_anti")
    return fresh.select("user_id", F.lit(False).alias("disabled"), now.alias("dateOfEnrollment"), group.cast("int").alias("participantGroup"), F.lit(True).alias("extendedActivityNudgesOptIn"))


def expired(auth: DataFrame, now: Column) -> DataFrame:
    """Accounts without claims whose last sign-in is over a day ago."""
    claims = F.coalesce(F.cardinality("customClaims"), F.lit(0))
    return auth.where((claims <= 0) & (F.col("lastSignInTime") < shifted(now, days=-1)))


def cascade(tables: dict[str, DataFrame], doomed: DataFrame, key: str = "user_id") -> dict[str, DataFrame]:
    """Each table without the rows of deleted users."""
    return {name: df.join(doomed.select(key), key, "left_anti") for name, df in tables.items()}


def backfilled(users: DataFrame, column: str, value) -> tuple[DataFrame, DataFrame]:
    """Users with a default where the column is missing, and the counters scanned, updated, skipped. Null counts as missing."""
    missing = F.col(column).isNull()
    counts = users.agg(F.count("*").alias("scanned"), F.count_if(missing).alias("updated"), F.count_if(~missing).alias("skipped"))
    return users.withColumn(column, F.coalesce(column, F.lit(value))), counts


def waitlist_error(regions: list[str]) -> Column:
    email = F.trim("email")
    return F.when(~F.coalesce(F.col("region").isin(*regions), F.lit(False)), "invalid region").when(~F.coalesce(email.rlike(EMAIL), F.lit(False)), "invalid email")


def waitlisted(requests: DataFrame, regions: list[str], time: str = "createdAt") -> DataFrame:
    """One row per region and address (trimmed, lower case): the latest valid request."""
    good = requests.where(waitlist_error(regions).isNull()).withColumn("key", waitlist_key(F.col("region"), F.col("email")))
    return good.groupBy("key").agg(F.max_by(F.struct("region", F.trim("email").alias("email"), time), F.struct(time, "email")).alias("r")).select("key", "r.*")


# --- keyed writes; a table format with MERGE would take these over ---


def overwrite(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Whole rows of ``new`` replace rows of equal keys."""
    return new.unionByName(old.join(new.select(*keys).distinct(), keys, "left_anti"), allowMissingColumns=True)


def merge(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Fields that ``new`` has, and that aren't null there, replace those of ``old``; new keys are added."""
    both = old.alias("o").join(new.alias("n"), keys, "full_outer")
    cols = [c for c in dict.fromkeys([*old.columns, *new.columns]) if c not in keys]
    pick = lambda c: F.coalesce(*([F.col(f"n.`{c}`")] if c in new.columns else []), *([F.col(f"o.`{c}`")] if c in old.columns else []))
    return both.select(*keys, *(pick(c).alias(c) for c in cols))


def create_if_absent(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    return old.unionByName(new.dropDuplicates(keys).join(old.select(*keys), keys, "left_anti"))


def partial_update(old: DataFrame, new: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """``old`` with the fields of ``new``, and the rows of ``new`` whose key isn't there."""
    fields = [c for c in new.columns if c not in keys]
    side = new.select(*keys, *(F.col(c).alias(f"_new_{c}") for c in fields)).withColumn("_hit", F.lit(True))
    joined = old.join(side, keys, "left")
    updated = reduce(lambda df, c: df.withColumn(c, F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)) if c in old.columns else F.col(f"_new_{c}")), fields, joined)
    return updated.drop("_hit", *(f"_new_{c}" for c in fields)), new.join(old.select(*keys), keys, "left_anti")


def delete(old: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    return old.join(gone.select(*keys), keys, "left_anti")


def batch_numbers(rows: DataFrame, partition: str, order: list[str], size: int) -> DataFrame:
    """Adds ``batch``: rows of a partition in batches of ``size``."""
    w = Window.partitionBy(partition).orderBy(*order)
    return rows.withColumn("batch", F.floor((F.row_number().over(w) - 1) / size).cast("long"))


def packed_batches(rows: DataFrame, key: str, order: str, size: str, most_rows: int = 500, most_bytes: int = 9 << 20) -> DataFrame:
    """Adds ``batch``: rows of a file in turn, a new batch where the next row would exceed either limit. The sum restarts at each batch, which no
    window frame can say, so the rows of a partition stream past in order of files; no file is held as a whole. A file without a key is one file."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    sorted_rows = rows.repartition(F.col(key)).sortWithinPartitions(key, order)

    def run(batches):
        file, number, n, total = object(), 0, 0, 0
        for batch in batches:
            out = []
            for k, s in zip(batch.column(key).to_pylist(), batch.column(size).to_pylist(), strict=True):
                s = int(s or 0)
                if k != file:
                    file, number, n, total = k, 0, 0, 0
                elif n >= most_rows or total + s > most_bytes:
                    number, n, total = number + 1, 0, 0
                n, total = n + 1, total + s
                out.append(number)
            yield batch.append_column("batch", pa.array(out, pa.int64()))

    return sorted_rows.mapInArrow(run, ", ".join(f"`{c}` {k}" for c, k in kinds.items()) + ", batch bigint")


def latest(rows: DataFrame, key: str, time: str, tie: str) -> DataFrame:
    """The latest row of each key."""
    others = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*others), F.struct(time, tie)).alias("r")).select(key, "r.*")


def all_exist(wanted: DataFrame, there: DataFrame, key: str) -> DataFrame:
    """One row, ``all_there``: whether every wanted key is there; false for no key at all."""
    marked = wanted.join(there.select(key).distinct().withColumn("_there", F.lit(True)), key, "left")
    return marked.agg(F.coalesce(F.bool_and(F.coalesce("_there", F.lit(False))), F.lit(False)).alias("all_there"))

"""Coded observations: building, reading measurements, unit conversion."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions import vocab
from strandline.functions.scalars import converted


@dataclass(frozen=True)
class ScoreConfig:
    code: str
    display: str
    system: str
    unit: str = "count"
    unit_system: str = vocab.UCUM
    ucum_code: str | None = "{count}"


def score_to_observation(
    scores: DataFrame, config: ScoreConfig, now: Column, provenance: dict[str, str], user: str = "user_id", key: str = "response_id", value: str = "score", date: str = "date", new_id: Column | None = None
) -> DataFrame:
    """One final observation per score, with its lineage and provenance."""
    null = F.lit(None).cast("string")
    coding = F.struct(F.lit(config.system).alias("system"), null.alias("version"), F.lit(config.code).alias("code"), F.lit(config.display).alias("display"))
    extension = F.array(*(F.struct(F.lit(u).alias("url"), F.lit(v).alias("valueString")) for u, v in provenance.items())) if provenance else F.expr("CAST(array() AS array<struct<url:string,valueString:string>>)")
    return scores.select(
        F.col(user).alias("user_id"),
        (F.sha2(F.concat_ws("|", F.lit(config.code), F.col(user).cast("string"), F.col(key).cast("string")), 256) if new_id is None else new_id).alias("id"),
        F.lit("final").alias("status"),
        F.struct(F.concat(F.lit("user/"), F.col(user).cast("string")).alias("reference")).alias("subject"),
        F.struct(F.array(coding).alias("coding"), F.lit(config.display).alias("text")).alias("code"),
        F.struct(F.lit(config.ucum_code or config.unit).alias("code"), F.lit(config.unit_system).alias("system"), F.lit(config.unit).alias("unit"), F.col(value).cast("double").alias("value")).alias("valueQuantity"),
        F.col(date).alias("effectiveDateTime"),
        now.alias("issued"),
        F.array(F.struct(F.concat(F.lit("QuestionnaireResponse/"), F.col(key).cast("string")).alias("reference"))).alias("derivedFrom"),
        extension.alias("extension"),
    )


def simple_observation(rows: DataFrame, unit: str, codes: dict[str, str], value: str = "value", date: str = "date", code: str = "code", user: str = "user_id") -> DataFrame:
    """An observation of one LOINC code and value per row; ``codes`` has the display texts."""
    unit_code, text = vocab.UNITS[unit]
    display = F.create_map(*(F.lit(x) for pair in codes.items() for x in pair))[F.col(code)] if codes else F.lit(None).cast("string")
    coding = F.struct(F.lit(vocab.LOINC).alias("system"), F.lit(None).cast("string").alias("version"), F.col(code).alias("code"), display.alias("display"))
    return rows.select(
        F.col(user).alias("user_id"), F.lit("final").alias("status"), F.struct(F.array(coding).alias("coding"), display.alias("text")).alias("code"),
        F.struct(F.lit(unit_code).alias("code"), F.lit(vocab.UCUM).alias("system"), F.lit(text).alias("unit"), F.col(value).alias("value")).alias("valueQuantity"), F.col(date).alias("effectiveDateTime"),
    )


def encoded(observations: DataFrame) -> DataFrame:
    """user_id, id and json: empty fields left out, one effective field only (period before date-time before instant)."""
    period = F.col("effectivePeriod")
    one = [
        period.alias("effectivePeriod"),
        F.when(period.isNull(), F.col("effectiveDateTime")).alias("effectiveDateTime"),
        F.when(period.isNull() & F.col("effectiveDateTime").isNull(), F.col("effectiveInstant")).alias("effectiveInstant"),
    ]
    rest = [F.col(c) for c in observations.columns if c not in ("user_id", "collection", "effectivePeriod", "effectiveDateTime", "effectiveInstant")]
    return observations.select("user_id", "id", F.to_json(F.struct(*rest, *one), {"ignoreNullFields": "true"}).alias("json"))


def effective_time(date_time: Column, instant: Column, period: Column) -> Column:
    """For reading: date-time, else instant, else the period's start, else its end."""
    return F.coalesce(date_time, instant, period["start"], period["end"])


def has_coding(concept: Column, system: str | None = None, code: str | None = None, version: str | None = None) -> Column:
    """Whether a coding agrees in all that is given."""
    wanted = {k: v for k, v in (("system", system), ("code", code), ("version", version)) if v is not None}

    def agrees(c: Column) -> Column:
        out = F.lit(True)
        for k, v in wanted.items():
            out = out & (c[k] == v)
        return out

    return F.coalesce(F.exists(concept["coding"], agrees), F.lit(False))


def codes_of(concept: Column, system: str, version: str | None = None) -> Column:
    """Codes of a system (and version)."""
    hit = F.filter(concept["coding"], lambda c: (c["system"] == system) & (F.lit(True) if version is None else c["version"] == version))
    return F.transform(hit, lambda c: c["code"])


def unit_table(spark: SparkSession) -> DataFrame:
    """source_code, source_unit, target (unit name), operation, factor; with every unit to itself. A few dozen rows."""
    rows = {(*vocab.UNITS[s], t): (op, f) for s, t, op, f in reversed(vocab.CONVERSIONS)}
    for name, (code, text) in vocab.UNITS.items():
        rows[(code, text, name)] = ("same", 1.0)
    return spark.createDataFrame([(*k, *v) for k, v in sorted(rows.items())], "source_code string, source_unit string, target string, operation string, factor double")


def convert_units(rows: DataFrame, code: str, unit: str, target: str, value: str, drop_zero: bool = True) -> DataFrame:
    """Adds ``converted``. Rows without a conversion go; so do zeros, before and (for a true conversion) after it, unless ``drop_zero`` is off."""
    table = F.broadcast(unit_table(rows.sparkSession).withColumnRenamed("target", "_target"))
    joined = rows.join(table, (F.col(code) == F.col("source_code")) & (F.col(unit) == F.col("source_unit")) & (F.col(target) == F.col("_target")))
    out = joined.select(*rows.columns, converted(F.col(value), F.col("operation"), F.col("factor")).alias("converted"))
    return out.where((F.col(value) != 0) & (F.col("converted") != 0)) if drop_zero else out


def measurement_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(n, c, u, p) for n, (c, u, p) in sorted(vocab.MEASUREMENTS.items())], "accessor string, loinc string, target string, component_code string")


def measurements(observations: DataFrame, unit_overrides: dict[str, str] | None = None) -> DataFrame:
    """user_id, id, accessor, date, value, unit: the first value of each of the typed accessors that an observation answers."""
    table = measurement_table(observations.sparkSession)
    if unit_overrides:
        m = F.create_map(*(F.lit(x) for p in unit_overrides.items() for x in p))
        table = table.withColumn("target", F.coalesce(m[F.col("accessor")], F.col("target")))
    date = effective_time(F.col("effectiveDateTime"), F.col("effectiveInstant"), F.col("effectivePeriod"))
    base = observations.select("user_id", "id", date.alias("date"), F.explode(F.array_distinct(codes_of(F.col("code"), vocab.LOINC))).alias("loinc"), "valueQuantity", "component").where("date is not null")
    met = base.join(F.broadcast(table), "loinc")
    plain = met.where("component_code is null").select("user_id", "id", "accessor", "date", "target", F.lit(0).alias("turn"), F.col("valueQuantity").alias("q"))
    parts = met.where("component_code is not null").select("user_id", "id", "accessor", "date", "target", "component_code", F.posexplode("component").alias("turn", "c"))
    inner = parts.where(F.exists(F.col("c.code.coding"), lambda x: (x["system"] == vocab.LOINC) & (x["code"] == F.col("component_code")))).select("user_id", "id", "accessor", "date", "target", "turn", F.col("c.valueQuantity").alias("q"))
    both = plain.unionByName(inner).where(F.col("q.system") == vocab.UCUM)
    flat = both.select("user_id", "id", "accessor", "date", "target", "turn", F.col("q.code").alias("code"), F.col("q.unit").alias("unit_text"), F.col("q.value").alias("raw"))
    good = convert_units(flat, "code", "unit_text", "target", "raw")
    return good.groupBy("user_id", "id", "accessor").agg(F.min_by(F.struct("date", F.col("converted").alias("value"), F.col("target").alias("unit")), "turn").alias("m")).select("user_id", "id", "accessor", "m.*")

"""Scalar expressions on text, numbers, JSON and time. Every one is built-in Catalyst code; ``now`` is a parameter."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from strandline.functions import vocab


def lookup(key: Column, table: Mapping) -> Column:
    """The table's value, or null. For tables of a fixed, small size."""
    return F.create_map(*(F.lit(x) for pair in table.items() for x in pair))[key]


# --- text ---


def capitalize_words(s: Column) -> Column:
    """First letter of each word in upper case, the rest and all spaces as they are."""
    word = lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2)))
    return F.array_join(F.transform(F.split(s, " "), word), " ")


def blank_to_default(s: Column, default: str) -> Column:
    return F.coalesce(F.nullif(F.trim(s), F.lit("")), F.lit(default))


def csv_items(s: Column) -> Column:
    """Items between commas, trimmed, without blank ones."""
    return F.filter(F.transform(F.split(s, ","), lambda x: F.trim(x)), lambda x: x != "")


def composite_key(*parts: Column, sep: str = "__") -> Column:
    return F.concat_ws(sep, *parts)


def waitlist_key(region: Column, email: Column) -> Column:
    return F.concat_ws("_", region, F.lower(F.trim(email)))


def deterministic_id(*parts: Column) -> Column:
    """An upper-case UUID-shaped id that depends on its parts alone, where a store would draw a random one."""
    h = F.upper(F.md5(F.concat_ws("\u0001", *parts)))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12))


def fill_template(template: Column, *params: Column) -> Column:
    """Replaces the first @0 by the first parameter, then the first @1 by the second, and so on."""
    out = template
    for i, p in enumerate(params):
        at = F.instr(out, f"@{i}")
        out = F.when(at > 0, F.concat(F.substring(out, F.lit(1), at - 1), p.cast("string"), F.substr(out, at + len(f"@{i}")))).otherwise(out)
    return out


def localize(content: Column, *languages: Column) -> Column:
    """From a map by language: each language asked for, else its prefix, then en-US, en, the first entry, or ''. Empty texts count as missing."""
    found = []
    for language in (*languages, F.lit("en-US")):
        found += [content[language], content[F.split(language, "[-_]")[0]]]
    return F.coalesce(*(F.nullif(x, F.lit("")) for x in found), F.get(F.map_values(content), F.lit(0)), F.lit(""))


def error_name(code: Column) -> Column:
    """Known codes by name; other numbers as GRPC_n, other texts as they are, none as UNKNOWN_ERROR."""
    known = lookup(code, vocab.ERROR_NAMES)
    return F.when(code.isNull(), "UNKNOWN_ERROR").otherwise(F.coalesce(known, F.when(code.rlike(r"^-?\d+$"), F.concat(F.lit("GRPC_"), code)).otherwise(code)))


def percent(part: Column, whole: Column) -> Column:
    return F.format_string("%.2f%%", F.when(whole == 0, F.lit(0.0)).otherwise(part / whole * 100))


# --- numbers ---

NUMBER = r"^\s*([+-]?(?:\d+\.?\d*(?:[eE][+-]?\d+)?|\.\d+(?:[eE][+-]?\d+)?))"


def leading_number(s: Column) -> Column:
    """The number a text begins with ('120 mg/dL' is 120), or null."""
    return F.nullif(F.regexp_extract(s, NUMBER, 1), F.lit("")).try_cast("double")


def leading_integer(s: Column) -> Column:
    return F.nullif(F.regexp_extract(s, r"^\s*([+-]?\d+)", 1), F.lit("")).try_cast("long")


def converted(value: Column, operation: Column, factor: Column) -> Column:
    """A unit conversion, in the order of operations that gives the same doubles as plain arithmetic."""
    return (
        F.when(operation == "same", value)
        .when(operation == "mul", value * factor)
        .when(operation == "div", value / factor)
        .when(operation == "c2f", value * 9 / 5 + 32)
        .when(operation == "f2c", (value - 32) * 5 / 9)
    )


# --- JSON ---


def canonical(json: Column) -> Column:
    """A text that is equal for JSON values that differ in the order of keys only; null where it isn't JSON."""
    return F.to_json(F.try_parse_json(json))


def content_hash(json: Column) -> Column:
    return F.sha2(F.coalesce(canonical(json), json), 256)


# --- time ---


def parse_time(s: Column) -> Column:
    """Timestamps from ISO texts; null for null and for anything else."""
    return F.try_to_timestamp(s)


def iso_time(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def elapsed_days(since: Column, now: Column) -> Column:
    """Whole days of 24 hours, not calendar days."""
    return F.floor((F.unix_micros(now) - F.unix_micros(since)) / F.lit(86_400_000_000))


def age_years(born: Column, now: Column) -> Column:
    """Completed years by year, month and day."""
    before = (F.month(now) < F.month(born)) | ((F.month(now) == F.month(born)) & (F.dayofmonth(now) < F.dayofmonth(born)))
    return F.year(now) - F.year(born) - before.cast("int")


def local_date(ts: Column, zone: Column) -> Column:
    return F.to_date(F.from_utc_timestamp(ts, zone))


def local_time_to_utc(day: Column, clock: Column, zone: Column) -> Column:
    """The instant at which a zone's wall clock shows HH:mm on a date."""
    parts = F.split(clock, ":")
    minutes = F.coalesce(parts[0].try_cast("int"), F.lit(0)) * 60 + F.coalesce(F.get(parts, F.lit(1)).try_cast("int"), F.lit(0))
    wall = F.timestamp_seconds(F.unix_date(day).cast("long") * 86400 + minutes * 60)
    return F.to_utc_timestamp(wall, zone)


def scheduled(now: Column, clock: Column, zone: Column, offset_days: Column) -> Column:
    """That time of day, ``offset_days`` local days after today; day 0 may be past."""
    return local_time_to_utc(F.date_add(local_date(now, zone), offset_days), clock, zone)


def next_occurrence(now: Column, clock: Column, zone: Column) -> Column:
    """That time of day, today or else tomorrow, strictly after now."""
    today = scheduled(now, clock, zone, F.lit(0))
    return F.when(today <= now, scheduled(now, clock, zone, F.lit(1))).otherwise(today)


def shifted(ts: Column, days: float = 0, hours: float = 0, minutes: float = 0, seconds: float = 0) -> Column:
    """Moved by an absolute duration."""
    return F.timestamp_micros(F.unix_micros(ts) + int(((days * 24 + hours) * 60 + minutes) * 60_000_000 + seconds * 1_000_000))


def backoff(ts: Column, attempt: Column, base_s: int = 8 * 3600, cap_s: int = 24 * 3600) -> Column:
    """ts plus min(base * 2 ** attempt, cap)."""
    wait = F.least(F.lit(float(base_s)) * F.pow(F.lit(2.0), attempt), F.lit(float(cap_s)))
    return F.timestamp_micros(F.unix_micros(ts) + (wait * 1_000_000).cast("long"))


def human_time(ts: Column, zone: Column, zones: list[str] | None = None) -> Column:
    """A readable local time; the ISO form where the zone isn't one of ``zones`` (all known zones by default)."""
    import zoneinfo

    known = sorted(zones or zoneinfo.available_timezones())
    valid = F.coalesce(zone, F.lit("UTC")).isin(known)
    return F.when(valid, F.date_format(F.from_utc_timestamp(ts, F.when(valid, F.coalesce(zone, F.lit("UTC"))).otherwise("UTC")), "MMM d, yyyy, h:mm:ss a")).otherwise(iso_time(ts))


def random_group(user: Column, groups: int = 2) -> Column:
    """1 to ``groups``, from a hash of the user: the same on every run."""
    return F.pmod(F.conv(F.substring(F.md5(user.cast("string")), 1, 8), 16, 10).cast("long"), F.lit(groups)) + 1


# --- archive names and paths ---

def archive_collection(name: Column) -> Column:
    """The collection that an archive's file name stands for, or null."""
    sensor, health = F.regexp_extract(name, vocab.SENSORKIT_PATTERN, 1), F.regexp_extract(name, vocab.HEALTHKIT_PATTERN, 0)
    return F.when(sensor != "", F.concat(F.lit("SensorKitObservations_"), sensor)).when(health != "", F.concat(F.lit("HealthObservations_"), health))


def archive_user(path: Column) -> Column:
    """The segment after the first ``users``; null for a path that is no archive's."""
    parts = F.split(path, "/")
    at = F.array_position(parts, "users")
    user = F.get(parts, at.cast("int"))
    return F.when(path.contains("/liveHealthSamples/") & (at > 0) & (user != "") & (last_segment(path) != ""), user)


def last_segment(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)

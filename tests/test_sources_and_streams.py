import datetime as dt
import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strandline.operators import questionnaire, snapshots
from strandline.sources import readers, writers
from strandline.streaming import jobs


def zstd(value) -> bytes:
    return pa.compress(value if isinstance(value, bytes) else json.dumps(value).encode(), codec="zstd", asbytes=True)


@pytest.fixture
def store(tmp_path):
    def put(path, data):
        at = tmp_path / path
        at.parent.mkdir(parents=True, exist_ok=True)
        at.write_bytes(data)

    base = "users/u1/liveHealthSamples/"
    put(base + "HKQuantityTypeIdentifierStepCount_1.json.zstd", zstd([{"id": "a", "v": 1}, {"id": "a", "v": 2}, {"v": 3}, {"id": 4}, {"id": "b"}]))
    put(base + "com.apple.SensorKit.wrist_AB-12.json.zstd", zstd([{"id": "s"}]))
    put(base + "plain.json.zstd", zstd([{"id": "x"}]))
    put(base + "EmptyIdentifier.json.zstd", zstd([]))
    put(base + "ObjectIdentifier.json.zstd", zstd({"id": "x"}))
    put(base + "BrokenIdentifier.json.zstd", b"no zstd")
    put("users/u1/other/StepIdentifier.json.zstd", zstd([{"id": "y"}]))
    return str(tmp_path)


def test_archives(spark, store):
    read = readers.archives(readers.objects(spark, store))
    status = {r["file"].split(".json")[0]: r["status"] for r in read.collect()}
    assert status == {
        "HKQuantityTypeIdentifierStepCount_1": "ok", "com.apple.SensorKit.wrist_AB-12": "ok", "plain": "unknown_name", "EmptyIdentifier": "empty", "ObjectIdentifier": "not_an_array", "BrokenIdentifier": "bad_file",
    }
    rows = sorted((r["user_id"], r["collection"], r["id"], json.loads(r["json"]).get("v")) for r in readers.archive_samples(read).collect())
    assert rows == [("u1", "HealthObservations_HKQuantityTypeIdentifierStepCount", "a", 2), ("u1", "HealthObservations_HKQuantityTypeIdentifierStepCount", "b", None), ("u1", "SensorKitObservations_wrist", "s", None)]
    assert writers.remove(read.where("status IN ('ok', 'empty')").select("path")) == 3
    assert readers.objects(spark, store).count() == 4


def test_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"k": 1}, {"k": 2}]')
    assert readers.json_array(spark, str(tmp_path / "a.json"), "k int").count() == 2
    (tmp_path / "r.json").write_text('{"x": {"k": 1}}')
    assert [(r["key"], r["value"]["k"]) for r in readers.json_record(spark, str(tmp_path / "r.json"), "k int").collect()] == [("x", 1)]
    (tmp_path / "c.csv").write_text('a,b\n1,"x, ""y""\nz"\n')
    assert readers.csv_rows(spark, str(tmp_path / "c.csv")).first()["b"] == 'x, "y"\nz'
    made = []
    at = str(tmp_path / "cache")
    compute = lambda: (made.append(1), spark.range(3))[1]
    assert [readers.cached(spark, at, s, compute).count() for s in ("compute_and_store", "read_or_compute", "read_only", "compute_only")] == [3] * 4 and len(made) == 2


def test_observations_are_pruned_by_collection(spark, tmp_path):
    df = spark.createDataFrame([("u", "c1", "1", dt.datetime(2024, 1, 1)), ("u", "c2", "2", dt.datetime(2024, 1, 1))], "user_id string, collection string, id string, issued timestamp")
    writers.observations(df, str(tmp_path / "o"))
    read = spark.read.parquet(str(tmp_path / "o"))
    assert len(read.where("collection = 'c1'").inputFiles()) <= 2 and readers.collections_of(read).where("user_id = 'u'").count() == 2
    writers.replace_partitions(df.where("collection = 'c1'").withColumn("id", F.lit("9")), str(tmp_path / "o"), "collection")
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "o")).collect()) == ["2", "9"]


def test_streamed_debounce_equals_batch(spark, tmp_path):
    rows = [("u", t, i, c) for i, (t, c) in enumerate([(0, "a"), (50, "a"), (100_000, "b"), (220_000, "c"), (340_001, "d"), (900_000, "d")])]
    for n, part in enumerate((rows[:3], rows[3:])):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{n}.json").write_text("\n".join(json.dumps(dict(zip(("user_id", "t_ms", "seq", "content"), r, strict=True))) for r in part))
    feed = jobs.changes(spark, str(tmp_path / "in"), "user_id string, t_ms long, seq long, content string", per_trigger=1)
    query = jobs.debounce(feed).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).option("path", str(tmp_path / "out")).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination(90)
    got = spark.read.parquet(str(tmp_path / "out")).groupBy("user_id", "snapshot").agg(F.max_by("content", "captured_ms").alias("content"))
    batch = spark.createDataFrame([(u, dt.datetime(2024, 1, 1) + dt.timedelta(milliseconds=t), s, c) for u, t, s, c in rows], "user_id string, t timestamp, seq long, content string")
    assert sorted(r["content"] for r in got.collect()) == sorted(r["content"] for r in snapshots.debounced(batch, F.col("content")).collect())


def test_streamed_scores(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text('{"path": "p", "after": "never-smoked/vaped"}\n{"path": "q"}')
    feed = jobs.changes(spark, str(tmp_path / "in"), "path string, after string")
    jobs.score_feed(feed, lambda df: questionnaire.nicotine_score(df, F.col("after")), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(60)
    assert [(r["path"], r["score"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [("p", 0)]


def drained(query):
    query.awaitTermination(90)
    assert query.exception() is None


def test_enqueueing_again_changes_nothing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = [("a", "2024-01-01T00:00:00Z"), ("b", "2024-01-01T01:00:00Z"), ("a", "2024-01-01T02:00:00Z")]
    (tmp_path / "in" / "1.json").write_text("\n".join(json.dumps({"k": k, "t": t}) for k, t in rows))
    feed = jobs.changes(spark, str(tmp_path / "in"), "k string, t timestamp")
    drained(jobs.once_each(feed, ["k"], "t").writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).option("path", str(tmp_path / "out")).trigger(availableNow=True).start())
    assert sorted(r["k"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b"]


def test_requests_meet_samples_that_arrive_later(spark, tmp_path):
    for name, row in (("r", {"requested_at": "2024-01-01T00:00:00Z"}), ("s", {"arrived_at": "2024-01-01T20:00:00Z"})):
        (tmp_path / name).mkdir()
        (tmp_path / name / "1.json").write_text(json.dumps({"user_id": "u", "collection": "c", "id": "1"} | row))
    keys = "user_id string, collection string, id string, "
    joined = jobs.late_matches(jobs.changes(spark, str(tmp_path / "r"), keys + "requested_at timestamp"), jobs.changes(spark, str(tmp_path / "s"), keys + "arrived_at timestamp"))
    drained(joined.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).option("path", str(tmp_path / "out")).trigger(availableNow=True).start())
    assert [r["arrived_at"].hour for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [20]

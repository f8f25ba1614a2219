import datetime as dt

import pytest

from pyspark.sql import functions as F

from lodgeworks.catalog import QUERIES
from lodgeworks.operators.asof import latest_by_key
from lodgeworks.streaming import jobs

T0 = dt.datetime(2024, 1, 1, 12)


def _pushes(spark, path, batches):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, "k long, ts timestamp_ntz, v long").coalesce(1).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def _at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def test_push_over_several_runs_equals_batch(spark, tmp_path):
    path, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    first = [[(1, _at(0), 1), (1, _at(5), 2), (2, _at(1), 3)]]
    second = [[(1, _at(70), 4), (3, _at(65), 5)]]
    for batches in (first, second):
        rows = _pushes(spark, path, batches)
        stream = jobs.file_stream(spark, path, rows.schema)
        jobs.push_features(stream, ["k"], "ts", out, mark).awaitTermination()
    got = {(r.k, r.v) for r in jobs.latest_pushed(spark, out, ["k"], "ts").collect()}
    want = {(r.k, r.v) for r in latest_by_key(spark.read.parquet(path), ["k"], "ts").collect()}
    assert got == want == {(1, 4), (2, 3), (3, 5)}
    fresh = jobs.latest_pushed(spark, out, ["k"], "ts", as_of="2024-01-01 13:30:00", ttl=dt.timedelta(hours=1))
    assert {(r.k, r.v) for r in fresh.collect()} == {(1, 4), (2, None), (3, 5)}


def test_push_drops_rows_behind_the_watermark(spark, tmp_path):
    path, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    for batches in ([[(1, _at(600), 1)]], [[(2, _at(0), 2), (1, _at(601), 3)]]):
        rows = _pushes(spark, path, batches)
        jobs.push_features(jobs.file_stream(spark, path, rows.schema), ["k"], "ts", out, mark).awaitTermination()
    assert {(r.k, r.v) for r in jobs.latest_pushed(spark, out, ["k"], "ts").collect()} == {(1, 3)}


def test_metrics_stream_equals_batch(spark, tmp_path):
    path = str(tmp_path / "in")
    df = spark.range(400).select(
        (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("id").cast("decimal(18,6)"))).alias("ts"),
        (F.col("id") % 7 / 10).alias("duration"),
    )
    df.repartitionByRange(4, "ts").write.parquet(path)
    stream = jobs.file_stream(spark, path, df.schema, files_per_batch=1)
    jobs.request_metrics_stream(stream, "ts", "duration", str(tmp_path / "out"), str(tmp_path / "mark"),
                                late="1 hour").awaitTermination()
    got = jobs.latest_metrics(spark, str(tmp_path / "out"))
    want = jobs.request_metrics(df, "ts", "duration")
    columns = ["n_requests", "le_0_25", "le_0_5", "le_10"]
    as_rows = lambda d: sorted(tuple(r) for r in d.select(F.col("slot").cast("string"), *columns).collect())
    assert as_rows(got) == as_rows(want) and got.agg(F.sum("n_requests")).first()[0] == 400


def test_scoring_stream_equals_batch_and_resumes(spark, tmp_path):
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import SQLTransformer

    model = PipelineModel([SQLTransformer(statement="SELECT *, CAST(x > 5 AS DOUBLE) AS prediction FROM __THIS__")])
    path, log, mark = (str(tmp_path / n) for n in ("in", "log", "mark"))
    for part in (range(0, 8), range(8, 12)):
        spark.createDataFrame([(i,) for i in part], "x long").write.mode("append").parquet(path)
        stream = jobs.file_stream(spark, path, spark.read.parquet(path).schema)
        jobs.score_stream(stream, model, log, mark, ["x"]).awaitTermination()
    rows = spark.read.parquet(log).collect()
    assert sorted((r.x, r.booking_status) for r in rows) == [(i, int(i > 5)) for i in range(12)]


def test_performance_stream(spark, tmp_path):
    df = spark.range(200).select(
        (F.col("id") % 10).cast("double").alias("x"), F.lit(1.0).alias("prediction"), F.lit(1.0).alias("label"))
    path = str(tmp_path / "in")
    df.withColumn("x", F.col("x") + 100).write.parquet(path)
    stream = jobs.file_stream(spark, path, df.schema)
    jobs.performance_stream(stream, df, str(tmp_path / "out"), str(tmp_path / "mark"),
                            lambda i: "2024-02-01 00:00:00").awaitTermination()
    decision = spark.read.parquet(str(tmp_path / "out" / "decision")).first()
    assert decision.retrain is True and decision.accuracy == 1.0 and decision.drift_score > 0.9


def _folder_of_files(spark, small, tmp_path):
    """The tables of ``small`` with ``events`` as a folder of several files."""
    spark.read.parquet(f"{small}/events.parquet").repartition(3).write.parquet(str(tmp_path / "sf" / "events.parquet"))
    return str(tmp_path / "sf")


@pytest.mark.parametrize("name", ["st1_push_features", "s13_push_source_with_ttl", "st5_request_metrics"])
def test_streams_over_several_files(spark, small, tmp_path, name):
    sf = _folder_of_files(spark, small, tmp_path)
    columns = sorted(QUERIES[name](spark, small).columns)
    assert QUERIES[name](spark, sf).select(columns).exceptAll(QUERIES[name](spark, small).select(columns)).isEmpty()
    assert QUERIES[name](spark, sf).count() == QUERIES[name](spark, small).count() > 0


def test_compaction_keeps_the_newest_rows(spark, tmp_path):
    path, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    for i, batches in enumerate(([[(1, _at(0), 1), (2, _at(1), 3)]], [[(1, _at(70), 4), (3, _at(65), 5)]], [[(3, _at(71), 6)]])):
        rows = _pushes(spark, path, batches)
        jobs.push_features(jobs.file_stream(spark, path, rows.schema), ["k"], "ts", out, mark).awaitTermination()
        if i:
            jobs.compact(spark, out, ["k"], "ts")
            assert len(list((tmp_path / "out").glob("batch=*"))) == 1
    got = {(r.k, r.v) for r in jobs.latest_pushed(spark, out, ["k"], "ts").collect()}
    assert got == {(1, 4), (2, 3), (3, 6)}


def test_a_stream_without_rows_reads_as_empty(spark, tmp_path):
    path, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    rows = _pushes(spark, path, [[]])
    jobs.push_features(jobs.file_stream(spark, path, rows.schema), ["k"], "ts", out, mark).awaitTermination()
    assert jobs.latest_pushed(spark, out, ["k"], "ts").collect() == []

"""Bucketed online snapshots against whole ones."""

import glob
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from lodgeworks.operators import online
from lodgeworks.operators.online import OnlineStore
from lodgeworks.operators.store import snapshot


def events(spark, n=400, users=60):
    return spark.range(n).select(
        (F.col("id") * 7919 % users).alias("user"), F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, CAST(id AS INT))").alias("ts"),
        (F.col("id") * 3 % 101).cast("double").alias("value"))


def at(hour):
    return f"2024-01-{1 + hour // 24:02d} {hour % 24:02d}:00:00"


def rows_of(df):
    return sorted((r.user, r.ts, r.value) for r in df.collect())


def test_runs_equal_the_snapshot(spark, tmp_path):
    df, store = events(spark), OnlineStore(spark, str(tmp_path), ["user"], "ts", 8)
    assert store.read() is None and store.lookup(df) is None and store.version() == 0
    previous = None
    for k, hour in enumerate((100, 101, 250, 400)):
        assert store.materialize(df, at(hour), previous) == k + 1
        assert rows_of(store.read()) == rows_of(snapshot(df, ["user"], "ts", at(hour)))
        previous = at(hour)
    assert store.materialize(df, at(500), previous) == 4  # nothing new
    assert rows_of(store.read(1)) == rows_of(snapshot(df, ["user"], "ts", at(100)))


def test_only_touched_buckets_are_written_and_only_wanted_ones_read(spark, tmp_path):
    df, store = events(spark), OnlineStore(spark, str(tmp_path), ["user"], "ts", 8)
    store.materialize(df, at(300))
    before = store.manifest()
    store.materialize(df, at(301), at(300))  # one row
    after = store.manifest()
    changed = [b for b in after if after[b] != before[b]]
    assert len(changed) == 1 and len(glob.glob(f"{tmp_path}/data/run={after[changed[0]]}/bucket=*")) == 1
    request = spark.createDataFrame([(5,), (5,), (99,)], "user long")
    found = store.lookup(request, ["value"])
    want = {r[0]: r[2] for r in rows_of(store.read())}
    assert sorted((r.user, r.value) for r in found.collect() if r.user == 5) == [(5, want[5])] * 2
    assert [r.value for r in found.collect() if r.user == 99] == [None]
    read = {f.split("bucket=")[1].split("/")[0] for f in found.inputFiles()}
    assert len(read) <= 2


def test_a_lost_run_leaves_the_old_version(spark, tmp_path, monkeypatch):
    df, store = events(spark), OnlineStore(spark, str(tmp_path), ["user"], "ts", 8)
    store.materialize(df, at(200))
    old = rows_of(store.read())

    class Lost(Exception):
        pass

    def fail(*_):
        raise Lost

    create = spark.createDataFrame
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, *a, **k: fail() if "run string" in str(a) else create(*a, **k))
    with pytest.raises(Lost):
        store.materialize(df, at(400), at(200))
    monkeypatch.undo()
    assert store.version() == 1 and rows_of(store.read()) == old
    store.materialize(df, at(400), at(200))
    assert rows_of(store.read()) == rows_of(snapshot(df, ["user"], "ts", at(400)))
    # The lost run and the first one go; the newest version stays whole.
    assert store.vacuum(keep=1) >= 1 and rows_of(store.read()) == rows_of(snapshot(df, ["user"], "ts", at(400)))
    assert store.version() == 2


def test_expired_rows_and_null_keys(spark, tmp_path):
    rows = spark.createDataFrame([(1, at(1), 1.0), (2, at(50), 2.0), (None, at(2), 3.0)], "user long, t string, value double") \
        .select("user", F.col("t").cast("timestamp_ntz").alias("ts"), "value")
    store = OnlineStore(spark, str(tmp_path), ["user"], "ts", 4)
    store.materialize(rows, at(60))
    found = store.lookup(spark.createDataFrame([(1,), (2,)], "user long"), as_of=at(60), ttl=timedelta(hours=24))
    assert {r.user: r.value for r in found.collect()} == {1: None, 2: 2.0}
    with pytest.raises(ValueError, match="buckets"):
        OnlineStore(spark, str(tmp_path), ["user"], "ts", 5).read()
    with pytest.raises(ValueError):
        OnlineStore(spark, str(tmp_path), ["user"], "ts", 0)
    assert online.BUCKETS > 1

import datetime as dt
import random

import pytest

from lodgeworks.operators.asof import FeatureSet, as_of_join, latest_by_key

START = dt.datetime(2024, 1, 1)
TTL = dt.timedelta(hours=6)


def _rows(seed, n_spine=300, n_features=400, span=200):
    """Key 1 holds a third of all rows; times repeat often, also between the two sides."""
    rng = random.Random(seed)
    key = lambda: 1 if rng.random() < 1 / 3 else rng.choice([2, 3, 4, None])
    at = lambda: START + dt.timedelta(minutes=15 * rng.randrange(span))
    spine = [(key(), at(), i) for i in range(n_spine)]
    spine += spine[:5]  # copies must survive
    features = [(key(), at(), START + dt.timedelta(seconds=i), i if rng.random() < 0.9 else None)
                for i in range(n_features)]
    return spine, features


def _brute(spine, features, ttl):
    out = []
    for k, t, i in spine:
        best = None
        for fk, ft, created, value in features:
            if k is not None and fk == k and ft <= t and (best is None or (ft, created) > best[:2]):
                best = (ft, created, value)
        fresh = best is not None and (ttl is None or best[0] >= t - ttl)
        out.append((i, best[2] if fresh else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("ranges", [None, 2, 7, 60])
@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("ttl", [TTL, None])
def test_equals_brute_force(spark, ranges, seed, ttl):
    spine, features = _rows(seed)
    s = spark.createDataFrame(spine, "k long, ts timestamp_ntz, i long")
    f = spark.createDataFrame(features, "k long, ts timestamp_ntz, created timestamp_ntz, v long")
    got = as_of_join(s, FeatureSet(f, ("v",), "ts", ttl, "created"), ["k"], "ts", ranges)
    assert got.columns == ["k", "ts", "i", "v"]
    assert sorted(((r.i, r.v) for r in got.collect()), key=repr) == _brute(spine, features, ttl)


def test_one_time_only(spark):
    """All rows of a heavy key at one moment."""
    spine = [(1, START, i) for i in range(200)]
    features = [(1, START, START + dt.timedelta(seconds=i), i) for i in range(200)]
    s = spark.createDataFrame(spine, "k long, ts timestamp_ntz, i long")
    f = spark.createDataFrame(features, "k long, ts timestamp_ntz, created timestamp_ntz, v long")
    got = as_of_join(s, FeatureSet(f, ("v",), "ts", TTL, "created"), ["k"], "ts", ranges=10)
    assert got.count() == 200 and {r.v for r in got.collect()} == {199}


def test_ttl_edge_counts_and_expired_newest_is_null(spark):
    s = spark.createDataFrame([(1, START + TTL, 0), (1, START + TTL + dt.timedelta(microseconds=1), 1)],
                              "k long, ts timestamp_ntz, i long")
    f = spark.createDataFrame([(1, START, 7)], "k long, ts timestamp_ntz, v long")
    got = {r.i: r.v for r in as_of_join(s, FeatureSet(f, ("v",), "ts", TTL), ["k"], "ts").collect()}
    assert got == {0: 7, 1: None}


def test_two_views_of_one_table(spark):
    s = spark.createDataFrame([(1, START, 0)], "k long, ts timestamp_ntz, i long")
    f = spark.createDataFrame([(1, START, 7)], "k long, ts timestamp_ntz, v long")
    sets = [FeatureSet(f, ("v",), "ts", TTL, prefix=p) for p in ("a_", "b_")]
    joined = as_of_join(s, sets, ["k"], "ts")
    row = joined.first()
    assert (row.a_v, row.b_v) == (7, 7)


@pytest.mark.parametrize("ranges", [None, 20])
def test_two_views_equal_two_joins(spark, ranges):
    spine, features = _rows(5)
    s = spark.createDataFrame(spine, "k long, ts timestamp_ntz, i long")
    f = spark.createDataFrame(features, "k long, ts timestamp_ntz, created timestamp_ntz, v long")
    short = dt.timedelta(hours=1)
    sets = [FeatureSet(f.filter("v % 2 = 0"), ("v",), "ts", TTL, "created", "a_"),
            FeatureSet(f.filter("v % 2 = 1"), ("v",), "ts", short, "created", "b_")]
    got = as_of_join(s, sets, ["k"], "ts", ranges).collect()
    even = [r for r in features if r[3] is not None and r[3] % 2 == 0]
    odd = [r for r in features if r[3] is not None and r[3] % 2 == 1]
    assert sorted(((r.i, r.a_v) for r in got), key=repr) == _brute(spine, even, TTL)
    assert sorted(((r.i, r.b_v) for r in got), key=repr) == _brute(spine, odd, short)


def test_latest_by_key(spark):
    rows = [(1, START, 1), (1, START + TTL, 2), (2, START, 3)]
    df = spark.createDataFrame(rows, "k long, ts timestamp_ntz, v long")
    assert {(r.k, r.v) for r in latest_by_key(df, ["k"], "ts").collect()} == {(1, 2), (2, 3)}

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lodgeworks.operators import store

T0 = dt.datetime(2024, 1, 10)


@pytest.fixture(scope="module")
def rows(spark):
    data = [(b, T0, 10 * b, 5, 7, float(100 + b), b % 3, b % 2, dt.date(2018, 1, 1)) for b in range(6)]
    return spark.createDataFrame(
        data, "booking_id long, event_timestamp timestamp_ntz, lead_time long, arrival_month long, arrival_date long, "
              "avg_price_per_room float, no_of_special_requests long, booking_status long, booking_date date")


def _requests(spark, offset):
    data = [(b, T0 + offset, 1, 200.0, 0, 0.25) for b in range(7)]
    return spark.createDataFrame(
        data, "booking_id long, event_timestamp timestamp_ntz, lead_time_current long, avg_price_per_room_current float, "
              "no_of_special_requests_current long, current_promotion_discount float")


@pytest.mark.parametrize("name, offset, matched", [
    ("hotel_prediction_v1", dt.timedelta(days=7), True),
    ("hotel_prediction_v2", dt.timedelta(days=7, seconds=1), False),
    ("hotel_prediction_v3", dt.timedelta(hours=1), True),
    ("hotel_prediction_v3", dt.timedelta(hours=2), False),
])
def test_services_respect_their_ttl(spark, rows, name, offset, matched):
    service = store.hotel_services()[name]
    view = service.views[0][0]
    out = store.historical_features(service, _requests(spark, offset), {view.name: rows})
    got = {r.booking_id: r for r in out.collect()}
    assert len(got) == 7 and got[6].lead_time is None
    assert got[2].lead_time == (20 if matched else None)
    prefix = "fresh_" if name.endswith("v3") else ""
    assert got[2][f"{prefix}discounted_price_per_room"] == pytest.approx(150.0)
    if matched:
        assert got[2][f"{prefix}price_per_night_per_request"] == pytest.approx(102 / 2.001)


def test_online_features(spark, rows):
    service = store.hotel_services()["hotel_prediction_v1"]
    requests = _requests(spark, dt.timedelta(0)).drop("event_timestamp")
    fresh = store.online_features(service, requests, rows, as_of="2024-01-12 00:00:00")
    stale = store.online_features(service, requests, rows, as_of="2024-03-01 00:00:00")
    assert fresh.filter("booking_id = 3").first().lead_time == 30
    assert stale.filter("booking_id = 3").first().lead_time is None
    assert fresh.count() == 7


def test_training_set(spark, rows):
    df = store.training_set(rows)
    assert df.count() == 6
    assert "booking_status" in df.columns and "event_timestamp" not in df.columns and "booking_date" not in df.columns
    with pytest.raises(ValueError):
        store.training_set(rows.limit(0))
    assert store.training_set(rows.limit(0), fallback=rows).count() == 6


def test_custom_transform(spark, rows):
    """Any frame-to-frame function can be a request-time transform."""
    view = store.hotel_views()["hotel_booking_stats"]
    service = store.FeatureService("mine", ((view, ("lead_time",)),), (lambda df: df.withColumn("twice", F.col("lead_time") * 2),))
    out = store.historical_features(service, _requests(spark, dt.timedelta(0)), {view.name: rows})
    assert out.filter("booking_id = 4").first().twice == 80


def test_materialize_in_steps_equals_once(spark, rows, tmp_path):
    later = rows.withColumns({"event_timestamp": F.col("event_timestamp") + F.expr("INTERVAL 1 DAY"),
                              "lead_time": F.col("lead_time") + 1})
    rows.unionByName(later.filter("booking_id < 3")).write.parquet(str(tmp_path / "source"))
    view = store.hotel_views(store.TableSource(str(tmp_path / "source"), "event_timestamp", "created"))["hotel_booking_stats"]
    first = store.materialize(spark, view, str(tmp_path / "online"), "2024-01-10 12:00:00")
    assert first.count() == 6 and first.agg(F.max("lead_time")).first()[0] == 50
    second = store.materialize(spark, view, str(tmp_path / "online"), "2024-01-12 00:00:00", "2024-01-10 12:00:00", 1)
    got = {r.booking_id: r.lead_time for r in second.collect()}
    assert got == {0: 1, 1: 11, 2: 21, 3: 30, 4: 40, 5: 50}


def test_view_reads_its_source_and_ignores_absent_created(spark, rows, tmp_path):
    rows.write.parquet(str(tmp_path / "t"))
    views = store.hotel_views(store.TableSource(str(tmp_path / "t"), "event_timestamp", "created"))
    service = store.hotel_services(views)["hotel_prediction_v2"]
    out = store.historical_features(service, rows.select("booking_id", "event_timestamp"))
    assert out.filter("lead_time IS NULL").isEmpty()
    with pytest.raises(ValueError):
        store.historical_features(store.hotel_services()["training"], rows.select("booking_id", "event_timestamp"))


def test_served_rows_are_logged(spark, rows, tmp_path):
    for _ in range(2):
        store.log_served(rows, str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).count() == 12


def test_online_read_names_what_is_missing(spark):
    user = store.Entity("user", ("k",))
    views = [store.FeatureView(n, user, (n,), dt.timedelta(days=1)) for n in ("a", "b")]
    service = store.FeatureService("both", tuple((v, v.fields) for v in views), (lambda d: d.withColumn("c", F.col("r") + 1),), request_fields=("r",))
    at = dt.datetime(2024, 1, 1)
    latest = {n: spark.createDataFrame([(1, at, 10 + i)], f"k long, event_timestamp timestamp_ntz, {n} long") for i, n in enumerate("ab")}
    requests = spark.createDataFrame([(1, 5), (2, 6)], "k long, r long")
    rows = {r.k: (r.a, r.b, r.c) for r in store.online_features(service, requests, latest).collect()}
    assert rows == {1: (10, 11, 6), 2: (None, None, 7)}
    with pytest.raises(ValueError):
        store.online_features(service, requests.drop("r"), latest)
    assert store.online_features(service, requests.drop("r"), latest, on_demand=False).columns == ["k", "a", "b"]
    with pytest.raises(ValueError):
        store.online_features(service, requests, {"a": latest["a"]})

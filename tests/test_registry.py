"""The stored registry: versions, differences, conflicts."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from lodgeworks.operators import store
from lodgeworks.operators.registry import Conflict, Registry
from lodgeworks.operators.store import Entity, FeatureService, FeatureView, TableSource


def changes(df):
    return [tuple(r) for r in df.collect()]


def test_services_load_by_name(spark, tmp_path):
    registry = Registry(spark, str(tmp_path))
    assert registry.version() == 0 and registry.rows() == {}
    services = store.hotel_services()
    first = changes(registry.apply(services.values()))
    assert ("service", "hotel_prediction_v1", "added") in first and ("view", "hotel_booking_stats", "added") in first and ("entity", "booking", "added") in first
    assert registry.version() == 1 and all(registry.service(n) == s for n, s in services.items())
    assert changes(registry.apply(services.values())) == [] and registry.version() == 1
    with pytest.raises(KeyError):
        registry.service("hotel_prediction_v9")


def test_changes_make_a_version_and_old_ones_stay(spark, tmp_path):
    registry = Registry(spark, str(tmp_path))
    registry.apply(store.hotel_services().values())
    fresh = store.hotel_services()["hotel_prediction_v3"]
    view = fresh.views[0][0]
    slower = FeatureView(view.name, view.entity, view.fields, timedelta(hours=2), view.source)
    assert changes(registry.apply([slower])) == [("view", view.name, "changed")]
    assert registry.view(view.name).ttl == timedelta(hours=2) and registry.view(view.name, 1).ttl == timedelta(hours=1)
    assert registry.service("hotel_prediction_v3").views[0][0] == slower
    with pytest.raises(ValueError, match="needs"):
        registry.apply([], remove=[view.name])
    gone = changes(registry.apply([], remove=[view.name, "hotel_prediction_v3"]))
    assert gone == [("service", "hotel_prediction_v3", "removed"), ("view", view.name, "removed")] and registry.version() == 3


def test_two_definitions_of_one_service_are_a_conflict(spark, tmp_path):
    """A basic service v1, and another v1 that takes the whole view without its time."""
    registry = Registry(spark, str(tmp_path))
    basic = store.hotel_services()["hotel_prediction_v1"]
    view = basic.views[0][0]
    other = FeatureService("hotel_prediction_v1", ((view, view.fields),), basic.on_demand, request_fields=basic.request_fields)
    with pytest.raises(Conflict, match="service hotel_prediction_v1.*event_timestamp"):
        registry.apply([basic, other])
    assert registry.version() == 0


def test_schemas_and_names_are_checked(spark, tmp_path):
    spark.range(3).select(F.col("id").alias("k"), F.current_timestamp().alias("ts"), F.lit(1.5).alias("x")).write.parquet(f"{tmp_path}/t")
    source = TableSource(f"{tmp_path}/t", "ts")
    entity = Entity("e", ("k",))
    registry = Registry(spark, f"{tmp_path}/r")
    registry.apply([FeatureView("v", entity, ("x",), timedelta(days=1), source)])
    assert registry.rows()["view", "v"][1] == '{"k": "bigint", "x": "double"}'
    with pytest.raises(ValueError, match="lacks"):
        registry.apply([FeatureView("w", entity, ("y",), timedelta(days=1), source)])
    service = FeatureService("s", ((registry.view("v"), ("x",)),), (lambda df: df,))
    with pytest.raises(ValueError, match="no name"):
        registry.apply([service])
    named = Registry(spark, f"{tmp_path}/r", {"same": service.on_demand[0]})
    named.apply([service])
    assert named.service("s") == service
    with pytest.raises(ValueError, match="transforms"):
        registry.service("s")

import pytest
from pyspark.sql import functions as F

from lodgeworks.operators import features, models
from lodgeworks.plans.ingest import build_features, clean_bookings, load_training_rows, publish_features
from lodgeworks.sources.bookings import bookings
from tests.conftest import with_columns


def test_stay_features(spark, processed):
    nights = [(0, 9, "No"), (4, 0, "Yes"), (2, 5, None), (6, 1, "Yes")]
    df = with_columns(spark, processed, "no_of_weekend_nights long, no_of_week_nights long, repeated_guest string", nights)
    rows = features.add_stay_features(df).orderBy("feature1").collect()
    assert [r.total_nights_stayed for r in rows] == [9, 4, 7, 7]
    assert [r.is_repeat_guest for r in rows] == [0, 1, 0, 1]


def test_stay_features_need_columns(processed):
    with pytest.raises(KeyError):
        features.add_stay_features(processed)


def test_repeat_guest_of_numbers_is_zero_by_default(spark):
    df = spark.createDataFrame([(1, 1, 1)], "no_of_weekend_nights long, no_of_week_nights long, repeated_guest long")
    assert features.add_stay_features(df).first().is_repeat_guest == 0
    assert features.add_stay_features(df, ("1",)).first().is_repeat_guest == 1


def _categories(spark, processed):
    values = [("soup", "attic", "rail"), ("bread", "attic", "air"), ("soup", "loft", "sea"), ("tea", "cellar", "air")]
    return with_columns(
        spark, processed, "type_of_meal_plan string, room_type_reserved string, market_segment_type string", values
    )


def test_encoding(spark, processed):
    df, codes = features.encode_categories(_categories(spark, processed))
    rows = df.orderBy("feature1").collect()
    assert [r.type_of_meal_plan for r in rows] == [1, 0, 1, 2]
    assert [r.market_segment_type for r in rows] == [1, 0, 2, 0]
    assert df.schema["room_type_reserved"].dataType.simpleString() == "bigint"
    assert codes.small["market_segment_type"] == ["air", "rail", "sea"]
    back = codes.decode(df, "market_segment_type").orderBy("feature1").collect()
    assert [r.market_segment_type for r in back] == ["rail", "air", "sea", "air"]


def test_encoding_errors(spark, processed):
    with pytest.raises(ValueError):
        features.encode_categories(processed)
    with pytest.raises(ValueError):
        features.encode_categories(_categories(spark, processed), [])
    with pytest.raises(ValueError):
        features.encode_categories(_categories(spark, processed).limit(0))


@pytest.mark.parametrize("driver_labels", [10_000, 100, 10])
def test_dictionaries_of_every_size_agree(spark, driver_labels):
    """Literal, broadcast and table dictionaries give the same codes."""
    df = spark.range(3_000).select("id", F.concat(F.lit("l"), F.col("id") % 90).alias("x"))
    df = df.withColumn("x", F.when(F.col("id") % 7 != 0, F.col("x")))
    out = features.fit_label_codes(df, ["x"], driver_labels).encode(df)
    labels = sorted({f"l{i % 90}" for i in range(3_000) if i % 7})
    for r in out.collect():
        assert r.x == (labels.index(f"l{r.id % 90}") if r.id % 7 else None)


def test_split_target(spark, processed):
    df = with_columns(spark, processed, "booking_status string", [("Canceled",), ("Not_Canceled",)] * 2)
    out, names = features.split_target(df, encode=True)
    assert names == ["feature1", "feature2", "feature3", "feature4"]
    assert [r.booking_status for r in out.orderBy("feature1").collect()] == [0, 1, 0, 1]
    with pytest.raises(ValueError):
        features.split_target(processed)


def test_lookup_default(spark):
    df = spark.createDataFrame([("Canceled",), ("Not_Canceled",), ("?",), (None,)], "booking_status string")
    assert [r[0] for r in df.select(features.target_from_text()).collect()] == [1, 0, 0, 0]


def test_importance_and_threshold(spark):
    df = spark.range(600).select(
        (F.col("id") % 10).cast("double").alias("x"), F.rand(1).alias("noise"),
        (F.col("id") % 10 > 4).cast("int").alias("label"),
    )
    table = models.feature_importance(df, ["x", "noise"], trees=10, depth=4)
    scores = {r.feature: r.importance for r in table.collect()}
    assert sum(scores.values()) == pytest.approx(1.0) and scores["x"] > scores["noise"]
    assert [r.feature for r in models.important_features(table, 0.5).collect()] == ["x"]
    assert [r.feature for r in models.top_features(table, 1).collect()] == ["x"]
    edge = spark.createDataFrame([("a", 0.05), ("b", 0.06)], "feature string, importance double")
    assert [r.feature for r in models.important_features(edge).collect()] == ["b"]
    for bad in ("0.1", -0.1, 1.1, None, True):
        with pytest.raises(ValueError):
            models.important_features(table, bad)
    with pytest.raises(ValueError):
        models.feature_importance(df.limit(0), ["x"])


def test_feature_table_to_training_rows(spark, small, tmp_path):
    cleaned = clean_bookings(bookings(spark, small), keep_id=True)
    out = build_features(cleaned, "2024-02-01 00:00:00", trees=5, depth=4)
    rows = out.features
    assert features.check_feature_table(rows) == []
    n = cleaned.count()
    ids = sorted(r.booking_id for r in rows.select("booking_id").collect())
    assert ids == list(range(n))
    publish_features(rows, str(tmp_path))
    loaded = load_training_rows(spark, str(tmp_path))
    assert loaded.count() == n
    assert set(loaded.columns) == {"booking_id", "lead_time", "avg_price_per_room", "no_of_special_requests",
                                   "arrival_date", "arrival_month", "booking_status"}
    zeroed = features.to_feature_table(
        rows, "2024-02-01 00:00:00", selected=["lead_time"], zero_unselected=True)
    assert zeroed.filter("arrival_month != 0").isEmpty() and not zeroed.filter("lead_time != 0").isEmpty()


def test_feature_table_check(spark, small):
    cleaned = clean_bookings(bookings(spark, small), keep_id=True)
    table = features.to_feature_table(cleaned.withColumn("n", F.lit(1)).withColumnRenamed("n", "key"), "2024-02-01", key="key")
    with pytest.raises(ValueError):
        features.check_feature_table(table.drop("lead_time"))
    with pytest.raises(ValueError):
        features.check_feature_table(table.withColumn("booking_date", F.lit(None).cast("date")))
    assert features.check_feature_table(table.withColumn("lead_time", F.lit(1.5))) == ["lead_time"]


def test_default_columns_and_truncation(spark):
    df = spark.createDataFrame([(1, "2018-01-01", 3.9, "Canceled")], "booking_id long, booking_date string, lead_time double, booking_status string")
    row = features.to_feature_table(df, "2024-02-01").first()
    assert row.lead_time == 3 and row.arrival_month == 0 and row.booking_status == 1


def test_one_hot_and_chi_square(spark):
    rows = [("red", "y"), ("red", "n"), ("blue", "y"), (None, "y"), ("blue", "y"), ("red", None), ("red", "n")]
    df = spark.createDataFrame(rows, "c string, label string")
    hot = features.one_hot(df, {"c": ["red", "green"]}).collect()
    assert [(r["c=red"], r["c=green"]) for r in hot] == [(int(c == "red"), 0) for c, _ in rows]
    # Counts red: y 1, n 2; blue: y 2, n 0.
    want = sum((n - e) ** 2 / e for n, e in ((1, 9 / 5), (2, 6 / 5), (2, 6 / 5), (0, 4 / 5)))
    found = features.chi_square(df, ["c"], "label").first()
    assert found.statistic == pytest.approx(want) and found.degrees == 1
    assert features.chi_square(df.limit(0), ["c"], "label").collect() == []


def test_decode_joins_a_dictionary_that_is_a_table(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(["b", "a", None, "c", "b"])], "id long, v string")
    codes = features.fit_label_codes(df, ["v"], driver_labels=1)
    assert codes.small["v"] is None
    back = codes.decode(codes.encode(df), "v")
    assert back.columns == df.columns and sorted(back.collect()) == sorted(df.collect())

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodgeworks.functions.dates import is_valid_date, parse_date, repair_date, strict_date
from lodgeworks.operators import clean
from lodgeworks.operators.features import require_rows


def test_duplicates(two_columns):
    assert clean.drop_duplicate_rows(two_columns).count() == 5
    once = clean.drop_duplicate_rows(two_columns)
    assert clean.drop_duplicate_rows(once).count() == 5
    assert clean.drop_duplicate_rows(two_columns.unionByName(two_columns)).count() == 5


def test_duplicates_ignoring_a_column(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", 2)], "id string, x int")
    rows = {tuple(r) for r in clean.drop_duplicate_rows(df, ["id"]).collect()}
    assert rows == {("a", 1), ("c", 2)}


def test_duplicate_summary(spark, two_columns):
    row = clean.duplicate_summary(two_columns).first()
    assert (row.n_rows, row.n_distinct, row.n_duplicates, row.has_duplicates) == (7, 5, 2, True)
    assert clean.duplicate_summary(two_columns.limit(0)).first().n_duplicates == 0


def test_fill_nulls_uses_mean(two_columns):
    filled = clean.fill_nulls(two_columns)
    values = sorted(r.feature1 for r in filled.collect())
    assert values == [1.0, 5.0, 6.0, 6.0, 8.0, 8.0, 8.0]


def test_fill_nulls_without_nulls(two_columns):
    df = two_columns.fillna(0)
    assert clean.fill_nulls(df).exceptAll(df).isEmpty()


def test_fill_nulls_only_nulls(spark):
    df = spark.createDataFrame([(None, None)] * 5, "feature1 double, feature2 string")
    with pytest.raises(ValueError):
        clean.fill_nulls(df)


def test_fill_nulls_empty_frame(two_columns):
    with pytest.raises(ValueError):
        clean.fill_nulls(two_columns.limit(0))


def test_fill_nulls_counts_nan_and_promotes(spark):
    df = spark.createDataFrame([(1, float("nan")), (None, 4.0), (2, 2.0)], "a long, b double")
    rows = clean.fill_nulls(df)
    assert rows.schema["a"].dataType.simpleString() == "double"
    assert sorted(r.b for r in rows.collect()) == [2.0, 3.0, 4.0]


def test_mode_takes_smallest_of_ties(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("b", 3), ("a", 4), (None, 5)], "s string, n int")
    assert clean.value_modes(df, ["s"]).first().mode == "a"
    assert {r.s for r in clean.fill_nulls(df).filter("n = 5").collect()} == {"a"}


def test_auto_clean_uses_median(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (9.0,), (None,), (1.0,)], "a double")
    assert sorted(r.a for r in clean.auto_clean(df).collect()) == [1.0, 2.0, 2.0, 9.0]


def test_drop_identifier(spark, two_columns):
    df = two_columns.withColumn("Booking_ID", F.lit(1))
    assert clean.drop_id_column(df).columns == ["feature1", "feature2"]
    with pytest.raises(ValueError):
        clean.drop_id_column(two_columns)


def test_types(spark, two_columns):
    typed = clean.set_types(two_columns)
    assert typed.schema["feature2"].metadata == {"categorical": True}
    assert typed.schema["feature1"].dataType.simpleString() == "double"
    again = clean.set_types(typed)
    assert again.schema == typed.schema
    with pytest.raises(ValueError):
        clean.set_types(two_columns.withColumn("flag", F.lit(True)))


def test_types_accept_booking_date_anywhere(two_columns):
    typed = clean.set_types(two_columns.withColumn("booking_date", F.lit("2018-03-01").cast("date")))
    assert typed.schema["booking_date"].dataType.simpleString() == "date"
    coerced = clean.set_types(two_columns, numbers_as_text=["feature2"])
    assert coerced.filter("feature2 IS NOT NULL").isEmpty()


def test_null_counts(two_columns):
    assert {r["column"]: r.n_null for r in clean.null_counts(two_columns).collect()} == {"feature1": 1, "feature2": 0}


def test_booking_date_needs_its_columns(two_columns):
    with pytest.raises(ValueError):
        clean.add_booking_date(two_columns)


def test_require_rows(two_columns):
    assert require_rows(two_columns) is two_columns
    with pytest.raises(ValueError):
        require_rows(two_columns.limit(0))


def _dates(spark, rows, expr):
    df = spark.createDataFrame(rows, "d double, m double, y double")
    return [r[0] for r in df.select(expr).collect()]


def test_repair_examples(spark):
    rows = [(31.0, 2.0, 2018.0), (0.0, 13.0, 2019.0), (30.0, 2.0, 2016.0), (None, 1.0, 2018.0),
            (29.9, 2.0, 2018.0), (5.0, 0.0, 2030.0), (float("nan"), 1.0, 2018.0)]
    got = _dates(spark, rows, repair_date("d", "m", "y"))
    assert got == [dt.date(2018, 2, 28), dt.date(2019, 12, 1), dt.date(2018, 2, 28), None,
                   dt.date(2018, 2, 28), dt.date(2018, 1, 5), None]


def test_leap_day_with_wide_years(spark):
    rows = [(31.0, 2.0, 2020.0), (31.0, 2.0, 1850.0)]
    wide = repair_date("d", "m", "y", years=(1900, 2100), default_year=2023)
    assert _dates(spark, rows, wide) == [dt.date(2020, 2, 29), dt.date(2023, 2, 28)]


def test_same_year_and_strict(spark):
    rows = [(31.0, 4.0, 2001.0), (30.0, 4.0, 2001.0), (1.0, 1.0, 12_000.0), (1.0, 1.0, 1500.0)]
    same = repair_date("d", "m", "y", years=None)
    assert _dates(spark, rows, same) == [dt.date(2001, 4, 30), dt.date(2001, 4, 30), None, None]
    assert _dates(spark, rows, strict_date("d", "m", "y")) == [None, dt.date(2001, 4, 30), None, None]
    assert _dates(spark, rows, is_valid_date("d", "m", "y")) == [False, True, False, True]


def test_parse_date_fails_on_impossible_dates(spark):
    df = spark.createDataFrame([(30, 2, 2018)], "d int, m int, y int")
    with pytest.raises(Exception):
        df.select(parse_date("d", "m", "y")).collect()


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(*[st.integers(-50, 4_000)] * 3), min_size=1, max_size=30))
def test_repair_is_valid_and_idempotent(spark, parts):
    df = spark.createDataFrame(parts, "d int, m int, y int")
    out = df.select(repair_date("d", "m", "y").alias("x"))
    again = out.select("x", repair_date(F.day("x"), F.month("x"), F.year("x")).alias("again"))
    for row in again.collect():
        assert row.x is not None and 2017 <= row.x.year <= 2019 and row.x == row.again

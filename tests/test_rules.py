import pytest
from pyspark.sql import functions as F

from lodgeworks.operators import rules
from lodgeworks.operators.clean import fill_nulls, set_types
from lodgeworks.plans.ingest import clean_bookings
from lodgeworks.session import staged
from lodgeworks.sources.bookings import bookings


@pytest.fixture(scope="module")
def raw(spark, small):
    return staged(bookings(spark, small))


@pytest.fixture(scope="module")
def good(spark, small):
    df = clean_bookings(bookings(spark, small))
    return df.withColumn("arrival_month", F.greatest(F.least("arrival_month", F.lit(12)), F.lit(1))).withColumn(
        "arrival_date", F.greatest("arrival_date", F.lit(1.0)))


def test_clean_table_passes(good):
    assert rules.check_schema(good).is_valid
    assert rules.check_feature_readiness(good).is_valid and not rules.check_feature_readiness(good).warnings
    _, result = rules.validate(good, strict=True)
    assert result.is_valid


def test_all_failures_are_collected(raw):
    result = rules.check_schema(raw)
    assert not result.is_valid
    found = {(f.check, f.column): f.n_rows for f in result.findings}
    assert {("not_null", "lead_time"), ("1_to_12", "arrival_month"), ("1_to_31", "arrival_date"),
            ("no_nulls", None)} <= set(found)
    assert "failed" in result.report and "arrival month" in result.report


def test_strict_raises_with_findings(raw):
    with pytest.raises(rules.ValidationError) as caught:
        rules.validate(raw)
    assert caught.value.findings


def test_auto_fix_removes_nulls_and_copies(raw):
    fixed, result = rules.validate(raw, strict=False, auto_fix=True)
    assert fixed.count() < raw.count()
    assert not [f for f in result.findings if f.check in ("not_null", "nulls", "duplicates")]


def test_one_scan_for_all_rules(raw):
    plan = rules.evaluate(raw, rules.cleaned_rules())._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan") == 1


def test_absent_column_and_wrong_type_are_findings(good):
    df = good.drop("lead_time").withColumn("arrival_year", F.col("arrival_year").cast("string"))
    found = {(f.check, f.column) for f in rules.check_schema(df).findings}
    assert found == {("present", "lead_time"), ("type", "arrival_year")}


def test_empty_frame_is_a_finding(good):
    assert "not_empty" in {f.check for f in rules.check_schema(good.limit(0)).findings}


def test_number_rule_by_name():
    checks = {n: [r.check for r in rules.number_rule(n)] for n in ("room_price", "week_nights", "lead_time", "other")}
    assert checks == {
        "room_price": ["at_least_0", "at_most_50000"], "week_nights": ["at_least_0", "at_most_365"],
        "lead_time": ["at_least_0", "at_most_1000"], "other": ["at_least_0"],
    }


def test_business_rules_only_warn(raw):
    result = rules.check_business(raw)
    assert result.is_valid and len(result.warnings) >= 2
    assert rules.check_business(raw.select("arrival_month")).warnings == []


def test_business_thresholds(spark):
    df = spark.createDataFrame([(0, 0, 9.99, 366), (1, 0, 10.0, 365), (0, 1, 5000.5, 1)],
                               "no_of_weekend_nights long, no_of_week_nights long, avg_price_per_room double, lead_time long")
    found = {f.check: f.n_rows for f in rules.check_business(df).findings}
    assert found == {"zero_nights": 1, "low_price": 1, "high_price": 1, "long_lead": 1}


def test_infinities(spark):
    df = spark.createDataFrame([(1.0, float("inf")), (2.0, float("-inf"))], "a double, b double")
    assert [(r["column"], r.n_infinite) for r in rules.infinite_counts(df).collect()] == [("b", 2)]
    report = rules.quality_report(df)
    assert report.issues == ["infinite values in: ['b']"]


def test_post_ingestion(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "guest_id long, type_of_meal_plan string")
    found = {f.check: f.severity for f in rules.check_post_ingestion(df).findings}
    assert found == {"duplicates": "info", "nulls": "error", "id_like": "info", "not_categorical": "warning"}
    clean = set_types(fill_nulls(df)).drop("guest_id").distinct()  # the filled row equals the others
    assert rules.check_post_ingestion(clean).findings == []


def test_readiness(spark):
    df = spark.createDataFrame([("x", "y")], "lead_time string, type_of_meal_plan string")
    result = rules.check_feature_readiness(df)
    assert len(result.errors) == 2 and len(result.warnings) == 1


def test_report_text(raw):
    text = rules.validation_report(raw)
    assert "missing values in" in text and "with warnings" in text

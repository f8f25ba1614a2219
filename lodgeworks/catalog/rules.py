"""Validation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodgeworks.catalog.cleaning import RAW, cleaned
from lodgeworks.catalog.registry import NUMBERS, long_sql, over_bookings, over_cleaned, query
from lodgeworks.fields import ID_NAME_PATTERNS
from lodgeworks.functions.columns import long_form, number_columns
from lodgeworks.operators import clean, features, rules, sketches
from lodgeworks.operators.quantiles import iqr_outliers
from lodgeworks.session import staged
from lodgeworks.sources.bookings import bookings


def _findings_sql(source: str, checks: list[tuple[str, str | None, str, str]]) -> str:
    """``(check, column, severity, condition of a bad row)`` as a findings query."""
    parts = []
    for check, column, severity, bad in checks:
        named = f"'{column}'" if column else "NULL::VARCHAR"
        parts.append(
            f"SELECT '{check}' AS \"check\", {named} AS \"column\", '{severity}' AS severity,"
            f" COUNT(*) FILTER (WHERE {bad}) AS n_rows FROM {source}"
        )
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE n_rows > 0"


_REQUIRED = ("type_of_meal_plan", "room_type_reserved", "market_segment_type", "lead_time",
             "no_of_weekend_nights", "no_of_week_nights", "booking_status", "arrival_date", "arrival_month",
             "arrival_year", "repeated_guest", "required_car_parking_space", "avg_price_per_room",
             "no_of_special_requests")
_CLEANED_CHECKS = [("not_null", c, "error", f"{c} IS NULL") for c in _REQUIRED] + [
    ("at_least_0", "lead_time", "error", "lead_time < 0"),
    ("at_most_1000", "lead_time", "error", "lead_time > 1000"),
    ("at_least_0", "no_of_weekend_nights", "error", "no_of_weekend_nights < 0"),
    ("at_most_365", "no_of_weekend_nights", "error", "no_of_weekend_nights > 365"),
    ("at_least_0", "no_of_week_nights", "error", "no_of_week_nights < 0"),
    ("at_most_365", "no_of_week_nights", "error", "no_of_week_nights > 365"),
    ("known_label", "booking_status", "error", "booking_status NOT IN ('Canceled', 'Not_Canceled')"),
    ("1_to_31", "arrival_date", "error", "arrival_date NOT BETWEEN 1 AND 31"),
    ("1_to_12", "arrival_month", "error", "arrival_month NOT BETWEEN 1 AND 12"),
    ("2000_to_2030", "arrival_year", "error", "arrival_year NOT BETWEEN 2000 AND 2030"),
    ("0_or_1", "repeated_guest", "error", "repeated_guest NOT IN (0, 1)"),
    ("0_or_1", "required_car_parking_space", "error", "required_car_parking_space NOT IN (0, 1)"),
    ("at_least_0", "avg_price_per_room", "error", "avg_price_per_room < 0"),
    ("at_most_10000", "avg_price_per_room", "error", "avg_price_per_room > 10000"),
    ("at_least_0", "no_of_special_requests", "error", "no_of_special_requests < 0"),
    ("at_most_20", "no_of_special_requests", "error", "no_of_special_requests > 20"),
]
_BUSINESS_CHECKS = [
    ("zero_nights", None, "warning", "no_of_weekend_nights + no_of_week_nights = 0"),
    ("low_price", None, "warning", "avg_price_per_room < 10"),
    ("high_price", None, "warning", "avg_price_per_room > 5000"),
    ("long_lead", None, "warning", "lead_time > 365"),
]
_COLUMNS = ("check", "column", "severity", "n_rows")


@query("v1_declared_rules", over_cleaned(_findings_sql("cleaned", _CLEANED_CHECKS)))
def declared(spark, sf):
    df = cleaned(spark, sf)
    row_rules = [r for r in rules.cleaned_rules() if isinstance(r, rules.Rule)]
    return rules.evaluate(df, row_rules).select(*_COLUMNS)


@query("v3_schema_findings", over_bookings(_findings_sql("bookings", _CLEANED_CHECKS)))
def schema_findings(spark, sf):
    row_rules = [r for r in rules.cleaned_rules() if isinstance(r, rules.Rule)]
    return rules.evaluate(bookings(spark, sf), row_rules).select(*_COLUMNS)


@query(
    "v2_number_rules",
    over_bookings(
        _findings_sql(
            "bookings",
            [("not_null", c, "error", f"{c} IS NULL") for c in ("avg_price_per_room", "lead_time", "no_of_week_nights")]
            + [
                ("at_least_0", "avg_price_per_room", "error", "avg_price_per_room < 0"),
                ("at_most_50000", "avg_price_per_room", "error", "avg_price_per_room > 50000"),
                ("at_most_1000", "lead_time", "error", "lead_time > 1000"),
                ("at_most_365", "no_of_week_nights", "error", "no_of_week_nights > 365"),
            ],
        )
    ),
)
def number_rules(spark, sf):
    names = ("avg_price_per_room", "lead_time", "no_of_week_nights")
    found = [r for c in names for r in rules.number_rule(c)]
    return rules.evaluate(bookings(spark, sf, names), found).select(*_COLUMNS)


_OUTLIER_COLUMNS = NUMBERS


def _outliers_sql(source: str, columns) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", ROUND(q1, 8)::DOUBLE AS q1, ROUND(q3, 8)::DOUBLE AS q3,
        (SELECT COUNT(*) FROM {source} WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS n_outliers
        FROM (SELECT QUANTILE_CONT({c}, 0.25) AS q1, QUANTILE_CONT({c}, 0.75) AS q3 FROM {source})"""
        for c in columns
    )


@query("a11_iqr_outliers", over_bookings(_outliers_sql("bookings", _OUTLIER_COLUMNS)))
def outliers(spark, sf):
    found = iqr_outliers(staged(bookings(spark, sf, _OUTLIER_COLUMNS)), _OUTLIER_COLUMNS)
    return found.withColumns({c: F.round(c, 8) for c in ("q1", "q3")})


@query(
    "a14_row_and_column_counts",
    over_bookings(f"SELECT COUNT(*) AS n_rows, {len(RAW)}::BIGINT AS n_columns FROM bookings"),
)
def shape(spark, sf):
    df = bookings(spark, sf)
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).cast("long").alias("n_columns"))


_SHARES = (0.01, 0.25, 0.5, 0.75, 0.99)


@query(
    "a10_sketched_quantiles",
    over_bookings(" UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", p.p AS share, (SELECT COUNT({c}) FROM bookings) AS n, true AS within_error "
        f"FROM (SELECT UNNEST([{', '.join(f'{s}::DOUBLE' for s in _SHARES)}]) AS p) p" for c in NUMBERS)),
)
def sketched_quantiles(spark, sf):
    """Quantiles from merged sketches; the exact rank of each answer is within the stated error."""
    df = staged(bookings(spark, sf, NUMBERS, key=True).withColumn("part", F.col("k") % 7), "bookings")
    merged = sketches.merge(sketches.sketch(df, NUMBERS, by=["part"]))
    found = sketches.sketched_quantiles(merged, _SHARES)
    answers = F.array(*[F.struct(F.lit(s).alias("share"), F.col(f"q{i}").alias("v")) for i, s in enumerate(_SHARES)])
    asked = staged(found.select("name", "n", "error", F.explode(answers).alias("a")).select("name", "n", "error", "a.*"), "answers")
    # A row per column and share meets the values of its column.
    ranks = long_form(df, NUMBERS, "double").filter(F.col("value").isNotNull()).join(F.broadcast(asked), "name").groupBy(
        "name", "n", "error", "share").agg(
        F.count_if(F.col("value") < F.col("v")).alias("below"), F.count_if(F.col("value") <= F.col("v")).alias("upto"))
    low, high = F.col("below") / F.col("n") - F.col("error"), F.col("upto") / F.col("n") + F.col("error")
    return ranks.select(F.col("name").alias("column"), "share", "n", ((low <= F.col("share")) & (F.col("share") <= high)).alias("within_error"))


@query("a25_business_counts", over_bookings(_findings_sql("bookings", _BUSINESS_CHECKS)))
def business_counts(spark, sf):
    df = bookings(spark, sf)
    return rules.evaluate(df, rules.business_rules(df)).select(*_COLUMNS)


@query("v6_business_rules", over_cleaned(_findings_sql("cleaned", _BUSINESS_CHECKS)))
def business_rules(spark, sf):
    df = cleaned(spark, sf)
    return rules.evaluate(df, rules.business_rules(df)).select(*_COLUMNS)


@query(
    "a26_infinite_columns",
    over_bookings(
        """SELECT 'ratio' AS "column", COUNT(*) AS n_infinite FROM bookings
        WHERE no_of_week_nights = 0 AND avg_price_per_room IS NOT NULL HAVING COUNT(*) > 0"""
    ),
)
def infinite_columns(spark, sf):
    df = bookings(spark, sf, ["avg_price_per_room", "no_of_week_nights"])
    price = F.col("avg_price_per_room")
    # A ratio with infinities where the divisor is 0, as pandas arithmetic would give.
    ratio = F.when(F.col("no_of_week_nights") == 0, price * float("inf")).otherwise(
        F.try_divide(price, F.col("no_of_week_nights"))
    )
    return rules.infinite_counts(df.withColumn("ratio", ratio))


@query(
    "v4_quality_report",
    over_bookings(
        "SELECT 'rows' AS metric, NULL::VARCHAR AS \"column\", COUNT(*)::BIGINT AS n FROM bookings UNION ALL "
        "SELECT 'duplicates', NULL, (SELECT COUNT(*) FROM bookings) - COUNT(*) FROM (SELECT DISTINCT * FROM bookings)"
        " UNION ALL SELECT 'nulls', \"column\", n FROM ("
        + long_sql("bookings", [(c, f"COUNT(*) - COUNT({c})") for c in RAW])
        + ") UNION ALL SELECT 'outliers', \"column\", n_outliers FROM ("
        + _outliers_sql("bookings", [c for c in RAW if c not in (
            "Booking_ID", "type_of_meal_plan", "room_type_reserved", "market_segment_type", "booking_status")])
        + ") WHERE n_outliers > 0"
    ),
)
def quality(spark, sf):
    report = rules.quality_report(staged(bookings(spark, sf)))
    rows = [("rows", None, report.total_rows), ("duplicates", None, report.duplicate_rows)]
    rows += [("nulls", c, n) for c, n in report.missing_values.items()]
    rows += [("outliers", c, n) for c, n in report.outliers.items()]
    return spark.createDataFrame(rows, "metric string, column string, n long")


@query(
    "v5_post_ingestion",
    over_bookings(
        """SELECT * FROM (
        SELECT 'duplicates' AS "check", 'info' AS severity,
          (SELECT COUNT(*) FROM bookings) - COUNT(*) AS n_rows FROM (SELECT DISTINCT * FROM bookings)
        UNION ALL SELECT 'nulls', 'error', ("""
        + " + ".join(f"COUNT(*) - COUNT({c})" for c in RAW)
        + """)::BIGINT FROM bookings
        UNION ALL SELECT 'not_categorical', 'warning', 0 FROM RANGE(3)
        UNION ALL SELECT 'id_like', 'info', 0 FROM (SELECT UNNEST(["""
        + ", ".join(f"'{c}'" for c in RAW)
        + """]) AS c) WHERE """
        + " OR ".join(f"CONTAINS(c, '{p}')" for p in ID_NAME_PATTERNS)
        + ")"
    ),
)
def post_ingestion(spark, sf):
    found = rules.check_post_ingestion(staged(bookings(spark, sf))).findings
    return spark.createDataFrame(
        [(f.check, f.severity, f.n_rows) for f in found], "check string, severity string, n_rows long"
    )


@query("v8_all_stages")
def all_stages(spark, sf):
    _, result = rules.validate(staged(bookings(spark, sf)), strict=False)
    return spark.createDataFrame(
        [(f.check, f.column, f.severity, f.n_rows, f.message) for f in result.findings], rules.FINDINGS_SCHEMA
    )


@query("v8_all_stages_after_auto_fix")
def all_stages_fixed(spark, sf):
    _, result = rules.validate(staged(bookings(spark, sf)), strict=False, auto_fix=True)
    return spark.createDataFrame(
        [(f.check, f.column, f.severity, f.n_rows, f.message) for f in result.findings], rules.FINDINGS_SCHEMA
    )


@query("v10_report_text")
def report_text(spark, sf):
    text = rules.validation_report(staged(bookings(spark, sf)))
    return spark.createDataFrame([(i, line) for i, line in enumerate(text.splitlines())], "line int, text string")


_ENCODED_CHECKS = [
    ("not_null", c, "error", f"{c} IS NULL")
    for c in ("lead_time", "no_of_special_requests", "no_of_week_nights", "arrival_date")
] + [
    ("not_null", "type_of_meal_plan", "error", "type_of_meal_plan IS NULL"),
    ("not_null", "avg_price_per_room", "error", "avg_price_per_room IS NULL"),
    ("1_to_32", "arrival_date", "error", "arrival_date NOT BETWEEN 1 AND 32"),
    ("1_to_13", "arrival_month", "error", "arrival_month NOT BETWEEN 1 AND 13"),
]


@query("v11_encoded_rules", over_bookings(_findings_sql("bookings", _ENCODED_CHECKS)))
def encoded(spark, sf):
    df, _ = features.encode_categories(features.add_stay_features(bookings(spark, sf)))
    return rules.evaluate(df, rules.encoded_rules()).select(*_COLUMNS)


@query(
    "v7_feature_readiness",
    over_cleaned("SELECT 0::BIGINT AS n_errors, 0::BIGINT AS n_warnings, COUNT(*) AS n_rows FROM cleaned"),
)
def readiness(spark, sf):
    df = cleaned(spark, sf)
    found = rules.check_feature_readiness(df)
    return df.agg(
        F.lit(len(found.errors)).cast("long").alias("n_errors"),
        F.lit(len(found.warnings)).cast("long").alias("n_warnings"),
        F.count(F.lit(1)).alias("n_rows"),
    )


@query("v9_validate_cleaned_data", over_cleaned("SELECT booking_status, COUNT(*) AS n FROM cleaned GROUP BY 1"))
def validated(spark, sf):
    """The lenient entry point keeps every row."""
    rows = rules.validate_cleaned_data(staged(cleaned(spark, sf)), strict=False)
    return rows.groupBy("booking_status").agg(F.count(F.lit(1)).alias("n"))


@query(
    "f17_id_like_columns",
    over_bookings(
        """SELECT 'Booking_ID' AS "column", COUNT(DISTINCT Booking_ID) AS n_distinct FROM bookings"""
    ),
)
def id_like(spark, sf):
    df = bookings(spark, sf)
    names = rules.id_like_columns(df)
    counts = df.agg(*[F.countDistinct(c).alias(c) for c in names])
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).alias("n_distinct")) for c in names]
    return counts.select(F.explode(F.array(*cells)).alias("r")).select("r.*")


@query(
    "x5_custom_rules",
    over_bookings(
        """SELECT 'parking_needs_price' AS "check", NULL::VARCHAR AS "column", 'warning' AS severity,
        COUNT(*) FILTER (WHERE required_car_parking_space = 1 AND avg_price_per_room IS NULL) AS n_rows FROM bookings
        UNION ALL SELECT 'even_week_nights', 'no_of_week_nights', 'error', COUNT(*) FILTER (WHERE no_of_week_nights % 2 <> 0)
        FROM bookings"""
    ),
)
def custom_rules(spark, sf):
    """User rules: a column predicate and an aggregate over the frame."""
    mine = [
        rules.TableRule(
            "parking_needs_price", "parking without a price",
            lambda df: F.count_if((F.col("required_car_parking_space") == 1) & F.col("avg_price_per_room").isNull()),
            rules.WARNING,
        ),
        rules.Rule("no_of_week_nights", "even_week_nights", "odd number of nights", lambda c: c % 2 == 0),
    ]
    return rules.evaluate(bookings(spark, sf), mine).select(*_COLUMNS)

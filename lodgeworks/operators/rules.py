"""Declarative validation: all rules of a set are evaluated in one aggregate over one scan."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodgeworks.fields import CATEGORICAL, ID_NAME_PATTERNS, NUMERICAL, TARGET, TARGET_LABELS
from lodgeworks.functions.columns import (
    absent_columns,
    is_categorical,
    is_numeric,
    missing,
    number_columns,
    present,
)
from lodgeworks.operators.clean import auto_clean, duplicate_summary
from lodgeworks.operators.quantiles import iqr_outliers

ERROR, WARNING, INFO = "error", "warning", "info"
FINDINGS_SCHEMA = "check string, column string, severity string, n_rows long, message string"


class ValidationError(Exception):
    """Raised by strict validation; carries the findings."""

    def __init__(self, message: str, findings: Sequence[Finding] = ()) -> None:
        super().__init__(message)
        self.findings = list(findings)


@dataclass(frozen=True)
class Rule:
    """``holds`` gives the condition of a good row; null counts as good (see ``nullable``)."""

    column: str
    check: str
    message: str
    holds: Callable[[Column], Column] | None = None
    severity: str = ERROR
    nullable: bool = False
    types: tuple[type[T.DataType], ...] = ()


@dataclass(frozen=True)
class TableRule:
    """A condition on the whole frame: ``broken`` is an aggregate that counts what is wrong."""

    check: str
    message: str
    broken: Callable[[DataFrame], Column]
    severity: str = ERROR


@dataclass(frozen=True)
class Finding:
    check: str
    column: str | None
    severity: str
    n_rows: int
    message: str


@dataclass
class ValidationResult:
    """Outcome of one stage or of all of them."""

    is_valid: bool
    errors: list[str] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)
    findings: list[Finding] = field(default_factory=list)

    @classmethod
    def of(cls, findings: Sequence[Finding]) -> ValidationResult:
        errors = [f.message for f in findings if f.severity == ERROR]
        warnings = [f.message for f in findings if f.severity == WARNING]
        return cls(not errors, errors, warnings, list(findings))

    @property
    def report(self) -> str:
        lines = [f"Validation {'passed' if self.is_valid else 'failed'}"]
        for title, texts in (("Errors", self.errors), ("Warnings", self.warnings)):
            if texts:
                lines += [f"{title}:", *[f"  - {t}" for t in texts]]
        if len(lines) == 1:
            lines.append("No findings")
        return "\n".join(lines)


def _between(low: float | None, high: float | None) -> Callable[[Column], Column]:
    def holds(col: Column) -> Column:
        bounds = F.lit(True)
        if low is not None:
            bounds = bounds & (col >= low)
        if high is not None:
            bounds = bounds & (col <= high)
        return bounds

    return holds


def _one_of(*values) -> Callable[[Column], Column]:
    return lambda col: col.isin(*values)


def number_rule(name: str) -> list[Rule]:
    """Range rules of a number column, chosen by what its name says it measures."""
    lower = name.lower()
    if "price" in lower:
        kind, high = T.DoubleType, 50_000
    elif "nights" in lower:
        kind, high = T.LongType, 365
    elif "time" in lower and "lead" in lower:
        kind, high = T.LongType, 1_000
    else:
        kind, high = T.LongType, None
    # A count column that had nulls was filled with its mean and is DOUBLE from then on.
    kinds = (kind,) if kind is T.DoubleType else (kind, T.DoubleType)
    rules = [Rule(name, "at_least_0", f"{name} must not be negative", _between(0, None), types=kinds)]
    if high is not None:
        rules.append(Rule(name, f"at_most_{high}", f"{name} is unrealistic", _between(None, high)))
    return rules


def cleaned_rules() -> list[Rule | TableRule]:
    """What a cleaned bookings table must satisfy; further columns are allowed."""
    whole = (T.LongType, T.DoubleType)
    rules: list[Rule | TableRule] = [
        Rule(c, "text", f"{c} must be categorical", types=(T.StringType,)) for c in CATEGORICAL
    ]
    for c in NUMERICAL:
        rules += number_rule(c)
    rules += [
        Rule(TARGET, "known_label", "unknown booking status", _one_of(*TARGET_LABELS),
             types=(T.StringType,)),
        Rule("arrival_date", "1_to_31", "arrival date must be 1 to 31", _between(1, 31), types=whole),
        Rule("arrival_month", "1_to_12", "arrival month must be 1 to 12", _between(1, 12), types=whole),
        Rule("arrival_year", "2000_to_2030", "arrival year must be 2000 to 2030",
             _between(2000, 2030), types=whole),
        Rule("repeated_guest", "0_or_1", "repeated guest must be 0 or 1", _one_of(0, 1), types=whole),
        Rule("required_car_parking_space", "0_or_1", "parking space must be 0 or 1", _one_of(0, 1),
             types=whole),
        Rule("avg_price_per_room", "at_least_0", "price must not be negative", _between(0, None),
             types=(T.DoubleType,)),
        Rule("avg_price_per_room", "at_most_10000", "price above 10000", _between(None, 10_000)),
        Rule("no_of_special_requests", "at_least_0", "requests must not be negative",
             _between(0, None), types=whole),
        Rule("no_of_special_requests", "at_most_20", "more than 20 requests", _between(None, 20)),
        TableRule("not_empty", "the frame is empty", lambda df: (F.count(F.lit(1)) == 0).cast("long")),
        TableRule("no_nulls", "the frame contains nulls", total_nulls),
    ]
    return rules


def encoded_rules() -> list[Rule | TableRule]:
    """Rules for the encoded table of the exploratory variant (categories as whole numbers)."""
    whole = (T.LongType, T.IntegerType)
    floor = ("lead_time", "no_of_special_requests", "total_nights_stayed",
             "no_of_week_nights", "no_of_weekend_nights")
    rules: list[Rule | TableRule] = [
        Rule(c, "at_least_0", f"{c} must not be negative", _between(0, None), types=whole) for c in floor
    ]
    rules.append(Rule("avg_price_per_room", "at_least_0", "price must not be negative",
                      _between(0, None), types=(T.DoubleType, T.FloatType)))
    for c, low, high in (("arrival_date", 1, 32), ("arrival_month", 1, 13), ("arrival_year", 2000, 2100)):
        rules.append(Rule(c, f"{low}_to_{high}", f"{c} out of range", _between(low, high), types=whole))
    rules += [Rule(c, "whole_number", f"{c} must be encoded", types=whole) for c in CATEGORICAL]
    rules += [
        Rule(c, "0_or_1", f"{c} must be 0 or 1", _one_of(0, 1), types=whole)
        for c in ("repeated_guest", "required_car_parking_space")
    ]
    rules.append(Rule(TARGET, "known_label", "unknown booking status", _one_of(*TARGET_LABELS),
                      types=(T.StringType,)))
    return rules


def total_nulls(df: DataFrame) -> Column:
    counts = [F.count_if(missing(df, c)) for c in df.columns]
    total = counts[0]
    for c in counts[1:]:
        total = total + c
    return total


def business_rules(df: DataFrame) -> list[TableRule]:
    """Plausibility counts; a rule whose columns are absent is left out."""
    have = set(df.columns)

    def count(name: str, text: str, cond: Column) -> TableRule:
        return TableRule(name, text, lambda _: F.count_if(cond), WARNING)

    rules = []
    if {"no_of_weekend_nights", "no_of_week_nights"} <= have:
        rules.append(count("zero_nights", "bookings of 0 nights",
                           F.col("no_of_weekend_nights") + F.col("no_of_week_nights") == 0))
    if "avg_price_per_room" in have:
        price = present(df, "avg_price_per_room")
        rules.append(count("low_price", "bookings with a price below 10", price < 10))
        rules.append(count("high_price", "bookings with a price above 5000", price > 5000))
    if "lead_time" in have:
        rules.append(count("long_lead", "bookings more than a year ahead",
                           present(df, "lead_time") > 365))
    return rules


def evaluate(df: DataFrame, rules: Sequence[Rule | TableRule]) -> DataFrame:
    """Findings of a rule set, one row per broken rule, as a lazy DataFrame.

    Type and presence findings come from the schema; all row counts come from a single aggregate
    whose one result row is unfolded.
    """
    counted: list[tuple[str, str | None, str, Column, str]] = []
    seen_nulls: set[str] = set()
    for rule in rules:
        if isinstance(rule, TableRule):
            counted.append((rule.check, None, rule.severity, rule.broken(df), rule.message))
            continue
        if rule.column not in df.columns:
            if rule.column not in seen_nulls:
                seen_nulls.add(rule.column)
                counted.append(("present", rule.column, rule.severity, F.lit(1).cast("long"),
                                f"{rule.column} is absent"))
            continue
        if rule.types and not isinstance(df.schema[rule.column].dataType, rule.types):
            counted.append(("type", rule.column, rule.severity, F.lit(1).cast("long"),
                            f"{rule.column} has type {df.schema[rule.column].dataType.simpleString()}"))
            continue
        if not rule.nullable and rule.column not in seen_nulls:
            seen_nulls.add(rule.column)
            counted.append(("not_null", rule.column, rule.severity,
                            F.count_if(missing(df, rule.column)), f"{rule.column} has nulls"))
        if rule.holds is not None:
            counted.append((rule.check, rule.column, rule.severity,
                            F.count_if(~rule.holds(present(df, rule.column))), rule.message))
    if not counted:
        return df.sparkSession.createDataFrame([], FINDINGS_SCHEMA)
    # A count of all rows keeps the aggregate valid when every finding is a constant.
    row = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[c.alias(f"_{i}") for i, (_, _, _, c, _) in enumerate(counted)])
    cells = [
        F.struct(
            F.lit(check).alias("check"),
            F.lit(column).cast("string").alias("column"),
            F.lit(severity).alias("severity"),
            F.col(f"_{i}").cast("long").alias("n_rows"),
            F.lit(message).alias("message"),
        )
        for i, (check, column, severity, _, message) in enumerate(counted)
    ]
    return row.select(F.explode(F.array(*cells)).alias("_f")).select("_f.*").filter("n_rows > 0")


def _collect(findings: DataFrame) -> list[Finding]:
    return [Finding(r["check"], r["column"], r["severity"], r["n_rows"], r["message"])
            for r in findings.collect()]


def infinite_counts(df: DataFrame) -> DataFrame:
    """``(column, n_infinite)`` for the double columns that hold an infinity."""
    doubles = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    if not doubles:
        return df.sparkSession.createDataFrame([], "column string, n_infinite long")
    bad = [float("inf"), float("-inf")]
    row = df.agg(*[F.count_if(F.col(f"`{c}`").isin(*bad)).alias(c) for c in doubles])
    cells = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("n_infinite")) for c in doubles]
    return row.select(F.explode(F.array(*cells)).alias("_r")).select("_r.*").filter("n_infinite > 0")


@dataclass
class QualityReport:
    """Profile of a frame: sizes, nulls, copies, types, infinities and outliers."""

    total_rows: int
    total_columns: int
    missing_values: dict[str, int]
    duplicate_rows: int
    data_types: dict[str, str]
    issues: list[str]
    outliers: dict[str, int]

    @property
    def text(self) -> str:
        lines = [
            "Data validation report",
            f"- rows: {self.total_rows:,}",
            f"- columns: {self.total_columns}",
            f"- duplicate rows: {self.duplicate_rows}",
            "Issues:",
            *([f"- {i}" for i in self.issues] or ["- none"]),
        ]
        if self.outliers:
            lines.append(f"Outliers: {self.outliers}")
        lines.append(f"Ready for features: {'yes' if not self.issues else 'with warnings'}")
        return "\n".join(lines)


def quality_report(df: DataFrame) -> QualityReport:
    """Counts in one scan, copies in one aggregation, outliers by :func:`iqr_outliers`."""
    doubles = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    bad = [float("inf"), float("-inf")]
    row = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(missing(df, c)).alias(f"n_{c}") for c in df.columns],
        *[F.count_if(F.col(f"`{c}`").isin(*bad)).alias(f"i_{c}") for c in doubles],
    ).first()
    nulls = {c: row[f"n_{c}"] for c in df.columns}
    issues = []
    if any(nulls.values()):
        issues.append(f"missing values in: {[c for c, n in nulls.items() if n]}")
    infinite = [c for c in doubles if row[f"i_{c}"]]
    if infinite:
        issues.append(f"infinite values in: {infinite}")
    outliers = {
        r["column"]: r["n_outliers"]
        for r in iqr_outliers(df, number_columns(df)).filter("n_outliers > 0").collect()
    }
    return QualityReport(
        row["_rows"], len(df.columns), nulls, duplicate_summary(df).first()["n_duplicates"],
        {f.name: f.dataType.simpleString() for f in df.schema}, issues, outliers,
    )


def id_like_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if any(p in c for p in ID_NAME_PATTERNS)]


def check_schema(df: DataFrame) -> ValidationResult:
    return ValidationResult.of(_collect(evaluate(df, cleaned_rules())))


def check_business(df: DataFrame) -> ValidationResult:
    rules = business_rules(df)
    return ValidationResult.of(_collect(evaluate(df, rules)) if rules else [])


def _post_ingestion(df: DataFrame, report: QualityReport) -> list[Finding]:
    found = []
    if report.duplicate_rows:
        found.append(Finding("duplicates", None, INFO, report.duplicate_rows, "duplicate rows remain"))
    holes = {c: n for c, n in report.missing_values.items() if n}
    if holes:
        found.append(Finding("nulls", None, ERROR, sum(holes.values()), f"nulls in {list(holes)}"))
    for c in id_like_columns(df):
        found.append(Finding("id_like", c, INFO, 0, f"{c} looks like an identifier"))
    for c in CATEGORICAL:
        if c in df.columns and isinstance(df.schema[c].dataType, T.StringType) and not is_categorical(df, c):
            found.append(Finding("not_categorical", c, WARNING, 0, f"{c} is plain text"))
    return found


def check_post_ingestion(df: DataFrame, report: QualityReport | None = None) -> ValidationResult:
    """Nulls are errors, plain-text categories warnings, copies and id-like names only noted."""
    return ValidationResult.of(_post_ingestion(df, report or quality_report(df)))


def check_feature_readiness(df: DataFrame) -> ValidationResult:
    """Schema only: expected columns, categorical marks and number types."""
    found = []
    absent = absent_columns(df, [*CATEGORICAL, *NUMERICAL, TARGET])
    if absent:
        found.append(Finding("present", None, ERROR, 0, f"expected columns absent: {absent}"))
    for c in CATEGORICAL:
        if c in df.columns and not is_categorical(df, c):
            found.append(Finding("not_categorical", c, WARNING, 0, f"{c} is not categorical"))
    for c in NUMERICAL:
        if c in df.columns and not is_numeric(df.schema[c].dataType):
            found.append(Finding("not_numeric", c, ERROR, 0, f"{c} is not numeric"))
    return ValidationResult.of(found)


def validate(
    df: DataFrame, strict: bool = True, auto_fix: bool = False
) -> tuple[DataFrame, ValidationResult]:
    """All stages. ``auto_fix`` cleans first when there are copies or nulls; ``strict`` raises."""
    if auto_fix:
        n_nulls = df.agg(total_nulls(df).alias("n")).first()["n"]
        if n_nulls or duplicate_summary(df).first()["n_duplicates"]:
            df = auto_clean(df)
    report = quality_report(df)
    findings = _collect(evaluate(df, [*cleaned_rules(), *business_rules(df)]))
    findings += [Finding("quality", None, WARNING, 0, issue) for issue in report.issues]
    if report.outliers:
        findings.append(Finding("outliers", None, WARNING, sum(report.outliers.values()),
                                f"outliers: {report.outliers}"))
    findings += _post_ingestion(df, report)
    findings += check_feature_readiness(df).findings
    result = ValidationResult.of(findings)
    if strict and not result.is_valid:
        raise ValidationError(f"{len(result.errors)} validation errors", findings)
    return df, result


def validate_cleaned_data(df: DataFrame, strict: bool = True, auto_clean: bool = False) -> DataFrame:
    """The frame after all stages; raises on errors when ``strict``, repairs copies and nulls first on request."""
    return validate(df, strict, auto_clean)[0]


def generate_validation_report(df: DataFrame) -> str:
    """The quality report as text; never raises on findings."""
    return validation_report(df)


def validation_report(df: DataFrame) -> str:
    return quality_report(df).text

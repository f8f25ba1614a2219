"""Raw bookings to the cleaned table, and the cleaned table to the feature table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeworks.fields import FEATURE_TABLE, ID_COLUMN, IMPORTANCE_THRESHOLD, TARGET
from lodgeworks.operators.clean import (
    add_booking_date,
    drop_duplicate_rows,
    drop_id_column,
    fill_nulls,
    set_types,
)
from lodgeworks.operators.features import (
    LabelCodes,
    add_stay_features,
    check_feature_table,
    encode_categories,
    fit_label_codes,
    to_feature_table,
)
from lodgeworks.operators.models import feature_importance, important_features
from lodgeworks.operators.ordering import number_rows
from lodgeworks.operators.rules import ValidationResult, validate
from lodgeworks.session import staged
from lodgeworks.sources.files import read_parquet, write_csv, write_parquet


def clean_bookings(
    raw: DataFrame, *, dedup_ignore: Sequence[str] = (), keep_id: bool = False, stage: bool = True
) -> DataFrame:
    """Date repair, distinct rows, null fill, identifier dropped, types set.

    The distinct rows feed the fill statistics and the result, so they are written once
    (``stage=False`` recomputes them instead).
    """
    distinct = drop_duplicate_rows(add_booking_date(raw), dedup_ignore)
    if stage:
        distinct = staged(distinct, "distinct")
    filled = fill_nulls(distinct)
    return set_types(filled if keep_id else drop_id_column(filled))


def ingest(raw: DataFrame, path: str, keep_id: bool = False) -> None:
    """Write the cleaned table, partitioned by arrival month so that readers can prune.

    ``keep_id`` keeps the identifier as the stable key that feature building needs.
    """
    write_parquet(clean_bookings(raw, keep_id=keep_id), path, partition_by=("arrival_year", "arrival_month"))


def load_cleaned(spark: SparkSession, path: str) -> DataFrame:
    """The cleaned table; partition values come back as 32-bit numbers and are widened again."""
    table = read_parquet(spark, path)
    return table.withColumns({c: F.col(c).cast("long") for c in ("arrival_year", "arrival_month")})


@dataclass
class FeatureOutput:
    features: DataFrame
    importance: DataFrame
    selected: list[str]
    codes: LabelCodes
    validation: ValidationResult


def build_features(
    cleaned: DataFrame, run_ts: str, key: str = ID_COLUMN, threshold: float = IMPORTANCE_THRESHOLD,
    zero_unselected: bool = False, trees: int = 100, depth: int = 12,
) -> FeatureOutput:
    """Validate, derive, encode, rank features and lay out the feature table.

    ``key`` is a stable unique column; the contiguous ``booking_id`` follows its order.
    """
    _, findings = validate(cleaned.drop(key), strict=False)
    derived = add_stay_features(cleaned)
    encoded, codes = encode_categories(derived)
    encoded = fit_label_codes(encoded, [TARGET]).encode(encoded)
    columns = [c for c in encoded.columns if c not in (key, TARGET, "booking_date")]
    # Names compare without case: the number must not meet the identifier it replaces.
    numbered = number_rows(encoded, [key], "_number").drop(key)
    ready = staged(numbered.withColumnRenamed("_number", "booking_id"), "encoded")
    importance = feature_importance(ready, columns, TARGET, trees, depth=depth)
    selected = [r["feature"] for r in important_features(importance, threshold).collect()]
    table = to_feature_table(ready, run_ts, "booking_id", selected, zero_unselected)
    return FeatureOutput(table, importance, selected, codes, findings)


def publish_features(features: DataFrame, directory: str, csv_target: bool = True) -> None:
    """The feature table, its features and its target, each with the key.

    The table is written first and read back for the other two, so it is computed once.
    """
    check_feature_table(features)
    path = f"{directory}/feature_table.parquet"
    write_parquet(features.select(*FEATURE_TABLE), path)
    table = features.sparkSession.read.parquet(path)
    write_parquet(table.drop(TARGET), f"{directory}/features.parquet")
    target = table.select("booking_id", TARGET)
    if csv_target:
        write_csv(target, f"{directory}/target.csv")
    else:
        write_parquet(target, f"{directory}/target.parquet")


def load_training_rows(spark: SparkSession, directory: str) -> DataFrame:
    """Features and target joined on the key; times, dates and a second target are left out."""
    features = spark.read.parquet(f"{directory}/features.parquet").drop(
        "event_timestamp", TARGET, "booking_date"
    )
    target = spark.read.schema(f"booking_id long, {TARGET} long").option("header", True).csv(
        f"{directory}/target.csv"
    )
    return features.join(target, "booking_id")


def cancellation_by_month(cleaned: DataFrame) -> DataFrame:
    """Bookings and cancellation rate per repaired month."""
    return cleaned.groupBy(
        F.year("booking_date").cast("long").alias("year"), F.month("booking_date").cast("long").alias("month")
    ).agg(
        F.count(F.lit(1)).alias("n_bookings"),
        F.round(F.avg((F.col(TARGET) == "Canceled").cast("double")), 6).alias("cancel_rate"),
    )

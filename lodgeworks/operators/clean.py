"""Cleaning: dates, duplicates, nulls, columns and types."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodgeworks.fields import DATE_PARTS, ID_COLUMN
from lodgeworks.functions.columns import (
    CATEGORICAL_META,
    is_numeric,
    long_form,
    missing,
    number_columns,
    present,
    require_columns,
    string_columns,
)
from lodgeworks.functions.dates import repair_date
from lodgeworks.operators.quantiles import exact_quantiles


def add_booking_date(
    df: DataFrame,
    *,
    years: tuple[int, int] | None = (2017, 2019),
    default_year: int = 2018,
    name: str = "booking_date",
) -> DataFrame:
    """Add the repaired booking date; raises when a date part column is absent."""
    require_columns(df, DATE_PARTS)
    return df.withColumn(name, repair_date(*DATE_PARTS, years=years, default_year=default_year))


def date_part_profile(df: DataFrame, *, years: tuple[int, int] = (2018, 2019)) -> DataFrame:
    """One row: absent and out-of-range parts before repair. ``years`` only drives the warning."""
    require_columns(df, DATE_PARTS)
    day, month, year = (F.col(c) for c in DATE_PARTS)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(missing(df, c)).alias(f"{c}_missing") for c in DATE_PARTS],
        F.count_if((day > 31) | (day < 1)).alias("invalid_days"),
        F.count_if((month > 12) | (month < 1)).alias("invalid_months"),
        F.count_if((year < years[0]) | (year > years[1])).alias("invalid_years"),
    )


def date_summary(df: DataFrame, name: str = "booking_date") -> DataFrame:
    """One row: rows, valid and absent dates, first and last date."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(name).alias("valid_dates"),
        F.count_if(F.col(name).isNull()).alias("invalid_dates"),
        F.min(name).alias("first_date"),
        F.max(name).alias("last_date"),
    )


def drop_duplicate_rows(df: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """Keep one of each set of equal rows (nulls equal).

    The copies collapse before the shuffle, so a row that makes up a large part of the table costs
    one row per task. With ``ignore``, rows equal in the other columns are merged and the smallest
    combination of the ignored columns is kept.
    """
    if not ignore:
        return df.dropDuplicates()
    keys = [c for c in df.columns if c not in ignore]
    kept = df.groupBy(*keys).agg(F.min(F.struct(*ignore)).alias("_kept"))
    return kept.select(*[F.col(f"_kept.{c}") if c in ignore else F.col(c) for c in df.columns])


def duplicate_summary(df: DataFrame) -> DataFrame:
    """One row: rows, distinct rows, surplus copies and whether there are any."""
    return (
        df.groupBy(*df.columns)
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
            F.count(F.lit(1)).alias("n_distinct"),
            F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("n_duplicates"),
        )
        .withColumn("has_duplicates", F.col("n_duplicates") > 0)
    )


def null_counts(df: DataFrame) -> DataFrame:
    """``(column, n_null)`` for every column from one aggregate over one scan."""
    row = df.agg(*[F.count_if(missing(df, c)).alias(c) for c in df.columns])
    return row.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("n_null"))
                    for c in df.columns
                ]
            )
        ).alias("_r")
    ).select("_r.column", "_r.n_null")


def drop_incomplete_rows(df: DataFrame) -> DataFrame:
    """Rows without any null or NaN."""
    return df.dropna("any")


def value_modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(name, mode, n)``: the most frequent value per column as text, smallest among ties.

    Counts are combined before the shuffle and keyed by (column, value), so neither a frequent
    value nor a column with very many values gathers in one task.
    """
    counts = (
        long_form(df, columns, "string")
        .groupBy("name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = counts.groupBy("name").agg(F.min(F.struct(-F.col("n"), "value")).alias("_best"))
    return best.select("name", F.col("_best.value").alias("mode"), (-F.col("_best.col1")).alias("n"))


@dataclass(frozen=True)
class FillValues:
    """What :func:`fill_values` measured: rows, nulls per column, replacement per column."""

    n_rows: int
    nulls: dict[str, int]
    values: dict[str, Any] = field(default_factory=dict)

    @property
    def empty_columns(self) -> list[str]:
        return [c for c, n in self.nulls.items() if n == self.n_rows]


def fill_values(df: DataFrame, numeric: str = "mean") -> FillValues:
    """Measure replacements for the columns that have some, but not only, nulls."""
    if numeric not in ("mean", "median"):
        raise ValueError(f"numeric must be 'mean' or 'median', not {numeric!r}")
    kinds = {f.name: f.dataType for f in df.schema}
    numbers = [c for c, t in kinds.items() if is_numeric(t)]
    row = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(missing(df, c)).alias(f"n_{c}") for c in df.columns],
        *[F.avg(present(df, c)).alias(f"m_{c}") for c in numbers],
    ).first()
    n_rows = row["_rows"]
    nulls = {c: row[f"n_{c}"] for c in df.columns}
    partial = [c for c in df.columns if 0 < nulls[c] < n_rows]
    values: dict[str, Any] = {}
    numeric_gaps = [c for c in partial if c in numbers]
    if numeric == "mean":
        values.update({c: row[f"m_{c}"] for c in numeric_gaps})
    elif numeric_gaps:
        medians = exact_quantiles(df, numeric_gaps, [0.5])
        values.update({c: medians[c][0.5] for c in numeric_gaps})
    other_gaps = [c for c in partial if c not in numbers]
    if other_gaps:
        values.update({r["name"]: r["mode"] for r in value_modes(df, other_gaps).collect()})
    return FillValues(n_rows, nulls, values)


def apply_fill(df: DataFrame, fill: FillValues) -> DataFrame:
    """Replace nulls by measured values; a filled number column becomes DOUBLE."""
    replaced = {}
    for name, value in fill.values.items():
        dtype = df.schema[name].dataType
        kind = T.DoubleType() if is_numeric(dtype) else dtype
        replaced[name] = F.coalesce(present(df, name).cast(kind), F.lit(value).cast(kind))
    return df.withColumns(replaced) if replaced else df


def fill_nulls(df: DataFrame, numeric: str = "mean") -> DataFrame:
    """Mean (or median) for numbers, mode for the rest; a column of nulls only is an error."""
    fill = fill_values(df, numeric)
    if fill.empty_columns:
        raise ValueError(f"columns with only null values: {fill.empty_columns}")
    return apply_fill(df, fill)


def auto_clean(df: DataFrame) -> DataFrame:
    """Distinct rows, then median / mode for the nulls that are left."""
    distinct = drop_duplicate_rows(df)
    return apply_fill(distinct, fill_values(distinct, "median"))


def drop_id_column(df: DataFrame, name: str = ID_COLUMN) -> DataFrame:
    """Drop the identifier; an absent identifier is an error."""
    require_columns(df, [name])
    return df.drop(name)


def drop_if_present(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def set_types(df: DataFrame, numbers_as_text: Sequence[str] = ()) -> DataFrame:
    """Mark text as categorical, coerce numbers, read ``booking_date``; refuse other types.

    ``numbers_as_text`` names text columns that hold numbers: what does not parse becomes null.
    """
    text, numbers = string_columns(df), number_columns(df)
    refused = [c for c in df.columns if c not in text + numbers and c != "booking_date"]
    if refused:
        raise ValueError(f"unsupported column types: {refused}")
    typed = df
    for name in text:
        if name in numbers_as_text:
            typed = typed.withColumn(name, F.col(name).try_cast("double"))
        elif name != "booking_date":
            typed = typed.withMetadata(name, CATEGORICAL_META)
    if "booking_date" in df.columns:
        typed = typed.withColumn("booking_date", F.col("booking_date").try_cast("date"))
    return typed


def as_text(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("string") for n in names})


def require_rows(df: DataFrame, what: str = "the frame") -> DataFrame:
    """Raise on a frame without rows or without columns (a one-row job)."""
    if not df.columns or df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df

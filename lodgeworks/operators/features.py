"""Feature engineering: new columns, category codes, the feature table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodgeworks.fields import CATEGORICAL, FEATURE_TABLE, TARGET
from lodgeworks.functions.columns import absent_columns, long_form, missing, require_columns
from lodgeworks.operators.clean import require_rows
from lodgeworks.operators.ordering import running_totals
from lodgeworks.session import staged

LITERAL_LABELS = 64  # a dictionary up to this size becomes part of the expression
DRIVER_LABELS = 10_000  # up to this size it is fetched and broadcast; beyond, it stays a table


def add_stay_features(df: DataFrame, true_values: Sequence[str] = ("Yes",)) -> DataFrame:
    """Total nights, and whether the guest is a repeat guest.

    The flag compares as text: in data where ``repeated_guest`` is 0/1 it is 0 on every row unless
    ``true_values`` says otherwise.
    """
    require_columns(df, ["no_of_weekend_nights", "no_of_week_nights", "repeated_guest"], KeyError)
    return df.withColumns(
        {
            "total_nights_stayed": F.col("no_of_weekend_nights") + F.col("no_of_week_nights"),
            "is_repeat_guest": F.when(
                F.col("repeated_guest").cast("string").isin(*true_values), 1
            ).otherwise(0).cast("long"),
        }
    )


@dataclass
class LabelCodes:
    """Codes 0..k-1 per column in label order. ``small`` holds every column that fits the driver."""

    small: dict[str, list[str] | None]
    labels: DataFrame  # distinct (name, value), all columns

    def encode(self, df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
        for name in columns or self.columns:
            df = self._encode_one(df, name)
        return df

    @property
    def columns(self) -> list[str]:
        return list(self.small)

    def table(self) -> DataFrame:
        """``(name, value, code)`` of every column, numbered without fetching a label."""
        return label_table(self.labels)

    def known(self) -> dict[str, list[str]]:
        """The labels of every column, which must all fit the driver."""
        if large := [c for c, labels in self.small.items() if labels is None]:
            raise ValueError(f"too many labels in {large}")
        return dict(self.small)

    def _encode_one(self, df: DataFrame, name: str) -> DataFrame:
        labels = self.small[name]
        if labels is not None and len(labels) <= LITERAL_LABELS:
            return df.withColumn(name, lookup(name, {v: i for i, v in enumerate(labels)}))
        if labels is not None:
            book = df.sparkSession.createDataFrame(
                [(v, i) for i, v in enumerate(labels)], "_label string, _code long"
            )
            book = F.broadcast(book)  # at most DRIVER_LABELS rows
        else:
            book = self.table().filter(F.col("name") == name).select(
                F.col("value").alias("_label"), F.col("code").alias("_code")
            )
        order = df.columns
        joined = df.join(book, F.col(name).cast("string") == F.col("_label"), "left")
        return joined.withColumn(name, F.col("_code")).select(*order)

    def decode(self, df: DataFrame, name: str) -> DataFrame:
        """Back from codes to labels; a dictionary that is not held on the driver is joined on the code."""
        labels = self.small[name]
        if labels is None:
            book = self.table().filter(F.col("name") == name).select(
                F.col("value").alias("_label"), F.col("code").alias("_code")
            )
            joined = df.join(book, F.col(name) == F.col("_code"), "left")
            return joined.withColumn(name, F.col("_label")).select(*df.columns)
        pairs = {i: v for i, v in enumerate(labels)}
        return df.withColumn(name, lookup(name, pairs))


def fit_label_codes(
    df: DataFrame, columns: Sequence[str], driver_labels: int = DRIVER_LABELS
) -> LabelCodes:
    """Number the distinct labels of each column in sorted order.

    All columns share one distinct. A dictionary larger than ``driver_labels`` is never fetched: it
    is numbered by bucketed running totals and joined as a table.
    """
    labels = long_form(df, columns, "string").distinct()
    first = labels.limit(driver_labels + 1).collect()
    if len(first) <= driver_labels:  # the usual case: everything there is
        small: dict[str, list[str] | None] = {c: [] for c in columns}
    else:
        labels = staged(labels, "labels")  # counted, numbered and joined from several reads
        sizes = {r["name"]: r["count"] for r in labels.groupBy("name").count().collect()}
        fits = [c for c in columns if sizes.get(c, 0) <= driver_labels]
        small = {c: [] if c in fits else None for c in columns}
        first = labels.filter(F.col("name").isin(*fits)).collect() if fits else []
    for r in first:
        small[r["name"]].append(r["value"])
    for known in small.values():
        if known is not None:
            known.sort(key=str.encode)
    return LabelCodes(small, labels)


def label_table(labels: DataFrame, buckets: int | None = None) -> DataFrame:
    """``(name, value, code)`` from distinct ``(name, value)`` rows; works for any size."""
    ones = labels.withColumn("_one", F.lit(1).cast("long"))
    return running_totals(ones, ["value"], ["_one"], ["name"], buckets).select(
        "name", "value", (F.col("_one_upto") - 1).alias("code")
    )


def encode_categories(
    df: DataFrame, columns: Sequence[str] = CATEGORICAL
) -> tuple[DataFrame, LabelCodes]:
    """Replace category columns by their codes; returns every fitted dictionary."""
    if not columns:
        raise ValueError("no category columns were given")
    require_columns(df, columns)
    require_rows(df)
    codes = fit_label_codes(df, columns)
    return codes.encode(df), codes


def lookup(name: str, pairs: Mapping, default=None) -> Column:
    """Value for each key of a small dictionary, ``default`` for the rest."""
    chain = None
    for key, value in pairs.items():
        hit = F.col(name) == F.lit(key)
        chain = F.when(hit, F.lit(value)) if chain is None else chain.when(hit, F.lit(value))
    if chain is None:
        return F.lit(default)
    kinds = {type(v) for v in pairs.values()}
    out = chain.otherwise(F.lit(default))
    return out.cast("long") if kinds == {int} else out


def one_hot(df: DataFrame, labels: Mapping[str, Sequence[str]]) -> DataFrame:
    """One 0/1 column ``{column}={label}`` per given label; a null or another label is 0 in all of them."""
    hits = {f"{c}={v}": F.coalesce((F.col(c) == v).cast("int"), F.lit(0)) for c, known in labels.items() for v in known}
    return df.withColumns(hits)


def chi_square(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """``(column, statistic, degrees)``: Pearson's test of each category column against ``label``.

    Counts of (column, value, label) are combined before the shuffle; all else reads those counts.
    Rows without a value or without a label are left out.
    """
    cells = staged(
        long_form(df.filter(F.col(label).isNotNull()), columns, "string", [label])
        .groupBy("name", "value", F.col(label).cast("string").alias("label")).agg(F.count(F.lit(1)).alias("n")),
        "cells",
    )
    by_value = cells.groupBy("name", "value").agg(F.sum("n").alias("of_value"))
    by_label = cells.groupBy("name", "label").agg(F.sum("n").alias("of_label"))
    totals = by_label.groupBy("name").agg(F.sum("of_label").alias("total"), F.count(F.lit(1)).alias("n_labels"))
    # Sum of (n - e)^2 / e over all cells is the sum of n^2 / e over those with rows, minus the total.
    joined = cells.join(by_value, ["name", "value"]).join(by_label, ["name", "label"])
    parts = joined.groupBy("name").agg(F.sum(F.col("n") * F.col("n") / (F.col("of_value") * F.col("of_label"))).alias("s"))
    sizes = by_value.groupBy("name").agg(F.count(F.lit(1)).alias("n_values"))
    return parts.join(totals, "name").join(sizes, "name").select(
        F.col("name").alias("column"), (F.col("total") * (F.col("s") - 1)).alias("statistic"),
        ((F.col("n_values") - 1) * (F.col("n_labels") - 1)).alias("degrees"))


def chi2_scores(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """``(feature, statistic)``: for columns of counts or 0/1, how far their sums per class are from the class shares.

    One aggregate by class; a class is a row of sums. A column whose sum is 0 scores null; rows without a
    label are left out, a null counts as 0.
    """
    sums = df.filter(F.col(label).isNotNull()).groupBy(F.col(label).alias("_label")).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.coalesce(F.sum(F.col(f"`{c}`").cast("double")), F.lit(0.0)).alias(f"_s{i}") for i, c in enumerate(columns)])
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"_s{i}").alias("n")) for i, c in enumerate(columns)])
    per_class = sums.select("_label", "_rows", F.explode(cells).alias("c")).select("_label", "_rows", "c.feature", "c.n")
    whole = Window.partitionBy("feature")
    expected = F.sum("n").over(whole) * F.col("_rows") / F.sum("_rows").over(whole)
    parts = per_class.select("feature", "n", expected.alias("e"))
    return parts.groupBy("feature").agg(F.sum(F.try_divide((F.col("n") - F.col("e")) ** 2, F.col("e"))).alias("statistic"))


def k_best(scores: DataFrame, k: int) -> DataFrame:
    """The ``k`` features of the largest ``statistic``, ties by name; null scores come last."""
    return scores.orderBy(F.col("statistic").desc_nulls_last(), "feature").limit(k)


# Codes of the target when it reaches the feature table still as text.
TARGET_CODES = {"Not_Canceled": 0, "Canceled": 1}


def target_from_text(name: str = TARGET) -> Column:
    """The fallback coding of the target; unknown text is 0."""
    return lookup(name, TARGET_CODES, 0)


def split_target(df: DataFrame, target: str = TARGET, encode: bool = False) -> tuple[DataFrame, list[str]]:
    """The frame (target encoded on request) and the names of its feature columns.

    Features and target stay in one frame: two frames could only be lined up again by a join.
    """
    require_columns(df, [target])
    features = [c for c in df.columns if c != target]
    if encode:
        df = fit_label_codes(df, [target]).encode(df)
    return df, features


def add_defaults(df: DataFrame, names: Sequence[str], default: float = 0) -> DataFrame:
    """Add the named columns that are absent, filled with ``default``."""
    absent = absent_columns(df, names)
    return df.withColumns({c: F.lit(default) for c in absent}) if absent else df


def to_feature_table(
    df: DataFrame,
    run_ts: str,
    key: str = "booking_id",
    selected: Sequence[str] | None = None,
    zero_unselected: bool = False,
) -> DataFrame:
    """The feature table: fixed columns in fixed order with fixed types.

    ``df`` carries its key. Absent number columns become 0; with ``zero_unselected`` so does a
    column that importance selection left out (``selected`` names the survivors).
    """
    require_columns(df, [key, "booking_date"])
    df = add_defaults(df, [c for c in FEATURE_TABLE if c not in ("booking_id", "event_timestamp")])
    if zero_unselected and selected is not None:
        keep = {*selected, "booking_id", "event_timestamp", "booking_date", TARGET}
        df = df.withColumns({c: F.lit(0) for c in FEATURE_TABLE if c not in keep})
    target = (
        target_from_text()
        if isinstance(df.schema[TARGET].dataType, T.StringType)
        else F.col(TARGET).cast("long")
    )
    return df.select(
        F.col(key).cast("long").alias("booking_id"),
        F.lit(run_ts).cast("timestamp_ntz").alias("event_timestamp"),
        F.col("booking_date").cast("date").alias("booking_date"),
        F.col("lead_time").cast("long").alias("lead_time"),
        F.col("avg_price_per_room").cast("float").alias("avg_price_per_room"),
        F.col("no_of_special_requests").cast("long").alias("no_of_special_requests"),
        F.col("arrival_date").cast("long").alias("arrival_date"),
        F.col("arrival_month").cast("long").alias("arrival_month"),
        target.alias("booking_status"),
    )


FEATURE_TYPES = {
    "booking_id": ("bigint",),
    "event_timestamp": ("timestamp_ntz", "timestamp"),
    "booking_date": ("date", "timestamp_ntz", "timestamp"),
    "lead_time": ("bigint",),
    "avg_price_per_room": ("float", "double"),
    "no_of_special_requests": ("bigint",),
    "arrival_date": ("bigint",),
    "arrival_month": ("bigint",),
    "booking_status": ("bigint",),
}


def check_feature_table(df: DataFrame) -> list[str]:
    """Raise on absent columns or null keys; return the columns whose type is unexpected."""
    require_columns(df, FEATURE_TABLE)
    keys = ["booking_id", "event_timestamp", "booking_date"]
    nulls = df.agg(*[F.count_if(missing(df, c)).alias(c) for c in keys]).first()
    broken = [c for c in keys if nulls[c]]
    if broken:
        raise ValueError(f"null values in key columns: {broken}")
    return [c for c, kinds in FEATURE_TYPES.items() if df.schema[c].dataType.simpleString() not in kinds]

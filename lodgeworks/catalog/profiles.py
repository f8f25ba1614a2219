"""Profile queries: the numbers behind the distribution plots."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodgeworks.catalog.cleaning import cleaned
from lodgeworks.catalog.registry import NUMBERS, over_bookings, query
from lodgeworks.fields import CATEGORICAL, PCA_COLUMNS
from lodgeworks.operators import features, profile
from lodgeworks.session import staged
from lodgeworks.sources.bookings import bookings


def _count_sql(*columns: str) -> str:
    names = ", ".join(columns)
    known = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    return over_bookings(f"SELECT {names}, COUNT(*) AS n FROM bookings WHERE {known} GROUP BY {names}")


def _count_query(name: str, *columns: str) -> None:
    @query(name, _count_sql(*columns))
    def counts(spark, sf):
        return profile.count_by(bookings(spark, sf, columns), *columns)


_count_query("a15_count_by_arrival_date", "arrival_date")
_count_query("a15_count_by_arrival_month", "arrival_month")
_count_query("a15_count_by_arrival_year", "arrival_year")
_count_query("a15_count_by_meal_plan", "type_of_meal_plan")
_count_query("a15_count_by_previous_cancellations", "no_of_previous_cancellations")
_count_query("a16_count_by_date_and_weekend_nights", "arrival_date", "no_of_weekend_nights")
_count_query("a16_count_by_month_and_cancellations", "arrival_month", "no_of_previous_cancellations")
_count_query("a16_count_by_year_and_cancellations", "arrival_year", "no_of_previous_cancellations")


@query(
    "a17_histogram",
    over_bookings(
        """SELECT LEAST(FLOOR((lead_time - lo) / w), 19)::INT AS bin, COUNT(*) AS n
        FROM bookings, (SELECT MIN(lead_time) AS lo, (MAX(lead_time) - MIN(lead_time)) / 20 AS w FROM bookings)
        WHERE lead_time IS NOT NULL GROUP BY 1"""
    ),
)
def histogram(spark, sf):
    return profile.histogram(bookings(spark, sf, ["lead_time"]), "lead_time", 20).select("bin", "n")


@query("a17_density_curve")
def density(spark, sf):
    return profile.density_curve(bookings(spark, sf, ["lead_time"]), "lead_time")


_BOX = NUMBERS


@query(
    "a18_box_stats",
    over_bookings(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", ROUND(q1, 8)::DOUBLE AS q1, ROUND(m, 8)::DOUBLE AS median,
            ROUND(q3, 8)::DOUBLE AS q3,
            MIN({c}) FILTER (WHERE {c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))::DOUBLE AS whisker_low,
            MAX({c}) FILTER (WHERE {c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))::DOUBLE AS whisker_high,
            COUNT(*) FILTER (WHERE {c} NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS n_fliers
            FROM bookings, (SELECT QUANTILE_CONT({c}, 0.25) AS q1, QUANTILE_CONT({c}, 0.5) AS m,
              QUANTILE_CONT({c}, 0.75) AS q3 FROM bookings) GROUP BY q1, m, q3"""
            for c in _BOX
        )
    ),
)
def box_stats(spark, sf):
    df = profile.box_stats(staged(bookings(spark, sf, _BOX)), _BOX)
    return df.withColumns({c: F.round(c, 8) for c in ("q1", "median", "q3")})


def _box_by_sql(group: str) -> str:
    inside = "lead_time BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)"
    return over_bookings(
        f"""SELECT b.{group}, n, ROUND(q1, 8)::DOUBLE AS q1, ROUND(median, 8)::DOUBLE AS median,
        ROUND(q3, 8)::DOUBLE AS q3, MIN(lead_time) FILTER (WHERE {inside})::DOUBLE AS whisker_low,
        MAX(lead_time) FILTER (WHERE {inside})::DOUBLE AS whisker_high,
        COUNT(lead_time) FILTER (WHERE NOT ({inside})) AS n_fliers
        FROM bookings b JOIN (SELECT {group} AS g, COUNT(lead_time) AS n, QUANTILE_CONT(lead_time, 0.25) AS q1,
          QUANTILE_CONT(lead_time, 0.5) AS median, QUANTILE_CONT(lead_time, 0.75) AS q3 FROM bookings GROUP BY 1) s
        ON b.{group} IS NOT DISTINCT FROM s.g GROUP BY b.{group}, n, q1, median, q3"""
    )


def _box_by(name: str, group: str) -> None:
    @query(name, _box_by_sql(group))
    def stats(spark, sf):
        df = profile.box_stats_by(bookings(spark, sf, [group, "lead_time"]), group)
        return df.withColumns({c: F.round(c, 8) for c in ("q1", "median", "q3")})


_box_by("a19_box_stats_by_segment", "market_segment_type")
_box_by("a19_box_stats_by_meal_plan", "type_of_meal_plan")
_box_by("a19_box_stats_by_room_type", "room_type_reserved")


def _pca(spark, sf):
    df = features.add_stay_features(cleaned(spark, sf))
    coded, _ = features.encode_categories(df, CATEGORICAL)
    return profile.fit_pca(coded, PCA_COLUMNS, 6), coded


@query("m3_pca_projection")
def pca_projection(spark, sf):
    from pyspark.ml.functions import vector_to_array

    model, df = _pca(spark, sf)
    values = vector_to_array("pca")
    return model.transform(df).select(
        "Booking_ID", *[F.round(values[i], 4).alias(f"pc{i + 1}") for i in range(6)]
    )


@query("t5_leading_features")
def leading_features(spark, sf):
    model, _ = _pca(spark, sf)
    return profile.leading_features(profile.pca_loadings(spark, model, PCA_COLUMNS))

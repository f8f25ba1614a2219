"""The rules as SQL functions, called from plain SQL over a view of the bookings."""

from __future__ import annotations

from lodgeworks.catalog.cleaning import RAW
from lodgeworks.catalog.registry import long_sql, over_bookings, query, repaired
from lodgeworks.fields import ID_NAME_PATTERNS
from lodgeworks.functions.sql import register_functions, register_table_checks
from lodgeworks.sources.bookings import bookings

_VIEW = "bookings_as_sql"


def _registered(spark, sf, key: bool = False):
    bookings(spark, sf, key=key).createOrReplaceTempView(_VIEW)
    register_functions(spark)
    return spark


_VALID = """COALESCE(arrival_year BETWEEN 1 AND 9999 AND arrival_month BETWEEN 1 AND 12 AND arrival_date >= 1 AND arrival_date <= DAY(LAST_DAY(
  MAKE_DATE(arrival_year, LEAST(GREATEST(arrival_month, 1), 12), 1))), false)"""


@query("x1_sql_date_repair", over_bookings(f"SELECT k, {repaired()} AS booking_date, {_VALID} AS valid FROM bookings"))
def sql_date_repair(spark, sf):
    parts = ", ".join(f"CAST({c} AS INT)" for c in ("arrival_date", "arrival_month", "arrival_year"))
    return _registered(spark, sf, key=True).sql(f"SELECT k, repaired_date({parts}) AS booking_date, is_calendar_day({parts}) AS valid FROM {_VIEW}")


@query(
    "x4_sql_prices",
    over_bookings("""SELECT k, ROUND(avg_price_per_room::DOUBLE / (no_of_special_requests + 0.001::DOUBLE), 6) AS per_request,
      ROUND(avg_price_per_room::DOUBLE * (1 - 0.25::DOUBLE), 8) AS discounted FROM bookings"""),
)
def sql_prices(spark, sf):
    return _registered(spark, sf, key=True).sql(
        f"""SELECT k, round(price_per_request(avg_price_per_room, no_of_special_requests), 6) AS per_request,
        round(discounted_price(avg_price_per_room, 0.25D), 8) AS discounted FROM {_VIEW}""")


@query(
    "x5_sql_findings",
    over_bookings(
        'SELECT \'nulls\' AS "check", "column", n::BIGINT AS n_rows FROM (' + long_sql("bookings", [(c, f"COUNT(*) - COUNT({c})") for c in RAW])
        + ") WHERE n >= 1 UNION ALL SELECT 'duplicates', NULL, n::BIGINT FROM (SELECT (SELECT COUNT(*) FROM bookings) - COUNT(*) AS n"
        " FROM (SELECT DISTINCT " + ", ".join(RAW) + " FROM bookings)) WHERE n >= 1"
        " UNION ALL SELECT 'id_like', c, 0 FROM (SELECT UNNEST([" + ", ".join(f"'{c}'" for c in RAW) + "]) AS c) WHERE "
        + " OR ".join(f"CONTAINS(c, '{p}')" for p in ID_NAME_PATTERNS)),
)
def sql_findings(spark, sf):
    _registered(spark, sf)
    register_table_checks(spark, _VIEW)
    return spark.sql(f"SELECT * FROM {_VIEW}_findings()")

"""Registration of queries and shared SQL fragments."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lodgeworks.fields import RAW_SCHEMA
from lodgeworks.sources.bookings import BOOKINGS_SQL

Query = Callable[[SparkSession, str], DataFrame]
#: All number and all text columns of the bookings, without the identifier.
NUMBERS = tuple(f.name for f in RAW_SCHEMA if f.dataType.typeName() != "string")
TEXTS = tuple(f.name for f in RAW_SCHEMA if f.dataType.typeName() == "string" and f.name != "Booking_ID")
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def repaired(low: int = 2017, high: int = 2019, default: int = 2018) -> str:
    """SQL of the date repair; the year is kept as it is when ``low`` is None."""
    year = f"CASE WHEN arrival_year BETWEEN {low} AND {high} THEN arrival_year ELSE {default} END"
    return _date(year)


def _date(year: str) -> str:
    month = "GREATEST(LEAST(arrival_month, 12), 1)"
    first = f"MAKE_DATE({year}, {month}, 1)"
    day = f"LEAST(GREATEST(arrival_date, 1), DAY(LAST_DAY({first})))"
    return (
        "CASE WHEN arrival_date IS NULL OR arrival_month IS NULL OR arrival_year IS NULL THEN NULL "
        f"ELSE MAKE_DATE({year}, {month}, {day}) END"
    )


REPAIRED_SAME_YEAR = _date("arrival_year")


def mode_of(column: str, table: str) -> str:
    return (
        f"(SELECT v FROM (SELECT {column} AS v, COUNT(*) AS c FROM {table} WHERE {column} IS NOT NULL"
        " GROUP BY 1) ORDER BY c DESC, v LIMIT 1)"
    )


def filled(source: str, numeric: str = "AVG") -> str:
    """SELECT list that fills the four columns with gaps."""
    gap = lambda c: f"COALESCE({c}, (SELECT {numeric}({c}) FROM {source}))::DOUBLE AS {c}"
    mode = lambda c: f"COALESCE({c}, {mode_of(c, source)}) AS {c}"
    parts = [gap(c) for c in ("lead_time", "arrival_date", "avg_price_per_room")]
    parts += [mode(c) for c in ("type_of_meal_plan", "booking_date")]
    return f"SELECT * REPLACE ({', '.join(parts)}) FROM {source}"


CLEANED_SQL = f"""{BOOKINGS_SQL},
dated AS (SELECT * EXCLUDE (k), {repaired()} AS booking_date FROM bookings),
uniq AS (SELECT DISTINCT * FROM dated),
cleaned AS ({filled("uniq")})
"""


def over_bookings(body: str, *ctes: str) -> str:
    """A query over ``bookings`` (the raw view, with its key ``k``)."""
    return f"WITH RECURSIVE {BOOKINGS_SQL} {''.join(', ' + c for c in ctes)} {body}"


def over_cleaned(body: str, *ctes: str) -> str:
    """A query over ``uniq`` (repaired, distinct) and ``cleaned`` (also filled)."""
    return f"WITH {CLEANED_SQL} {''.join(', ' + c for c in ctes)} {body}"


def long_sql(source: str, pairs: list[tuple[str, str]], name: str = "column", value: str = "n") -> str:
    """UNION ALL of one scalar per name."""
    return " UNION ALL ".join(
        f"SELECT '{n}' AS \"{name}\", {expr} AS {value} FROM {source}" for n, expr in pairs
    )

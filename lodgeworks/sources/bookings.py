"""The raw bookings table, derived from the orders / lineitem / customer tables.

Nulls, impossible dates and exact duplicates are put in by key arithmetic, so any SQL engine
derives the same rows (:data:`BOOKINGS_SQL`).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeworks.fields import RAW_SCHEMA

_FROM_LINES = {
    "no_of_week_nights",
    "required_car_parking_space",
    "lead_time",
    "no_of_special_requests",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bookings(
    spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None, key: bool = False
) -> DataFrame:
    """Raw bookings; ``columns`` narrows the output, ``key`` keeps the stable key ``k``.

    The line items are aggregated before they meet the orders, so that the join is one row per
    order on each side, and the join is left out when no requested column needs it. The duplicated
    rows come from ``explode`` over one scan instead of a union of two.
    """
    wanted = list(columns) if columns is not None else RAW_SCHEMA.fieldNames()
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    base = orders.join(customer, orders.o_custkey == customer.c_custkey)
    if _FROM_LINES & set(wanted):
        lines = (
            table(spark, sf_dir, "lineitem")
            .groupBy("l_orderkey")
            .agg(
                F.count(F.lit(1)).alias("n_lines"),
                F.sum(F.col("l_quantity").cast("long")).alias("qty"),
                F.count_if(F.col("l_returnflag") == "R").alias("n_returned"),
            )
        )
        base = base.join(lines, base.o_orderkey == lines.l_orderkey, "left")
    else:
        base = base.withColumns(
            {c: F.lit(0).cast("long") for c in ("n_lines", "qty", "n_returned")}
        )

    k, cust = F.col("o_orderkey"), F.col("o_custkey")
    null = F.lit(None)
    lines_mod = (F.coalesce("n_lines", F.lit(0)) % 6).cast("long")
    derived = {
        "k": k,
        "Booking_ID": F.concat(F.lit("INN"), k.cast("string")),
        "no_of_weekend_nights": (k % 3).cast("long"),
        "no_of_week_nights": lines_mod,
        "type_of_meal_plan": F.when(k % 17 == 0, null).otherwise(F.col("o_orderpriority")),
        "required_car_parking_space": F.when(F.coalesce("n_returned", F.lit(0)) > 2, 1)
        .otherwise(0)
        .cast("long"),
        "room_type_reserved": F.concat(F.lit("Room_Type "), (1 + cust % 7).cast("string")),
        "lead_time": F.when(k % 13 == 0, null)
        .otherwise(F.coalesce("qty", F.lit(0)) + cust % 200)
        .cast("long"),
        "arrival_year": (F.year("o_orderdate") + 20).cast("long"),
        "arrival_month": F.when(k % 29 == 0, 13)
        .when(k % 31 == 0, 0)
        .otherwise(F.month("o_orderdate"))
        .cast("long"),
        "arrival_date": F.when(k % 7 == 0, 31)
        .when(k % 19 == 0, 0)
        .when(k % 23 == 0, null)
        .otherwise(F.day("o_orderdate"))
        .cast("long"),
        "market_segment_type": F.col("c_mktsegment"),
        "repeated_guest": (cust % 2).cast("long"),
        "no_of_previous_cancellations": (cust % 4).cast("long"),
        "no_of_previous_bookings_not_canceled": (cust % 9).cast("long"),
        "avg_price_per_room": F.when(k % 11 == 0, null).otherwise(F.col("o_totalprice") / 1000.0),
        "no_of_special_requests": lines_mod,
        "booking_status": F.when(F.col("o_orderstatus") == "F", "Canceled").otherwise(
            "Not_Canceled"
        ),
    }
    names = (["k"] if key else []) + [c for c in wanted if c != "k"]
    copies = F.when(k % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return base.select(*[derived[c].alias(c) for c in names], F.explode(copies).alias("_copy")).drop(
        "_copy"
    )


BOOKINGS_SQL = """
li AS (
  SELECT l_orderkey,
         CAST(COUNT(*) AS BIGINT) AS n_lines,
         CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty,
         CAST(SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS n_returned
  FROM lineitem GROUP BY l_orderkey),
b0 AS (
  SELECT o.o_orderkey AS k,
    CONCAT('INN', CAST(o.o_orderkey AS STRING)) AS Booking_ID,
    CAST(o.o_orderkey % 3 AS BIGINT) AS no_of_weekend_nights,
    CAST(COALESCE(li.n_lines, 0) % 6 AS BIGINT) AS no_of_week_nights,
    CASE WHEN o.o_orderkey % 17 = 0 THEN NULL ELSE o.o_orderpriority END AS type_of_meal_plan,
    CAST(CASE WHEN COALESCE(li.n_returned, 0) > 2 THEN 1 ELSE 0 END AS BIGINT)
      AS required_car_parking_space,
    CONCAT('Room_Type ', CAST(1 + o.o_custkey % 7 AS STRING)) AS room_type_reserved,
    CAST(CASE WHEN o.o_orderkey % 13 = 0 THEN NULL
              ELSE COALESCE(li.qty, 0) + o.o_custkey % 200 END AS BIGINT) AS lead_time,
    CAST(YEAR(o.o_orderdate) + 20 AS BIGINT) AS arrival_year,
    CAST(CASE WHEN o.o_orderkey % 29 = 0 THEN 13 WHEN o.o_orderkey % 31 = 0 THEN 0
              ELSE MONTH(o.o_orderdate) END AS BIGINT) AS arrival_month,
    CAST(CASE WHEN o.o_orderkey % 7 = 0 THEN 31 WHEN o.o_orderkey % 19 = 0 THEN 0
              WHEN o.o_orderkey % 23 = 0 THEN NULL ELSE DAY(o.o_orderdate) END AS BIGINT)
      AS arrival_date,
    c.c_mktsegment AS market_segment_type,
    CAST(o.o_custkey % 2 AS BIGINT) AS repeated_guest,
    CAST(o.o_custkey % 4 AS BIGINT) AS no_of_previous_cancellations,
    CAST(o.o_custkey % 9 AS BIGINT) AS no_of_previous_bookings_not_canceled,
    CASE WHEN o.o_orderkey % 11 = 0 THEN NULL ELSE o.o_totalprice / 1000.0 END
      AS avg_price_per_room,
    CAST(COALESCE(li.n_lines, 0) % 6 AS BIGINT) AS no_of_special_requests,
    CASE WHEN o.o_orderstatus = 'F' THEN 'Canceled' ELSE 'Not_Canceled' END AS booking_status
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN li ON o.o_orderkey = li.l_orderkey),
bookings AS (SELECT * FROM b0 UNION ALL SELECT * FROM b0 WHERE k % 50 = 0)
"""

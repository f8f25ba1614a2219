"""SQL functions against the column expressions of the library."""

from pyspark.sql import functions as F

from lodgeworks.functions import dates
from lodgeworks.functions.sql import register_functions, register_table_checks


def test_dates_equal_the_operator(spark):
    parts = [None, -3, 0, 1, 15, 28, 29, 30, 31, 40]
    days = spark.createDataFrame([(d,) for d in parts], "d int")
    months = spark.createDataFrame([(m,) for m in (None, 0, 1, 2, 6, 12, 13)], "m int")
    years = spark.createDataFrame([(y,) for y in (None, 0, 1999, 2016, 2017, 2018, 2019, 2020)], "y int")
    df = days.crossJoin(months).crossJoin(years)
    df.createOrReplaceTempView("all_parts")
    names = register_functions(spark)
    assert "repaired_date" in names
    got = spark.sql("SELECT d, m, y, repaired_date(d, m, y) AS a, repaired_date(d, m, y, 2000, 2020, 2001) AS b, is_calendar_day(d, m, y) AS c FROM all_parts")
    want = df.select("d", "m", "y", dates.repair_date("d", "m", "y").alias("a"),
                     dates.repair_date("d", "m", "y", years=(2000, 2020), default_year=2001).alias("b"), dates.is_valid_date("d", "m", "y").alias("c"))
    assert got.exceptAll(want).isEmpty() and got.count() == 560
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()


def test_table_functions(spark):
    df = spark.createDataFrame([(1, float("nan"), "a"), (1, float("nan"), "a"), (2, None, None), (3, 1.5, "o'b")], "hotel_id int, x double, `it's` string")
    df.createOrReplaceTempView("odd_rows")
    counts, findings = register_table_checks(spark, "odd_rows")
    assert {r["column"]: r.n for r in spark.sql(f"SELECT * FROM {counts}()").collect()} == {"hotel_id": 0, "x": 3, "it's": 1}
    rows = {(r["check"], r["column"]): r.n_rows for r in spark.sql(f"SELECT * FROM {findings}()").collect()}
    assert rows == {("nulls", "x"): 3, ("nulls", "it's"): 1, ("duplicates", None): 1, ("id_like", "hotel_id"): 0}
    assert {r["column"] for r in spark.sql(f"SELECT * FROM {findings}(2) WHERE check = 'nulls'").collect()} == {"x"}
    assert spark.sql("SELECT round(price_per_request(10.0D, 0.0D)) AS p, discounted_price(80.0D, 0.25D) AS q").first() == (10_000.0, 60.0)
    assert df.select(F.count(F.lit(1))).first()[0] == 4

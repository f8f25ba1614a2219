import pytest
from pyspark.sql import functions as F

from lodgeworks.fields import RAW_SCHEMA
from lodgeworks.session import checkpointed, is_local, shared_dir, staged
from lodgeworks.sources import files
from lodgeworks.sources.bookings import bookings


def test_csv_round_trip(spark, small, tmp_path):
    df = bookings(spark, small)
    files.write_csv(df, str(tmp_path / "raw"))
    back = files.read_csv(spark, str(tmp_path / "raw"), RAW_SCHEMA)
    assert back.count() == 1_530
    assert back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()


def test_csv_without_path(spark):
    with pytest.raises(ValueError):
        files.read_csv(spark, None)


def test_missing_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.read_csv(spark, str(tmp_path / "absent.csv"))
    with pytest.raises(FileNotFoundError):
        files.read_parquet(spark, str(tmp_path / "absent"))


def test_malformed_csv_fails(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("a,b\n1,2\nx,y,z\n")
    with pytest.raises(Exception, match="MALFORMED"):
        files.read_csv(spark, str(path), "a int, b int").collect()


def test_csv_header_only(spark, tmp_path):
    path = tmp_path / "empty.csv"
    path.write_text("a,b\n")
    df = files.read_csv(spark, str(path), "a int, b int")
    assert df.isEmpty() and df.columns == ["a", "b"]


def test_csv_tables(spark, tmp_path):
    for name in ("x", "y"):
        (tmp_path / f"{name}.csv").write_text("a\n1\n2\n")
    tables = files.read_csv_tables(spark, {n: str(tmp_path / f"{n}.csv") for n in ("x", "y")})
    assert {n: t.count() for n, t in tables.items()} == {"x": 2, "y": 2}


def test_bookings_columns_do_not_change_rows(spark, small):
    whole = bookings(spark, small)
    assert whole.columns == RAW_SCHEMA.fieldNames()
    narrow = bookings(spark, small, ["arrival_year", "booking_status"])
    assert narrow.exceptAll(whole.select(*narrow.columns)).isEmpty()
    assert narrow.count() == whole.count()


def test_narrow_bookings_leave_the_line_items_out(spark, small):
    plan = bookings(spark, small, ["arrival_year"])._jdf.queryExecution().toString()
    assert "lineitem" not in plan


def test_append_log(spark, tmp_path):
    df = spark.range(3)
    files.append_log(df, str(tmp_path / "log"))
    files.append_log(df, str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).count() == 6


def test_shared_folder_and_staging(spark):
    assert is_local(spark) and shared_dir(spark)
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    assert staged(df).exceptAll(df).isEmpty()
    assert checkpointed(df).count() == 10

"""CSV and parquet scans and sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def _require_path(path: str | None) -> str:
    if not path:
        raise ValueError("no path was given for the scan")
    return path


def _scan(load, path: str) -> DataFrame:
    try:
        return load(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(path) from error
        raise


def read_csv(spark: SparkSession, path: str | None, schema: StructType | None = None) -> DataFrame:
    """Header CSV scan. A malformed row fails the job; without a schema the types are inferred."""
    reader = spark.read.option("header", True).option("mode", "FAILFAST")
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True)
    return _scan(reader.csv, _require_path(path))


def read_csv_tables(
    spark: SparkSession, paths: Mapping[str, str], schemas: Mapping[str, StructType] | None = None
) -> dict[str, DataFrame]:
    """One lazy CSV scan per named table."""
    schemas = schemas or {}
    return {name: read_csv(spark, path, schemas.get(name)) for name, path in paths.items()}


def read_parquet(spark: SparkSession, path: str | None) -> DataFrame:
    return _scan(spark.read.parquet, _require_path(path))


def write_parquet(
    df: DataFrame, path: str | None, partition_by: Sequence[str] = (), mode: str = "overwrite"
) -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(_require_path(path))


def write_csv(df: DataFrame, path: str | None, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(_require_path(path))


def append_log(df: DataFrame, path: str | None) -> None:
    """Append rows to a log table; the first append creates it."""
    df.write.mode("append").parquet(_require_path(path))

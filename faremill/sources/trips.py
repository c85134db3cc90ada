"""Typed readers and writers for trip months, dimensions and reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

CALENDAR_SCHEMA = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("name", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("major", T.BooleanType()),
        T.StructField("day_of_week", T.StringType()),
    ]
)

ZONE_SCHEMA = T.StructType(
    [
        T.StructField("LocationID", T.IntegerType()),
        T.StructField("Borough", T.StringType()),
        T.StructField("Zone", T.StringType()),
        T.StructField("service_zone", T.StringType()),
    ]
)


def month_tag(ts: str = "tpep_pickup_datetime") -> Column:
    return F.date_format(F.col(ts), "yyyy-MM")


def scan_months(spark: SparkSession, path: str, pattern: str = r"[_=](\d{4}-\d{2})(?:\.parquet|/)") -> DataFrame:
    """All monthly Parquet files below path, each row tagged with the month its file or folder names (trips_2022-01.parquet, month=2022-01/).

    The month is an expression of the file's path, so a filter on it skips files before they are opened.
    """
    files = spark.read.option("recursiveFileLookup", "true").parquet(path)
    return files.withColumn("month", F.regexp_extract(F.col("_metadata.file_path"), pattern, 1))


def write_months(trips: DataFrame, path: str, month: str = "month") -> None:
    """One folder per month. The rebalance hint lets adaptive execution split a heavy month over tasks."""
    trips.hint("rebalance", month).write.partitionBy(month).parquet(path)


def redo_months(trips: DataFrame, path: str, month: str = "month") -> None:
    """Replace the folders of the months that trips holds and leave the others as they are."""
    trips.hint("rebalance", month).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(month).parquet(path)


def read_months(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def read_calendar(spark: SparkSession, path: str, extra: tuple[T.StructField, ...] = ()) -> DataFrame:
    return spark.read.csv(path, header=True, schema=T.StructType([*CALENDAR_SCHEMA.fields, *extra]))


def read_zones(spark: SparkSession, path: str, extra: tuple[T.StructField, ...] = ()) -> DataFrame:
    return spark.read.csv(path, header=True, schema=T.StructType([*ZONE_SCHEMA.fields, *extra]))


def write_report(report: DataFrame, path: str) -> None:
    report.write.csv(path, header=True)


def write_params(params: DataFrame, path: str) -> None:
    params.write.json(path)


def concat_months(frames: list[DataFrame]) -> DataFrame:
    """Union of month frames by column name."""
    return reduce(DataFrame.unionByName, frames)


def distinct_dates(trips: DataFrame, ts: str = "tpep_pickup_datetime") -> DataFrame:
    return trips.select(F.to_date(ts).alias("pickup_date")).distinct()

"""Scoring and monitoring on live feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T, functions as F
from pyspark.sql.streaming import StreamingQuery

from faremill.functions.basics import flag
from faremill.functions.calendar import utc_instant, zoneless
from faremill.operators.errors import error_columns
from faremill.operators.scoring import request_features, rule_scores


def file_feed(spark: SparkSession, path: str, schema: T.StructType, name_filter: str = "*.parquet", files_per_batch: int = 1) -> DataFrame:
    """The Parquet files of a folder as a stream."""
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).option("pathGlobFilter", name_filter).parquet(path)
    )


def score_stream(requests: DataFrame, weather: DataFrame, calendar: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Score requests as they come: repeats within the delay are dropped, weather and calendar are static sides."""
    return rule_scores(request_features(without_repeats(requests, delay), weather, calendar))


def without_repeats(requests: DataFrame, delay: str) -> DataFrame:
    return requests.withColumn("event_time", utc_instant("request_time")).withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["request_id"])


def deliver_weather(hours: DataFrame, path: str, number: int) -> None:
    """Append a delivery of hourly weather columns; a later number replaces the hours it holds."""
    hours.withColumn("delivery", F.lit(number).cast("bigint")).write.mode("append").parquet(path)


def newest_weather(spark: SparkSession, path: str) -> DataFrame:
    """Each hour as its last delivery has it. The files are listed when this is called."""
    rows = spark.read.parquet(path)
    readings = [c for c in rows.columns if c not in ("datetime", "delivery")]
    return rows.groupBy("datetime").agg(F.max_by(F.struct(*readings), "delivery").alias("w")).select("datetime", "w.*")


def score_refreshing(requests: DataFrame, weather_path: str, calendar: DataFrame, path: str, checkpoint: str, delay: str = "1 hour") -> StreamingQuery:
    """As score_stream, but each batch is scored by the weather delivered until it runs.

    A batch writes its own folder and overwrites it when it is run again after a failure, so each request is stored once.
    """

    def one_batch(batch: DataFrame, number: int) -> None:
        weather = newest_weather(batch.sparkSession, weather_path)
        rule_scores(request_features(batch, weather, calendar)).write.mode("overwrite").parquet(f"{path}/batch={number}")

    stream = without_repeats(requests, delay).writeStream.foreachBatch(one_batch)
    return stream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def scored_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def monitor_stream(scored: DataFrame, ts: str, delay: str = "1 day", width: str = "7 days", r2_floor: float = 0.80, mae_limit: float = 3.0) -> DataFrame:
    """MAE and R² per closed window; rows later than the delay are dropped."""
    errors = error_columns(scored).withColumn("event_time", utc_instant(ts)).withWatermark("event_time", delay)
    n = F.count("*").cast("double")
    weeks = errors.groupBy(F.window("event_time", width).alias("w")).agg(
        F.count("*").alias("n"), F.avg("abs_error").alias("mae"),
        (F.lit(1.0) - F.try_divide(F.sum("squared_error"), F.var_pop("y_true") * n)).alias("r2"),
    )
    return weeks.select(zoneless(F.col("w.start")).alias("week_start"), "n", "mae", "r2", flag((F.col("r2") < r2_floor) | (F.col("mae") > mae_limit)).alias("alert"))


def run_to_table(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append everything available to Parquet files and stop."""
    return (
        stream.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )

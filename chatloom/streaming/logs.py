"""Metrics of running training jobs, as their log files grow."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.operators.logs import parse_log


def _stream(spark: SparkSession, path: str, files_per_trigger: int | None) -> DataFrame:
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return split_lines(reader.load(path))


def split_lines(raw: DataFrame) -> DataFrame:
    """``value`` lines as ``arrived``, ``run``, ``line``, and why a line is ``bad`` (null if it isn't)."""
    parts = F.split("value", "\t", 3)
    arrived = F.get(parts, F.lit(0)).try_cast("timestamp")
    bad = F.when(F.size(parts) < 3, F.lit("too few fields")).when(arrived.isNull(), F.lit("bad time"))
    return raw.select(
        arrived.alias("arrived"),
        F.get(parts, F.lit(1)).alias("run"),
        F.get(parts, F.lit(2)).alias("line"),
        bad.alias("bad"),
        "value",
    )


def read_log_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None):
    """Lines ``arrived <tab> run <tab> line`` from a growing folder; bad ones are left to
    ``bad_lines``."""
    rows = _stream(spark, path, files_per_trigger)
    return rows.where(F.col("bad").isNull()).select("arrived", "run", "line")


def bad_lines(spark: SparkSession, path: str, files_per_trigger: int | None = None):
    """The lines that ``read_log_stream`` leaves out, counted by reason, as a stream."""
    rows = _stream(spark, path, files_per_trigger)
    return rows.where(F.col("bad").isNotNull()).groupBy("bad").agg(F.count(F.lit(1)).alias("lines"))


def window_metrics(
    lines: DataFrame, width: str = "10 minutes", late: str = "30 minutes", metric: str = "loss"
) -> DataFrame:
    """Per run and tumbling window: steps, mean and highest value of a metric.

    A resumed run repeats steps; the first arrival of (run, epoch, step) counts.
    Lines later than ``late`` are dropped, and state older than that is freed.
    """
    value = F.col(metric)
    unique = (
        parse_log(lines)
        .select("arrived", "run", "epoch", "step", value.alias("value"))
        .withWatermark("arrived", late)
        .dropDuplicatesWithinWatermark(["run", "epoch", "step"])
    )
    return (
        unique.groupBy(F.window("arrived", width), "run")
        .agg(
            F.count(F.lit(1)).alias("steps"),
            F.max("step").alias("max_step"),
            F.avg("value").alias("avg_value"),
            F.max("value").alias("max_value"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            "run",
            "steps",
            "max_step",
            "avg_value",
            "max_value",
        )
    )


def stream_log(
    spark: SparkSession, path: str, out: str, checkpoint: str, available_now: bool = True, **options
):
    """Start the query: append closed windows to Parquet at ``out``."""
    writer = (
        window_metrics(read_log_stream(spark, path, options.pop("files_per_trigger", None)), **options)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()

"""Latest step wins, on the stream: a resumed run's lines replace those it repeats.

What is known stands in tables, and no executor keeps it: each batch reduces its own lines to
one row for (run, epoch, step) and window of arrival, the values of the latest line and
the number of lines, and writes them at once to a folder named by the batch's number; a
batch that is run again after a failure overwrites its own folder, which makes the upsert
idempotent. Every ``fold`` batches, the batch also writes the merged table of all so far, so a
reader opens the newest merged table and the few batches after it, however long the
stream has run. Lines of windows that the watermark has passed are left out, as a stateful
aggregation would; memory grows with a task's rows, never with the steps there are.

``read_latest`` is the table at any time: for each (run, epoch, step) the values of the latest
line, whenever it came. It equals ``operators.logs.latest_steps`` over the lines that have
arrived. ``window_metrics`` of it puts each step into the window of its latest line.
"""

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.operators.logs import METRICS, parse_log
from chatloom.streaming.logs import read_log_stream

KEYS = ["run", "epoch", "step"]
REST = ["arrived", "format", "total_steps", *METRICS]
FOLD = 20  # batches between two merged tables


def changes(lines: DataFrame, width: str = "1 hour", late: str = "30 minutes") -> DataFrame:
    """A stream of (``window``, run, epoch, step, values, ``arrivals``), for update mode.

    Of two lines of one moment the one with the greater values stands, so the result
    doesn't depend on the order of arrival. The values are the order as well: state and
    shuffle hold them once.
    """
    return _reduced(parse_log(lines).withWatermark("arrived", late), width)


def _reduced(parsed: DataFrame, width: str, passed: int | None = None) -> DataFrame:
    """One row for each (window, run, epoch, step), without windows that end by ``passed`` (milliseconds)."""
    value = F.struct(*REST)
    rows = parsed.groupBy(F.window("arrived", width).alias("w"), *KEYS).agg(
        F.max(value).alias("r"), F.count(F.lit(1)).alias("arrivals")
    )
    if passed is not None:
        rows = rows.where(F.col("w.end") > F.timestamp_millis(F.lit(passed)))
    return rows.select(F.col("w.start").alias("window"), *KEYS, "r.*", "arrivals")


def _schema(spark: SparkSession):
    lines = spark.createDataFrame([], "arrived timestamp, run string, line string")
    return changes(lines).withColumn("batch", F.lit(0).cast("long")).schema


def folders(spark: SparkSession, out: str) -> tuple[int, list[int]]:
    """Number of the newest merged table (-1 if none), and of the batches after it; names and no rows."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    path = hadoop.Path(out)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path):
        return -1, []
    names = [s.getPath().getName() for s in system.listStatus(path)]
    done = [n for n in names if system.exists(hadoop.Path(f"{out}/{n}/_SUCCESS"))]
    merged = max((int(n[7:]) for n in done if n.startswith("merged-")), default=-1)
    return merged, sorted(int(n[6:]) for n in done if n.startswith("batch-") and int(n[6:]) > merged)


def _merged(rows: DataFrame) -> DataFrame:
    """The rows of several batches as one of each (window, run, epoch, step)."""
    value = F.struct(*REST)
    return (
        rows.groupBy("window", *KEYS)
        .agg(F.max(value).alias("r"), F.sum("arrivals").alias("arrivals"), F.max("batch").alias("batch"))
        .select("window", *KEYS, "r.*", "arrivals", "batch")
    )


def _before(spark: SparkSession, out: str, number: int | None = None) -> DataFrame:
    """The rows of the newest merged table and the batches after it, of all batches before ``number``."""
    merged, batches = folders(spark, out)
    if number is not None and merged >= number:  # a batch that is run again after it had merged
        raise RuntimeError(f"{out}: merged-{merged} is newer than batch {number}")
    names = [f"{out}/merged-{merged}"] * (merged >= 0) + [
        f"{out}/batch-{n}" for n in batches if number is None or n < number
    ]
    schema = _schema(spark)
    return spark.read.schema(schema).parquet(*names) if names else spark.createDataFrame([], schema)


def upsert(out: str, fold: int = FOLD):
    """The sink: writes the rows that batch ``number`` adds, and overwrites them if it comes again."""

    def write(rows: DataFrame, number: int):
        spark = rows.sparkSession
        rows = rows.withColumn("batch", F.lit(number).cast("long"))
        rows.write.mode("overwrite").parquet(f"{out}/batch-{number}")
        if number % fold == fold - 1:
            merged, _ = folders(spark, out)
            if merged < number:
                _merged(_before(spark, out, number + 1)).write.mode("overwrite").parquet(f"{out}/merged-{number}")

    return write


def read_latest(spark: SparkSession, out: str) -> DataFrame:
    """One row for each (run, epoch, step): the values of its latest line, and ``arrivals``, its lines."""
    value = F.struct(*REST)
    return (
        _before(spark, out)
        .groupBy(*KEYS)
        .agg(F.max(value).alias("r"), F.sum("arrivals").alias("arrivals"))
        .select(*KEYS, "r.*", "arrivals")
    )


def window_metrics(latest: DataFrame, width: str = "10 minutes", metric: str = "loss") -> DataFrame:
    """Per run and tumbling window of the latest line: steps, mean and highest value of a metric."""
    return (
        latest.groupBy(F.window("arrived", width).alias("w"), "run")
        .agg(
            F.count(F.lit(1)).alias("steps"),
            F.max("step").alias("max_step"),
            F.avg(metric).alias("avg_value"),
            F.max(metric).alias("max_value"),
        )
        .select(F.col("w.start").alias("window_start"), "run", "steps", "max_step", "avg_value", "max_value")
    )


def _passed(spark: SparkSession, checkpoint: str, number: int) -> int:
    """The watermark of batch ``number`` in milliseconds, as Spark has noted it before the batch began."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/offsets/{number}")
    file = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    try:
        lines = spark._jvm.org.apache.commons.io.IOUtils.toString(file, "UTF-8").splitlines()
    finally:
        file.close()
    return json.loads(lines[1])["batchWatermarkMs"]


def _refuse_older(spark: SparkSession, checkpoint: str) -> None:
    """Stateful versions wrote counts of all lines so far; added up, they would be too high."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/state")
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        raise RuntimeError(f"{checkpoint}: written by a version that kept state; start the stream anew")


def stream_latest(
    spark: SparkSession,
    path: str,
    out: str,
    checkpoint: str,
    available_now: bool = True,
    fold: int = FOLD,
    files_per_trigger: int | None = None,
    width: str = "1 hour",
    late: str = "30 minutes",
):
    """Start the query: keep the latest values of each step at ``out``."""
    _refuse_older(spark, checkpoint)
    sink = upsert(out, fold)

    def write(parsed: DataFrame, number: int):
        sink(_reduced(parsed, width, _passed(spark, checkpoint, number)), number)

    writer = (
        parse_log(read_log_stream(spark, path, files_per_trigger))
        .withWatermark("arrived", late)
        .writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()

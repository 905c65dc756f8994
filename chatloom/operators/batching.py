"""Epoch order, worker shards, batches and resume points, as tables.

The order of an epoch is the order of a hash of (seed + epoch, id). Hash values
are uniform, so cutting their range into equal buckets cuts the table into even
pieces, as many as the rows ask for: one counting pass gives each bucket its offset, and
positions inside a bucket come from a window over that bucket alone. No task sorts the whole table
and nothing is sampled, so a lost task recomputes the same positions.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEED = 42
BUCKET_ROWS = 250_000  # rows of a bucket, about


def digits_for(rows: int, bucket: int = BUCKET_ROWS) -> int:
    """Hex digits of the hash that cut ``rows`` into buckets of about ``bucket`` rows; two at
    least, so that a small table is spread, too."""
    digits = 2
    while rows > bucket * 16**digits:
        digits += 1
    return digits


def epoch_buckets(
    df: DataFrame, key: str, seed: int = SEED, epoch: int = 0, bucket: int = BUCKET_ROWS
) -> tuple[DataFrame, DataFrame, int]:
    """Rows with their hash ``_h`` and bucket ``_b``, the place ``_o`` of each bucket's first row, and
    the number of rows. There is a bucket for some ``bucket`` rows, so the table of buckets
    is the rows' number by 15,000 or more, 12 bytes each."""
    n = df.count()
    digest = F.md5(F.concat(F.lit(f"{seed + epoch}:"), F.col(key).cast("string")))
    keyed = df.withColumn("_h", digest).withColumn(
        "_b", F.conv(F.substring("_h", 1, digits_for(n, bucket)), 16, 10).cast("int")
    )
    sizes = keyed.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"))
    return keyed, offsets, n


def shuffle_epoch(
    df: DataFrame, key: str, seed: int = SEED, epoch: int = 0, bucket: int = BUCKET_ROWS
) -> DataFrame:
    """Add ``position``, the zero-based place in this epoch's permutation."""
    keyed, offsets, _ = epoch_buckets(df, key, seed, epoch, bucket)
    local = Window.partitionBy("_b").orderBy("_h", key)
    return (
        keyed.join(F.broadcast(offsets), "_b")
        .withColumn("position", F.col("_o") + F.row_number().over(local) - 1)
        .select(*df.columns, "position")
    )


def shard(ordered: DataFrame, rank: int | None, world: int, even: bool = False) -> DataFrame:
    """Interleaved split over workers: adds ``rank`` and ``shard_position``.

    ``even`` repeats rows from the start of the order until all workers have the
    same number. ``rank=None`` keeps all workers' rows.
    """
    out = ordered
    if even:
        n = ordered.select(F.count(F.lit(1))).scalar()
        padded = F.ceil(n / world) * world
        repeats = F.floor((padded - 1 - F.col("position")) / F.greatest(n, F.lit(1)))
        out = (
            out.withColumn(
                "_lap", F.explode(F.sequence(F.lit(0).cast("bigint"), repeats.cast("bigint")))
            )
            .withColumn("position", F.col("position") + F.col("_lap") * n)
            .drop("_lap")
        )
    out = out.withColumn("rank", F.pmod("position", F.lit(world)).cast("int")).withColumn(
        "shard_position", F.floor(F.col("position") / world).cast("bigint")
    )
    return out if rank is None else out.where(F.col("rank") == rank)


def batches(shards: DataFrame, size: int, position: str = "shard_position") -> DataFrame:
    """Consecutive batches, numbered from 0; the last may be short."""
    return shards.withColumn("batch", F.floor(F.col(position) / size).cast("bigint"))


def skip_batches(df: DataFrame, k: int) -> DataFrame:
    """Resume after ``k`` batches; ``step`` goes on at ``k + 1``."""
    return df.where(F.col("batch") >= k).withColumn("step", F.col("batch") + 1)


def batch_plan(
    df: DataFrame,
    key: str,
    size: int,
    world: int = 1,
    rank: int | None = None,
    skip: int = 0,
    seed: int = SEED,
    epoch: int = 0,
    even: bool = False,
) -> DataFrame:
    """The whole input plan of an epoch: who reads which sample in which step."""
    ordered = shuffle_epoch(df, key, seed, epoch)
    return skip_batches(batches(shard(ordered, rank, world, even), size), skip)


def batch_count(n: Column, size: Column, skip: Column) -> Column:
    return F.greatest(F.lit(0).cast("bigint"), F.ceil(n / size) - skip)


def rescale_step(step: Column, saved: Column, now: Column) -> Column:
    """Step to resume at when the number of workers changed."""
    return F.when(saved != now, F.floor(step * saved / now).cast("bigint")).otherwise(step)


def optimizer_steps(n: Column, accum: Column, epochs: Column, flush_tail: bool) -> Column:
    """Scheduler steps of a run: tail dropped, or flushed as a step of its own."""
    if flush_tail:
        return F.ceil(n / accum) * epochs
    return F.greatest(F.lit(1).cast("bigint"), F.floor(n / accum) * epochs)


def lr_value(step: Column, total: Column, lr, kind: str = "cosine") -> Column:
    """Learning rate at a step: cosine down to a tenth, in the two usual forms."""
    lr = lr if isinstance(lr, Column) else F.lit(float(lr))
    wave = 1 + F.cos(F.lit(3.141592653589793) * step / total)
    if kind == "cosine":
        return lr * (0.1 + 0.45 * wave)
    low = lr / 10
    return low + (lr - low) * wave / 2


def lr_schedule(spark, total: int, lr: float, kind: str = "cosine") -> DataFrame:
    steps = spark.range(total + 1).withColumnRenamed("id", "step")
    return steps.withColumn("lr", lr_value(F.col("step"), F.lit(total), lr, kind))


def cadence(
    df: DataFrame, log: int, save: int, refresh: int, step: str = "step", total: str = "total"
) -> DataFrame:
    """When a step logs and saves, and which policy version it samples from."""
    s, last = F.col(step), F.col(step) == F.col(total)
    return (
        df.withColumn("logs", (F.pmod(s, F.lit(log)) == 0) | last)
        .withColumn("saves", (F.pmod(s, F.lit(save)) == 0) | last)
        .withColumn("policy_version", F.floor(s / refresh).cast("bigint"))
    )

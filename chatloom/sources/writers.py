"""Sample tables to Parquet, in reading order."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.operators.batching import BUCKET_ROWS, SEED, epoch_buckets


def write_samples(
    df: DataFrame, path: str, shards: int, order: str = "position", total: Column | int | None = None
) -> None:
    """Cut positions ``0 … total - 1`` into ``shards`` even ranges, each sorted.

    The range of a row follows from its position, so nothing is sampled and the
    input is shuffled once. A resumed run skips whole files by their statistics
    instead of reading and discarding. ``total`` defaults to the number of rows.
    """
    if total is None:
        total = df.select(F.count(F.lit(1))).scalar()
    elif isinstance(total, int):
        total = F.lit(total)
    place = F.floor(F.col(order) * shards / F.greatest(total, F.lit(1)))
    (
        df.repartitionById(shards, F.least(place, F.lit(shards - 1)).cast("int"))
        .sortWithinPartitions(order)
        .write.mode("errorifexists")
        .parquet(path)
    )


def write_epoch(
    df: DataFrame,
    key: str,
    path: str,
    shards: int,
    seed: int = SEED,
    epoch: int = 0,
    bucket: int = BUCKET_ROWS,
) -> None:
    """The rows in the order of an epoch, with their ``position``, as ``shards`` files.

    A shard is a run of hash buckets, so file and position follow from one shuffle of
    the rows: they are dealt to their shard and sorted there, and a row's place in the
    file is added to the place of the shard's first row.
    """
    keyed, offsets, n = epoch_buckets(df, key, seed, epoch, bucket)
    place = F.floor(F.col("_o") * shards / max(n, 1)).cast("int")
    dealt = offsets.withColumn("_s", F.least(place, F.lit(shards - 1)))
    begins = dealt.groupBy("_s").agg(F.min("_o").alias("_begin"))
    rows = keyed.join(F.broadcast(dealt.join(begins, "_s").select("_b", "_s", "_begin")), "_b")
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    (
        rows.repartitionById(shards, "_s")
        .sortWithinPartitions("_h", key)
        .withColumn("position", F.col("_begin") + inside)
        .select(*df.columns, "position")
        .write.mode("errorifexists")
        .parquet(path)
    )

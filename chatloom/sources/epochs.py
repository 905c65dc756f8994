"""Epochs at rest: written once in reading order, resumed from any batch.

A stored epoch is a folder with ``rows`` (Parquet files, each a run of positions) and a
``manifest``, which is written last: file, first and last position, number of rows and a
checksum, and a header row for the whole. A folder without a manifest is half written
and refused, as is one whose files are not those of its manifest.

Worker ``rank`` of ``world`` reads batch ``b`` from the positions ``b * size * world`` up to the next
batch's, so a run that resumes at a batch opens only the files that reach so far: their
names come from the manifest, and inside the first of them row groups are skipped by
their statistics, since a file is sorted by position. Nothing is read and discarded.
"""

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatloom.operators.batching import BUCKET_ROWS, SEED, batches, skip_batches
from chatloom.sources.writers import write_epoch

MANIFEST = T.StructType(
    [
        T.StructField("file", T.StringType()),  # null in the header row
        *[T.StructField(c, T.LongType()) for c in ("first", "last", "rows", "checksum")],
        T.StructField("key", T.StringType()),
        T.StructField("seed", T.LongType()),
        T.StructField("epoch", T.LongType()),
        T.StructField("files", T.LongType()),
        T.StructField("schema", T.StringType()),
    ]
)


class EpochError(RuntimeError):
    """A stored epoch that is not whole."""


def _checksum(df: DataFrame) -> Column:
    """Order plays no part, but a row's position does: rows differ, and none cancels another."""
    plain = [
        F.to_json(F.struct(f.name)) if any(t in f.dataType.simpleString() for t in ("map<", "variant")) else F.col(f.name)
        for f in df.schema
    ]
    return F.bit_xor(F.xxhash64(*plain))


def _file() -> Column:
    return F.col("_metadata.file_name")


def _sums(rows: DataFrame) -> DataFrame:
    """``file``, ``first``, ``last``, ``rows`` and ``checksum`` of each file."""
    return rows.groupBy(_file().alias("file")).agg(
        F.min("position").alias("first"),
        F.max("position").alias("last"),
        F.count(F.lit(1)).alias("rows"),
        _checksum(rows).alias("checksum"),
    )


def store_epoch(
    df: DataFrame, key: str, path: str, shards: int, seed: int = SEED, epoch: int = 0, bucket: int = BUCKET_ROWS
) -> None:
    """Write ``df`` in the order of an epoch, then its manifest. ``path`` must be new."""
    spark = df.sparkSession
    write_epoch(df, key, f"{path}/rows", shards, seed, epoch, bucket)
    rows = spark.read.parquet(f"{path}/rows")
    files = _sums(rows)
    header = files.agg(
        F.lit(None).cast("string").alias("file"),
        F.lit(0).cast("long").alias("first"),
        (F.coalesce(F.sum("rows"), F.lit(0)) - 1).alias("last"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.bit_xor("checksum").alias("checksum"),
        F.count(F.lit(1)).alias("files"),
    )
    said = {"key": F.lit(key), "seed": F.lit(seed), "epoch": F.lit(epoch), "schema": F.lit(rows.schema.json())}
    both = files.withColumn("files", F.lit(None).cast("long")).unionByName(header)
    table = both.select(*[said[f.name].cast(f.dataType).alias(f.name) if f.name in said else f.name for f in MANIFEST])
    table.coalesce(1).write.mode("errorifexists").parquet(f"{path}/manifest")  # a row for each file, whole or not at all


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest of a stored epoch, header row included."""
    try:
        return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    except AnalysisException as missing:
        raise EpochError(f"{path}: no manifest, so the epoch is half written") from missing


class Epoch:
    """A stored epoch that was found whole. What stays on the driver is a row for each file."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        table = manifest(spark, path).collect()
        head = [r for r in table if r.file is None]
        if len(head) != 1:
            raise EpochError(f"{path}: the manifest is half written")
        head = head[0]
        self.key, self.seed, self.epoch, self.total, self.checksum = head.key, head.seed, head.epoch, head.rows, head.checksum
        self.schema = T.StructType.fromJson(json.loads(head.schema))
        self.files = sorted((r for r in table if r.file is not None), key=lambda r: r["first"])
        end = 0
        for r in self.files:
            if r["first"] != end or r.last - r["first"] + 1 != r.rows:
                raise EpochError(f"{path}: positions of {r.file} don't follow those before it")
            end = r.last + 1
        if end != self.total or len(self.files) != head.files:
            raise EpochError(f"{path}: the manifest names {end} rows of {self.total}")
        there = {name.rsplit("/", 1)[-1] for name in self._read().inputFiles()} if self.total else set()
        named = {r.file for r in self.files}
        if named - there:
            raise EpochError(f"{path}: missing {sorted(named - there)[:3]}")
        if there - named and not self._read(sorted(there - named)).isEmpty():  # Spark may write a file without rows
            raise EpochError(f"{path}: rows in unknown files, as {sorted(there - named)[:3]}")

    def _read(self, files: list[str] | None = None) -> DataFrame:
        paths = [f"{self.path}/rows"] if files is None else [f"{self.path}/rows/{f}" for f in files]
        return self.spark.read.schema(self.schema).parquet(*paths)

    def files_for(self, begin: int, end: int) -> list[str]:
        """Names of the files that hold positions from ``begin`` up to, but not with, ``end``."""
        return [r.file for r in self.files if r.last >= begin and r["first"] < end]

    def positions(self, begin: int = 0, end: int | None = None) -> DataFrame:
        """Rows of a range of positions, from the files that hold them."""
        end = self.total if end is None else min(end, self.total)
        files = self.files_for(begin, end)
        if not files:
            return self.spark.createDataFrame([], self.schema)
        return self._read(files).where((F.col("position") >= begin) & (F.col("position") < end))

    def steps(
        self,
        size: int,
        world: int = 1,
        rank: int | None = None,
        skip: int = 0,
        until: int | None = None,
        even: bool = False,
    ) -> DataFrame:
        """Rows of the batches ``skip … until - 1``, with ``rank``, ``shard_position``, ``batch`` and ``step``: what
        ``batch_plan`` gives for the same order, read from the files that hold it.

        ``even`` repeats rows from the start of the order until all workers have the same
        number; they follow the last position.
        """
        begin = skip * size * world
        last = -(-self.total // world) * world if even else self.total
        end = last if until is None else min(last, until * size * world)
        rows = self.positions(begin, end)
        lap = 1
        while self.total and lap * self.total < end:  # one more lap, or several of fewer rows than workers
            shift = lap * self.total
            more = self.positions(max(0, begin - shift), end - shift)
            rows = rows.unionByName(more.withColumn("position", F.col("position") + shift))
            lap += 1
        placed = rows.withColumn("rank", F.pmod("position", F.lit(world)).cast("int")).withColumn(
            "shard_position", F.floor(F.col("position") / world).cast("bigint")
        )
        placed = placed if rank is None else placed.where(F.col("rank") == rank)
        return skip_batches(batches(placed, size), skip)

    def damaged(self, begin: int = 0, end: int | None = None) -> DataFrame:
        """Files of a range of positions whose rows are not those that were written: ``file``, ``rows``
        as named and as found. Reads the files whole."""
        files = self.files_for(begin, self.total if end is None else end)
        kind = "file string, rows long, checksum long"
        named = self.spark.createDataFrame([(r.file, r.rows, r.checksum) for r in self.files if r.file in set(files)], kind)
        if not files:
            return named.select("file", "rows", F.col("rows").alias("found"))
        found = _sums(self._read(files)).select("file", F.col("rows").alias("found"), F.col("checksum").alias("now"))
        wrong = (F.coalesce("found", F.lit(0)) != F.col("rows")) | ~F.col("checksum").eqNullSafe(F.col("now"))
        return named.join(found, "file", "left").where(wrong).select("file", "rows", F.coalesce("found", F.lit(0)).alias("found"))


def open_epoch(spark: SparkSession, path: str) -> Epoch:
    """A stored epoch; raises ``EpochError`` if it is not whole."""
    return Epoch(spark, path)

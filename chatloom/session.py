"""Session helpers: where lineage may be cut, and stable tables for reuse."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A session that names none may only be a local one; it then gets a folder of
    its own. On a cluster the setting has to be there, since executors cannot
    share a machine-local folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="chatloom-"))
    return sc.getCheckpointDir()


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/chatloom/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to reliable storage and go on from there.

    Used where a result is read several times, or where a plan depends on range
    bounds that must not be drawn twice. It survives lost executors.
    """
    spark = df.sparkSession
    path = fresh_path(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Use all cores on an input of few files.

    A scan with fewer splits than cores, as of one small file, would leave cores
    idle under work that is heavy per row. A large input has more splits than
    cores and is returned as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df

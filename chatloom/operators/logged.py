"""Log-probs that were logged apart: the policy's, the old policy's and the reference's.

Each is a table of (``prompt_id``, ``gen_id``, ``ids``, ``logps``), written by its own job. ``store_logps`` writes it
bucketed by (prompt_id, gen_id); tables of the same number of buckets are joined bucket by
bucket, without a shuffle. A row keeps the length and a digest of its token ids, so tables
that were logged over other tokens, or cut elsewhere, are told apart before anything is
computed from them: every key of any table comes out once, with the reason why it isn't
usable, or null.
"""

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ["prompt_id", "gen_id"]
SPEC = "buckets int, columns string"


def store_logps(df: DataFrame, path: str, buckets: int, keep: list[str] | None = None, order: str | None = None) -> None:
    """Write ``df`` to ``path``, which must be new, in ``buckets`` files sorted by key.

    ``keep`` names more columns that come along. A key that comes several times, as after a
    resumed run, is kept once: the row that is greatest by ``order``, or else by its values.
    Rows without a key are left out. One shuffle: the rows of a bucket are dealt, reduced
    and sorted in place.
    """
    spark = df.sparkSession
    value = [
        *([F.col(order).alias("_order")] if order else []),
        F.size("ids").alias("n_ids"),
        F.xxhash64("ids").alias("ids_digest"),
        F.col("logps").cast("array<double>").alias("logps"),
        *(keep or []),
    ]
    rows = df.where(F.col("prompt_id").isNotNull() & F.col("gen_id").isNotNull()).select(
        F.col("prompt_id").cast("long").alias("prompt_id"),
        F.col("gen_id").cast("int").alias("gen_id"),
        F.struct(*value).alias("r"),
    )
    table = rows.repartition(buckets, *KEYS).groupBy(*KEYS).agg(F.max("r").alias("r")).select(*KEYS, "r.*").drop("_order")
    name = f"chatloom_{uuid.uuid4().hex}"
    try:
        (
            table.write.bucketBy(buckets, *KEYS)
            .sortBy(*KEYS)
            .option("path", f"{path}/buckets-{buckets}")
            .mode("errorifexists")
            .saveAsTable(name)
        )
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # the files stay; they are opened by path
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema)
    spark.createDataFrame([(buckets, columns)], SPEC).coalesce(1).write.parquet(f"{path}/spec")  # last: the table is whole


def open_logps(spark: SparkSession, path: str) -> DataFrame:
    """A stored table, known to be bucketed."""
    try:
        n, columns = spark.read.schema(SPEC).parquet(f"{path}/spec").first()
    except (AnalysisException, TypeError) as missing:
        raise ValueError(f"{path}: no log-probs, or half written ones") from missing
    name = f"chatloom_{uuid.uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({', '.join(KEYS)}) SORTED BY ({', '.join(KEYS)})"
        f" INTO {n} BUCKETS LOCATION '{path}/buckets-{n}'"
    )
    table = spark.table(name)
    table.schema  # the plan has its files and buckets from here on
    spark.sql(f"DROP TABLE {name}")
    return table


def _reason(sides: list[str]) -> Column:
    """Why a key is not usable: the first that holds, or null."""
    first, rest = sides[0], sides[1:]
    cases = [(F.col(f"_{s}_n").isNull() & F.col(f"_{s}_logps").isNull(), f"no {s}") for s in sides]
    cases += [(F.coalesce(F.size(f"_{s}_logps"), F.lit(-1)) < 0, f"null logps of {s}") for s in sides]
    for s in rest:
        cases.append((F.size(f"_{s}_logps") != F.size(f"_{first}_logps"), f"length of {s}"))
        cases.append((~F.col(f"_{s}_n").eqNullSafe(F.col(f"_{first}_n")) | ~F.col(f"_{s}_d").eqNullSafe(F.col(f"_{first}_d")), f"ids of {s}"))
    out = F.lit(None).cast("string")
    for wrong, name in reversed(cases):
        out = F.when(wrong, F.lit(name)).otherwise(out)
    return out


def join_logps(policy: DataFrame, **others: DataFrame) -> DataFrame:
    """One row for each key of any of the stored tables: the policy's kept columns, ``new_logps``, ``<name>_logps`` of
    the others, and ``mismatch``, the reason why they don't belong together (null if they do)."""
    sides = ["policy", *others]
    parts = []
    for side, table in zip(sides, (policy, *others.values()), strict=True):
        names = {"n_ids": f"_{side}_n", "ids_digest": f"_{side}_d", "logps": f"_{side}_logps"}
        kept = [c for c in table.columns if c not in (*KEYS, *names)] if side == "policy" else []
        parts.append(table.select(*KEYS, *[F.col(a).alias(b) for a, b in names.items()], *kept))
    more = [c for c in policy.columns if c not in (*KEYS, "n_ids", "ids_digest", "logps")]
    # A full outer join would lose the buckets: rows of each table that none before it has,
    # with those after it. Each of these joins keeps the partitioning of its left side.
    joined = None
    for i, part in enumerate(parts):
        for other in parts[:i]:
            part = part.join(other.select(*KEYS).hint("merge"), KEYS, "left_anti")
        for other in parts[i + 1 :]:
            part = part.join(other.hint("merge"), KEYS, "left")
        joined = part if joined is None else joined.unionByName(part, allowMissingColumns=True)
    return joined.select(
        *KEYS,
        *more,
        F.col("_policy_logps").alias("new_logps"),
        *[F.col(f"_{s}_logps").alias(f"{s}_logps") for s in others],
        _reason(sides).alias("mismatch"),
    )


def usable(joined: DataFrame) -> DataFrame:
    return joined.where(F.col("mismatch").isNull()).drop("mismatch")


def mismatches(joined: DataFrame) -> DataFrame:
    """``mismatch`` and its number of ``rows``; null counts the usable ones."""
    return joined.groupBy("mismatch").agg(F.count(F.lit(1)).alias("rows"))

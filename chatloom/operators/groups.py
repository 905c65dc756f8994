"""Group statistics, ranks and ordered collection, one plan each.

Statistics are aggregated, combined before the shuffle, and joined back on the keys;
adaptive execution broadcasts the aggregate where it is small and splits a hot key
where it isn't. Nothing is counted beforehand, and no size decides on the plan.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.session import materialize


def same(left: DataFrame, right: DataFrame, keys: list[str], prefix: str = "") -> Column:
    """Equal keys, null being equal to null; ``prefix`` stands before the right side's names."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"{prefix}{k}"]) for k in keys])


def join_stats(df: DataFrame, table: DataFrame, keys: list[str], stats: list[str]) -> DataFrame:
    """Repeat the columns ``stats`` of ``table``, unique by ``keys``, on the rows of ``df``."""
    renamed = table.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *stats)
    joined = df.join(renamed, same(df, renamed, keys, "_k_"))
    return joined.select(*[df[c] for c in df.columns], *stats)


def with_group_stats(df: DataFrame, keys: list[str], stats: dict[str, Column]) -> DataFrame:
    """Repeat aggregates of each group on its rows."""
    table = df.groupBy(*keys).agg(*[c.alias(n) for n, c in stats.items()])
    return join_stats(df, table, keys, list(stats))


def rank_in_group(
    df: DataFrame, keys: list[str], order: list[Column], out: str = "rank", how: str = "window"
) -> DataFrame:
    """Zero-based place of each row in its group, a bigint. ``order`` must be total.

    ``how="window"`` sorts each group in one task. ``how="spread"`` is for groups that
    no task should hold: rows are dealt by ranges of (group, order), written once, and
    numbered by what lies before them.
    """
    if how == "spread":
        return _rank_spread(df, keys, order, out)
    if how != "window":
        raise ValueError(f"how must be window or spread, not {how}")
    within = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(out, (F.row_number().over(within) - 1).cast("bigint"))


def _rank_spread(df: DataFrame, keys: list[str], order: list[Column], out: str) -> DataFrame:
    by = [*[F.col(k).asc_nulls_first() for k in keys], *order]
    # The row id holds the partition number and the place inside it. The table is
    # written, so the sampled range bounds are drawn exactly once.
    parts = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = materialize(
        df.repartitionByRange(parts, *by)
        .sortWithinPartitions(*by)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_id", 33))
    )
    # one row per (partition, group)
    pieces = rows.groupBy("_part", *keys).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first")
    )
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    pieces = pieces.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    ranked = join_stats(rows, pieces, ["_part", *keys], ["_first", "_before"])
    return ranked.select(
        *df.columns, (F.col("_before") + F.col("_id") - F.col("_first")).alias(out)
    )


def collect_in_order(df: DataFrame, keys: list[str], order: list[str], value: Column) -> DataFrame:
    """Each group's values in order, ``(keys, items)``: one row, which a group has to fit."""
    fields = F.struct(*order, value.alias("_v"))
    items = F.transform(F.sort_array(F.collect_list(fields)), lambda e: e["_v"])
    return df.groupBy(*keys).agg(items.alias("items"))


def collect_pieces(
    df: DataFrame, keys: list[str], order: list[str], value: Column, size: int
) -> DataFrame:
    """Each group's values in order, cut into pieces of ``size``: ``(keys, segment, last, items)``.

    For groups that no row should hold; none is ever gathered. Copies of a value are
    interchangeable.
    """
    marked = df.withColumn("_row", F.monotonically_increasing_id())
    placed = rank_in_group(
        marked, keys, [*map(F.col, order), F.col("_row")], "_place", how="spread"
    ).withColumn("segment", F.floor(F.col("_place") / size).cast("int"))
    parts = collect_in_order(placed, [*keys, "segment"], order, value)
    # a segment is the last unless the next one has a first row
    more = placed.where((F.col("segment") > 0) & (F.col("_place") % size == 0)).select(
        *keys, (F.col("segment") - 1).alias("segment"), F.lit(True).alias("_more")
    )
    by = [*keys, "segment"]
    flagged = parts.join(
        more.select(*[F.col(k).alias(f"_k_{k}") for k in by], "_more").alias("m"),
        reduce(lambda a, b: a & b, [parts[k].eqNullSafe(F.col(f"m._k_{k}")) for k in by]),
        "left",
    )
    return flagged.select(*[parts[k] for k in by], F.col("_more").isNull().alias("last"), "items")

import math

import pytest
from pyspark.sql import functions as F

from chatloom.operators import batching as B
from chatloom.sources.writers import write_samples


def ids(spark, n, parts=4):
    return spark.range(n).withColumnRenamed("id", "doc_id").repartition(parts)


def order(df):
    return [r.doc_id for r in df.orderBy("position").collect()]


def test_epoch_is_a_permutation_that_ignores_partitions(spark):
    a = order(B.shuffle_epoch(ids(spark, 500, 1), "doc_id"))
    assert sorted(a) == list(range(500)) and a != sorted(a)
    assert a == order(B.shuffle_epoch(ids(spark, 500, 17), "doc_id"))
    assert a != order(B.shuffle_epoch(ids(spark, 500), "doc_id", epoch=1))
    positions = [r.position for r in B.shuffle_epoch(ids(spark, 500), "doc_id").collect()]
    assert sorted(positions) == list(range(500))


@pytest.mark.parametrize("n, world", [(10, 4), (3, 8), (16, 4), (1, 3)])
def test_even_shards(spark, n, world):
    ordered = B.shuffle_epoch(ids(spark, n), "doc_id")
    first = order(ordered)
    rows = B.shard(ordered, None, world, even=True).collect()
    total = math.ceil(n / world) * world
    want = [first[i % n] for i in range(total)]
    assert sorted((r.position, r.doc_id) for r in rows) == list(enumerate(want))
    for k in range(world):
        mine = sorted((r.shard_position, r.doc_id) for r in rows if r["rank"] == k)
        assert [d for _, d in mine] == want[k::world]


def test_plan_covers_each_sample_once(spark):
    plan = B.batch_plan(ids(spark, 103), "doc_id", size=5, world=3).collect()
    assert sorted(r.doc_id for r in plan) == list(range(103))
    sizes = {}
    for r in plan:
        sizes[r["rank"], r.batch] = sizes.get((r["rank"], r.batch), 0) + 1
    assert all(n == 5 for (k, b), n in sizes.items() if b < 6)
    assert {b for _, b in sizes} == set(range(7))


def test_resume_keeps_order_and_short_tail(spark):
    whole = B.batch_plan(ids(spark, 23), "doc_id", size=5).collect()
    rest = B.batch_plan(ids(spark, 23), "doc_id", size=5, skip=4).collect()
    assert {(r.step, r.doc_id) for r in rest} == {(r.step, r.doc_id) for r in whole if r.step > 4}
    assert len(rest) == 3 and {r.step for r in rest} == {5}
    assert B.batch_plan(ids(spark, 23), "doc_id", size=5, skip=5).count() == 0


def test_counts(one):
    lit = F.lit
    assert one(B.batch_count(lit(23), lit(5), lit(0)), B.batch_count(lit(23), lit(5), lit(9))) == (5, 0)
    assert one(B.rescale_step(lit(100), lit(4), lit(3)), B.rescale_step(lit(100), lit(2), lit(2))) == (133, 100)
    n, a, e = lit(23), lit(8), lit(3)
    assert one(B.optimizer_steps(n, a, e, False), B.optimizer_steps(n, a, e, True)) == (6, 9)
    assert one(B.optimizer_steps(lit(3), a, e, False)) == 1


def test_learning_rates(spark):
    for kind in ("cosine", "annealing"):
        rows = B.lr_schedule(spark, 100, 0.5, kind).orderBy("step").collect()
        assert len(rows) == 101
        assert rows[0].lr == pytest.approx(0.5) and rows[-1].lr == pytest.approx(0.05)
        assert rows[50].lr == pytest.approx(0.275)


def test_cadence(spark):
    steps = spark.range(1, 12).select(F.col("id").alias("step"), F.lit(11).alias("total"))
    rows = B.cadence(steps, log=5, save=10, refresh=4).orderBy("step").collect()
    assert [r.step for r in rows if r.logs] == [5, 10, 11]
    assert [r.step for r in rows if r.saves] == [10, 11]
    assert [r.policy_version for r in rows] == [0, 0, 0, 1, 1, 1, 1, 2, 2, 2, 2]


def test_written_shards_are_even_and_sorted(spark, tmp_path):
    path = str(tmp_path / "out")
    write_samples(B.shuffle_epoch(ids(spark, 100), "doc_id"), path, shards=4)
    back = spark.read.parquet(path).select("position", F.col("_metadata.file_name").alias("f"))
    by_file = {}
    for r in back.collect():
        by_file.setdefault(r.f, []).append(r.position)
    assert sorted(map(tuple, by_file.values())) == [tuple(range(k, k + 25)) for k in (0, 25, 50, 75)]


def test_buckets_follow_the_rows(spark):
    assert [B.digits_for(n, 100) for n in (0, 25_600, 25_601, 409_600, 409_601)] == [2, 2, 3, 3, 4]
    rows = spark.range(3000).withColumnRenamed("id", "k")
    order = {tuple(r) for r in B.shuffle_epoch(rows, "k").collect()}
    assert order == {tuple(r) for r in B.shuffle_epoch(rows, "k", bucket=1).collect()}


def test_epoch_files(spark, tmp_path):
    from chatloom.sources.writers import write_epoch

    rows = spark.range(2000).withColumnRenamed("id", "k")
    write_epoch(rows, "k", f"{tmp_path}/e", shards=5, epoch=3)
    files = spark.read.parquet(f"{tmp_path}/e")
    want = {tuple(r) for r in B.shuffle_epoch(rows, "k", epoch=3).collect()}
    assert {tuple(r) for r in files.collect()} == want
    parts = files.groupBy(F.input_file_name().alias("f")).agg(
        F.min("position").alias("a"), F.max("position").alias("b"), F.count("*").alias("n")
    )
    spans = sorted((r.a, r.b, r.n) for r in parts.collect())
    assert len(spans) == 5 and all(b - a + 1 == n for a, b, n in spans) and spans[0][0] == 0
    write_epoch(rows.limit(0), "k", f"{tmp_path}/none", shards=2)
    assert spark.read.parquet(f"{tmp_path}/none").count() == 0

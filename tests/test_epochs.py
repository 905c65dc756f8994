import os

import pytest
from pyspark.sql import functions as F

from chatloom.operators import batching as B
from chatloom.sources.epochs import EpochError, manifest, open_epoch, store_epoch


def table(spark, n):
    return spark.range(n).select(F.col("id").alias("k"), F.concat(F.lit("text "), "id").alias("text"), F.create_map(F.lit("a"), "id").alias("m"))


def rows_of(df):
    return sorted((r.position, r["rank"], r.batch, r.step, r.k, r.text) for r in df.collect())


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("epoch") / "e")
    store_epoch(table(spark, 1000), "k", path, shards=10, epoch=3)
    return path


@pytest.mark.parametrize("even", [False, True])
@pytest.mark.parametrize("world, rank, skip, until", [(1, None, 0, None), (3, None, 7, None), (4, 2, 11, 14), (3, 0, 500, None)])
def test_resume_equals_the_plan(spark, stored, world, rank, skip, until, even):
    """Rows read from the files are those of the plan for the same order."""
    ordered = B.shuffle_epoch(table(spark, 1000), "k", epoch=3)
    want = B.skip_batches(B.batches(B.shard(ordered, rank, world, even), 16), skip)
    want = want if until is None else want.where(F.col("batch") < until)
    got = open_epoch(spark, stored).steps(16, world, rank, skip, until, even)
    assert rows_of(got) == rows_of(want)


def test_only_files_that_are_needed(spark, stored):
    epoch = open_epoch(spark, stored)
    assert len(epoch.files) == 10 and epoch.total == 1000
    late = epoch.steps(10, world=2, skip=45)
    assert {f.rsplit("/", 1)[-1] for f in late.inputFiles()} == set(epoch.files_for(900, 1000))
    assert len(late.inputFiles()) < 3
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(position,900)" in plan and "Exchange" not in plan
    assert epoch.steps(10, skip=3, until=4).count() == 10


def test_more_workers_than_rows(spark, tmp_path):
    path = f"{tmp_path}/e"
    store_epoch(table(spark, 3), "k", path, shards=2)
    want = B.skip_batches(B.batches(B.shard(B.shuffle_epoch(table(spark, 3), "k"), None, 8, even=True), 1), 0)
    assert rows_of(open_epoch(spark, path).steps(1, world=8, even=True)) == rows_of(want)


def test_half_written_is_refused(spark, tmp_path):
    with pytest.raises(EpochError, match="no manifest"):
        open_epoch(spark, f"{tmp_path}/none")
    path = f"{tmp_path}/e"
    store_epoch(table(spark, 100), "k", path, shards=5)
    spark.read.parquet(f"{path}/manifest").limit(0).write.parquet(f"{tmp_path}/h/manifest")
    with pytest.raises(EpochError, match="half written"):
        open_epoch(spark, f"{tmp_path}/h")
    files = sorted(f for f in os.listdir(f"{path}/rows") if f.endswith(".parquet"))
    os.rename(f"{path}/rows/{files[2]}", f"{tmp_path}/away.parquet")
    with pytest.raises(EpochError, match="missing"):
        open_epoch(spark, path)
    with pytest.raises(Exception):
        store_epoch(table(spark, 100), "k", path, shards=5)  # a folder is never written twice


def test_damage_is_found(spark, tmp_path):
    path = f"{tmp_path}/e"
    store_epoch(table(spark, 100), "k", path, shards=5)
    assert open_epoch(spark, path).damaged().count() == 0
    name = open_epoch(spark, path).files[1].file
    other = spark.read.parquet(f"{path}/rows/{name}").withColumn("text", F.lit("changed")).coalesce(1)
    other.write.parquet(f"{tmp_path}/other")
    new = next(f for f in os.listdir(f"{tmp_path}/other") if f.endswith(".parquet"))
    os.replace(f"{tmp_path}/other/{new}", f"{path}/rows/{name}")
    crc = f"{path}/rows/.{name}.crc"
    os.replace(f"{tmp_path}/other/.{new}.crc", crc)
    assert [r.file for r in open_epoch(spark, path).damaged().collect()] == [name]
    assert open_epoch(spark, path).damaged(60).count() == 0


def test_empty_epoch(spark, tmp_path):
    path = f"{tmp_path}/e"
    store_epoch(table(spark, 0), "k", path, shards=3)
    epoch = open_epoch(spark, path)
    assert epoch.total == 0 and epoch.steps(4, world=2, even=True).count() == 0 and epoch.damaged().count() == 0
    assert manifest(spark, path).count() == 1

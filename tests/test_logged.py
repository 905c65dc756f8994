import pytest
from pyspark.sql import functions as F

from chatloom.operators import logged

KIND = "prompt_id long, gen_id int, ids array<int>, logps array<double>, at long"


def store(spark, path, rows, buckets=4, **options):
    logged.store_logps(spark.createDataFrame(rows, KIND), str(path), buckets, **options)
    return logged.open_logps(spark, str(path))


def row(p, g, n=3, ids=None, at=0):
    return (p, g, ids or list(range(n)), [-(p + g + k / 10) for k in range(n)], at)


def test_join_without_a_shuffle(spark, tmp_path):
    rows = [row(p, g) for p in range(40) for g in range(4)]
    policy, old, ref = (store(spark, tmp_path / n, rows) for n in ("policy", "old", "ref"))
    joined = logged.join_logps(policy, old=old, ref=ref)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("SortMergeJoin") == 6
    got = joined.collect()
    assert len(got) == 160 and all(r.mismatch is None and r.new_logps == r.old_logps == r.ref_logps for r in got)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("chatloom_")]


def test_mismatches_are_named_and_counted(spark, tmp_path):
    policy = [row(1, 0), row(1, 1), row(1, 2), row(1, 3), row(2, 0)]
    old = [row(1, 0), row(1, 1, n=2), row(1, 2, ids=[9, 9, 9]), row(2, 0), row(7, 0)]
    ref = [row(1, 0), row(1, 1), row(1, 2), row(1, 3)]
    a, b, c = (store(spark, tmp_path / n, r) for n, r in (("p", policy), ("o", old), ("r", ref)))
    joined = logged.join_logps(a, old=b, ref=c)
    assert {(r.prompt_id, r.gen_id): r.mismatch for r in joined.collect()} == {
        (1, 0): None,
        (1, 1): "length of old",
        (1, 2): "ids of old",
        (1, 3): "no old",
        (2, 0): "no ref",
        (7, 0): "no policy",
    }
    counts = {r.mismatch: r.rows for r in logged.mismatches(joined).collect()}
    assert counts[None] == 1 and sum(counts.values()) == 6
    assert [r.prompt_id for r in logged.usable(joined).collect()] == [1]


def test_repeated_and_null_keys(spark, tmp_path):
    rows = [row(1, 0, n=2, at=1), row(1, 0, n=4, at=2), row(1, 0, n=3, at=0), (None, 0, [1], [0.0], 0)]
    kept = store(spark, tmp_path / "a", rows, keep=["at"], order="at")
    assert [(r.prompt_id, r.n_ids, r.at) for r in kept.collect()] == [(1, 4, 2)]
    none = store(spark, tmp_path / "b", [(3, 0, [1, 2], None, 0)])
    joined = logged.join_logps(none, old=store(spark, tmp_path / "c", [row(3, 0, n=2)]))
    assert [r.mismatch for r in joined.collect()] == ["null logps of policy"]


def test_other_numbers_of_buckets_still_join(spark, tmp_path):
    rows = [row(p, 0) for p in range(50)]
    a, b = store(spark, tmp_path / "a", rows, buckets=4), store(spark, tmp_path / "b", rows, buckets=6)
    assert logged.join_logps(a, old=b).where(F.col("mismatch").isNull()).count() == 50
    empty = store(spark, tmp_path / "c", [])
    assert {r.mismatch for r in logged.join_logps(a, old=empty).collect()} == {"no old"}
    with pytest.raises(Exception):
        store(spark, tmp_path / "a", rows)
    with pytest.raises(ValueError, match="no log-probs"):
        logged.open_logps(spark, f"{tmp_path}/none")

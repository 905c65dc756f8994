import math

import pytest
from pyspark.sql import functions as F

from chatloom.operators import groups as G
from chatloom.operators import objectives as O
from chatloom.operators import preference as P
from chatloom.sources.readers import with_ids


def skewed(spark, n=600):
    """A third of the rows in one group, the rest in groups of five; nulls too."""
    i = F.col("id")
    return spark.range(n).select(
        F.when(i % 3 == 0, F.lit(-1)).when(i % 50 == 1, F.lit(None)).otherwise(F.floor(i / 10)).cast("long").alias("prompt_id"),
        i.cast("int").alias("gen_id"),
        (F.pmod(i * 7919, F.lit(13)) / 4).alias("score"),
        F.floor(i / 100).alias("batch_id"),
    )


def test_statistics(spark):
    stats = {"m": F.avg("score"), "s": F.stddev_samp("score"), "n": F.count(F.lit(1))}
    rows = G.with_group_stats(skewed(spark), ["prompt_id"], stats).collect()
    assert len(rows) == 600
    seen = {}
    for r in rows:
        seen.setdefault(r.prompt_id, []).append(r)
    for members in seen.values():
        mean = sum(r.score for r in members) / len(members)
        for r in members:
            assert r.n == len(members) and r.m == pytest.approx(mean)
    assert G.with_group_stats(skewed(spark).limit(0), ["prompt_id"], stats).count() == 0


def test_no_job_runs_before_the_table_is_touched(spark):
    tracker = spark.sparkContext.statusTracker()
    before = max([0, *tracker.getJobIdsForGroup()])
    rows = skewed(spark).withColumnRenamed("score", "reward")
    O.group_advantage(rows)
    O.agent_advantage(rows)
    G.with_group_stats(rows, ["prompt_id"], {"m": F.avg("reward")})
    P.rank(skewed(spark))
    assert max([0, *tracker.getJobIdsForGroup()]) == before


@pytest.mark.parametrize("how", ["window", "spread"])
def test_ranks_agree_both_ways(spark, how):
    ranked = P.rank(skewed(spark), how=how)
    assert dict(ranked.dtypes)["rank"] == "bigint"
    rows = ranked.collect()
    assert len(rows) == 600
    seen = {}
    for r in rows:
        seen.setdefault(r.prompt_id, []).append(r)
    for members in seen.values():
        best_first = sorted(members, key=lambda r: (-r.score, r.gen_id))
        assert [r["rank"] for r in best_first] == list(range(len(members)))


def test_ranks_ignore_partitions(spark):
    def ranks(parts):
        rows = P.rank(skewed(spark).repartition(parts), how="spread")
        return sorted((r.gen_id, r["rank"]) for r in rows.collect())

    assert ranks(1) == ranks(4) == ranks(17)


def test_ids_of_equal_rows_differ(spark):
    rows = spark.createDataFrame([("a",)] * 40 + [("b",), (None,)], "text string")
    ids = [r.doc_id for r in with_ids(rows, "doc_id").collect()]
    assert len(ids) == len(set(ids)) == 42
    assert sum(i.endswith("-0") for i in ids) == 3


def rollouts(spark, rows):
    return spark.createDataFrame(rows, "prompt_id long, gen_id int, batch_id long, reward double")


def test_group_advantage_by_hand(spark):
    rows = [(1, g, 0, r) for g, r in enumerate([1.0, 2.0, 3.0])] + [(2, g, 0, 5.0) for g in range(3)]
    got = {(r.prompt_id, r.gen_id): r.advantage for r in O.group_advantage(rollouts(spark, rows)).collect()}
    raw = [-1 / (1 + 1e-4), 0.0, 1 / (1 + 1e-4), 0.0, 0.0, 0.0]
    spread = math.sqrt(sum(x * x for x in raw) / 5)
    for (key, value), want in zip(sorted(got.items()), raw):
        assert value == pytest.approx(want / (spread + 1e-8)), key


def test_lonely_rollout_has_no_group_advantage(spark):
    rows = [(1, 0, 0, 1.0), (2, 0, 0, 1.0), (2, 1, 0, 3.0)]
    got = {r.prompt_id: r.advantage for r in O.group_advantage(rollouts(spark, rows)).collect()}
    assert got[1] is None and got[2] is not None
    pop = O.agent_advantage(rollouts(spark, rows)).collect()
    assert sorted(round(r.advantage, 3) for r in pop) == [-1.0, 0.0, 1.0]


def test_outlier_is_held_at_ten(spark):
    rows = [(1, g, g % 2, 0.0) for g in range(200)] + [(1, 200, 0, 1000.0)]
    average = 1000 / 201
    deviation = math.sqrt(((1000 - average) ** 2 + 200 * average**2) / 200)
    assert (1000 - average) / deviation > 10
    got = O.group_advantage(rollouts(spark, rows)).where("gen_id = 200").first().advantage
    # the outlier's batch: itself, held, and the even half of the others
    values = [10.0] + [-average / (deviation + 1e-4)] * 100
    mean = sum(values) / 101
    spread = math.sqrt(sum((v - mean) ** 2 for v in values) / 100)
    assert got == pytest.approx((10 - mean) / spread, rel=1e-4)
    assert sum(r.advantage for r in O.agent_advantage(rollouts(spark, rows)).collect()) == pytest.approx(0, abs=1e-6)


CHATS = [(0, 0.767578125), (1, -2.22265625)]


def test_documented_scores(spark):
    scores = spark.createDataFrame(CHATS, "chat_id long, score double")
    pairs = spark.createDataFrame([(0, 1), (1, 0), (0, 0)], "chat_1 long, chat_2 long")
    better = {(r.chat_1, r.chat_2): r.better for r in P.compare(pairs, scores).collect()}
    assert better == {(0, 1): True, (1, 0): False, (0, 0): False}
    cand = spark.createDataFrame([(9, g, s) for g, s in CHATS], "prompt_id long, gen_id int, score double")
    assert [r["rank"] for r in P.rank(cand).orderBy("gen_id").collect()] == [0, 1]


def test_order_and_rank_are_different_things(spark):
    cand = spark.createDataFrame(
        [(1, 0, 1.0), (1, 1, 3.0), (1, 2, 2.0)], "prompt_id long, gen_id int, score double"
    )
    order = [r.candidate for r in P.rank_order(cand).orderBy("place").collect()]
    ranks = [r["rank"] for r in P.rank(cand).orderBy("gen_id").collect()]
    assert order == [1, 2, 0] and ranks == [2, 0, 1]
    assert P.best_of_n(cand).first().gen_id == 1


def test_ties_go_to_the_first(spark):
    cand = spark.createDataFrame(
        [(1, g, 2.0) for g in range(4)] + [(2, 0, None), (2, 1, -5.0)],
        "prompt_id long, gen_id int, score double",
    )
    assert [r.candidate for r in P.rank_order(cand).where("prompt_id = 1").orderBy("place").collect()] == [0, 1, 2, 3]
    assert {r.prompt_id: r.gen_id for r in P.best_of_n(cand).collect()} == {1: 0, 2: 1}
    lists = {r.prompt_id: (r.candidates, r.scores) for r in P.rank_lists(cand).collect()}
    assert lists == {1: ([0, 1, 2, 3], [2.0] * 4), 2: ([1, 0], [-5.0, None])}


def test_accuracy(spark):
    pairs = spark.createDataFrame(
        [("a", 1.0, 0.0), ("a", 0.0, 0.0), ("b", 2.0, 1.0), (None, 0.0, 1.0), ("b", None, 1.0)],
        "subset string, chosen_score double, rejected_score double",
    )
    got = {(r.subset, r.overall): (r.pairs, r.unscored, r.accuracy) for r in P.preference_accuracy(pairs).collect()}
    assert got == {
        ("a", False): (2, 0, 0.5),
        ("b", False): (1, 1, 1.0),
        (None, False): (1, 0, 0.0),
        (None, True): (4, 1, 0.5),
    }

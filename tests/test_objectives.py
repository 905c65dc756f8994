import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from chatloom.functions import logps as L
from chatloom.operators import objectives as O

RNG = np.random.default_rng(5)


def close(a, b):
    assert np.allclose(a, b, rtol=1e-9, atol=1e-12)


def col(values):
    return F.array(*[F.lit(float(v)) for v in values])


def test_log_softmax(one):
    x = RNG.normal(0, 30, 12)
    x[3] = 800.0  # overflows without the shift
    want = x - x.max() - math.log(np.exp(x - x.max()).sum())
    for k in (0, 3, 11):
        close(one(L.token_logp(col(x), F.lit(k))), want[k])


def test_masked_sums(one):
    x, m = RNG.normal(size=9), RNG.integers(0, 2, 9)
    mask = F.array(*[F.lit(int(v)) for v in m])
    close(one(L.seq_logp_sum(col(x), mask)), (x * m).sum())
    close(one(L.seq_logp_mean(col(x), mask)), (x * m).sum() / m.sum())
    assert one(L.seq_logp_mean(col(x), F.array(*[F.lit(0)] * 9))) == 0.0


def test_preference_loss_is_stable(one):
    for x in (-2000.0, -3.0, 0.0, 3.0, 2000.0):
        want = np.logaddexp(0.0, -x)
        close(one(L.neg_log_sigmoid(F.lit(x))), want)
    value = one(L.dpo_row_loss(F.lit(-1.0), F.lit(-2.0), F.lit(-1.5), F.lit(-1.75), beta=0.5))
    close(value, np.logaddexp(0.0, -0.5 * (1.0 - 0.25)))


def test_token_terms(one):
    new, old, ref = (-np.abs(RNG.normal(size=8)) for _ in range(3))
    d = ref - new
    close(one(L.token_kl(col(ref), col(new))), np.exp(d) - d - 1)
    r = np.exp(new - old)
    close(one(L.ratio(col(new), col(old))), r)
    kl = np.exp(d) - d - 1
    for adv in (1.5, -0.7, 0.0):
        grpo = -(np.minimum(r * adv, np.clip(r, 0.8, 1.2) * adv) - 0.02 * kl)
        close(one(L.grpo_token_loss(col(r), col(kl), F.lit(adv))), grpo)
        cispo = -(np.minimum(r, 1.1) * adv * new - 0.1 * kl)
        close(one(L.cispo_token_loss(col(r), col(kl), col(new), F.lit(adv), 1.1, 0.1)), cispo)


def test_last_value(one):
    values = col([5.0, 6.0, 7.0])
    assert one(L.last_valid(values, F.array(*map(F.lit, [1, 1, 0])))) == 6.0


def test_empty_rows_count_or_not(spark):
    rows = spark.createDataFrame(
        [(0, [2.0, 4.0], [1, 1]), (0, [9.0, 9.0], [0, 0]), (1, [9.0], [0])],
        "batch_id long, token_loss array<double>, mask array<int>",
    )
    kept = {r.batch_id: r.loss for r in O.sequence_loss(rows).collect()}
    skipped = {r.batch_id: r.loss for r in O.sequence_loss(rows, skip_empty=True).collect()}
    assert kept == {0: 1.5, 1: 0.0} and skipped == {0: 3.0, 1: 0.0}


def test_ppo(spark):
    n = 20
    new, old, ref = (-np.abs(RNG.normal(size=n)) for _ in range(3))
    reward, value = RNG.normal(size=n), RNG.normal(size=n)
    adv = reward - value
    rows = spark.createDataFrame(
        [(0, *map(float, t)) for t in zip(new, old, ref, reward, value, adv)],
        "batch_id long, new_logp double, old_logp double, ref_logp double, reward double, value double, advantage double",
    )
    r = np.exp(new - old)
    policy = -np.minimum(r * adv, np.clip(r, 0.9, 1.1) * adv).mean()
    mse = ((value - reward) ** 2).mean()
    got = O.ppo_objective(rows).first()
    close([got.policy_loss, got.value_loss, got.kl], [policy, mse, (new - old).mean()])
    close(got.loss, policy + 0.5 * mse + 0.02 * (new - ref).mean())


def test_stats(spark):
    n = 24
    reward = RNG.normal(size=n)
    adv = RNG.normal(size=n)
    new, ref = -np.abs(RNG.normal(size=(n, 5))), -np.abs(RNG.normal(size=(n, 5)))
    mask = (np.arange(5) < RNG.integers(0, 6, (n, 1))).astype(int)
    rows = spark.createDataFrame(
        [
            (0, i // 8, float(reward[i]), float(adv[i]), new[i].tolist(), ref[i].tolist(), mask[i].tolist())
            for i in range(n)
        ],
        "batch_id long, prompt_id long, reward double, advantage double, new_logps array<double>, ref_logps array<double>, mask array<int>",
    )
    got = O.rollout_stats(rows.repartition(5)).first()
    assert got.rollouts == n
    close(got.reward, reward.mean())
    close(got.avg_response_len, mask.sum(1).mean())
    close(got.kl_ref, ((ref - new) * mask).sum() / mask.sum())
    close(got.group_reward_std, reward.reshape(3, 8).std(axis=1).mean())
    close([got.advantages_mean, got.advantages_std], [adv.mean(), adv.std(ddof=1)])


def test_stats_of_nothing(spark):
    rows = spark.createDataFrame(
        [(0, 1, 1.0, None, [-1.0], [-1.0], [0])],
        "batch_id long, prompt_id long, reward double, advantage double, new_logps array<double>, ref_logps array<double>, mask array<int>",
    )
    got = O.rollout_stats(rows).first()
    assert got.kl_ref == 0 and got.advantages_std is None and got.group_reward_std == 0


def test_loss_by_batch(spark):
    rows = spark.createDataFrame(
        [(0, -1.0, -2.0, -1.0, -1.0), (0, -1.0, -1.0, -1.0, -1.0), (1, -3.0, -1.0, -1.0, -1.0)],
        "batch_id long, policy_chosen double, policy_rejected double, ref_chosen double, ref_rejected double",
    )
    got = {r.batch_id: r.loss for r in O.dpo_loss(rows, by="batch_id").collect()}
    assert got[0] == pytest.approx((np.logaddexp(0, -0.1) + math.log(2)) / 2)
    assert O.dpo_loss(rows).first().pairs == 3

"""Advantages, objectives and statistics: A1 to A14."""

from pyspark.sql import functions as F

from chatloom.functions import logps as L
from chatloom.functions.text import uniform
from chatloom.operators import logged
from chatloom.operators import objectives as O
from chatloom.plans.common import query, r6, s_r6, s_u, s_wsum, wsum
from chatloom.plans.tokens import S_ROLL
from chatloom.session import fresh_path
from chatloom.sources import tables as D


def _sql(select: str, more: str = "", source: str = "roll") -> str:
    return f"WITH {S_ROLL}{more} SELECT {select} FROM {source}"


def s_sum(x: str) -> str:
    return f"coalesce(list_sum({x}), 0)"


_D = "CAST(v AS DOUBLE)"
_LOGIT = f"list_transform(embedding, lambda v: {_D} * 4)"


@query(
    "a01_token_logp",
    f"""SELECT vec_id, {s_r6(f"list_transform(embedding, lambda v: {_D} * 4)[label + 1] - list_max({_LOGIT}) - ln(list_sum(list_transform({_LOGIT}, lambda z: exp(z - list_max({_LOGIT})))))")} AS logp FROM embeddings""",
)
def a01(spark, sf):
    e = D.table(spark, sf, "embeddings")
    logits = F.transform("embedding", lambda v: v.cast("double") * 4)
    rows = e.select("vec_id", "label", logits.alias("logits"))
    return rows.select("vec_id", r6(L.token_logp(F.col("logits"), F.col("label"))).alias("logp"))


_MASKED = "list_transform(list_zip(new_logps, mask), lambda z: z[1] * z[2])"
_MASKED_OLD = "list_transform(list_zip(old_logps, mask), lambda z: z[1] * z[2])"
_TOKENS = "list_sum(mask)"


@query("a02_seq_logp_sum", _sql(f"vec_id, {s_r6(s_sum(_MASKED))} AS logp"))
def a02(spark, sf):
    return D.logged_rollouts(spark, sf).select(
        "vec_id", r6(L.seq_logp_sum(F.col("new_logps"), F.col("mask"))).alias("logp")
    )


@query(
    "a03_seq_logp_mean",
    _sql(f"vec_id, {s_r6(f'{s_sum(_MASKED)} / greatest({_TOKENS}, CAST(1e-8 AS DOUBLE))')} AS logp"),
)
def a03(spark, sf):
    return D.logged_rollouts(spark, sf).select(
        "vec_id", r6(L.seq_logp_mean(F.col("new_logps"), F.col("mask"))).alias("logp")
    )


def _s_mean(x: str) -> str:
    z = f"list_transform(list_zip({x}, mask), lambda z: z[1] * z[2])"
    return f"({s_sum(z)} / greatest({_TOKENS}, CAST(1e-8 AS DOUBLE)))"


@query(
    "a04_dpo_loss",
    _sql(
        f"c.batch_id, count(*) AS pairs, {s_r6('avg(greatest(-x, 0) + ln(1 + exp(-abs(x))))')} AS loss",
        f""", m AS (SELECT vec_id, batch_id, {_s_mean('new_logps')} AS p, {_s_mean('ref_logps')} AS q FROM roll),
c AS (SELECT a.batch_id, CAST(0.1 AS DOUBLE) * ((a.p - b.p) - (a.q - b.q)) AS x FROM m a JOIN m b ON b.vec_id = a.vec_id + 1 WHERE a.vec_id % 2 = 0)""",
        "c",
    )
    + " GROUP BY c.batch_id",
)
def a04(spark, sf):
    rows = D.logged_rollouts(spark, sf)
    vec = F.col("vec_id")
    side = F.struct(
        L.seq_logp_mean(F.col("new_logps"), F.col("mask")).alias("p"),
        L.seq_logp_mean(F.col("ref_logps"), F.col("mask")).alias("q"),
    )
    sides = rows.select("batch_id", F.floor(vec / 2).alias("pair"), (vec % 2 == 0).alias("first"), side.alias("s"))
    pairs = (
        sides.groupBy("batch_id", "pair")
        .agg(F.max(F.when(F.col("first"), F.col("s"))).alias("c"), F.max(F.when(~F.col("first"), F.col("s"))).alias("r"))
        .where(F.col("c").isNotNull() & F.col("r").isNotNull())
        .select(
            "batch_id",
            F.col("c.p").alias("policy_chosen"),
            F.col("r.p").alias("policy_rejected"),
            F.col("c.q").alias("ref_chosen"),
            F.col("r.q").alias("ref_rejected"),
        )
    )
    return O.dpo_loss(pairs, by="batch_id").withColumn("loss", r6(F.col("loss")))


S_ADV = """, g AS (SELECT *, (reward - avg(reward) OVER p) / (stddev_samp(reward) OVER p + 1e-4) AS raw,
  (reward - avg(reward) OVER p) / (stddev_pop(reward) OVER p + 1e-4) AS adv_pop FROM roll WINDOW p AS (PARTITION BY prompt_id)),
h AS (SELECT *, CASE WHEN raw IS NOT NULL THEN greatest(least(raw, 10.0), -10.0) END AS held FROM g),
adv AS (SELECT *, (held - avg(held) OVER b) / (stddev_samp(held) OVER b + 1e-8) AS advantage FROM h WINDOW b AS (PARTITION BY batch_id))"""


@query("a05_group_advantage", _sql(f"vec_id, {s_r6('advantage')} AS advantage", S_ADV, "adv"))
def a05(spark, sf):
    return O.group_advantage(D.logged_rollouts(spark, sf)).select(
        "vec_id", r6(F.col("advantage")).alias("advantage")
    )


@query("a05_group_advantage_hot", _sql(f"vec_id, {s_r6('advantage')} AS advantage", S_ADV, "adv"))
def a05_hot(spark, sf):
    """The way taken for groups too large for one task."""
    rows = D.logged_rollouts(spark, sf).select("vec_id", "prompt_id", "batch_id", "reward")
    return O.group_advantage(rows).select(
        "vec_id", r6(F.col("advantage")).alias("advantage")
    )


@query("a06_agent_advantage", _sql(f"vec_id, {s_r6('adv_pop')} AS advantage", S_ADV, "adv"))
def a06(spark, sf):
    return O.agent_advantage(D.logged_rollouts(spark, sf)).select(
        "vec_id", r6(F.col("advantage")).alias("advantage")
    )


@query(
    "a07_value_advantage",
    _sql(f"vec_id, {s_r6('new_logps[stop]')} AS value, {s_r6('reward - new_logps[stop]')} AS advantage"),
)
def a07(spark, sf):
    rows = D.logged_rollouts(spark, sf).withColumn("values", F.col("new_logps"))
    return O.value_advantage(rows).select(
        "vec_id", r6(F.col("value")).alias("value"), r6(F.col("advantage")).alias("advantage")
    )


_KL = "list_transform(list_zip(ref_logps, new_logps), lambda z: exp(z[1] - z[2]) - (z[1] - z[2]) - 1)"
_RATIO = "list_transform(list_zip(new_logps, old_logps), lambda z: exp(z[1] - z[2]))"


@query("a08_token_kl", _sql(f"vec_id, {s_wsum(_KL)} AS kl"))
def a08(spark, sf):
    return D.logged_rollouts(spark, sf).select(
        "vec_id", wsum(L.token_kl(F.col("ref_logps"), F.col("new_logps"))).alias("kl")
    )


@query(
    "a09_ratio",
    _sql(f"vec_id, {s_wsum(_RATIO)} AS ratio, {s_r6(f'exp({s_sum(_MASKED)} - {s_sum(_MASKED_OLD)})')} AS row_ratio"),
)
def a09(spark, sf):
    new, old, mask = F.col("new_logps"), F.col("old_logps"), F.col("mask")
    whole = F.exp(L.seq_logp_sum(new, mask) - L.seq_logp_sum(old, mask))
    return D.logged_rollouts(spark, sf).select(
        "vec_id", wsum(L.ratio(new, old)).alias("ratio"), r6(whole).alias("row_ratio")
    )


_Z = f"list_zip({_RATIO}, {_KL}, new_logps)"
_GRPO = f"list_transform({_Z}, lambda z: -(least(z[1] * advantage, greatest(least(z[1], 1.2::DOUBLE), 0.8::DOUBLE) * advantage) - 0.02::DOUBLE * z[2]))"
_CISPO = f"list_transform({_Z}, lambda z: -(least(z[1], 1.02::DOUBLE) * advantage * z[3] - 0.02::DOUBLE * z[2]))"


def _with_advantage(spark, sf):
    return O.group_advantage(D.logged_rollouts(spark, sf))


@query("a10_grpo_token_loss", _sql(f"vec_id, {s_wsum(_GRPO)} AS loss", S_ADV, "adv"))
def a10(spark, sf):
    return O.token_losses(_with_advantage(spark, sf)).select("vec_id", wsum("token_loss").alias("loss"))


@query("a11_cispo_token_loss", _sql(f"vec_id, {s_wsum(_CISPO)} AS loss", S_ADV, "adv"))
def a11(spark, sf):
    rows = O.token_losses(_with_advantage(spark, sf), "cispo", eps_high=1.02)
    return rows.select("vec_id", wsum("token_loss").alias("loss"))


_KEPT = "list_transform(mask, lambda m: CASE WHEN label = 0 THEN 0 ELSE m END)"
_ROW = f"{s_sum(f'list_transform(list_zip(tl, mk), lambda z: z[1] * z[2])')} / greatest(list_sum(mk), 1)"


@query(
    "a12_sequence_loss",
    _sql(
        f"batch_id, count(*) AS rollouts, {s_r6(f'coalesce(avg({_ROW}), 0)')} AS loss, {s_r6(f'coalesce(avg(CASE WHEN list_sum(mk) > 0 THEN {_ROW} END), 0)')} AS loss_nonempty",
        f"{S_ADV}, tl AS (SELECT batch_id, {_GRPO} AS tl, {_KEPT} AS mk FROM adv)",
        "tl",
    )
    + " GROUP BY batch_id",
)
def a12(spark, sf):
    """Rollouts of label 0 have no tokens; the two conventions differ on them."""
    kept = F.transform(
        "mask", lambda m: F.when(F.col("label") == 0, F.lit(0).cast("tinyint")).otherwise(m)
    )
    rows = O.token_losses(_with_advantage(spark, sf)).withColumn("mask", kept)
    rows = rows.select("batch_id", "token_loss", "mask")
    one = O.sequence_loss(rows)
    two = O.sequence_loss(rows, skip_empty=True).select("batch_id", F.col("loss").alias("loss_nonempty"))
    return one.join(two, "batch_id").select(
        "batch_id", "rollouts", r6(F.col("loss")).alias("loss"), r6(F.col("loss_nonempty")).alias("loss_nonempty")
    )


def _s_masked(x: str) -> str:
    return s_sum(f"list_transform(list_zip({x}, mask), lambda z: z[1] * z[2])")


@query(
    "a13_ppo_objective",
    _sql(
        f"""batch_id, {s_r6('-avg(least(r * a, greatest(least(r, 1.1::DOUBLE), 0.9::DOUBLE) * a))')} AS policy_loss, {s_r6('avg((val - reward) * (val - reward))')} AS value_loss,
  {s_r6('avg(n - o)')} AS kl, {s_r6('avg(n - f)')} AS kl_ref,
  {s_r6('-avg(least(r * a, greatest(least(r, 1.1::DOUBLE), 0.9::DOUBLE) * a)) + 0.5::DOUBLE * avg((val - reward) * (val - reward)) + 0.02::DOUBLE * avg(n - f)')} AS loss""",
        f""", s AS (SELECT batch_id, reward, {s_u('vec_id', 'value')} AS val, {_s_masked('new_logps')} AS n, {_s_masked('old_logps')} AS o, {_s_masked('ref_logps')} AS f FROM roll),
t AS (SELECT *, exp(n - o) AS r, reward - val AS a FROM s)""",
        "t",
    )
    + " GROUP BY batch_id",
)
def a13(spark, sf):
    mask = F.col("mask")
    rows = D.logged_rollouts(spark, sf).select(
        "batch_id",
        "reward",
        uniform(F.col("vec_id"), "value").alias("value"),
        *[
            L.seq_logp_sum(F.col(f"{k}_logps"), mask).alias(f"{k}_logp")
            for k in ("new", "old", "ref")
        ],
    ).withColumn("advantage", F.col("reward") - F.col("value"))
    out = O.ppo_objective(rows)
    return out.select("batch_id", *[r6(F.col(c)).alias(c) for c in out.columns if c != "batch_id"])


@query(
    "a14_rollout_stats",
    _sql(
        f"""batch_id, count(*) AS rollouts, {s_r6('avg(reward)')} AS reward, {s_r6('avg(tok)')} AS avg_response_len,
  {s_r6('sum(gap) / greatest(sum(tok), 1)')} AS kl_ref, {s_r6('(SELECT avg(sp) FROM (SELECT x.batch_id, stddev_pop(x.reward) AS sp FROM st x GROUP BY x.batch_id, x.prompt_id) y WHERE y.batch_id = st.batch_id)')} AS group_reward_std,
  {s_r6('avg(adv_pop)')} AS advantages_mean, {s_r6('stddev_samp(adv_pop)')} AS advantages_std""",
        f"{S_ADV}, st AS (SELECT batch_id, prompt_id, reward, adv_pop, list_sum(mask) AS tok, {_s_masked('list_transform(list_zip(ref_logps, new_logps), lambda z: z[1] - z[2])')} AS gap FROM adv)",
        "st",
    )
    + " GROUP BY batch_id",
)
def a14(spark, sf):
    out = O.rollout_stats(O.agent_advantage(D.logged_rollouts(spark, sf)))
    return out.select(
        "batch_id",
        "rollouts",
        *[r6(F.col(c)).alias(c) for c in out.columns if c not in ("batch_id", "rollouts")],
    )


@query(
    "a09_joined_logps",
    f"""WITH {S_ROLL}, j AS (SELECT *, CASE WHEN vec_id % 19 = 7 THEN 'no policy' WHEN vec_id % 11 = 3 THEN 'no old'
  WHEN vec_id % 13 = 5 THEN 'length of old' WHEN vec_id % 17 = 6 THEN 'ids of ref' END AS mismatch FROM roll)
SELECT prompt_id, gen_id, mismatch, CASE WHEN mismatch IS NULL THEN {s_wsum(_RATIO)} END AS ratio,
  CASE WHEN mismatch IS NULL THEN {s_wsum(_KL)} END AS kl FROM j""",
)
def a09_joined(spark, sf):
    """Log-probs of three jobs, stored apart and joined by bucket: some keys are missing, cut, or of other tokens."""
    rows, vec = D.logged_rollouts(spark, sf), F.col("vec_id")
    keys = ["prompt_id", "gen_id", "ids"]
    cut = F.when(vec % 13 == 5, F.slice("old_logps", 1, F.size("old_logps") - 1)).otherwise(F.col("old_logps"))
    other = F.when(vec % 17 == 6, F.reverse("ids")).otherwise(F.col("ids"))
    tables = {
        "policy": rows.where(vec % 19 != 7).select(*keys, F.col("new_logps").alias("logps")),
        "old": rows.where(vec % 11 != 3).select(*keys, cut.alias("logps")),
        "ref": rows.select("prompt_id", "gen_id", other.alias("ids"), F.col("ref_logps").alias("logps")),
    }
    base = fresh_path(spark, "logps")
    for name, table in tables.items():
        logged.store_logps(table, f"{base}/{name}", buckets=8)
    policy, old, ref = (logged.open_logps(spark, f"{base}/{name}") for name in tables)
    joined = logged.join_logps(policy, old=old, ref=ref)
    fine = F.col("mismatch").isNull()
    return joined.select(
        "prompt_id",
        "gen_id",
        "mismatch",
        F.when(fine, wsum(L.ratio(F.col("new_logps"), F.col("old_logps")))).alias("ratio"),
        F.when(fine, wsum(L.token_kl(F.col("ref_logps"), F.col("new_logps")))).alias("kl"),
    )

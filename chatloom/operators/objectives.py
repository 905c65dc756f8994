"""Advantages, objective values and batch statistics over logged rollouts."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.functions import logps as L
from chatloom.operators.groups import join_stats, with_group_stats


def group_advantage(rows: DataFrame) -> DataFrame:
    """Reward against its prompt's mean and sample deviation, clamped to ±10, then
    standardised over the batch. A prompt with one rollout has no sample
    deviation and gives null.

    Statistics of prompts and of batches come from the narrow columns; whole rows only
    meet the two tables of them.
    """
    narrow = rows.select("prompt_id", "batch_id", "reward")
    prompts = narrow.groupBy("prompt_id").agg(
        F.avg("reward").alias("_m"), F.stddev_samp("reward").alias("_s")
    )
    raw = (F.col("reward") - F.col("_m")) / (F.col("_s") + 1e-4)
    # least/greatest skip nulls: keep an undefined advantage undefined
    held = F.when(raw.isNotNull(), F.greatest(F.least(raw, F.lit(10.0)), F.lit(-10.0)))
    batches = (
        join_stats(narrow, prompts, ["prompt_id"], ["_m", "_s"])
        .groupBy("batch_id")
        .agg(F.avg(held).alias("_bm"), F.stddev_samp(held).alias("_bs"))
    )
    joined = join_stats(
        join_stats(rows, prompts, ["prompt_id"], ["_m", "_s"]), batches, ["batch_id"], ["_bm", "_bs"]
    )
    return joined.withColumn(
        "advantage", (held - F.col("_bm")) / (F.col("_bs") + 1e-8)
    ).select(*rows.columns, "advantage")


def agent_advantage(rows: DataFrame) -> DataFrame:
    """Reward against its prompt's mean and population deviation."""
    grouped = with_group_stats(
        rows, ["prompt_id"], {"_m": F.avg("reward"), "_s": F.stddev_pop("reward")}
    )
    return grouped.withColumn(
        "advantage", (F.col("reward") - F.col("_m")) / (F.col("_s") + 1e-4)
    ).select(*rows.columns, "advantage")


def value_advantage(rows: DataFrame) -> DataFrame:
    """Reward minus the critic's value at the last valid position."""
    value = L.last_valid(F.col("values"), F.col("mask"))
    return rows.withColumn("value", value).withColumn(
        "advantage", F.col("reward") - F.col("value")
    )


def dpo_loss(pairs: DataFrame, beta: float = 0.1, by: str | None = None) -> DataFrame:
    """Mean preference loss over pairs ``policy|ref _ chosen|rejected``."""
    row = L.dpo_row_loss(
        F.col("policy_chosen"), F.col("policy_rejected"), F.col("ref_chosen"), F.col("ref_rejected"), beta
    )
    keys = [by] if by else []
    return pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("pairs"), F.avg(row).alias("loss"))


def token_losses(rows: DataFrame, kind: str = "grpo", eps=0.2, eps_high=5.0, beta=0.02) -> DataFrame:
    """Add the per-token loss of rollouts with ``new, old, ref _logps`` and ``advantage``."""
    new, old, ref = F.col("new_logps"), F.col("old_logps"), F.col("ref_logps")
    kl, ratios = L.token_kl(ref, new), L.ratio(new, old)
    if kind == "cispo":
        loss = L.cispo_token_loss(ratios, kl, new, F.col("advantage"), eps_high, beta)
    else:
        loss = L.grpo_token_loss(ratios, kl, F.col("advantage"), eps, beta)
    return rows.withColumn("token_loss", loss)


def sequence_loss(rows: DataFrame, skip_empty: bool = False, by: str = "batch_id") -> DataFrame:
    """Token mean of each row, then the mean of rows. Rows without tokens count as
    0, or not at all with ``skip_empty`` (0 when none is left)."""
    tokens = F.aggregate("mask", F.lit(0), lambda a, m: a + m)
    loss = L.row_loss(F.col("token_loss"), F.col("mask"))
    if skip_empty:
        loss = F.when(tokens > 0, loss)
    return rows.groupBy(by).agg(
        F.count(F.lit(1)).alias("rollouts"), F.coalesce(F.avg(loss), F.lit(0.0)).alias("loss")
    )


def ppo_objective(
    rows: DataFrame, clip: float = 0.1, vf: float = 0.5, kl: float = 0.02, by: str = "batch_id"
) -> DataFrame:
    """Clipped policy term, value error, divergence and their weighted total."""
    ratio = F.exp(F.col("new_logp") - F.col("old_logp"))
    adv = F.col("advantage")
    held = F.greatest(F.least(ratio, F.lit(1 + clip)), F.lit(1 - clip))
    terms = rows.groupBy(by).agg(
        (-F.avg(F.least(ratio * adv, held * adv))).alias("policy_loss"),
        F.avg((F.col("value") - F.col("reward")) * (F.col("value") - F.col("reward"))).alias("value_loss"),
        F.avg(F.col("new_logp") - F.col("old_logp")).alias("kl"),
        F.avg(F.col("new_logp") - F.col("ref_logp")).alias("kl_ref"),
    )
    total = F.col("policy_loss") + vf * F.col("value_loss") + kl * F.col("kl_ref")
    return terms.withColumn("loss", total)


def rollout_stats(rows: DataFrame, by: str = "batch_id") -> DataFrame:
    """Batch report: reward, length, divergence per token, spread inside groups,
    advantage mean and spread. Two partial aggregations, groups then batches."""
    tokens = F.aggregate("mask", F.lit(0), lambda a, m: a + m)
    gap = F.aggregate(
        F.zip_with(
            F.zip_with("ref_logps", "new_logps", lambda r, n: r - n), "mask", lambda d, m: d * m
        ),
        F.lit(0.0),
        lambda a, x: a + x,
    )

    def total(c: Column, name: str):
        return F.sum(c).alias(name)

    adv = F.col("advantage")
    groups = (
        rows.select(by, "prompt_id", "reward", "advantage", tokens.alias("tokens"), gap.alias("gap"))
        .groupBy(by, "prompt_id")
        .agg(
            F.count(F.lit(1)).alias("n"),
            total(F.col("reward"), "r"),
            F.stddev_pop("reward").alias("spread"),
            total(F.col("tokens"), "t"),
            total(F.col("gap"), "g"),
            F.count(adv).alias("an"),
            F.avg(adv).alias("am"),
            F.var_pop(adv).alias("av"),
        )
    )
    # deviations of parts combine exactly: within plus between
    mean = F.sum(F.col("am") * F.col("an")) / F.nullif(F.sum("an"), F.lit(0))
    square = F.sum((F.col("av") + F.col("am") * F.col("am")) * F.col("an"))
    out = groups.groupBy(by).agg(
        F.sum("n").alias("rollouts"),
        (F.sum("r") / F.sum("n")).alias("reward"),
        (F.sum("t") / F.sum("n")).alias("avg_response_len"),
        (F.sum("g") / F.greatest(F.sum("t"), F.lit(1))).alias("kl_ref"),
        F.avg("spread").alias("group_reward_std"),
        mean.alias("advantages_mean"),
        F.when(
            F.sum("an") > 1,
            F.sqrt(
                F.greatest(square - mean * mean * F.sum("an"), F.lit(0.0)) / (F.sum("an") - 1)
            ),
        ).alias("advantages_std"),
    )
    return out

"""Rollouts with tool turns: joining turns, packing, padding, repeating prompts."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.functions import arrays as A
from chatloom.operators.groups import collect_in_order, with_group_stats

KEYS = ["prompt_id", "gen_id"]


def expand_generations(prompts: DataFrame, n: int) -> DataFrame:
    """Each prompt ``n`` times, numbered by ``gen_id``."""
    return prompts.select("*", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("gen_id"))


def trajectory(turns: DataFrame, pad: int, eos: int) -> DataFrame:
    """One row per rollout from its turns ``(turn, part, ids, logps)``.

    Model turns lose end and pad ids and keep their log-probs (mask 1); tool
    turns are observed (mask 0, log-prob 0).
    """
    model = F.col("part") == "model"
    kept = F.filter(
        F.arrays_zip(F.col("ids").alias("t"), F.col("logps").alias("l")),
        lambda e: (e["t"] != pad) & (e["t"] != eos),
    )
    ids = F.when(model, F.transform(kept, lambda e: e["t"])).otherwise(F.col("ids"))
    logps = F.when(model, F.transform(kept, lambda e: e["l"])).otherwise(
        F.transform("ids", lambda _: F.lit(0.0))
    )
    mask = F.transform(ids, lambda _: F.when(model, F.lit(1)).otherwise(F.lit(0)))
    turn = F.struct("part", ids.alias("ids"), logps.alias("logps"), mask.alias("mask"))
    rows = collect_in_order(turns, KEYS, ["turn"], turn)
    prompt = F.filter("items", lambda e: e["part"] == "prompt")
    answer = F.filter("items", lambda e: e["part"] != "prompt")
    return rows.select(
        *KEYS,
        _joined(prompt, "ids").alias("prompt_ids"),
        _joined(answer, "ids").alias("response_ids"),
        _joined(answer, "mask").alias("response_mask"),
        _joined(answer, "logps").alias("response_logps"),
    )


def _joined(parts, field: str) -> Column:
    return F.flatten(F.transform(parts, lambda e: e[field]))


def _zeros(like: str, value) -> Column:
    return F.transform(like, lambda _: F.lit(value))


def pack_trajectory(rows: DataFrame, max_total: int = 2500) -> DataFrame:
    """Prompt and response in one row; a row too long keeps its tail."""
    if max_total < 2:
        raise ValueError("max_total must leave room for a target")
    flat = rows.select(
        *KEYS,
        F.concat("prompt_ids", "response_ids").alias("ids"),
        F.concat(_zeros("prompt_ids", 0), F.col("response_mask")).alias("mask"),
        # one per id here; the first of a row with a prompt goes away below
        F.concat(_zeros("prompt_ids", 0.0), F.col("response_logps")).alias("logps"),
        (F.size("prompt_ids") + F.size("response_ids")).cast("bigint").alias("total"),
        (F.size("prompt_ids") > 0).alias("prompted"),
    )
    cut = F.col("total") > max_total
    logps = (
        F.when(cut, A.keep_tail(F.col("logps"), max_total - 1))
        .when(F.col("prompted"), F.slice("logps", 2, F.greatest(F.size("logps") - 1, F.lit(0))))
        .otherwise(F.col("logps"))
    )
    return flat.select(
        *KEYS,
        A.keep_tail(F.col("ids"), max_total).alias("ids"),
        A.keep_tail(F.col("mask"), max_total).alias("mask"),
        logps.alias("old_logps"),
    ).withColumn("prompt_len", A.first_one(F.col("mask")))


def pad_batch(rows: DataFrame, pads: dict, batch: str = "batch_id") -> DataFrame:
    """Pad the named array columns to the longest row of each batch."""
    width = {f"_w_{c}": F.max(F.size(c)) for c in pads}
    wide = with_group_stats(rows, [batch], width)
    return wide.select(
        *[
            A.pad_right(F.col(c), F.col(f"_w_{c}"), pads[c]).alias(c) if c in pads else F.col(c)
            for c in rows.columns
        ]
    )

"""Comparing, ranking and picking scored candidates."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.operators.groups import collect_in_order, rank_in_group


def compare(pairs: DataFrame, scores: DataFrame, with_scores: bool = False) -> DataFrame:
    """Whether the first chat of a pair scores strictly higher; a tie is false."""
    one = scores.select(F.col("chat_id").alias("chat_1"), F.col("score").alias("score_1"))
    two = scores.select(F.col("chat_id").alias("chat_2"), F.col("score").alias("score_2"))
    out = (
        pairs.join(one, "chat_1", "left")
        .join(two, "chat_2", "left")
        .withColumn("better", F.col("score_1") > F.col("score_2"))
    )
    return out if with_scores else out.drop("score_1", "score_2")


def _best_first() -> list[Column]:
    return [F.desc("score"), F.asc("gen_id")]


def rank(candidates: DataFrame, how: str = "window") -> DataFrame:
    """Each candidate's rank within its prompt, best = 0, earlier wins a tie.
    ``how="spread"`` is for prompts of more candidates than a task should hold."""
    return rank_in_group(candidates, ["prompt_id"], _best_first(), "rank", how)


def rank_order(candidates: DataFrame, how: str = "window") -> DataFrame:
    """Candidate indices from best to worst: row ``place`` holds ``candidate``.

    The index list of a prompt in long form, so a prompt with very many
    candidates is never one value. It is the inverse of ``rank``.
    """
    return rank(candidates, how).select(
        "prompt_id", F.col("rank").alias("place"), F.col("gen_id").alias("candidate"), "score"
    )


def rank_lists(candidates: DataFrame) -> DataFrame:
    """The same as arrays, best first: ``(prompt_id, candidates, scores)``, a row per prompt."""
    rows = candidates.select(
        "prompt_id", "gen_id", "score", F.col("score").isNull().alias("_none"), (-F.col("score")).alias("_by")
    )
    lists = collect_in_order(
        rows, ["prompt_id"], ["_none", "_by", "gen_id"], F.struct("gen_id", "score")
    )
    return lists.select(
        "prompt_id",
        F.transform("items", lambda e: e["gen_id"]).alias("candidates"),
        F.transform("items", lambda e: e["score"]).alias("scores"),
    )


def best_of_n(candidates: DataFrame) -> DataFrame:
    """Top candidate of each prompt. One pass, combined before the shuffle."""
    keep = [c for c in candidates.columns if c != "prompt_id"]
    best = F.max_by(F.struct(*keep), F.struct(F.col("score"), -F.col("gen_id")))
    return (
        candidates.where(F.col("score").isNotNull())
        .groupBy("prompt_id")
        .agg(best.alias("b"))
        .select("prompt_id", "b.*")
    )


def preference_accuracy(pairs: DataFrame, by: str = "subset") -> DataFrame:
    """Share of pairs whose chosen side scores higher: per subset (a null one is a subset,
    too), and overall, where ``overall`` is true. Pairs without both scores are counted in
    ``unscored`` and have no part in ``pairs`` and ``accuracy``."""
    win = F.col("chosen_score") > F.col("rejected_score")
    return pairs.rollup(by).agg(
        (F.grouping(by) == 1).alias("overall"),
        F.count(win).alias("pairs"),
        F.count_if(win.isNull()).alias("unscored"),
        F.avg(win.cast("int")).alias("accuracy"),
    )

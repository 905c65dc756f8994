"""Preference comparison and ranking: P1 to P6."""

from pyspark.sql import functions as F

from chatloom.functions.text import uniform
from chatloom.operators import answers as O
from chatloom.operators import preference as P
from chatloom.plans.common import query, r6, s_r6, s_u
from chatloom.plans.rewards import S_ANSWERS
from chatloom.plans.sources import S_PAIRS
from chatloom.sources import tables as D

# Coarse scores, so that ties occur.
S_CAND = f"""cand AS (SELECT conv_id AS prompt_id, CAST(turn AS INTEGER) AS gen_id, text,
  floor({s_u("(conv_id || '/' || turn)", 'cand')} * 3) AS score FROM conversations WHERE role = 'assistant')"""


def candidates(spark, sf):
    key = F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    return (
        D.table(spark, sf, "conversations")
        .where(F.col("role") == "assistant")
        .select(
            F.col("conv_id").alias("prompt_id"),
            F.col("turn").cast("int").alias("gen_id"),
            "text",
            F.floor(uniform(key, "cand") * 3).cast("double").alias("score"),
        )
    )


@query(
    "p01_attach_scores",
    f"""WITH {S_ANSWERS} SELECT prompt_id, gen_id, length(t) AS chars,
  CASE WHEN prompt_id % 4 <> 0 THEN {s_r6(s_u("(prompt_id || '-' || gen_id || '-full')", 'score') + ' * 8 - 4')} END AS score FROM answers""",
)
def p01(spark, sf):
    scores = D.rollout_scores(spark, sf).where(
        (F.col("part") == "full") & (F.col("prompt_id") % 4 != 0)
    )
    rows = O.attach_scores(D.answers(spark, sf), scores)
    return rows.select(
        "prompt_id",
        "gen_id",
        F.length("completion").cast("bigint").alias("chars"),
        r6(F.col("score")).alias("score"),
    )


@query(
    "p01_scorer_udf",
    f"""WITH {S_ANSWERS} SELECT prompt_id, gen_id, {s_r6("(length(t) % 97) / 10.0")} AS score FROM answers""",
)
def p01_udf(spark, sf):
    """A scorer of the user's own (here: by length) in place of a score table."""
    run = O.scorer_udf(lambda: lambda texts: [len(t) % 97 / 10.0 for t in texts])
    rows = D.answers(spark, sf).withColumn("score", run("completion"))
    return rows.select("prompt_id", "gen_id", r6(F.col("score")).alias("score"))


@query(
    "p02_compare",
    f"""WITH {S_PAIRS} SELECT pair_id, chosen_score > rejected_score AS better,
  chosen_score AS score_1, rejected_score AS score_2 FROM pairs""",
)
def p02(spark, sf):
    docs = D.table(spark, sf, "documents").select("doc_id")
    scores = docs.select(
        F.col("doc_id").alias("chat_id"),
        F.floor(uniform(F.col("doc_id"), "pref") * 20).cast("double").alias("score"),
    )
    pairs = D.doc_pairs(spark, sf).select(
        "pair_id", F.col("chosen_id").alias("chat_1"), F.col("rejected_id").alias("chat_2")
    )
    return P.compare(pairs, scores, with_scores=True).select(
        "pair_id", "better", "score_1", "score_2"
    )


_RANKED = f"WITH {S_CAND}, k AS (SELECT *, CAST(row_number() OVER (PARTITION BY prompt_id ORDER BY score DESC, gen_id) - 1 AS BIGINT) AS rank FROM cand)"


@query("p03_rank_order", f"{_RANKED} SELECT prompt_id, rank AS place, gen_id AS candidate, score FROM k")
def p03(spark, sf):
    return P.rank_order(candidates(spark, sf))


@query(
    "p03_rank_lists",
    f"""{_RANKED} SELECT prompt_id, string_agg(gen_id, ' ' ORDER BY rank) AS candidates,
  string_agg(CAST(score AS INTEGER), ' ' ORDER BY rank) AS scores FROM k GROUP BY prompt_id""",
)
def p03_lists(spark, sf):
    rows = P.rank_lists(candidates(spark, sf))
    return rows.select(
        "prompt_id",
        F.array_join(F.col("candidates").cast("array<string>"), " ").alias("candidates"),
        F.array_join(F.col("scores").cast("array<int>").cast("array<string>"), " ").alias("scores"),
    )


@query("p04_rank", f"{_RANKED} SELECT prompt_id, gen_id, score, rank FROM k")
def p04(spark, sf):
    return P.rank(candidates(spark, sf)).select("prompt_id", "gen_id", "score", "rank")


@query(
    "p04_rank_hot_groups",
    f"""WITH r AS (SELECT doc_id, source, {s_u('doc_id', 'hot')} AS score FROM documents)
SELECT source, doc_id, CAST(row_number() OVER (PARTITION BY source ORDER BY score DESC, doc_id) - 1 AS BIGINT) AS rank FROM r""",
)
def p04_hot(spark, sf):
    """Ranks inside a few very large groups, none of which goes to one task."""
    rows = D.table(spark, sf, "documents").select(
        F.col("source").alias("prompt_id"),
        F.col("doc_id").alias("gen_id"),
        uniform(F.col("doc_id"), "hot").alias("score"),
    )
    return P.rank(rows, how="spread").select(
        F.col("prompt_id").alias("source"), F.col("gen_id").alias("doc_id"), "rank"
    )


@query("p05_best_of_n", f"{_RANKED} SELECT prompt_id, gen_id, score, md5(text) AS text_md5 FROM k WHERE rank = 0")
def p05(spark, sf):
    return P.best_of_n(candidates(spark, sf)).select(
        "prompt_id", "gen_id", "score", F.md5("text").alias("text_md5")
    )


@query(
    "p06_preference_accuracy",
    f"""WITH {S_PAIRS}, q AS (SELECT nullif(subset, 'src3') AS subset,
  CASE WHEN pair_id % 9 <> 4 THEN chosen_score END AS c, rejected_score AS r FROM pairs)
SELECT subset, grouping(subset) = 1 AS overall, count(c) AS pairs, count(*) - count(c) AS unscored,
  {s_r6('avg(CASE WHEN c > r THEN 1.0 WHEN c <= r THEN 0.0 END)')} AS accuracy FROM q GROUP BY ROLLUP (subset)""",
)
def p06(spark, sf):
    """With pairs of no subset, and pairs without a score."""
    pairs = D.doc_pairs(spark, sf).withColumns(
        {
            "subset": F.nullif("subset", F.lit("src3")),
            "chosen_score": F.when(F.col("pair_id") % 9 != 4, F.col("chosen_score")),
        }
    )
    return P.preference_accuracy(pairs).withColumn("accuracy", r6(F.col("accuracy")))

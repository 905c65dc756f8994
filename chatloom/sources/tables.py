"""The given tables in this package's input shapes.

The value-making expressions are plain SQL that reads the same in any engine, so
the check queries can use the very same text.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.functions import arrays as A
from chatloom.functions.text import uniform
from chatloom.operators.chats import chats_from_turns
from chatloom.operators.groups import collect_in_order
from chatloom.session import spread

OFFERED = (
    '[{"type":"function","function":{"name":"get_current_weather"}},'
    '{"type":"function","function":{"name":"unit_converter"}},'
    '{"type":"function","function":{"name":"translate_text"}}]'
)
TOOLS = f"CASE WHEN role = 'system' AND conv_id % 3 = 0 THEN '{OFFERED}' END"
TOOL_CALLS = (
    "CASE WHEN role = 'assistant' AND (conv_id + turn) % 5 = 0 THEN "
    """'[{"name":"unit_converter","arguments":{"value":' || CAST(turn AS VARCHAR(9)) ||"""
    """ ',"from_unit":"km","to_unit":"miles"}}]' END"""
)
BROKEN_CALLS = (
    "CASE WHEN role = 'assistant' AND (conv_id + turn) % 7 = 1 THEN '[{\"name\":' "
    f"ELSE {TOOL_CALLS} END"
)
REASONING = "CASE WHEN role = 'assistant' AND conv_id % 4 = 1 THEN text END"
EMPTY_THINK = "'<think>' || chr(10) || chr(10) || '</think>' || chr(10) || chr(10)"
THINKING = (
    f"CASE WHEN role = 'assistant' AND conv_id % 2 = 0 THEN {EMPTY_THINK} || text ELSE text END"
)
# Tagged answers by conversation: right, with a blank line, unclosed, doubled, plain.
_OPEN, _CLOSE = "'<think>' || chr(10)", "chr(10) || '</think>' || chr(10)"
_ANSWER, _END = "'<answer>' || chr(10)", "chr(10) || '</answer>'"
COMPLETION = f"""CASE conv_id % 5
  WHEN 0 THEN {_OPEN} || text || {_CLOSE} || {_ANSWER} || text || {_END}
  WHEN 1 THEN {_OPEN} || text || {_CLOSE} || chr(10) || {_ANSWER} || text || {_END} || chr(10)
  WHEN 2 THEN {_OPEN} || text || {_CLOSE} || {_ANSWER} || text
  WHEN 3 THEN {_OPEN} || '<think>' || text || {_CLOSE} || {_ANSWER} || text || {_END} || '</answer>'
  ELSE text END"""
# Model turns of tool-using rollouts, by conversation and turn.
TOOL_TURN = """CASE (conv_id * 3 + turn) % 7
  WHEN 0 THEN '<think>' || text || '</think> ' || text || '<tool_call>{"name":"unit_converter","arguments":{"value":0,"from_unit":"km","to_unit":"miles"}}</tool_call>'
  WHEN 1 THEN text || '<tool_call> {"name":"get_current_weather","arguments":"{\\"location\\":\\"Paris\\"}"} </tool_call>'
  WHEN 2 THEN text || '<tool_call>{bad</tool_call><tool_call>'
  WHEN 3 THEN '<think>short one</think>' || text || '</think>'
  WHEN 4 THEN text || '<tool_call>{"name":"translate_text","arguments":{"text":"","target_language":"english"}}</tool_call> so ' || CAST(conv_id AS VARCHAR(20)) || '.50 it is'
  WHEN 5 THEN text || '<tool_call>{"name":"get_current_time"}</tool_call><tool_call>{"name":"unit_converter","arguments":{"value":null,"from_unit":"km","to_unit":"m"}}</tool_call> 1,' || CAST(100 + conv_id AS VARCHAR(20)) || ' x' || CAST(turn AS VARCHAR(20))
  ELSE text END"""
# The same text for an engine whose string literals know backslash escapes.
TOOL_TURN_SPARK = TOOL_TURN.replace("\\", "\\\\")
EOS = 7  # end id of the id rows made from numbers


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def documents(spark, sf) -> DataFrame:
    """Documents for work that is heavy per text."""
    return spread(table(spark, sf, "documents"), "doc_id")


def turns(spark, sf, calls: str = TOOL_CALLS, text: str = "text") -> DataFrame:
    return table(spark, sf, "conversations").select(
        "conv_id",
        "turn",
        "role",
        F.expr(text).alias("text"),
        F.expr(TOOLS).alias("tools"),
        F.expr(calls).alias("tool_calls"),
        F.expr(REASONING).alias("reasoning_content"),
    )


def chats(spark, sf, calls: str = TOOL_CALLS, text: str = "text") -> DataFrame:
    return chats_from_turns(turns(spark, sf, calls, text))


def answers(spark, sf) -> DataFrame:
    """Assistant turns as rollouts: the chat is the prompt, the turn the generation."""
    return (
        table(spark, sf, "conversations")
        .where(F.col("role") == "assistant")
        .select(
            F.col("conv_id").alias("prompt_id"),
            F.col("turn").cast("int").alias("gen_id"),
            F.expr(COMPLETION).alias("completion"),
        )
    )


def rollout_scores(spark, sf) -> DataFrame:
    """A model score of the whole answer and of its answer part, per rollout."""
    rows = (
        table(spark, sf, "conversations")
        .where(F.col("role") == "assistant")
        .select(F.col("conv_id").alias("prompt_id"), F.col("turn").cast("int").alias("gen_id"))
    )
    key = F.concat_ws("-", F.col("prompt_id").cast("string"), F.col("gen_id").cast("string"))
    parts = rows.select("*", F.explode(F.array(F.lit("full"), F.lit("answer"))).alias("part"))
    score = uniform(F.concat_ws("-", key, F.col("part")), "score") * 8 - 4
    return parts.withColumn("score", score)


def tool_turns(spark, sf) -> DataFrame:
    """Model turns with calls, four turns of a chat to a rollout."""
    return (
        table(spark, sf, "conversations")
        .where(F.col("role") == "assistant")
        .select(
            F.col("conv_id").alias("prompt_id"),
            F.floor(F.col("turn") / 4).cast("int").alias("gen_id"),
            "turn",
            F.expr(TOOL_TURN_SPARK).alias("text"),
        )
    )


def tool_tasks(spark, sf) -> DataFrame:
    """What a rollout with tools is judged by, one row per rollout."""
    pid, gen = F.col("prompt_id"), F.col("gen_id")
    rows = tool_turns(spark, sf).select("prompt_id", "gen_id").distinct()
    number = pid.cast("string")
    gt = (
        F.when(pid % 4 == 0, F.array().cast("array<string>"))
        .when(pid % 4 == 1, F.array(F.concat(number, F.lit(".5"))))
        .when(pid % 4 == 2, F.array((pid + 1100).cast("string"), F.lit("x3")))
        .otherwise(F.array(number, number, F.lit("IT IS")))
    )
    return rows.select(
        "prompt_id",
        "gen_id",
        ((pid + gen) % 5 == 0).alias("unfinished"),
        F.when(pid % 6 != 5, F.lit(OFFERED)).alias("tools"),
        gt.alias("gt"),
        F.when(
            pid % 3 != 0, uniform(F.concat_ws("-", number, gen.cast("string")), "agent") * 4 - 2
        ).alias("score"),
    )


def tool_rollouts(spark, sf) -> DataFrame:
    """The same with the rollout's turns as an array."""
    keys = ["prompt_id", "gen_id"]
    rows = collect_in_order(tool_turns(spark, sf), keys, ["turn"], F.col("text"))
    turns = rows.select(
        *keys, F.col("items").alias("turns"), F.element_at("items", -1).alias("response")
    )
    return turns.join(tool_tasks(spark, sf), keys)


def logged_rollouts(spark, sf) -> DataFrame:
    """Rollouts with log-probs from the number rows: eight to a prompt, eight
    prompts to a batch."""
    e = table(spark, sf, "embeddings")
    x = F.transform("embedding", lambda v: F.abs(v.cast("double")))
    ids = F.transform(x, lambda v: F.pmod(F.floor(v * 1000).cast("int"), F.lit(13)))
    vec = F.col("vec_id")
    rows = e.select(
        vec,
        F.floor(vec / 8).cast("bigint").alias("prompt_id"),
        (vec % 8).cast("int").alias("gen_id"),
        F.floor(vec / 64).cast("bigint").alias("batch_id"),
        F.transform(x, lambda v: -v).alias("new_logps"),
        F.transform(x, lambda v, i: -v * (0.9 + 0.02 * (i % 10))).alias("old_logps"),
        F.transform(x, lambda v: -v * 1.1 - 0.01).alias("ref_logps"),
        ids.alias("ids"),
        "label",
        ((F.col("label") - 4.5) / 2 + uniform(vec, "reward")).alias("reward"),
    )
    return rows.withColumn("mask", A.completion_mask(F.col("ids"), EOS))


def doc_pairs(spark, sf) -> DataFrame:
    """Documents two by two: even chosen, odd rejected, scored by a seeded draw."""
    docs = table(spark, sf, "documents")
    pair = F.floor(F.col("doc_id") / 2).cast("bigint")
    even = F.col("doc_id") % 2 == 0
    side = F.struct("doc_id", "text", "source")
    paired = (
        docs.groupBy(pair.alias("pair_id"))
        .agg(F.max(F.when(even, side)).alias("c"), F.max(F.when(~even, side)).alias("r"))
        .where(F.col("c").isNotNull() & F.col("r").isNotNull())
    )
    return paired.select(
        "pair_id",
        F.col("c.source").alias("subset"),
        F.col("c.doc_id").alias("chosen_id"),
        F.col("r.doc_id").alias("rejected_id"),
        F.col("c.text").alias("chosen_text"),
        F.col("r.text").alias("rejected_text"),
        F.floor(uniform(F.col("c.doc_id"), "pref") * 20).alias("chosen_score"),
        F.floor(uniform(F.col("r.doc_id"), "pref") * 20).alias("rejected_score"),
    )


# Log lines in the five formats, by event type; the value is the metric reported.
LOG_LINE = """CASE event_type
  WHEN 'view' THEN {f}('Epoch:[1/2](%d/200000) loss:%.6f lr:0.000500000000 epoch_Time:12.0min:', event_id, value)
  WHEN 'purchase' THEN {f}('Epoch:[2/2](%d/200000), loss: %.4f, logits_loss: %.4f, aux_loss: 0.0000, lr: 0.00050000, epoch_time: 3.5min', event_id, value, value)
  WHEN 'error' THEN {f}('Epoch: 1, Step: %d/200000, Actor Loss: %.6f, Critic Loss: %.6f, Reward: -%.6f, KL: 0.010000, KL_ref: 0.020000, Avg Response Len: 12.00, Actor LR: 1.00e-06, Critic LR: 2.00e-06', event_id, value, value, value)
  WHEN 'signup' THEN {f}('Epoch: 2, Step: %d/200000, Actor Loss: %.6f, Reward: %.6f, Avg Response Len: 31.25, LR: 3.00e-07', event_id, value, value)
  ELSE CASE WHEN event_id % 11 = 0 THEN 'saved to disk' WHEN event_id % 13 = 0 THEN 'CUDA error: OutOfMemory, CUDA error again' WHEN event_id % 17 = 0 THEN 'Task has finished'
    ELSE {f}('Epoch:[1/1](%d/200000), Reward:%.4f, KL:0.0000, GrpStd:0.5000, AdvStd:0.9000, Loss:%.4f, AvgLen:20.00, AdvMean:0.0000, LR:0.00000030', event_id, value, value) END END"""


def log_lines(spark, sf) -> DataFrame:
    """Events as log lines of one run per user; offsets only tell the order."""
    return spread(table(spark, sf, "events"), "event_id").select(
        F.concat(F.lit("run"), F.col("user_id").cast("string")).alias("run"),
        (F.col("event_id") * 1000).alias("offset"),
        F.col("ts").alias("arrived"),
        F.expr(LOG_LINE.format(f="format_string")).alias("line"),
    )


WIDE = 320  # characters of a padded line, so that offsets are exact


def one_log(spark, sf) -> DataFrame:
    """All events as a single log with lines of equal width and exact offsets."""
    return log_lines(spark, sf).select(
        F.lit("all").alias("run"),
        (F.col("offset") / 1000 * (WIDE + 1)).cast("bigint").alias("offset"),
        F.rpad("line", WIDE, ".").alias("line"),
    )

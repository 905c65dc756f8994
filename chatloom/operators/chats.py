"""Conversation tables: building, prompting, rejecting.

A chat row is ``(conv_id, conversations)``: a conversation is one record, whatever its
length, and has to fit a Spark row. ``chat_pieces`` cuts longer ones for those who ask;
``chat_stats`` gives what can be aggregated from turns without making rows of them.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.functions import chat as C
from chatloom.functions.rewards import is_json
from chatloom.functions.text import uniform
from chatloom.operators.groups import collect_in_order, collect_pieces
from chatloom.session import materialize


def _message(turns: DataFrame) -> Column:
    def text(name):
        return F.col(name) if name in turns.columns else F.lit(None).cast("string")

    return F.struct(
        F.col("role"),
        F.col("text").alias("content"),
        text("reasoning_content").alias("reasoning_content"),
        text("tools").alias("tools"),
        text("tool_calls").alias("tool_calls"),
    )


def chats_from_turns(turns: DataFrame) -> DataFrame:
    """Long form ``(conv_id, turn, role, text, …)`` to one ordered array per chat."""
    rows = collect_in_order(turns, ["conv_id"], ["turn"], _message(turns))
    return rows.withColumnRenamed("items", "conversations")


def chat_pieces(turns: DataFrame, size: int) -> DataFrame:
    """Conversations cut into ordered pieces of ``size`` turns, for those too long for a row:
    ``(conv_id, segment, last, conversations)``. A piece is no chat; the operators below
    take whole ones."""
    rows = collect_pieces(turns, ["conv_id"], ["turn"], _message(turns), size)
    return rows.withColumnRenamed("items", "conversations")


def chat_stats(turns: DataFrame) -> DataFrame:
    """What aggregates over turns, from long form: messages, characters, whether tools are on
    offer, and the tools JSON of the last system message that has one."""
    message = _message(turns)
    offers = F.coalesce(message["tools"], F.lit("")) != ""
    return turns.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("messages"),
        F.sum(F.coalesce(F.length("text"), F.lit(0))).cast("bigint").alias("chars"),
        F.coalesce(F.bool_or(offers), F.lit(False)).alias("tool_chat"),
        F.max_by(message["tools"], F.when(offers & (F.col("role") == "system"), F.col("turn"))).alias("tools"),
    )


def inject_system(
    chats: DataFrame, ratio: float = 0.2, seed="system", name: str = "Assistant"
) -> DataFrame:
    """A system prompt in front of a share of the chats without one or tools."""
    opened = C.with_system_prompt(F.col("conversations"), F.col("conv_id"), ratio, seed, name)
    return chats.withColumn("conversations", opened)


def with_reasoning(conv: Column) -> Column:
    """Splice each reasoning text in front of its answer as a think block."""
    return F.transform(
        conv,
        lambda m: m.withField(
            "content",
            F.when(
                F.coalesce(m["reasoning_content"], F.lit("")) != "",
                F.concat(
                    F.lit("<think>\n"),
                    m["reasoning_content"],
                    F.lit("\n</think>\n\n"),
                    F.coalesce(m["content"], F.lit("")),
                ),
            ).otherwise(m["content"]),
        ),
    )


def rl_prompts(
    chats: DataFrame,
    thinking_ratio: float = 0.5,
    ratio: float = 0.2,
    seed="rl",
    name="Assistant",
    render=C.render_chat,
) -> DataFrame:
    """Prompt text up to the last message, the tools on offer, and a drawn thinking switch.

    ``render`` makes the text from the messages, as ``render(conv, generation_prompt=True)``.
    """
    ready = inject_system(chats, ratio, f"{seed}/system", name)
    conv = F.col("conversations")
    return ready.select(
        "conv_id",
        render(C.drop_last(conv), generation_prompt=True).alias("prompt"),
        F.lit("").alias("answer"),
        C.tool_schema(conv).alias("tools"),
        (uniform(F.col("conv_id"), f"{seed}/thinking") < thinking_ratio).alias("open_thinking"),
    )


def agent_tasks(chats: DataFrame) -> DataFrame:
    """Messages before the last, the tools on offer, and the expected values."""
    extra = ["gt"] if "gt" in chats.columns else []
    return chats.select(
        "conv_id",
        C.drop_last(F.col("conversations")).alias("messages"),
        C.tool_schema(F.col("conversations")).alias("tools"),
        *extra,
    )


def reject_reason(conv: Column) -> Column:
    """Why a chat cannot become a sample; null when it can."""
    bad_tools = F.exists(
        conv,
        lambda m: (F.coalesce(m["tools"], F.lit("")) != "")
        & ~is_json(m["tools"]),
    )
    bad_calls = F.exists(
        conv,
        lambda m: (F.coalesce(m["tool_calls"], F.lit("")) != "")
        & ~is_json(m["tool_calls"]),
    )
    return (
        F.when(conv.isNull() | (F.size(conv) == 0), F.lit("empty conversation"))
        .when(F.exists(conv, lambda m: m["role"].isNull()), F.lit("missing role"))
        .when(bad_tools, F.lit("bad tools json"))
        .when(bad_calls, F.lit("bad tool call json"))
        .when(F.size(conv) == 1, F.lit("empty prompt"))
    )


def validate_chats(chats: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable chats, reject counts by reason). Chats are judged once and written, as both
    tables read them."""
    marked = materialize(chats.withColumn("reason", reject_reason(F.col("conversations"))))
    good = marked.where(F.col("reason").isNull()).drop("reason")
    bad = (
        marked.where(F.col("reason").isNotNull())
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("chats"))
    )
    return good, bad

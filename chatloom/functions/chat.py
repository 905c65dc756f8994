"""Conversation columns: ``ARRAY<STRUCT<role, content, reasoning_content, tools, tool_calls>>``."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatloom.functions.arrays import let
from chatloom.functions.text import BLANK, strip, uniform

START, END = "<|im_start|>", "<|im_end|>"
EMPTY_THINK = "<think>\n\n</think>\n\n"

# The ten system prompts. Four of them introduce the assistant by
# name; the name is a parameter (``{name}``).
SYSTEM_PROMPTS = [
    "你是一个知识丰富的AI，尽力为用户提供准确的信息。",
    "你是{name}，一个小巧但有用的语言模型。",
    "你是一个专业的AI助手，请提供有价值的回答。",
    "你是{name}，请尽力帮助用户解决问题。",
    "你是一个可靠的AI，请给出准确的回答。",
    "You are a helpful AI assistant.",
    "You are {name}, a lightweight intelligent assistant.",
    "You are a friendly chatbot. Please answer the user's questions carefully.",
    "You are a knowledgeable AI. Try your best to provide accurate information.",
    "You are {name}, a small but useful language model.",
]


def system_prompts(name: str = "Assistant") -> list[str]:
    return [p.replace("{name}", name) for p in SYSTEM_PROMPTS]


def message(role, content: Column) -> Column:
    role = role if isinstance(role, Column) else F.lit(role)
    empty = F.lit(None).cast("string")
    return F.struct(
        role.alias("role"),
        content.alias("content"),
        empty.alias("reasoning_content"),
        empty.alias("tools"),
        empty.alias("tool_calls"),
    )


def is_tool_chat(conv: Column) -> Column:
    return F.exists(conv, lambda m: F.coalesce(m["tools"], F.lit("")) != "")


def with_system_prompt(conv: Column, key: Column, ratio: float, seed, name: str) -> Column:
    """Put one of the ten prompts in front of a share of the chats that lack one."""
    prompts = F.array(*[F.lit(p) for p in system_prompts(name)])
    pick = F.element_at(prompts, (F.floor(uniform(key, f"{seed}/prompt") * 10) + 1).cast("int"))
    opens_with = F.get(conv, F.lit(0))["role"]
    wanted = (
        ~is_tool_chat(conv)
        & (F.size(conv) > 0)
        & (F.coalesce(opens_with, F.lit("")) != "system")
        & (uniform(key, seed) < ratio)
    )
    return F.when(wanted, F.concat(F.array(message("system", pick)), conv)).otherwise(conv)


def drop_empty_think(text: Column, key: Column, keep: float = 0.2, seed="think") -> Column:
    """Remove every empty think block from a share ``1 - keep`` of the texts."""
    drawn = uniform(key, seed) > keep
    block = F.lit(EMPTY_THINK)
    return let(
        text, lambda t: F.when(drawn & F.contains(t, block), F.replace(t, block, F.lit(""))).otherwise(t)
    )


def tool_schema(conv: Column) -> Column:
    """Tools JSON of the last system message that carries one (null if none)."""
    carriers = F.filter(
        conv, lambda m: (m["role"] == "system") & (F.coalesce(m["tools"], F.lit("")) != "")
    )
    return F.try_element_at(carriers, F.lit(-1))["tools"]


def decode_tool_calls(conv: Column) -> Column:
    """Per message: role, content and the tool calls as a variant. Bad JSON raises."""
    return F.transform(
        conv,
        lambda m: F.struct(
            m["role"].alias("role"),
            m["content"].alias("content"),
            F.parse_json(F.nullif(m["tool_calls"], F.lit(""))).alias("tool_calls"),
        ),
    )


def render_chat(
    conv: Column, generation_prompt: bool = False, start: str = START, end: str = END
) -> Column:
    """The framed messages one after another, optionally opening the next answer."""
    turns = F.transform(
        conv,
        lambda m: F.concat(
            F.lit(start), m["role"], F.lit("\n"), F.coalesce(m["content"], F.lit("")), F.lit(end + "\n")
        ),
    )
    text = F.concat_ws("", turns)
    return F.concat(text, F.lit(f"{start}assistant\n")) if generation_prompt else text


def render_tool_chat(
    conv: Column, generation_prompt: bool = False, start: str = START, end: str = END
) -> Column:
    """As ``render_chat``, with what tools add: a system message is followed by the tools it
    offers, and an answer by its calls, each as the JSON text that it is."""

    def tagged(tag, text):
        block = F.concat(F.lit(f"\n<{tag}>\n"), text, F.lit(f"\n</{tag}>"))
        return F.when(F.coalesce(text, F.lit("")) != "", block).otherwise(F.lit(""))

    def content(m):
        tools = F.when(m["role"] == "system", m["tools"])
        return F.concat(
            F.coalesce(m["content"], F.lit("")), tagged("tools", tools), tagged("tool_call", m["tool_calls"])
        )

    whole = F.transform(conv, lambda m: m.withField("content", content(m)))
    return render_chat(whole, generation_prompt, start, end)


def tool_calls(conv: Column) -> Column:
    """The calls of each message as JSON text, null for messages without; null for chats
    without any."""
    calls = F.transform(conv, lambda m: F.nullif(m["tool_calls"], F.lit("")))
    return F.when(F.exists(calls, lambda c: c.isNotNull()), calls)


def render_reward_chat(conv: Column) -> Column:
    """The form the reward scorer reads: ``<s>`` in front, ``<|reward|>`` behind."""
    return F.concat(F.lit("<s>"), render_chat(conv), F.lit("<|reward|>"))


def drop_last(conv: Column) -> Column:
    return F.slice(conv, 1, F.greatest(F.size(conv) - 1, F.lit(0)))


def parse_rendered(prompt: Column) -> Column:
    """Rendered text back to closed messages; an open last turn does not match.

    The text is searched once; role and content are cut out of each match.
    """
    pattern = r"(?s)<\|im_start\|>(?:system|user|assistant)[" + BLANK + r"]+.*?<\|im_end\|>"
    found = F.regexp_extract_all(prompt, F.lit(pattern), F.lit(0))

    def cut(match):
        inner = F.substring(match, F.lit(len(START) + 1), F.length(match) - len(START) - len(END))
        role = F.element_at(
            F.filter(
                F.array(*map(F.lit, ("system", "user", "assistant"))),
                lambda r: F.startswith(inner, r),
            ),
            1,
        )
        return message(role, strip(F.substring(inner, F.length(role) + 1, F.length(inner))))

    return F.transform(found, cut)


def append_answer(conv: Column, text: Column) -> Column:
    return F.concat(conv, F.array(message("assistant", text)))


def last_turns(conv: Column, n: int) -> Column:
    if n == 0:
        return F.slice(conv, 1, 0)
    return F.slice(conv, F.greatest(F.size(conv) - n + 1, F.lit(1)), n)


def with_bos_prompt(text: Column, bos: str = START) -> Column:
    return F.concat(F.lit(bos), text)

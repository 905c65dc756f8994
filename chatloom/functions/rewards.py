"""Rule rewards over generated answers, and tool calls read out of them."""

import sys
import unicodedata
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatloom.functions.arrays import let
from chatloom.functions.text import (
    WORD,
    after_first,
    after_last,
    before_first,
    count_of,
    strip,
    words,
)

# Tags, patterns and weights of the scoring rules.
FORMAT = r"(?s)\A<think>\n.*?\n</think>\n\n?<answer>\n.*?\n</answer>\n?\z"
ANSWER = r"(?s)<answer>(.*?)</answer>"
TOOL_CALL = r"(?s)<tool_call>(.*?)</tool_call>"
SCORED_TAGS = ["<think>", "</think>", "<answer>", "</answer>"]
NUMBER = r"[-+]?\p{Nd}+(?:\.\p{Nd}+)?"
FREE_NUMBER = rf"(?<![{WORD}.]){NUMBER}(?![{WORD}.])"

# Arguments each tool must get. "truthy" wants a non-empty,
# non-zero value; "not_null" accepts 0 and "".
TOOL_RULES = {
    "calculate_math": [("expression", "truthy")],
    "unit_converter": [("value", "not_null"), ("from_unit", "truthy"), ("to_unit", "truthy")],
    "get_current_weather": [("location", "truthy")],
    "get_current_time": [],
    "get_exchange_rate": [("from_currency", "truthy"), ("to_currency", "truthy")],
    "translate_text": [("text", "truthy"), ("target_language", "truthy")],
}


def format_reward(text: Column) -> Column:
    return F.when(text.rlike(FORMAT), F.lit(0.5)).otherwise(F.lit(0.0))


def tag_reward(text: Column) -> Column:
    once = [F.when(count_of(text, t) == 1, F.lit(0.25)).otherwise(F.lit(0.0)) for t in SCORED_TAGS]
    return reduce(lambda a, b: a + b, once)


def clip(score: Column, bound: float = 3.0) -> Column:
    """Clamp to ``±bound``; an absent score stays absent."""
    inside = F.greatest(F.least(score, F.lit(bound)), F.lit(-bound))
    return F.when(score.isNotNull(), inside)


def extract_answer(text: Column) -> Column:
    return F.when(text.rlike(ANSWER), strip(F.regexp_extract(text, ANSWER, 1)))


def blended_score(text: Column, score: Column, answer_score: Column, reasoning: bool) -> Column:
    """Model score of the whole answer, mixed with that of its answer part."""
    if not reasoning:
        return clip(score)
    mixed = clip(score) * 0.4 + clip(answer_score) * 0.6
    return F.when(text.rlike(ANSWER), mixed).otherwise(clip(score))


def repetition_penalty(text: Column, n: int = 3, cap: float = 0.5) -> Column:
    """Share of repeated word n-grams, scaled and capped. Grams are joined with a
    blank, which no token holds, so equal strings are equal grams."""
    def from_tokens(ts):
        count = F.size(ts) - (n - 1)
        grams = F.transform(
            ts, lambda w, i: F.concat_ws(" ", w, *[F.get(ts, i + k) for k in range(1, n)])
        )
        distinct = F.size(F.array_distinct(F.slice(grams, 1, F.greatest(count, F.lit(0)))))
        return F.when(
            count >= 1, F.least(F.lit(cap), (count - distinct) * F.lit(cap) * 2 / count)
        ).otherwise(F.lit(0.0))

    return let(words(text), from_tokens)


def strip_think(turn: Column) -> Column:
    """What follows the first closing think tag, stripped; else the stripped turn."""
    return strip(after_first(turn, "</think>"))


def _wrapped(text: Column, kind: str) -> Column:
    """JSON ``text`` as ``kind``, read the way writers of NaN and Infinity mean it (they come as
    text), and with repeated keys in a map's entries; null if it isn't that."""
    options = {"allowNonNumericNumbers": "true"}
    return F.from_json(F.concat(F.lit('{"v":'), text, F.lit("}")), f"struct<v:{kind}>", options)["v"]


def _last_wins(entries: Column) -> Column:
    """A map of variants as a variant object; of repeated keys the last one counts."""

    def later(e, i):
        rest = F.slice(listed, i + 2, F.size(listed))
        return ~F.exists(rest, lambda f: f["key"] == e["key"])

    listed = F.map_entries(entries)
    return F.when(entries.isNotNull(), F.to_variant_object(F.map_from_entries(F.filter(listed, later))))


def lenient_object(text: Column) -> Column:
    """A JSON object as a variant, also one that repeats a key (the last one counts) or holds
    NaN or Infinity (which become text); null for anything else."""
    return F.coalesce(F.try_parse_json(text), _last_wins(_wrapped(text, "map<string,variant>")))


def lenient_call(text: Column) -> Column:
    """As ``lenient_object``, with repeated keys inside ``arguments``, too."""

    def call(c):
        args = _last_wins(c["arguments"])
        whole = F.to_variant_object(F.struct(c["name"].alias("name"), args.alias("arguments")))
        return F.when(c["name"].isNotNull() | c["arguments"].isNotNull(), whole)

    parts = _wrapped(text, "struct<name:string,arguments:map<string,variant>>")
    return F.coalesce(lenient_object(text), let(parts, call))


def is_json(text: Column) -> Column:
    """Whether a lenient reader takes ``text``: repeated keys, NaN and Infinity are allowed."""
    return (
        F.try_parse_json(text).isNotNull()
        | _wrapped(text, "variant").isNotNull()
        | _wrapped(text, "map<string,variant>").isNotNull()
        | _wrapped(text, "array<map<string,variant>>").isNotNull()
    )


def parse_tool_calls(text: Column) -> Column:
    """Bodies of all tool calls that are JSON, as variants."""
    bodies = F.regexp_extract_all(text, F.lit(TOOL_CALL), F.lit(1))
    return F.filter(
        F.transform(bodies, lambda b: lenient_call(strip(b))), lambda c: c.isNotNull()
    )


def call_name(call: Column) -> Column:
    return F.try_variant_get(call, "$.name", "string")


def call_arguments(call: Column) -> Column:
    """Arguments object; a JSON string is decoded once more, failure gives ``{}``."""
    raw = F.try_variant_get(call, "$.arguments", "string")
    return F.coalesce(lenient_object(raw), F.parse_json(F.lit("{}")))


def _passes(args: Column, arg: str, test: str) -> Column:
    value = F.to_json(F.try_variant_get(args, f"$.{arg}", "variant"))
    present = value.isNotNull() & (value != "null")
    if test == "not_null":
        return present
    return present & ~value.isin("false", "0", "0.0", "-0.0", '""', "[]", "{}")


def offered_names(tools: Column) -> Column:
    """Distinct tool names in a tools JSON array; empty when there is none."""
    listed = F.from_json(tools, "array<struct<function:struct<name:string>>>")
    return F.array_distinct(
        F.coalesce(F.transform(listed, lambda t: t["function"]["name"]), F.array().cast("array<string>"))
    )


def passes_rules(call: Column, rules=None) -> Column:
    """Known, and all required arguments given."""
    rules = TOOL_RULES if rules is None else rules

    def judge(c):
        check = F.lit(False)
        for tool, needs in rules.items():
            ok = reduce(lambda a, b: a & b, [_passes(c["args"], a, t) for a, t in needs], F.lit(True))
            check = F.when(c["name"] == tool, ok).otherwise(check)
        return F.coalesce(check, F.lit(False))

    name = F.coalesce(call_name(call), F.lit(""))
    return let(F.struct(name.alias("name"), call_arguments(call).alias("args")), judge)


def valid_call(call: Column, offered: Column, rules=None) -> Column:
    """Offered, known, and all required arguments given."""
    name = F.coalesce(call_name(call), F.lit(""))
    return F.array_contains(offered, name) & passes_rules(call, rules)


def unpaired_tags(turn: Column) -> Column:
    return F.abs(count_of(turn, "<tool_call>") - count_of(turn, "</tool_call>"))


def tag_imbalance(turns: Column) -> Column:
    """-0.5 for every unpaired tool-call tag, turn by turn (turns think-stripped)."""
    gaps = F.transform(turns, unpaired_tags)
    return F.aggregate(gaps, F.lit(0), lambda a, x: a + x) * F.lit(-0.5)


def length_reward(text: Column) -> Column:
    return F.when(F.length(strip(text)).between(5, 800), F.lit(0.5)).otherwise(F.lit(-0.5))


def think_reward(text: Column) -> Column:
    """Length and closure of the thinking part; 0 when it is never closed. The
    part before the tag keeps its opening tag, which counts in the length."""
    size = F.length(strip(before_first(text, "</think>")))
    closed = count_of(text, "</think>")
    points = F.when(size.between(20, 300), F.lit(1.0)).otherwise(F.lit(-0.5)) + F.when(
        closed == 1, F.lit(0.25)
    ).otherwise(F.lit(-0.25))
    return F.when(closed > 0, points).otherwise(F.lit(0.0))


def tool_gap_reward(calls: Column, valid: Column, wanted: Column) -> Column:
    gap = F.abs(valid - wanted) + F.greatest(F.lit(0), calls - valid)
    return F.when(gap == 0, F.lit(0.5)).otherwise(gap * F.lit(-0.5))


def _other_digits() -> tuple[str, str]:
    """Decimal digits of all scripts but ASCII, and what they read as."""
    found = [chr(c) for c in range(128, sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Nd"]
    return "".join(found), "".join(str(unicodedata.digit(c)) for c in found)


OTHER_DIGITS = _other_digits()


def _as_double(number: Column) -> Column:
    plain = F.when(number.rlike(r"^[\x00-\x7F]*$"), number).otherwise(F.translate(number, *OTHER_DIGITS))
    return plain.try_cast("double")


def free_numbers(text: Column) -> Column:
    """Numbers that stand alone, thousands commas removed first."""
    plain = F.replace(text, F.lit(","), F.lit(""))
    return F.transform(F.regexp_extract_all(plain, F.lit(FREE_NUMBER), F.lit(0)), _as_double)


def gt_found(text: Column, gt: Column) -> Column:
    """Distinct expected values present as text (any case) or as a number (1e-6)."""

    def search(seen):
        def one(g):
            s = strip(g)
            bare = F.replace(s, F.lit(","), F.lit(""))
            as_text = (s != "") & F.contains(seen["lower"], F.lower(s))
            as_number = bare.rlike(rf"\A{NUMBER}\z") & F.exists(
                seen["numbers"], lambda x: F.abs(_as_double(bare) - x) < 1e-6
            )
            return F.coalesce(as_text, F.lit(False)) | F.coalesce(as_number, F.lit(False))

        return F.filter(F.array_distinct(gt), one)

    seen = F.struct(F.lower(text).alias("lower"), free_numbers(text).alias("numbers"))
    return let(seen, search)


def gt_match(text: Column, gt: Column) -> Column:
    """2.5 times the share found; repeats in ``gt`` lower it, since finds are distinct."""
    return F.when(F.size(gt) > 0, F.lit(2.5) * F.size(gt_found(text, gt)) / F.size(gt)).otherwise(
        F.lit(0.0)
    )


def final_text(answer: Column, unfinished: Column) -> Column:
    return F.when(unfinished, F.lit("")).otherwise(after_last(answer, "</tool_call>"))


def tool_result_text(result_json: Column) -> Column:
    """Result as text, cut to 2,048 characters; the error object if there is none."""
    missing = F.lit('{"error": "tool not found"}')
    return F.left(F.coalesce(result_json, missing), F.lit(2048))

"""Rewards of whole rollouts: reasoning answers, tool-using answers, tool lookups."""

import json
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.functions import rewards as R
from chatloom.functions.arrays import let
from chatloom.functions.text import after_first, strip

KEYS = ["prompt_id", "gen_id"]


def attach_scores(rows: DataFrame, scores: DataFrame, keys=None) -> DataFrame:
    """Model scores from a table ``(keys, score)``; unscored rows keep a null."""
    keys = KEYS if keys is None else keys
    return rows.join(scores.select(*keys, "score"), keys, "left")


def scorer_udf(load):
    """A scorer of the user's own: ``load()`` runs once per Python worker and
    returns ``list of texts -> list of scores``; rows come in Arrow batches."""
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        run = load()
        for texts in batches:
            yield pd.Series(run(texts.tolist()), dtype="float64")

    return score


def score_parts(scores: DataFrame) -> DataFrame:
    """Long ``(keys, part, score)`` to one row per rollout. At most one row per
    part, so the group is two rows."""
    return scores.groupBy(*KEYS).agg(
        F.max(F.when(F.col("part") == "full", F.col("score"))).alias("score"),
        F.max(F.when(F.col("part") == "answer", F.col("score"))).alias("answer_score"),
    )


def reasoning_reward(rollouts: DataFrame, scores: DataFrame, reasoning: bool = True) -> DataFrame:
    """Format and tag points plus the blended model score, per rollout."""
    scored = rollouts.join(score_parts(scores), KEYS, "left")
    text = F.col("completion")
    total = R.blended_score(text, F.col("score"), F.col("answer_score"), reasoning)
    if reasoning:
        total = R.format_reward(text) + R.tag_reward(text) + total
    return scored.withColumn("reward", total).drop("score", "answer_score")


def _agent_total(calls: Column, valid: Column, tags: Column, answer: Column) -> Column:
    """Reward of a rollout from what its turns add up to and its last answer."""
    response = F.col("response")
    spoken = F.when(
        F.contains(response, F.lit("</think>")), strip(after_first(response, "</think>"))
    ).otherwise(answer)
    plain = (
        R.length_reward(response)
        + R.think_reward(response)
        + F.coalesce(F.col("score"), F.lit(0.0))
        - R.repetition_penalty(spoken)
    )
    last = R.final_text(answer, F.col("unfinished"))
    tooled = (
        R.tool_gap_reward(calls, valid, F.size("gt"))
        + R.gt_match(last, F.col("gt"))
        - F.when(F.col("unfinished"), F.lit(0.5)).otherwise(F.lit(0.0))
        - R.repetition_penalty(F.when(last != "", last).otherwise(answer))
    )
    return R.clip(tags + F.when(calls == 0, plain).otherwise(tooled))


def agent_reward(rollouts: DataFrame) -> DataFrame:
    """Reward of a tool-using rollout ``(turns, response, unfinished, tools, gt, score)``.

    ``turns`` are the model's texts, ``response`` the last of them, ``tools`` the
    tools JSON, ``score`` a model score of the no-call answer (null: none).
    """
    read = rollouts.withColumn("_answers", F.transform("turns", R.strip_think))
    read = read.withColumn(
        "_answer",
        F.coalesce(F.try_element_at("_answers", F.lit(-1)), strip(F.col("response"))),
    ).withColumn("_names", R.offered_names(F.col("tools")))
    calls = F.flatten(F.transform("_answers", R.parse_tool_calls))
    # one flag per call: its size and its true entries are all the rules need
    read = read.withColumn("_valid", F.transform(calls, lambda c: R.valid_call(c, F.col("_names"))))
    n_calls = F.size("_valid")
    n_valid = F.size(F.filter("_valid", lambda v: v))
    total = _agent_total(n_calls, n_valid, R.tag_imbalance(F.col("_answers")), F.col("_answer"))
    return read.select(
        *rollouts.columns,
        n_calls.alias("calls"),
        n_valid.alias("valid_calls"),
        total.alias("reward"),
    )


def agent_reward_from_turns(turns: DataFrame, rollouts: DataFrame) -> DataFrame:
    """The same from long form: ``turns`` are ``(keys, turn, text)``, ``rollouts`` are
    ``(keys, unfinished, tools, gt, score)``.

    Turns are never gathered. Calls and tags add up by partial aggregation, calls by
    name first, so that the tools on offer meet a count and not every call.
    """
    read = turns.select(*KEYS, "turn", "text", R.strip_think(F.col("text")).alias("answer"))
    judged = F.transform(
        R.parse_tool_calls(F.col("answer")),
        lambda c: F.struct(
            F.coalesce(R.call_name(c), F.lit("")).alias("name"), R.passes_rules(c).alias("ok")
        ),
    )
    read = read.withColumn("calls", judged)
    sums = read.groupBy(*KEYS).agg(
        F.sum(F.size("calls")).alias("calls"),
        (F.sum(R.unpaired_tags(F.col("answer"))) * F.lit(-0.5)).alias("_tags"),
        F.max_by(F.struct("text", "answer"), F.col("turn")).alias("_last"),
    )
    passed = (
        read.select(*KEYS, F.inline("calls"))
        .where("ok")
        .groupBy(*KEYS, "name")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    offered = rollouts.select(*KEYS, F.explode(R.offered_names(F.col("tools"))).alias("name"))
    valid = (
        passed.join(offered, [*KEYS, "name"]).groupBy(*KEYS).agg(F.sum("n").alias("valid_calls"))
    )
    rows = (
        rollouts.join(sums, KEYS)
        .join(valid, KEYS, "left")
        .withColumn("response", F.col("_last.text"))
        .fillna(0, ["valid_calls"])
    )
    total = _agent_total(F.col("calls"), F.col("valid_calls"), F.col("_tags"), F.col("_last.answer"))
    return rows.select(*rollouts.columns, "calls", "valid_calls", total.alias("reward"))


# The lookup tables behind the five lookup tools.
WEATHER = [
    ("北京", "28°C", "晴"), ("上海", "15°C", "多云"), ("广州", "32°C", "闷热"),
    ("深圳", "30°C", "晴"), ("杭州", "22°C", "阴"), ("成都", "18°C", "小雨"),
    ("武汉", "25°C", "多云"), ("南京", "20°C", "晴"), ("西安", "16°C", "大风"),
    ("重庆", "26°C", "阴"), ("Tokyo", "12°C", "晴"), ("New York", "8°C", "多云"),
    ("London", "5°C", "小雨"), ("Paris", "10°C", "阴"), ("Sydney", "25°C", "晴朗"),
]
TIMES = [
    ("Asia/Shanghai", "2025-03-07 14:30:00"), ("America/New_York", "2025-03-07 01:30:00"),
    ("Europe/London", "2025-03-07 06:30:00"), ("Asia/Tokyo", "2025-03-07 15:30:00"),
    ("Europe/Paris", "2025-03-07 07:30:00"), ("Australia/Sydney", "2025-03-07 17:30:00"),
]
RATES = [
    ("USD", "CNY", 7.21), ("EUR", "CNY", 7.85), ("GBP", "CNY", 9.12), ("JPY", "CNY", 0.048),
    ("USD", "EUR", 0.92), ("USD", "GBP", 0.79), ("CNY", "JPY", 20.83), ("AUD", "CNY", 4.72),
]
TRANSLATIONS = [
    ("你好世界", "english", "Hello World"), ("Good morning", "chinese", "早上好"),
    ("今天天气真好", "english", "The weather is nice today"),
    ("I love programming", "chinese", "我喜欢编程"),
    ("机器学习很有趣", "english", "Machine learning is interesting"),
    ("Happy birthday", "chinese", "生日快乐"),
]
UNITS = [
    ("km_miles", 0.621371), ("miles_km", 1.60934), ("kg_pounds", 2.20462),
    ("pounds_kg", 0.453592), ("meters_feet", 3.28084), ("feet_meters", 0.3048),
    ("celsius_fahrenheit", 1.8), ("fahrenheit_celsius", 0.5556),
]
DEFAULT_TIME = "2025-03-07 14:30:00"
DEFAULT_ZONE = "Asia/Shanghai"


# What a lookup tool is asked by, and what it answers.
_DIMS = {
    "weather": (WEATHER, "location string, temp string, cond string"),
    "time": (TIMES, "tz string, ts string"),
    "rate": (RATES, "c_from string, c_to string, rate double"),
    "translation": (TRANSLATIONS, "t_text string, t_lang string, t_out string"),
    "unit": (UNITS, "pair string, factor double"),
}
_KEYS = {"weather": ["_loc"], "time": ["_tz"], "rate": ["_cf", "_ct"], "translation": ["_text", "_lang"], "unit": ["_pair"]}


def tool_dims(spark) -> dict[str, DataFrame]:
    return {name: spark.createDataFrame(rows, kind) for name, (rows, kind) in _DIMS.items()}


def _entry(name: str) -> Column:
    """The entry of a fixed table, of fifteen at most, that a call asks for: the table is a constant in the plan."""
    entries, kind = _DIMS[name]
    columns, keys = [c.split()[0] for c in kind.split(", ")], _KEYS[name]
    table = {"\x00".join(e[: len(keys)]): dict(zip(columns, e, strict=True)) for e in entries}  # the sign is in no key
    constant = F.from_json(F.lit(json.dumps(table, ensure_ascii=False)), f"map<string,struct<{kind.replace(' ', ':')}>>".replace(",:", ","))
    key = F.concat(*[x for k in keys for x in (F.lit("\x00"), F.col(k))][1:])  # null if a part is
    return F.try_element_at(constant, key)


def _looked_up(rows: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """``rows`` with the columns of all lookup tables, null where a table has no entry.

    Fixed tables are looked up, the user's own are joined; how is left to Spark, which knows
    their bytes.
    """
    fixed = [name for name in _DIMS if name not in dims]
    rows = rows.select("*", *[_entry(name).alias(f"_{name}") for name in fixed])
    rows = rows.select("*", *[f"_{name}.*" for name in fixed])
    for name, table in dims.items():
        columns = [c.split()[0] for c in _DIMS[name][1].split(", ")]
        same = [F.col(k) == F.col(c) for k, c in zip(_KEYS[name], columns, strict=False)]
        rows = rows.join(table, reduce(lambda x, y: x & y, same), "left")
    return rows


def _quoted(text: Column) -> Column:
    """A JSON string, or ``null``."""
    packed = F.to_json(F.struct(text.alias("v")))
    inner = F.substring(packed, F.lit(6), F.length(packed) - 6)
    return F.when(text.isNull(), F.lit("null")).otherwise(inner)


def _number(x: Column) -> Column:
    """A double the way a JSON writer prints it: its shortest digits, plain from 1e-4 up to
    1e16 and with an exponent of at least two digits outside."""

    def parts(short):
        """Digits and exponent of the shortest text, as of ``-1.25E-7``."""
        mantissa = F.regexp_extract(short, r"^-?([0-9.]+)", 1)
        whole = F.regexp_extract(mantissa, r"^([0-9]+)", 1)
        fraction = F.regexp_replace(F.regexp_extract(mantissa, r"\.([0-9]*)", 1), "0+$", "")
        power = F.coalesce(F.regexp_extract(short, r"E(-?[0-9]+)$", 1).try_cast("int"), F.lit(0))
        sign = F.when(F.startswith(short, F.lit("-")), F.lit("-")).otherwise(F.lit(""))
        return F.struct(
            sign.alias("sign"), whole.alias("whole"), fraction.alias("fraction"), power.alias("power")
        )

    def shifted(p):
        digits = F.concat(p["whole"], p["fraction"])
        point = F.length(p["whole"]) + p["power"]  # digits before the point
        left = F.when(point <= 0, F.lit("0")).otherwise(F.rpad(F.substring(digits, F.lit(1), point), point, "0"))
        right = F.when(
            point <= 0, F.concat(F.repeat(F.lit("0"), -point), F.regexp_replace(digits, "0+$", ""))
        ).otherwise(F.regexp_replace(F.substring(digits, point + 1, F.length(digits)), "0+$", ""))
        return F.concat(p["sign"], left, F.lit("."), F.when(right == "", F.lit("0")).otherwise(right))

    def scientific(p):
        mantissa = F.when(p["fraction"] == "", p["whole"]).otherwise(
            F.concat(p["whole"], F.lit("."), p["fraction"])
        )
        mark = F.when(p["power"] < 0, F.lit("e-")).otherwise(F.lit("e+"))
        return F.concat(p["sign"], mantissa, mark, F.when(F.abs(p["power"]) < 10, F.lit("0")).otherwise(F.lit("")), F.abs(p["power"]).cast("string"))

    def text(p):
        plain = (x == 0) | ((F.abs(x) >= 1e-4) & (F.abs(x) < 1e16))
        return F.when(plain, shifted(p)).otherwise(scientific(p))

    # most numbers are printed plainly as they are
    as_is = (x == 0) | ((F.abs(x) >= 1e-3) & (F.abs(x) < 1e7))
    return F.when(x.isNotNull(), F.when(as_is, x.cast("string")).otherwise(let(parts(x.cast("string")), text)))


def tool_lookup(
    calls: DataFrame, dims: dict[str, DataFrame] | None = None
) -> DataFrame:
    """Resolve lookup calls ``(name, call)``, with the call as a variant, to
    ``result`` JSON.

    Lookups with defaults for what is not listed. Unknown tools give null. ``dims`` replaces
    fixed tables by the user's own.
    """
    arg = F.col("_args")

    def text(field):
        return F.try_variant_get(arg, f"$.{field}", "string")

    rows = calls.withColumn("_args", R.call_arguments(F.col("call"))).select(
        *calls.columns,
        text("location").alias("_loc"),
        F.coalesce(text("timezone"), F.lit(DEFAULT_ZONE)).alias("_tz"),
        text("from_currency").alias("_cf"),
        text("to_currency").alias("_ct"),
        text("text").alias("_text"),
        text("target_language").alias("_lang"),
        # absent counts as 0; present but not a number fails the call
        F.when(F.try_variant_get(arg, "$.value", "variant").isNull(), F.lit(0.0))
        .otherwise(F.try_variant_get(arg, "$.value", "double"))
        .alias("_value"),
        F.concat_ws(
            "_",
            F.lower(F.coalesce(text("from_unit"), F.lit(""))),
            F.lower(F.coalesce(text("to_unit"), F.lit(""))),
        ).alias("_pair"),
    )
    rows = _looked_up(rows, dims or {})

    def obj(*fields):
        parts = []
        for i, (label, value) in enumerate(fields):
            parts += [F.lit(("{" if i == 0 else ", ") + f'"{label}": '), value]
        return F.concat(*parts, F.lit("}"))

    converted = F.round(F.col("_value") * F.coalesce("factor", F.lit(1.0)), 4)
    name = F.col("name")
    number = F.when(name == "get_exchange_rate", F.coalesce("rate", F.lit(1.0))).when(name == "unit_converter", converted)
    # one number to a call, printed in one place: the plan stays small
    rows = rows.withColumn("_num", number).withColumn("_num", _number(F.col("_num")))
    result = (
        F.when(
            name == "get_current_weather",
            obj(
                ("city", _quoted(F.col("_loc"))),
                ("temperature", _quoted(F.coalesce("temp", F.lit("22°C")))),
                ("humidity", F.lit('"65%"')),
                ("condition", _quoted(F.coalesce("cond", F.lit("晴")))),
            ),
        )
        .when(
            name == "get_current_time",
            obj(
                ("datetime", _quoted(F.coalesce("ts", F.lit(DEFAULT_TIME)))),
                ("timezone", _quoted(F.col("_tz"))),
            ),
        )
        .when(
            name == "get_exchange_rate",
            obj(
                ("from", _quoted(F.col("_cf"))),
                ("to", _quoted(F.col("_ct"))),
                ("rate", F.col("_num")),
            ),
        )
        .when(
            name == "translate_text",
            obj(("translated_text", _quoted(F.coalesce("t_out", "_text", F.lit(""))))),
        )
        .when(name == "unit_converter", obj(("result", F.col("_num"))))
    )
    return rows.select(*calls.columns, result.alias("result"))

"""Fixed values, written out a second time: patterns against Python's own on random texts,
constants as literals."""

import random
import re

from pyspark.sql import functions as F

from chatloom.functions import rewards as R
from chatloom.functions import text as T

PARTS = [
    "a", "B", "_", "1", "12.5", "-3", "+", ".", ",", " ", "\n", "é", "中", "x7", "٣", "-", "7.", "(", "<think>", "</think>",
    " ", "　", "１", "ª", "<answer>", "</answer>", "<tool_call>", "</tool_call>",
]


def texts(n=400, seed=11, parts=PARTS):
    rng = random.Random(seed)
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def table(spark, rows):
    return spark.createDataFrame([(t,) for t in rows], "t string")


def test_words_and_marks(spark):
    for r in table(spark, texts()).select("t", T.words(F.col("t")).alias("w")).collect():
        assert r.w == re.findall(r"\w+|[^\w\s]", r.t.lower()), r.t


def test_free_numbers(spark):
    for r in table(spark, texts(seed=2)).select("t", R.free_numbers(F.col("t")).alias("n")).collect():
        plain = r.t.replace(",", "")
        assert r.n == [float(x) for x in re.findall(r"(?<![\w.])[-+]?\d+(?:\.\d+)?(?![\w.])", plain)], r.t


def test_format(spark):
    one = r"^<think>\n.*?\n</think>\n<answer>\n.*?\n</answer>$"
    two = r"^<think>\n.*?\n</think>\n\n<answer>\n.*?\n</answer>$"
    parts = ["<think>", "\n", "a", "</think>", "\n\n", "<answer>", "</answer>"]
    frames = ["<think>\n{}\n</think>\n{}<answer>\n{}\n</answer>{}".format(*(random.Random(k).choice(["", "x", "\n", "\n\n"]) for k in range(i, i + 4))) for i in range(120)]
    rows = frames + texts(200, 4, parts)
    got = table(spark, rows).select("t", R.format_reward(F.col("t")).alias("r")).collect()
    for r in got:
        assert r.r == (0.5 if re.match(one, r.t, re.S) or re.match(two, r.t, re.S) else 0.0), r.t
    assert {r.r for r in got} == {0.0, 0.5}


def test_answers_and_calls(spark):
    rows = table(spark, texts(seed=7)).select(
        "t",
        R.extract_answer(F.col("t")).alias("a"),
        F.regexp_extract_all("t", F.lit(R.TOOL_CALL), F.lit(1)).alias("c"),
    )
    for r in rows.collect():
        m = re.search(r"<answer>(.*?)</answer>", r.t, re.DOTALL)
        assert r.a == (m.group(1).strip() if m else None), r.t
        assert r.c == re.findall(r"<tool_call>(.*?)</tool_call>", r.t, re.DOTALL)


def test_blanks_are_those_of_str_strip():
    assert set(T.BLANKS) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


def test_tool_rules():
    assert R.TOOL_RULES == {
        "calculate_math": [("expression", "truthy")],
        "unit_converter": [("value", "not_null"), ("from_unit", "truthy"), ("to_unit", "truthy")],
        "get_current_weather": [("location", "truthy")],
        "get_current_time": [],
        "get_exchange_rate": [("from_currency", "truthy"), ("to_currency", "truthy")],
        "translate_text": [("text", "truthy"), ("target_language", "truthy")],
    }
    assert R.SCORED_TAGS == ["<think>", "</think>", "<answer>", "</answer>"]

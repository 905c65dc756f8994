import json
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from chatloom.functions import rewards as R
from chatloom.operators import answers as O


@pytest.mark.parametrize(
    "text, want",
    [
        ("<think>\na\n</think>\n<answer>\nb\n</answer>", 0.5),
        ("<think>\na\n</think>\n\n<answer>\nb\n</answer>", 0.5),
        ("<think>\na\n</think>\n<answer>\nb\n</answer>\n", 0.5),
        ("<think>\na\n</think>\n<answer>\nb\n</answer>\n\n", 0.0),
        (" <think>\na\n</think>\n<answer>\nb\n</answer>", 0.0),
        ("<think>a</think><answer>b</answer>", 0.0),
        ("", 0.0),
    ],
)
def test_format(one, text, want):
    assert one(R.format_reward(F.lit(text))) == want


def test_tags(one):
    assert one(R.tag_reward(F.lit("<think></think><answer></answer>"))) == 1.0
    assert one(R.tag_reward(F.lit("<think><think></think>"))) == 0.25
    assert one(R.tag_reward(F.lit(""))) == 0.0


def test_clip_keeps_null(one):
    null = F.lit(None).cast("double")
    assert one(R.clip(F.lit(9.0)), R.clip(F.lit(-9.0)), R.clip(F.lit(1.5)), R.clip(null)) == (3.0, -3.0, 1.5, None)


def test_extract_answer(one):
    assert one(R.extract_answer(F.lit("x<answer>\n a \n</answer><answer>b</answer>"))) == "a"
    assert one(R.extract_answer(F.lit("</answer>x<answer>"))) is None
    assert one(R.extract_answer(F.lit("<answer></answer>"))) == ""


def penalty(text, n=3, cap=0.5):
    words = re.findall(r"\w+|[^\w\s]", text.lower())
    seen = Counter(zip(*(words[k:] for k in range(n))))
    repeats = sum(times - 1 for times in seen.values())
    return min(cap, 2 * cap * repeats / seen.total()) if seen else 0.0


@pytest.mark.parametrize(
    "text", ["a b c a b c a b c", "one two", "", "a b c d", "你好 你好 你好 你好", "A a A a a a", "x. y. x. y. x."]
)
def test_penalty(one, text):
    assert one(R.repetition_penalty(F.lit(text))) == pytest.approx(penalty(text))
    assert one(R.repetition_penalty(F.lit(text), n=2, cap=0.3)) == pytest.approx(penalty(text, 2, 0.3))


def test_strip_think(one):
    assert one(R.strip_think(F.lit("a</think> b </think> c "))) == "b </think> c"
    assert one(R.strip_think(F.lit("  no tag\n"))) == "no tag"


CALLS = (
    'x<tool_call>{"name":"a","arguments":{"k":1}}</tool_call>'
    "<tool_call>nonsense</tool_call>"
    '<tool_call>\n{"name":"b","arguments":"{\\"k\\": 2}"}\n</tool_call>'
    '<tool_call>{"name":"c","arguments":"oops"}</tool_call><tool_call>7</tool_call>'
)


def test_calls_and_arguments(one):
    calls = R.parse_tool_calls(F.lit(CALLS))
    read = F.transform(
        calls, lambda c: F.struct(R.call_name(c).alias("n"), F.to_json(R.call_arguments(c)).alias("a"))
    )
    assert [tuple(r) for r in one(read)] == [("a", '{"k":1}'), ("b", '{"k":2}'), ("c", "{}"), (None, "{}")]


@pytest.mark.parametrize(
    "name, arguments, want",
    [
        ("calculate_math", '{"expression":"1+1"}', True),
        ("calculate_math", '{"expression":""}', False),
        ("calculate_math", "{}", False),
        ("unit_converter", '{"value":0,"from_unit":"km","to_unit":"m"}', True),
        ("unit_converter", '{"value":null,"from_unit":"km","to_unit":"m"}', False),
        ("unit_converter", '{"value":1,"from_unit":"","to_unit":"m"}', False),
        ("get_current_weather", '{"location":"x"}', True),
        ("get_current_weather", '"{\\"location\\":\\"x\\"}"', True),
        ("get_current_weather", '{"location":[]}', False),
        ("get_current_weather", '{"location":0.0}', False),
        ("get_current_weather", "[1]", False),
        ("get_current_time", "{}", True),
        ("get_exchange_rate", '{"from_currency":"USD"}', False),
        ("translate_text", '{"text":"a","target_language":"b"}', True),
        ("unheard_of", "{}", False),
    ],
)
def test_valid_calls(one, name, arguments, want):
    call = F.parse_json(F.lit(f'{{"name":"{name}","arguments":{arguments}}}'))
    offered = F.array(*map(F.lit, [*R.TOOL_RULES, "unheard_of"]))
    assert one(R.valid_call(call, offered)) is want
    assert one(R.valid_call(call, F.array().cast("array<string>"))) is False


def test_offered(one):
    assert one(R.offered_names(F.lit('[{"function":{"name":"a"}},{"function":{"name":"a"}}]'))) == ["a"]
    assert one(R.offered_names(F.lit(None).cast("string"))) == []


def test_length_and_think(one):
    assert one(R.length_reward(F.lit(" 1234 "))) == -0.5
    assert one(R.length_reward(F.lit("12345"))) == 0.5
    assert one(R.length_reward(F.lit("你" * 801))) == -0.5
    long = "<think>" + "x" * 20
    assert one(R.think_reward(F.lit(long + "</think>a"))) == 1.25
    assert one(R.think_reward(F.lit("short</think>a</think>"))) == -0.75
    assert one(R.think_reward(F.lit("no tag"))) == 0.0


@pytest.mark.parametrize(
    "text, gt, want",
    [
        ("It costs 7.21 yuan", ["7.21"], ["7.21"]),
        ("It costs 1,234 yuan", ["1234"], ["1234"]),
        ("so 7.210000 then", ["7.21"], ["7.21"]),
        ("version 7.21.3 or x7.21y", ["7.2100"], []),
        ("PARIS is nice", ["paris", "London"], ["paris"]),
        ("5-3 is 2", ["-3"], ["-3"]),
        ("from 5-3.0", ["3"], ["3"]),
        ("minus -3.0 here", ["-3"], ["-3"]),
        ("nothing", ["", " "], []),
        ("a a", ["a", "a"], ["a"]),
        ("fullwidth １２ ok", ["12"], ["12"]),
    ],
)
def test_found(one, text, gt, want):
    got = one(R.gt_found(F.lit(text), F.array(*map(F.lit, gt))))
    assert sorted(got) == sorted(want)


def test_match_score(one):
    assert one(R.gt_match(F.lit("a"), F.array(F.lit("a"), F.lit("a")))) == 1.25
    assert one(R.gt_match(F.lit("a"), F.array().cast("array<string>"))) == 0.0


def test_final_text(one):
    text = F.lit("x<tool_call>1</tool_call> so <tool_call>2</tool_call> end")
    assert one(R.final_text(text, F.lit(False)), R.final_text(text, F.lit(True))) == (" end", "")


ROLLOUT = "prompt_id long, gen_id int, turns array<string>, response string, unfinished boolean, tools string, gt array<string>, score double"
OFFER = '[{"type":"function","function":{"name":"get_current_weather"}}]'


def rollout(spark, turns, unfinished=False, tools=OFFER, gt=(), score=None):
    row = (1, 0, turns, turns[-1] if turns else "", unfinished, tools, list(gt), score)
    return O.agent_reward(spark.createDataFrame([row], ROLLOUT)).first()


def test_agent_without_calls(spark):
    think = "<think>" + "because " * 5
    r = rollout(spark, [think + "</think>the answer"], score=1.0)
    assert r.calls == 0 and r.reward == 0.5 + 1.0 + 0.25 + 1.0
    r = rollout(spark, ["the answer"])
    assert r.reward == 0.5
    r = rollout(spark, ["<tool_call>the answer"])  # unpaired tag, no call
    assert r.reward == 0.5 - 0.5


def test_agent_with_calls(spark):
    call = '<tool_call>{"name":"get_current_weather","arguments":{"location":"Paris"}}</tool_call>'
    r = rollout(spark, [call, "it is 10°C there"], gt=["10°C"])
    assert (r.calls, r.valid_calls, r.reward) == (1, 1, 3.0)
    r = rollout(spark, [call, "unknown to me"], gt=["10°C"])
    assert r.reward == 0.5
    r = rollout(spark, [call, call], unfinished=True, gt=["x"])
    # one call too many; nothing found; unfinished; the answer itself is judged for repeats
    assert r.reward == pytest.approx(-0.5 - 0.5 - penalty(call))
    r = rollout(spark, [call, "10"], gt=["10"], tools=None)
    assert (r.valid_calls, r.reward) == (0, -0.5 * 2 + 2.5)


def test_agent_from_turns_agrees(spark):
    call = '<tool_call>{"name":"get_current_weather","arguments":{"location":"Paris"}}</tool_call>'
    cases = [
        [call, "it is 10°C there"],
        [call + call, "<think>hm</think> 10°C <tool_call>"],
        ["<think>" + "because " * 5 + "</think>the answer"],
        ["<tool_call>{}</tool_call>"],
        ["plain"],
    ]
    whole = spark.createDataFrame(
        [(i, 0, t, t[-1], i == 1, OFFER if i != 3 else None, ["10°C"], 0.5) for i, t in enumerate(cases)],
        ROLLOUT,
    )
    turns = whole.select("prompt_id", "gen_id", F.posexplode("turns").alias("turn", "text"))
    long = O.agent_reward_from_turns(turns.repartition(3), whole.drop("turns", "response"))
    columns = ["prompt_id", "calls", "valid_calls", "reward"]
    want = [tuple(r) for r in O.agent_reward(whole).select(*columns).orderBy("prompt_id").collect()]
    assert [tuple(r) for r in long.select(*columns).orderBy("prompt_id").collect()] == want


def test_reasoning_reward(spark):
    full = "<think>\na\n</think>\n<answer>\nb\n</answer>"
    rows = spark.createDataFrame([(1, 0, full), (1, 1, "plain"), (1, 2, "x")], "prompt_id long, gen_id int, completion string")
    scores = spark.createDataFrame(
        [(1, 0, "full", 5.0), (1, 0, "answer", -1.0), (1, 1, "full", 2.0)],
        "prompt_id long, gen_id int, part string, score double",
    )
    got = {r.gen_id: r.reward for r in O.reasoning_reward(rows, scores).collect()}
    assert got[0] == pytest.approx(0.5 + 1.0 + 0.4 * 3.0 - 0.6) and got[1] == 2.0 and got[2] is None
    plain = {r.gen_id: r.reward for r in O.reasoning_reward(rows, scores, reasoning=False).collect()}
    assert plain[0] == 3.0


def test_lookups(spark):
    calls = [
        ("get_current_weather", '{"location":"北京"}'),
        ("get_current_weather", '{"location":"Oslo"}'),
        ("get_current_weather", "{}"),
        ("get_current_time", "{}"),
        ("get_exchange_rate", '{"from_currency":"USD","to_currency":"CNY"}'),
        ("get_exchange_rate", '{"from_currency":"CNY","to_currency":"USD"}'),
        ("translate_text", '{"text":"Happy birthday","target_language":"chinese"}'),
        ("translate_text", '{"text":"a \\"b\\"","target_language":"chinese"}'),
        ("unit_converter", '{"value":5,"from_unit":"KM","to_unit":"miles"}'),
        ("unit_converter", '{"value":0.0005,"from_unit":"x","to_unit":"y"}'),
        ("unit_converter", '{"value":12345678,"from_unit":"x","to_unit":"y"}'),
        ("unit_converter", '{"value":"none","from_unit":"x","to_unit":"y"}'),
        ("nothing", "{}"),
    ]
    df = spark.createDataFrame([(i, n, a) for i, (n, a) in enumerate(calls)], "i int, name string, a string")
    df = df.withColumn("call", F.parse_json(F.concat(F.lit('{"arguments":'), "a", F.lit("}")))).drop("a")
    got = [r.result for r in O.tool_lookup(df).orderBy("i").collect()]
    assert got == [
        '{"city": "北京", "temperature": "28°C", "humidity": "65%", "condition": "晴"}',
        '{"city": "Oslo", "temperature": "22°C", "humidity": "65%", "condition": "晴"}',
        '{"city": null, "temperature": "22°C", "humidity": "65%", "condition": "晴"}',
        '{"datetime": "2025-03-07 14:30:00", "timezone": "Asia/Shanghai"}',
        '{"from": "USD", "to": "CNY", "rate": 7.21}',
        '{"from": "CNY", "to": "USD", "rate": 1.0}',
        '{"translated_text": "生日快乐"}',
        '{"translated_text": "a \\"b\\""}',
        '{"result": 3.1069}',
        '{"result": 0.0005}',
        '{"result": 12345678.0}',
        None,
        None,
    ]
    text = O.tool_lookup(df).select(R.tool_result_text(F.col("result"))).where("i = 12").first()[0]
    assert text == '{"error": "tool not found"}'


def test_own_dimension(spark):
    df = spark.createDataFrame([("get_current_weather", '{"arguments":{"location":"Oslo"}}')], "name string, c string")
    df = df.withColumn("call", F.parse_json("c")).drop("c")
    own = spark.createDataFrame([("Oslo", "1°C", "snow")], "location string, temp string, cond string")
    got = O.tool_lookup(df, {"weather": own}).first().result
    assert '"condition": "snow"' in got


def test_calls_that_a_lenient_reader_takes(one):
    text = F.lit(
        '<tool_call>{"name":"a","name":"unit_converter","arguments":{"value":0,"from_unit":"km","to_unit":"","to_unit":"m"}}</tool_call>'
        '<tool_call>{"name":"unit_converter","arguments":{"value":NaN,"from_unit":"a","to_unit":"b"}}</tool_call>'
        '<tool_call>{"name":"translate_text","arguments":"{\\"text\\":\\"\\",\\"text\\":\\"x\\",\\"target_language\\":\\"e\\"}"}</tool_call>'
        "<tool_call>{bad</tool_call>"
    )
    calls = R.parse_tool_calls(text)
    names = one(F.transform(calls, R.call_name))
    assert names == ["unit_converter", "unit_converter", "translate_text"]
    offered = F.array(F.lit("unit_converter"), F.lit("translate_text"))
    assert one(F.transform(calls, lambda c: R.valid_call(c, offered))) == [True, True, True]


def test_digits_of_all_scripts(one):
    gt = F.array(F.lit("3"), F.lit("12.5"))
    assert one(R.gt_match(F.lit("it is ٣ and १२.५ now"), gt)) == 2.5
    assert one(R.gt_match(F.lit("it is ٤"), gt)) == 0.0


def test_numbers_as_json_writes_them(spark):
    values = [0.0, -0.0, 1.0, -2.5, 0.1, 1e-4, 0.00012, 1.2e-7, 123456.789, 1e15, 1234567890123456.0, 1e16, 1.5e17]
    values += [-3e-300, 1.7976931348623157e308, 7.21, 1 / 3, 100.0]
    rows = spark.createDataFrame([(v,) for v in values], "x double").select("x", O._number(F.col("x")).alias("n"))
    assert [r.n for r in rows.collect()] == [json.dumps(v) for v in values]

import pytest
from pyspark.sql import functions as F

from chatloom import schemas
from chatloom.functions import chat as C
from chatloom.operators import chats as O

CONV = "conv_id long, conversations array<struct<role:string,content:string,reasoning_content:string,tools:string,tool_calls:string>>"


def msg(role, content, reasoning=None, tools=None, calls=None):
    return (role, content, reasoning, tools, calls)


def chat(spark, *convs):
    rows = spark.createDataFrame(list(enumerate(convs)), CONV)
    return rows.select("conv_id", "conversations")


def test_rendered_forms(spark):
    df = chat(spark, [msg("user", "1+1=?"), msg("assistant", "2")])
    conv = F.col("conversations")
    plain, opened, reward = df.select(
        C.render_chat(conv), C.render_chat(conv, True), C.render_reward_chat(conv)
    ).first()
    body = "<|im_start|>user\n1+1=?<|im_end|>\n<|im_start|>assistant\n2<|im_end|>\n"
    assert plain == body
    assert opened == body + "<|im_start|>assistant\n"
    assert reward == "<s>" + body + "<|reward|>"


def test_rendered_text_reads_back(spark):
    df = chat(spark, [msg("system", " s "), msg("user", "a\n b\n"), msg("tool", "t"), msg("assistant", "open")])
    text = F.concat(C.render_chat(F.col("conversations")), F.lit("<|im_start|>user\nnot closed"))
    got = df.select(C.parse_rendered(text)).first()[0]
    assert [(m.role, m.content) for m in got] == [("system", "s"), ("user", "a\n b"), ("assistant", "open")]


def test_system_prompt_goes_where_it_may(spark):
    df = chat(
        spark,
        [msg("user", "a")],
        [msg("system", "own"), msg("user", "a")],
        [msg("user", "a", tools="[1]")],
        [],
    )
    always = O.inject_system(df, ratio=1.0).orderBy("conv_id").collect()
    first = always[0].conversations
    assert first[0].role == "system" and first[0].content in C.system_prompts() and len(first) == 2
    assert [len(r.conversations) for r in always] == [2, 2, 1, 0]
    never = O.inject_system(df, ratio=0.0).orderBy("conv_id").collect()
    assert [len(r.conversations) for r in never] == [1, 2, 1, 0]


def test_prompt_share_and_choice(spark):
    df = spark.range(4000).select(
        F.col("id").alias("conv_id"),
        F.array(C.message("user", F.lit("x"))).alias("conversations"),
    )
    got = O.inject_system(df, name="Loom").where(F.size("conversations") == 2)
    picked = {r[0]: r[1] for r in got.groupBy(F.col("conversations")[0]["content"]).count().collect()}
    assert 700 < sum(picked.values()) < 900  # about a fifth
    assert set(picked) == set(C.system_prompts("Loom")) and min(picked.values()) > 40


def test_empty_think_goes_everywhere_or_nowhere(one):
    block = C.EMPTY_THINK
    text = F.lit(f"a{block}b{block}c")
    assert one(C.drop_empty_think(text, F.lit(1), keep=0.0)) == "abc"
    assert one(C.drop_empty_think(text, F.lit(1), keep=1.0)) == f"a{block}b{block}c"
    assert one(C.drop_empty_think(F.lit("plain"), F.lit(1), keep=0.0)) == "plain"


def test_tools_of_the_last_system_message(spark):
    df = chat(
        spark,
        [msg("system", "", tools="[1]"), msg("user", "", tools="[9]"), msg("system", "", tools="[2]"), msg("system", "")],
        [msg("user", "")],
    )
    got = df.orderBy("conv_id").select(C.tool_schema(F.col("conversations"))).collect()
    assert [r[0] for r in got] == ["[2]", None]


def test_tool_calls_decode_or_raise(spark):
    good = chat(spark, [msg("assistant", "x", calls='[{"name":"n"}]'), msg("user", "y", calls="")])
    m = good.select(C.decode_tool_calls(F.col("conversations")).alias("m")).select(
        F.to_json(F.col("m")[0]["tool_calls"]), F.col("m")[1]["tool_calls"].isNull()
    )
    assert tuple(m.first()) == ('[{"name":"n"}]', True)
    bad = chat(spark, [msg("assistant", "x", calls="[{")])
    with pytest.raises(Exception):
        bad.select(F.to_json(C.decode_tool_calls(F.col("conversations"))[0]["tool_calls"])).collect()


def test_slices(spark):
    df = chat(spark, [msg("user", str(i)) for i in range(4)], [msg("user", "0")])
    conv = F.col("conversations")
    sizes = df.orderBy("conv_id").select(
        F.size(C.drop_last(conv)), F.size(C.last_turns(conv, 2)), F.size(C.last_turns(conv, 0))
    )
    assert [tuple(r) for r in sizes.collect()] == [(3, 2, 0), (0, 1, 0)]


def test_reasoning_is_spliced_or_left_out(spark):
    df = chat(spark, [msg("user", "q"), msg("assistant", "a", reasoning="why")])
    conv = F.col("conversations")
    with_it, without = df.select(
        C.render_chat(O.with_reasoning(conv)), C.render_chat(conv)
    ).first()
    assert "<think>\nwhy\n</think>\n\na<|im_end|>" in with_it and "why" not in without


def test_rejects(spark):
    df = chat(
        spark,
        [],
        [msg("user", "only")],
        [msg("system", "", tools="{"), msg("user", "x")],
        [msg("user", "x"), msg("assistant", "", calls="[")],
        [msg("user", "x"), msg("assistant", "y")],
        [msg(None, "x"), msg("assistant", "y")],
    )
    good, bad = O.validate_chats(df)
    assert [r.conv_id for r in good.collect()] == [4]
    assert dict(bad.collect()) == {
        "empty conversation": 1, "empty prompt": 1, "bad tools json": 1, "bad tool call json": 1, "missing role": 1,
    }


# ---- conversations longer than a row may be --------------------------------------


def long_turns(spark, n=100):
    """One conversation holds most turns; positions have gaps and start at 5."""
    return spark.range(n).select(
        F.lit(7).cast("long").alias("conv_id"),
        (F.col("id") * 3 + 5).alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("t"), F.col("id").cast("string")).alias("text"),
    ).unionByName(
        spark.createDataFrame(
            [(1, 0, "user", "a"), (1, 1, "assistant", "b")],
            "conv_id long, turn long, role string, text string",
        )
    )


def test_long_conversations_are_one_row(spark):
    rows = {r.conv_id: r.conversations for r in O.chats_from_turns(long_turns(spark)).collect()}
    assert len(rows) == 2 and len(rows[1]) == 2
    assert [m.content for m in rows[7]] == [f"t{i}" for i in range(100)]


def test_conversations_in_pieces(spark):
    rows = O.chat_pieces(long_turns(spark), 16).orderBy("conv_id", "segment").collect()
    assert [(r.conv_id, r.segment, r.last) for r in rows] == [(1, 0, True)] + [
        (7, s, s == 6) for s in range(7)
    ]
    assert all(len(r.conversations) <= 16 for r in rows)
    texts = [m.content for r in rows[1:] for m in r.conversations]
    assert texts == [f"t{i}" for i in range(100)]


def test_copies_of_a_turn_in_pieces(spark):
    same = spark.range(60).select(
        F.lit(3).cast("long").alias("conv_id"),
        F.lit(0).cast("long").alias("turn"),
        F.lit("user").alias("role"),
        F.lit("x").alias("text"),
    )
    rows = O.chat_pieces(same, 8).collect()
    assert sum(len(r.conversations) for r in rows) == 60 and len(rows) == 8
    assert sum(r.last for r in rows) == 1


def test_late_tools_keep_the_system_prompt_out(spark):
    turns = long_turns(spark).withColumn(
        "tools", F.when(F.col("text") == "t90", F.lit("[1]"))
    )
    opened = O.inject_system(O.chats_from_turns(turns), ratio=1.0)
    opening = {r.conv_id: r.conversations[0].role for r in opened.collect()}
    assert opening == {1: "system", 7: "user"}
    stats = {r.conv_id: (r.messages, r.tool_chat, r.tools) for r in O.chat_stats(turns).collect()}
    assert stats == {1: (2, False, None), 7: (100, True, None)}


def test_tools_are_rendered_and_carried(spark):
    df = chat(
        spark,
        [msg("system", "s", tools='[{"x":1}]'), msg("user", "u"), msg("assistant", None, calls='[{"name":"f"}]'), msg("assistant", "a")],
    )
    conv = F.col("conversations")
    text = df.select(C.render_tool_chat(conv)).first()[0]
    assert text == (
        '<|im_start|>system\ns\n<tools>\n[{"x":1}]\n</tools><|im_end|>\n<|im_start|>user\nu<|im_end|>\n'
        '<|im_start|>assistant\n\n<tool_call>\n[{"name":"f"}]\n</tool_call><|im_end|>\n<|im_start|>assistant\na<|im_end|>\n'
    )
    prompt = O.rl_prompts(df, render=C.render_tool_chat).first()
    assert prompt.tools == '[{"x":1}]' and "</tool_call>" in prompt.prompt and prompt.prompt.endswith("<|im_start|>assistant\n")
    assert df.select(C.tool_calls(conv)).first()[0] == [None, None, '[{"name":"f"}]', None]


def test_lenient_json_is_no_reject(spark):
    df = chat(
        spark,
        [msg("user", "a"), msg("assistant", "b", calls='[{"name":"f","name":"g","v":NaN}]')],
        [msg("user", "a"), msg("assistant", "b", calls='[{"name":')],
    )
    good, bad = O.validate_chats(df)
    assert [r.conv_id for r in good.collect()] == [0]
    assert [tuple(r) for r in bad.collect()] == [("bad tool call json", 1)]


def test_schema_matches_the_declared_one(spark):
    assert chat(spark, []).schema["conversations"].dataType == schemas.CONVERSATION

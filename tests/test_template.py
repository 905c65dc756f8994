import pytest
from pyspark.sql import functions as F

from chatloom import schemas
from chatloom.functions import chat as C
from chatloom.functions.template import TemplateError, compile_template

# Fixed value: the template text that is stored beside the reward scorer's vocabulary.
STORED = (
    "{{ bos_token }}{% for message in messages %}{{'<|im_start|>' + message['role'] + '\\n' + message['content'] + "
    "'<|im_end|>' + '\\n'}}{% endfor %}{% if add_generation_prompt %}{{ '<|im_start|>assistant\\n' }}{% endif %}{{ '<|reward|>' }}"
)


def turn(role, content, reasoning=None, tools=None, calls=None):
    return role, content, reasoning, tools, calls


CHATS = [
    [turn("system", "be kind", tools='[{"name": "f"}]'), turn("user", "hi\n{{x}}"), turn("assistant", " yo ", reasoning="hm")],
    [turn("user", "你好"), turn("assistant", None, calls='[{"name":"f"}]')],
    [turn("user", "")],
    [],
    None,
]


def render(spark, source, trim=True, values=None, **options):
    rows = spark.createDataFrame([(k, c) for k, c in enumerate(CHATS)], f"k int, c {schemas.CONVERSATION.simpleString()}")
    column = compile_template(source, trim, **(values or {}))(F.col("c"), **options)
    return [r.t for r in rows.orderBy("k").select("k", column.alias("t")).collect()]


def test_stored_template_gives_the_reward_form(spark):
    """The text of C6 and C7."""
    rows = spark.createDataFrame([(c,) for c in CHATS[:4]], f"c {schemas.CONVERSATION.simpleString()}")
    whole = compile_template(STORED, bos_token="<s>")
    plain = compile_template(STORED.replace("{{ '<|reward|>' }}", ""), bos_token="")
    got = rows.select(
        (whole(F.col("c")) == C.render_reward_chat(F.col("c"))).alias("a"),
        (plain(F.col("c")) == C.render_chat(F.col("c"))).alias("b"),
        (plain(F.col("c"), generation_prompt=True) == C.render_chat(F.col("c"), True)).alias("c"),
    )
    assert all(all(r) for r in got.collect())


def test_conditions_fields_and_loops(spark):
    source = """
{%- if messages[0]['role'] == 'system' -%}
S:{{ messages[0].content | upper }}
{% endif %}
{%- for message in messages %}
{%- if loop.first and message.role != 'user' %}[{% elif not loop.last %}<{% else %}({% endif %}
{{- loop.index }}/{{ loop.index0 ~ '' }}{{ message.content | trim }}
{%- if message.reasoning_content is defined and message.reasoning_content is not none %}!{{ message.reasoning_content }}{% endif %}
{%- if message.tool_calls %}C{{ message.tool_calls | length }}{% endif %}
{%- if message.role in 'useruser' or (message.role == 'x') %}U{% endif %}
{%- if message.role not in ['a'] %}{% endif %}
{% endfor %}{# nothing #}."""
    with pytest.raises(TemplateError):  # lists are not supported
        compile_template(source)
    source = source.replace("{%- if message.role not in ['a'] %}{% endif %}\n", "")
    assert render(spark, source) == [
        "S:BE KIND\n[1/0be kind<2/1hi\n{{x}}U(3/2yo!hm.",
        "<1/0你好U(2/1C14.",
        "(1/0U.",
        ".",
        None,
    ]


def test_white_space_as_chat_templates_are_read(spark):
    source = "a\n  {% if true %}\nb\n  {% endif %}\n c {{ 'd' }}\n\n"
    assert render(spark, source)[3] == "a\nb\n c d\n"
    assert render(spark, source, trim=False)[3] == "a\n  \nb\n  \n c d\n"
    assert render(spark, "x  {{- 'y' -}}  z {%- if false %}q{% else -%} w{% endif %}")[3] == "xyzw"


def test_set_default_json_and_flags(spark):
    source = "{% set name = name | default('you') %}{{ name }}:{{ messages[-1].content | tojson }}:{{ messages|length }}:{% if thinking is defined and thinking %}T{% endif %}"
    assert render(spark, source)[:3] == ['you:" yo ":3:', 'you:"":2:', 'you:"":1:']
    assert render(spark, source, values={"name": 'a"b'}, thinking=True)[2] == 'a"b:"":1:T'
    assert render(spark, "{{ \"q\\n'\" }}")[3] == "q\n'"


@pytest.mark.parametrize(
    "source",
    [
        "{{ message }", "{% for m in messages %}", "{% if x %}a", "{% macro f() %}{% endmacro %}", "{{ f(1) }}",
        "{{ messages }}", "{{ messages | sort }}", "{% for a, b in messages %}{% endfor %}", "{{ 1 + }}", "{% for m in other %}{% endfor %}",
        "{{ m['a':] }}", "{% for m in messages %}{% set a = 1 %}{% endfor %}", "{% else %}", "{{ 'a %}", "{{ a ** b }}",
    ],
)
def test_what_is_not_supported_raises(spark, source):
    with pytest.raises(TemplateError):
        compile_template(source)


def test_stays_an_expression(spark):
    rows = spark.createDataFrame([(CHATS[0],)], f"c {schemas.CONVERSATION.simpleString()}")
    plan = rows.select(compile_template(STORED)(F.col("c")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan

"""Conversation preparation: U1 and C1 to C15."""

from pyspark.sql import functions as F

from chatloom.functions import chat as C
from chatloom.functions.template import compile_template
from chatloom.functions.text import BLANK, uniform
from chatloom.operators import chats as O
from chatloom.operators.samples import text_counts
from chatloom.plans.common import S_TURNS, query, r6, s_frame, s_r6, s_strip, s_u
from chatloom.sources import tables as D


@query("u01_uniform", f"SELECT doc_id, {s_r6(s_u('doc_id', '42'))} AS u FROM documents")
def u01(spark, sf):
    docs = D.table(spark, sf, "documents")
    return docs.select("doc_id", r6(uniform(F.col("doc_id"), 42)).alias("u"))


@query(
    "c01_is_tool_chat",
    f"""WITH {S_TURNS} SELECT conv_id, coalesce(bool_or(tools <> ''), FALSE) AS tool_chat
  FROM turns GROUP BY conv_id""",
)
def c01(spark, sf):
    return D.chats(spark, sf).select(
        "conv_id", C.is_tool_chat(F.col("conversations")).alias("tool_chat")
    )


S_PROMPTS = "[" + ", ".join("'" + p.replace("'", "''") + "'" for p in C.system_prompts()) + "]"


def s_injected(ratio: float, seed: str, turns: str = "turns") -> str:
    """CTE ``ready(conv_id, turn, role, text, …)`` with drawn system prompts at turn -1."""
    return f"""opening AS (SELECT conv_id, arg_min(role, turn) AS opener,
    coalesce(bool_or(tools <> ''), FALSE) AS tool_chat FROM {turns} GROUP BY conv_id),
ready AS (SELECT conv_id, turn, role, text, tools FROM {turns} UNION ALL
  SELECT conv_id, -1, 'system', ({S_PROMPTS})[1 + CAST(floor({s_u('conv_id', seed + '/prompt')} * 10) AS INTEGER)], NULL
  FROM opening WHERE opener <> 'system' AND NOT tool_chat AND {s_u('conv_id', seed)} < {ratio})"""


def s_body(rows: str = "ready") -> str:
    return f"SELECT conv_id, string_agg({s_frame()}, '' ORDER BY turn) AS body, count(*) AS messages FROM {rows} GROUP BY conv_id"


@query(
    "c02_inject_system",
    f"WITH {S_TURNS}, {s_injected(0.2, 'system')} SELECT conv_id, md5(body) AS body_md5, messages FROM ({s_body()})",
)
def c02(spark, sf):
    conv = F.col("conversations")
    return O.inject_system(D.chats(spark, sf)).select(
        "conv_id",
        F.md5(C.render_chat(conv)).alias("body_md5"),
        F.size(conv).cast("bigint").alias("messages"),
    )


S_EMPTY = D.EMPTY_THINK


@query(
    "c03_drop_empty_think",
    f"""WITH t AS (SELECT conv_id, turn, role, {D.THINKING} AS text FROM conversations),
r AS ({s_body('t')}) SELECT conv_id, md5(CASE WHEN {s_u('conv_id', 'think')} > 0.2
  THEN replace(body, {S_EMPTY}, '') ELSE body END) AS body_md5 FROM r""",
)
def c03(spark, sf):
    text = C.render_chat(F.col("conversations"))
    kept = C.drop_empty_think(text, F.col("conv_id"), 0.2, "think")
    return D.chats(spark, sf, text=D.THINKING).select("conv_id", F.md5(kept).alias("body_md5"))


@query(
    "c04_tool_schema",
    f"""WITH {S_TURNS} SELECT conv_id, arg_max(tools, turn) FILTER (role = 'system' AND tools <> '') AS tools
  FROM turns GROUP BY conv_id""",
)
def c04(spark, sf):
    return D.chats(spark, sf).select(
        "conv_id", C.tool_schema(F.col("conversations")).alias("tools")
    )


@query(
    "c05_decode_tool_calls",
    f"""WITH {S_TURNS} SELECT conv_id, turn, json_extract_string(tool_calls, '$[0].name') AS tool,
  CAST(json_extract_string(tool_calls, '$[0].arguments.value') AS BIGINT) AS value
  FROM turns WHERE tool_calls IS NOT NULL""",
)
def c05(spark, sf):
    decoded = D.chats(spark, sf).select(
        "conv_id", F.posexplode(C.decode_tool_calls(F.col("conversations"))).alias("turn", "m")
    )
    calls = F.col("m.tool_calls")
    return decoded.where(calls.isNotNull()).select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        F.variant_get(calls, "$[0].name", "string").alias("tool"),
        F.variant_get(calls, "$[0].arguments.value", "bigint").alias("value"),
    )


@query(
    "c04_chat_stats",
    f"""WITH {S_TURNS} SELECT conv_id, count(*) AS messages, CAST(sum(length(text)) AS BIGINT) AS chars,
  coalesce(bool_or(tools <> ''), FALSE) AS tool_chat,
  arg_max(tools, turn) FILTER (role = 'system' AND tools <> '') AS tools FROM turns GROUP BY conv_id""",
)
def c04_stats(spark, sf):
    return O.chat_stats(D.turns(spark, sf))


_PLAIN = s_body("conversations")


@query(
    "c06_render_chat",
    f"""SELECT conv_id, md5(body) AS body_md5, length(body) AS chars,
  md5(body || '<|im_start|>assistant' || chr(10)) AS open_md5 FROM ({_PLAIN})""",
)
def c06(spark, sf):
    conv = F.col("conversations")
    rows = D.chats(spark, sf).select("conv_id", C.render_chat(conv).alias("body"), "conversations")
    return rows.select(
        "conv_id",
        F.md5("body").alias("body_md5"),
        F.length("body").cast("bigint").alias("chars"),
        F.md5(C.render_chat(conv, generation_prompt=True)).alias("open_md5"),
    )


@query(
    "c07_render_reward_chat",
    f"SELECT conv_id, md5('<s>' || body || '<|reward|>') AS body_md5 FROM ({_PLAIN})",
)
def c07(spark, sf):
    return D.chats(spark, sf).select(
        "conv_id", F.md5(C.render_reward_chat(F.col("conversations"))).alias("body_md5")
    )


# Fixed value: the template text that is stored beside the reward scorer's vocabulary.
REWARD_TEMPLATE = (
    "{{ bos_token }}{% for message in messages %}{{'<|im_start|>' + message['role'] + '\\n' + message['content'] + "
    "'<|im_end|>' + '\\n'}}{% endfor %}{% if add_generation_prompt %}{{ '<|im_start|>assistant\\n' }}{% endif %}{{ '<|reward|>' }}"
)


@query(
    "c07_compiled_template",
    f"SELECT conv_id, md5('<s>' || body || '<|reward|>') AS body_md5, md5('<s>' || body || '<|im_start|>assistant' || chr(10) || '<|reward|>') AS open_md5 FROM ({_PLAIN})",
)
def c07_compiled(spark, sf):
    """The stored template, compiled."""
    render, conv = compile_template(REWARD_TEMPLATE, bos_token="<s>"), F.col("conversations")
    return D.chats(spark, sf).select(
        "conv_id", F.md5(render(conv)).alias("body_md5"), F.md5(render(conv, generation_prompt=True)).alias("open_md5")
    )


TOOL_TEMPLATE = """
{%- if messages[0].role == 'system' and messages[0].tools -%}
# Tools: {{ messages[0].tools }}
{% endif %}
{%- for message in messages %}
{%- if message.role == 'user' or (message.role == 'system' and not loop.first) %}
{{- '<|im_start|>' ~ message.role ~ '\\n' ~ message.content | trim ~ '<|im_end|>' }}
{%- elif message.role == 'assistant' %}
<|im_start|>assistant
{%- if message.reasoning_content is defined and loop.last %}
<think>{{ message.reasoning_content }}</think>
{%- endif %}
{{- message.content }}{% if message.tool_calls %}<tool_call>{{ message.tool_calls }}</tool_call>{% endif %}<|im_end|>
{%- endif %}
{{ loop.index }};
{%- endfor %}
"""


@query(
    "c06_compiled_tool_template",
    f"""WITH {S_TURNS}, p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k,
  count(*) OVER (PARTITION BY conv_id) AS n FROM turns),
m AS (SELECT conv_id, k, CASE WHEN k = 1 AND role = 'system' AND tools IS NOT NULL THEN '# Tools: ' || tools || chr(10) ELSE '' END AS head,
  CASE WHEN role = 'user' OR (role = 'system' AND k > 1) THEN '<|im_start|>' || role || chr(10) || {s_strip('text')} || '<|im_end|>'
  WHEN role = 'assistant' THEN '<|im_start|>assistant' ||
    CASE WHEN reasoning_content IS NOT NULL AND k = n THEN '<think>' || reasoning_content || '</think>' ELSE '' END
    || text || coalesce('<tool_call>' || tool_calls || '</tool_call>', '') || '<|im_end|>'
  ELSE '' END || k || ';' AS body FROM p)
SELECT conv_id, md5(string_agg(head, '' ORDER BY k) || string_agg(body, '' ORDER BY k)) AS body_md5 FROM m GROUP BY conv_id""",
)
def c06_compiled(spark, sf):
    """A template with tools, reasoning, conditions and loop variables, compiled."""
    return D.chats(spark, sf).select("conv_id", F.md5(compile_template(TOOL_TEMPLATE)(F.col("conversations"))).alias("body_md5"))


@query(
    "c08_drop_last",
    """SELECT c.conv_id, count(*) FILTER (turn < last) AS messages,
  md5(coalesce(string_agg(text, '|' ORDER BY turn) FILTER (turn < last), '')) AS text_md5
  FROM conversations c JOIN (SELECT conv_id, max(turn) AS last FROM conversations GROUP BY conv_id) USING (conv_id)
  GROUP BY c.conv_id""",
)
def c08(spark, sf):
    rows = D.chats(spark, sf).select("conv_id", C.drop_last(F.col("conversations")).alias("c"))
    return rows.select(
        "conv_id",
        F.size("c").cast("bigint").alias("messages"),
        F.md5(F.array_join(F.transform("c", lambda m: m["content"]), "|")).alias("text_md5"),
    )


_LAST = "last AS (SELECT conv_id, max(turn) AS last FROM conversations GROUP BY conv_id)"


@query(
    "c09_rl_prompts",
    f"""WITH {S_TURNS}, {s_injected(0.2, 'rl/system')}, {_LAST},
b AS ({s_body('(SELECT r.* FROM ready r JOIN last USING (conv_id) WHERE turn < last)')})
SELECT conv_id, md5(coalesce(body, '') || '<|im_start|>assistant' || chr(10)) AS prompt_md5, '' AS answer,
  {s_u('conv_id', 'rl/thinking')} < 0.5 AS open_thinking, t.tools FROM last LEFT JOIN b USING (conv_id)
  LEFT JOIN (SELECT conv_id, arg_max(tools, turn) FILTER (role = 'system' AND tools <> '') AS tools FROM turns GROUP BY conv_id) t USING (conv_id)""",
)
def c09(spark, sf):
    return O.rl_prompts(D.chats(spark, sf)).select(
        "conv_id", F.md5("prompt").alias("prompt_md5"), "answer", "open_thinking", "tools"
    )


@query(
    "c10_agent_tasks",
    f"""WITH {S_TURNS}, {_LAST} SELECT conv_id, count(*) FILTER (turn < last) AS messages,
  md5(coalesce(string_agg(text, '|' ORDER BY turn) FILTER (turn < last), '')) AS text_md5,
  coalesce(md5(arg_max(tools, turn) FILTER (role = 'system' AND tools <> '')), '') AS tools_md5,
  conv_id || ' x' AS gt FROM turns JOIN last USING (conv_id) GROUP BY conv_id""",
)
def c10(spark, sf):
    chats = D.chats(spark, sf).withColumn(
        "gt", F.array(F.col("conv_id").cast("string"), F.lit("x"))
    )
    return O.agent_tasks(chats).select(
        "conv_id",
        F.size("messages").cast("bigint").alias("messages"),
        F.md5(F.array_join(F.transform("messages", lambda m: m["content"]), "|")).alias("text_md5"),
        F.coalesce(F.md5("tools"), F.lit("")).alias("tools_md5"),
        F.array_join("gt", " ").alias("gt"),
    )


_PARSE = r"(?s)<\|im_start\|>(system|user|assistant)[" + BLANK + r"]+(.*?)<\|im_end\|>"


@query(
    "c11_parse_rendered",
    f"""WITH b AS (SELECT conv_id, body || '<|im_start|>assistant' || chr(10) AS body FROM ({_PLAIN}))
SELECT conv_id, array_to_string(regexp_extract_all(body, '{_PARSE}', 1), ' ') AS roles,
  md5(array_to_string(list_transform(regexp_extract_all(body, '{_PARSE}', 2), lambda m: {s_strip('m')}), '|')) AS text_md5 FROM b""",
)
def c11(spark, sf):
    text = C.render_chat(F.col("conversations"), generation_prompt=True)
    rows = D.chats(spark, sf).select("conv_id", C.parse_rendered(text).alias("m"))
    return rows.select(
        "conv_id",
        F.array_join(F.transform("m", lambda m: m["role"]), " ").alias("roles"),
        F.md5(F.array_join(F.transform("m", lambda m: m["content"]), "|")).alias("text_md5"),
    )


@query(
    "c12_append_answer",
    f"""SELECT conv_id, messages + 1 AS messages,
  md5(body || {s_frame("'assistant'", "'answer ' || conv_id")}) AS body_md5 FROM ({_PLAIN})""",
)
def c12(spark, sf):
    answer = F.concat(F.lit("answer "), F.col("conv_id").cast("string"))
    rows = D.chats(spark, sf).select(
        "conv_id", C.append_answer(F.col("conversations"), answer).alias("c")
    )
    return rows.select(
        "conv_id",
        F.size("c").cast("bigint").alias("messages"),
        F.md5(C.render_chat(F.col("c"))).alias("body_md5"),
    )


@query(
    "c13_last_turns",
    f"""WITH {_LAST} SELECT conv_id, md5(string_agg(text, '|' ORDER BY turn) FILTER (turn > last - 3)) AS last3_md5,
  0 AS last0 FROM conversations JOIN last USING (conv_id) GROUP BY conv_id""",
)
def c13(spark, sf):
    conv = F.col("conversations")
    return D.chats(spark, sf).select(
        "conv_id",
        F.md5(F.array_join(F.transform(C.last_turns(conv, 3), lambda m: m["content"]), "|")).alias(
            "last3_md5"
        ),
        F.size(C.last_turns(conv, 0)).alias("last0"),
    )


@query("c14_with_bos_prompt", "SELECT doc_id, md5('<|im_start|>' || text) AS prompt_md5 FROM documents")
def c14(spark, sf):
    return D.table(spark, sf, "documents").select(
        "doc_id", F.md5(C.with_bos_prompt(F.col("text"))).alias("prompt_md5")
    )


@query("c15_text_counts", "SELECT count(*) AS documents, count(*) FILTER (text IS NULL) AS without_text FROM documents")
def c15_texts(spark, sf):
    return text_counts(D.table(spark, sf, "documents"))


@query(
    "c15_validate_chats",
    f"""WITH t AS (SELECT conv_id, turn, {D.BROKEN_CALLS} AS tool_calls FROM conversations),
r AS (SELECT conv_id, count(*) AS n, bool_or(tool_calls IS NOT NULL AND NOT json_valid(tool_calls)) AS bad FROM t GROUP BY conv_id)
SELECT CASE WHEN bad THEN 'bad tool call json' WHEN n = 1 THEN 'empty prompt' END AS reason, count(*) AS chats
FROM r WHERE bad OR n = 1 GROUP BY 1""",
)
def c15(spark, sf):
    return O.validate_chats(D.chats(spark, sf, calls=D.BROKEN_CALLS))[1]

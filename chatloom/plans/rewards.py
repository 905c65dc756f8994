"""Rule rewards: R1 to R19, and the reward report of a batch."""

from pyspark.sql import functions as F

from chatloom.functions import rewards as R
from chatloom.functions.text import WORD, WORD_OR_MARK
from chatloom.operators import answers as O
from chatloom.operators import objectives as OB
from chatloom.plans.common import (
    query,
    r6,
    s_after_first,
    s_count,
    s_r6,
    s_strip,
    s_u,
)
from chatloom.session import spread
from chatloom.sources import tables as D

S_ANSWERS = f"""answers AS (SELECT conv_id AS prompt_id, CAST(turn AS INTEGER) AS gen_id, {D.COMPLETION} AS t
  FROM conversations WHERE role = 'assistant')"""
_FORMAT = f"CASE WHEN regexp_matches(t, '{R.FORMAT}') THEN 0.5 ELSE 0 END"
_TAGS = " + ".join(f"CASE WHEN {s_count('t', tag)} = 1 THEN 0.25 ELSE 0 END" for tag in R.SCORED_TAGS)


def _rows(spark, sf, **columns):
    return D.answers(spark, sf).select(
        "prompt_id", "gen_id", *[c.alias(n) for n, c in columns.items()]
    )


def _sql(select: str) -> str:
    return f"WITH {S_ANSWERS} SELECT prompt_id, gen_id, {select} FROM answers"



@query("r01_format_reward", _sql(f"{s_r6(_FORMAT)} AS reward"))
def r01(spark, sf):
    return _rows(spark, sf, reward=R.format_reward(F.col("completion")))


@query("r02_tag_reward", _sql(f"{s_r6(_TAGS)} AS reward"))
def r02(spark, sf):
    return _rows(spark, sf, reward=R.tag_reward(F.col("completion")))


def s_score(part: str) -> str:
    key = f"(prompt_id || '-' || gen_id || '-{part}')"
    return f"({s_u(key, 'score')} * 8 - 4)"


def s_clip(x: str) -> str:
    return f"greatest(least({x}, 3.0), -3.0)"


@query(
    "r03_clip",
    _sql(f"{s_r6(s_clip(s_score('full')))} AS clipped"),
)
def r03(spark, sf):
    scores = D.rollout_scores(spark, sf).where(F.col("part") == "full")
    return scores.select("prompt_id", "gen_id", r6(R.clip(F.col("score"))).alias("clipped"))


_ANSWER = f"CASE WHEN regexp_matches(t, '{R.ANSWER}') THEN {s_strip(f'''regexp_extract(t, '{R.ANSWER}', 1)''')} END"


@query("r04_extract_answer", _sql(f"md5({_ANSWER}) AS answer_md5"))
def r04(spark, sf):
    return _rows(spark, sf, answer_md5=F.md5(R.extract_answer(F.col("completion"))))


_MIXED = f"""CASE WHEN regexp_matches(t, '{R.ANSWER}') THEN {s_clip(s_score('full'))} * CAST(0.4 AS DOUBLE) + {s_clip(s_score('answer'))} * CAST(0.6 AS DOUBLE)
  ELSE {s_clip(s_score('full'))} END"""
S_REWARD = f"({_FORMAT} + {_TAGS} + {_MIXED})"


@query("r05_reasoning_reward", _sql(f"{s_r6(S_REWARD)} AS reward"))
def r05(spark, sf):
    rows = O.reasoning_reward(D.answers(spark, sf), D.rollout_scores(spark, sf))
    return rows.select("prompt_id", "gen_id", r6(F.col("reward")).alias("reward"))


def s_words(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '{WORD_OR_MARK}')"


def s_penalty(w: str) -> str:
    """From a list of words."""
    grams = f"list_transform(range(1, len({w}) - 1), lambda i: array_to_string({w}[i:i + 2], ' '))"
    return f"""(CASE WHEN len({w}) < 3 THEN 0 ELSE least(0.5, (len({w}) - 2 - len(list_distinct({grams}))) * CAST(0.5 AS DOUBLE) * 2 / (len({w}) - 2)) END)"""


@query(
    "r06_repetition_penalty",
    f"WITH w AS (SELECT doc_id, {s_words('text')} AS w FROM documents) SELECT doc_id, {s_r6(s_penalty('w'))} AS penalty FROM w",
)
def r06(spark, sf):
    docs = D.documents(spark, sf)
    return docs.select("doc_id", r6(R.repetition_penalty(F.col("text"))).alias("penalty"))


_STRIPPED = s_strip(s_after_first("t", "</think>"))


@query("r07_strip_think", _sql(f"md5({_STRIPPED}) AS text_md5"))
def r07(spark, sf):
    return _rows(spark, sf, text_md5=F.md5(R.strip_think(F.col("completion"))))


# ---- tool calls ---------------------------------------------------------------

S_TTURNS = f"""tturns AS (SELECT conv_id AS prompt_id, CAST(turn // 4 AS INTEGER) AS gen_id, turn, {D.TOOL_TURN} AS t
  FROM conversations WHERE role = 'assistant')"""
S_BODIES = f"""bodies AS (SELECT prompt_id, gen_id, turn, unnest(b) AS body, generate_subscripts(b, 1) AS n
  FROM (SELECT *, regexp_extract_all(t, '{R.TOOL_CALL}', 1) AS b FROM tturns)),
calls AS (SELECT prompt_id, gen_id, turn, n, CAST(trim(body) AS JSON) AS c FROM bodies WHERE json_valid(trim(body)))"""
_ARGS = """CASE json_type(c, '$.arguments') WHEN 'VARCHAR' THEN
  CASE WHEN json_valid(json_extract_string(c, '$.arguments')) THEN CAST(json_extract_string(c, '$.arguments') AS JSON) ELSE CAST('{}' AS JSON) END
  ELSE coalesce(json_extract(c, '$.arguments'), CAST('{}' AS JSON)) END"""


@query(
    "r08_parse_tool_calls",
    f"""WITH {S_TTURNS}, {S_BODIES} SELECT prompt_id, gen_id, turn, count(c) AS calls,
  coalesce(string_agg(json_extract_string(c, '$.name'), ' ' ORDER BY n), '') AS names
  FROM tturns LEFT JOIN calls USING (prompt_id, gen_id, turn) GROUP BY ALL""",
)
def r08(spark, sf):
    rows = D.tool_turns(spark, sf).withColumn("calls", R.parse_tool_calls(F.col("text")))
    return rows.select(
        "prompt_id",
        "gen_id",
        "turn",
        F.size("calls").cast("bigint").alias("calls"),
        F.array_join(F.transform("calls", R.call_name), " ").alias("names"),
    )


@query(
    "r09_call_arguments",
    f"""WITH {S_TTURNS}, {S_BODIES}, a AS (SELECT *, {_ARGS} AS args FROM calls)
SELECT prompt_id, gen_id, turn, n - 1 AS n, json_extract_string(args, '$.location') AS location,
  json_extract_string(args, '$.from_unit') AS from_unit, TRY_CAST(json_extract_string(args, '$.value') AS BIGINT) AS value FROM a""",
)
def r09(spark, sf):
    # places count all bodies, valid or not, as the SQL does
    bodies = F.regexp_extract_all("text", F.lit(R.TOOL_CALL), F.lit(1))
    rows = D.tool_turns(spark, sf).select(
        "prompt_id", "gen_id", "turn", F.posexplode(bodies).alias("n", "body")
    )
    args = R.call_arguments(F.try_parse_json(F.trim("body")))
    rows = rows.where(F.try_parse_json(F.trim("body")).isNotNull()).withColumn("args", args)
    return rows.select(
        "prompt_id",
        "gen_id",
        "turn",
        F.col("n").cast("bigint").alias("n"),
        F.try_variant_get("args", "$.location", "string").alias("location"),
        F.try_variant_get("args", "$.from_unit", "string").alias("from_unit"),
        F.try_variant_get("args", "$.value", "bigint").alias("value"),
    )


S_STRIPPED = f"""strip AS (SELECT prompt_id, gen_id, turn, {_STRIPPED} AS t FROM tturns)"""


@query(
    "r10_tag_imbalance",
    f"""WITH {S_TTURNS}, {S_STRIPPED} SELECT prompt_id, gen_id,
  {s_r6(f"-0.5 * sum(abs({s_count('t', '<tool_call>')} - {s_count('t', '</tool_call>')}))")} AS reward FROM strip GROUP BY ALL""",
)
def r10(spark, sf):
    rows = D.tool_rollouts(spark, sf)
    answers = F.transform("turns", R.strip_think)
    return rows.select("prompt_id", "gen_id", r6(R.tag_imbalance(answers)).alias("reward"))


def s_length(x: str) -> str:
    return f"(CASE WHEN length({s_strip(x)}) BETWEEN 5 AND 800 THEN 0.5 ELSE -0.5 END)"


def s_think(x: str) -> str:
    head = s_strip(f"split_part({x}, '</think>', 1)")
    closed = s_count(x, "</think>")
    return f"""(CASE WHEN {closed} = 0 THEN 0 ELSE CASE WHEN length({head}) BETWEEN 20 AND 300 THEN 1.0 ELSE -0.5 END
  + CASE WHEN {closed} = 1 THEN 0.25 ELSE -0.25 END END)"""


@query("r11_length_reward", _sql(f"{s_r6(s_length('t'))} AS reward"))
def r11(spark, sf):
    return _rows(spark, sf, reward=R.length_reward(F.col("completion")))


@query("r12_think_reward", _sql(f"{s_r6(s_think('t'))} AS reward"))
def r12(spark, sf):
    return _rows(spark, sf, reward=R.think_reward(F.col("completion")))


def _s_truthy(arg: str) -> str:
    got = f"json_extract(args, '$.{arg}')"
    return f"coalesce(CAST({got} AS VARCHAR) NOT IN ('null', 'false', '0', '0.0', '\"\"', '[]', '{{}}'), FALSE)"


def _s_given(arg: str) -> str:
    return f"coalesce(json_type(args, '$.{arg}') <> 'NULL', FALSE)"


_RULES = " ".join(
    f"WHEN '{tool}' THEN "
    + (" AND ".join((_s_truthy if t == "truthy" else _s_given)(a) for a, t in needs) or "TRUE")
    for tool, needs in R.TOOL_RULES.items()
)
_OFFERED = "('get_current_weather', 'unit_converter', 'translate_text')"
S_CHECKED = f"""checked AS (SELECT prompt_id, gen_id, turn, n,
  coalesce(prompt_id % 6 <> 5 AND json_extract_string(c, '$.name') IN {_OFFERED}
    AND CASE json_extract_string(c, '$.name') {_RULES} ELSE FALSE END, FALSE) AS valid
  FROM (SELECT *, {_ARGS} AS args FROM calls))"""


@query(
    "r13_valid_call",
    f"""WITH {S_TTURNS}, {S_BODIES}, {S_CHECKED} SELECT prompt_id, gen_id, turn, count(*) AS calls,
  count(*) FILTER (valid) AS valid FROM checked GROUP BY ALL""",
)
def r13(spark, sf):
    offered = R.offered_names(F.when(F.col("prompt_id") % 6 != 5, F.lit(D.OFFERED)))
    rows = D.tool_turns(spark, sf).withColumn("calls", R.parse_tool_calls(F.col("text")))
    valid = F.filter("calls", lambda c: R.valid_call(c, offered))
    return rows.where(F.size("calls") > 0).select(
        "prompt_id",
        "gen_id",
        "turn",
        F.size("calls").cast("bigint").alias("calls"),
        F.size(valid).cast("bigint").alias("valid"),
    )


# the stripped turns are what the reward reads calls from
_PER_ROLLOUT = f"""{S_TTURNS}, {S_STRIPPED},
bodies AS (SELECT prompt_id, gen_id, turn, unnest(b) AS body, generate_subscripts(b, 1) AS n
  FROM (SELECT *, regexp_extract_all(t, '{R.TOOL_CALL}', 1) AS b FROM strip)),
calls AS (SELECT prompt_id, gen_id, turn, n, CAST(trim(body) AS JSON) AS c FROM bodies WHERE json_valid(trim(body))),
{S_CHECKED}, tally AS (SELECT prompt_id, gen_id, count(*) AS calls, count(*) FILTER (valid) AS valid FROM checked GROUP BY ALL),
ro AS (SELECT s.prompt_id, s.gen_id, arg_max(s.t, s.turn) AS answer, arg_max(o.t, o.turn) AS response,
  -0.5 * sum(abs({s_count('s.t', '<tool_call>')} - {s_count('s.t', '</tool_call>')})) AS tags,
  (s.prompt_id + s.gen_id) % 5 = 0 AS unfinished,
  CASE s.prompt_id % 4 WHEN 0 THEN CAST([] AS VARCHAR[]) WHEN 1 THEN [s.prompt_id || '.5']
    WHEN 2 THEN [CAST(s.prompt_id + 1100 AS VARCHAR), 'x3'] ELSE [CAST(s.prompt_id AS VARCHAR), CAST(s.prompt_id AS VARCHAR), 'IT IS'] END AS gt,
  CASE WHEN s.prompt_id % 3 <> 0 THEN {s_u("(s.prompt_id || '-' || s.gen_id)", 'agent')} * 4 - 2 END AS score
  FROM strip s JOIN tturns o USING (prompt_id, gen_id, turn) GROUP BY s.prompt_id, s.gen_id),
full_ro AS (SELECT ro.*, coalesce(calls, 0) AS calls, coalesce(valid, 0) AS valid,
  CASE WHEN unfinished THEN '' ELSE string_split(answer, '</tool_call>')[-1] END AS last
  FROM ro LEFT JOIN tally USING (prompt_id, gen_id))"""
_GAP = "(abs(valid - len(gt)) + greatest(0, calls - valid))"
_GAP_REWARD = f"(CASE WHEN {_GAP} = 0 THEN 0.5 ELSE -0.5 * {_GAP} END)"


@query(
    "r14_tool_gap_reward",
    f"""WITH {_PER_ROLLOUT} SELECT prompt_id, gen_id, {s_r6(_GAP_REWARD)} AS reward FROM full_ro""",
)
def r14(spark, sf):
    rows = O.agent_reward(D.tool_rollouts(spark, sf))
    points = R.tool_gap_reward(F.col("calls"), F.col("valid_calls"), F.size("gt"))
    return rows.select("prompt_id", "gen_id", r6(points).alias("reward"))


# A free number is a whole run of word characters and dots that reads as a number.
_RUNS = rf"(^|[^{WORD}.])([-+]?[{WORD}.]+)"


def s_found(text: str, gt: str) -> str:
    nums = f"list_transform(list_filter(regexp_extract_all(replace({text}, ',', ''), '{_RUNS}', 2), lambda z: regexp_full_match(z, '{R.NUMBER}')), lambda z: CAST(z AS DOUBLE))"
    bare = f"replace({s_strip('g')}, ',', '')"
    return f"""list_filter(list_distinct({gt}), lambda g: ({s_strip('g')} <> '' AND contains(lower({text}), lower({s_strip('g')})))
  OR (regexp_full_match({bare}, '{R.NUMBER}') AND len(list_filter({nums}, lambda q: abs(q - TRY_CAST({bare} AS DOUBLE)) < 1e-6)) > 0))"""


_MATCH = f"(CASE WHEN len(gt) = 0 THEN 0 ELSE CAST(2.5 AS DOUBLE) * len({s_found('last', 'gt')}) / len(gt) END)"


@query(
    "r15_gt_match",
    f"WITH {_PER_ROLLOUT} SELECT prompt_id, gen_id, {s_r6(_MATCH)} AS reward FROM full_ro",
)
def r15(spark, sf):
    answer = R.strip_think(F.col("response"))
    rows = D.tool_rollouts(spark, sf).withColumn("last", R.final_text(answer, F.col("unfinished")))
    return rows.select(
        "prompt_id", "gen_id", r6(R.gt_match(F.col("last"), F.col("gt"))).alias("reward")
    )


@query(
    "r16_final_text",
    f"WITH {_PER_ROLLOUT} SELECT prompt_id, gen_id, md5(last) AS last_md5 FROM full_ro",
)
def r16(spark, sf):
    answer = R.strip_think(F.col("response"))
    return D.tool_rollouts(spark, sf).select(
        "prompt_id", "gen_id", F.md5(R.final_text(answer, F.col("unfinished"))).alias("last_md5")
    )


_SPOKEN = f"(CASE WHEN contains(response, '</think>') THEN {s_strip(s_after_first('response', '</think>'))} ELSE answer END)"
_PLAIN = f"({s_length('response')} + {s_think('response')} + coalesce(score, 0) - {s_penalty('spoken_w')})"
_TOOLED = f"({_GAP_REWARD} + {_MATCH} - CASE WHEN unfinished THEN 0.5 ELSE 0 END - {s_penalty('last_w')})"


S_AGENT_REWARD = f"""WITH {_PER_ROLLOUT}, w AS (SELECT *, {s_words(_SPOKEN)} AS spoken_w,
  {s_words("CASE WHEN last <> '' THEN last ELSE answer END")} AS last_w FROM full_ro)
SELECT prompt_id, gen_id, calls, valid AS valid_calls,
  {s_r6(s_clip(f"(tags + CASE WHEN calls = 0 THEN {_PLAIN} ELSE {_TOOLED} END)"))} AS reward FROM w"""


def _rewarded(rows):
    return rows.select(
        "prompt_id",
        "gen_id",
        F.col("calls").cast("bigint").alias("calls"),
        F.col("valid_calls").cast("bigint").alias("valid_calls"),
        r6(F.col("reward")).alias("reward"),
    )


@query("r17_agent_reward", S_AGENT_REWARD)
def r17(spark, sf):
    return _rewarded(O.agent_reward(D.tool_rollouts(spark, sf)))


@query("r17_agent_reward_from_turns", S_AGENT_REWARD)
def r17_turns(spark, sf):
    """From turns in long form: none are gathered."""
    return _rewarded(O.agent_reward_from_turns(D.tool_turns(spark, sf), D.tool_tasks(spark, sf)))


# ---- lookups ------------------------------------------------------------------

_CITIES = ["Paris", "北京", "Nowhere", "New York", "Sydney"]
_TEXTS = ["Good morning", "今天天气真好", 'say "hi"\n', "Happy birthday", "x"]
_PAIRS = [("km", "Miles"), ("kg", "pounds"), ("a", "b"), ("Celsius", "fahrenheit"), ("feet", "meters")]
_MONEY = [("USD", "CNY"), ("JPY", "CNY"), ("CNY", "USD"), ("CNY", "JPY"), ("EUR", "CNY")]
_ZONES = ["Asia/Tokyo", "Europe/Paris", "Mars/Base", "Asia/Shanghai", "Europe/London"]
_TOOLS = {
    "view": "get_current_weather",
    "purchase": "unit_converter",
    "signup": "translate_text",
    "click": "get_exchange_rate",
}


def _pick(values, i):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (i % len(values) + 1).cast("int"))


def lookup_calls(spark, sf):
    """A call per event: the tool by type, the arguments by id and value."""
    e, i = spread(D.table(spark, sf, "events"), "event_id"), F.col("event_id")
    kind = F.col("event_type")
    name = F.when(kind == "error", F.when(i % 2 == 0, F.lit("get_current_time")).otherwise(F.lit("no_such_tool")))
    for t, tool in _TOOLS.items():
        name = F.when(kind == t, F.lit(tool)).otherwise(name)
    zone = F.when(i % 4 != 0, _pick(_ZONES, i))
    args = F.to_json(
        F.when(kind == "view", F.struct(_pick(_CITIES, i).alias("location")))
    )
    args = F.coalesce(
        args,
        F.to_json(F.when(kind == "purchase", F.struct(F.col("value").alias("value"), _pick([p[0] for p in _PAIRS], i).alias("from_unit"), _pick([p[1] for p in _PAIRS], i).alias("to_unit")))),
        F.to_json(F.when(kind == "signup", F.struct(_pick(_TEXTS, i).alias("text"), _pick(["chinese", "english"], i).alias("target_language")))),
        F.to_json(F.when(kind == "click", F.struct(_pick([p[0] for p in _MONEY], i).alias("from_currency"), _pick([p[1] for p in _MONEY], i).alias("to_currency")))),
        F.to_json(F.when(kind == "error", F.struct(zone.alias("timezone")))),
    )
    call = F.concat(F.lit('{"name":"'), name, F.lit('","arguments":'), args, F.lit("}"))
    return e.select(i, name.alias("name"), F.parse_json(call).alias("call"))


def _values(rows) -> str:
    def cell(v):
        return str(v) if isinstance(v, float) else "'" + v.replace("'", "''") + "'"

    return ", ".join("(" + ", ".join(cell(v) for v in r) + ")" for r in rows)


def _s_pick(values) -> str:
    return "[" + ", ".join("'" + v + "'" for v in values) + f"][event_id % {len(values)} + 1]"


def _s_json(x: str) -> str:
    """JSON text of a string."""
    return f"CAST(to_json({x}) AS VARCHAR)"


_FACTOR = "coalesce(u.factor, CAST(1.0 AS DOUBLE))"
# decimal text without trailing zeros, at least one place
_S_NUM = r"regexp_replace(CAST(CAST({x} AS DECIMAL(38,6)) AS VARCHAR), '(\.\d+?)0+$', '\1')"
S_LOOKUP = f"""WITH weather(location, temp, cond) AS (VALUES {_values(O.WEATHER)}), times(tz, ts) AS (VALUES {_values(O.TIMES)}),
rates(f, t, rate) AS (VALUES {_values(O.RATES)}), texts(x, l, o) AS (VALUES {_values(O.TRANSLATIONS)}), units(pair, factor) AS (VALUES {_values(O.UNITS)}),
c AS (SELECT event_id, event_type, value, {_s_pick(_CITIES)} AS loc, CASE WHEN event_id % 4 <> 0 THEN {_s_pick(_ZONES)} ELSE 'Asia/Shanghai' END AS zone,
  {_s_pick([p[0] for p in _MONEY])} AS cf, {_s_pick([p[1] for p in _MONEY])} AS ct, {_s_pick(_TEXTS)} AS txt,
  {_s_pick(['chinese', 'english'])} AS lang, lower({_s_pick([p[0] for p in _PAIRS])} || '_' || {_s_pick([p[1] for p in _PAIRS])}) AS pr FROM events),
j AS (SELECT event_id, CASE event_type
  WHEN 'view' THEN '{{"city": ' || {_s_json('loc')} || ', "temperature": ' || {_s_json("coalesce(temp, '22°C')")} || ', "humidity": "65%", "condition": ' || {_s_json("coalesce(cond, '晴')")} || '}}'
  WHEN 'purchase' THEN '{{"result": ' || {_S_NUM.format(x=f"round(c.value * {_FACTOR}, 4)")} || '}}'
  WHEN 'signup' THEN '{{"translated_text": ' || {_s_json('coalesce(o, txt)')} || '}}'
  WHEN 'click' THEN '{{"from": ' || {_s_json('cf')} || ', "to": ' || {_s_json('ct')} || ', "rate": ' || {_S_NUM.format(x='coalesce(rate, 1.0)')} || '}}'
  ELSE CASE WHEN event_id % 2 = 0 THEN '{{"datetime": ' || {_s_json("coalesce(ts, '2025-03-07 14:30:00')")} || ', "timezone": ' || {_s_json('zone')} || '}}' END END AS result
  FROM c LEFT JOIN weather ON loc = location LEFT JOIN times ON zone = tz LEFT JOIN rates r ON cf = r.f AND ct = r.t
  LEFT JOIN texts ON txt = x AND lang = l LEFT JOIN units u ON pr = u.pair)"""


@query("r18_tool_lookup", f"{S_LOOKUP} SELECT event_id, result FROM j")
def r18(spark, sf):
    out = O.tool_lookup(lookup_calls(spark, sf))
    return out.select("event_id", "result")


@query(
    "r19_tool_result_text",
    f"""{S_LOOKUP} SELECT event_id, left(coalesce(result || repeat(result, CAST(event_id % 60 AS INTEGER)), '{{"error": "tool not found"}}'), 2048) AS answer FROM j""",
)
def r19(spark, sf):
    out = O.tool_lookup(lookup_calls(spark, sf))
    long = F.concat("result", F.repeat("result", (F.col("event_id") % 60).cast("int")))
    return out.select("event_id", R.tool_result_text(long).alias("answer"))


# ---- rollouts to a batch report --------------------------------------------------

_BATCH = "CAST(prompt_id // 32 AS BIGINT)"


@query(
    "q01_reward_report",
    f"""WITH {S_ANSWERS}, s AS (SELECT prompt_id, gen_id, {_BATCH} AS batch_id, length(t) AS size, {S_REWARD} AS reward FROM answers),
g AS (SELECT *, (reward - avg(reward) OVER p) / (stddev_samp(reward) OVER p + 1e-4) AS raw, stddev_pop(reward) OVER p AS spread FROM s WINDOW p AS (PARTITION BY prompt_id)),
a AS (SELECT *, CASE WHEN raw IS NOT NULL THEN greatest(least(raw, 10.0), -10.0) END AS held FROM g),
b AS (SELECT *, (held - avg(held) OVER b) / (stddev_samp(held) OVER b + 1e-8) AS advantage FROM a WINDOW b AS (PARTITION BY batch_id))
SELECT batch_id, count(*) AS rollouts, count(DISTINCT prompt_id) AS prompts, {s_r6('avg(reward)')} AS reward,
  {s_r6('avg(size)')} AS avg_chars, {s_r6('avg(advantage)')} AS advantages_mean, {s_r6('stddev_samp(advantage)')} AS advantages_std FROM b GROUP BY batch_id""",
)
def reward_report(spark, sf):
    """Rollouts, model scores, rule rewards, advantages, one line per batch."""
    scored = O.reasoning_reward(D.answers(spark, sf), D.rollout_scores(spark, sf))
    rows = scored.select(
        "prompt_id",
        "gen_id",
        F.floor(F.col("prompt_id") / 32).cast("bigint").alias("batch_id"),
        F.length("completion").alias("size"),
        "reward",
    )
    return (
        OB.group_advantage(rows)
        .groupBy("batch_id")
        .agg(
            F.count(F.lit(1)).alias("rollouts"),
            F.count_distinct("prompt_id").alias("prompts"),
            r6(F.avg("reward")).alias("reward"),
            r6(F.avg("size")).alias("avg_chars"),
            r6(F.avg("advantage")).alias("advantages_mean"),
            r6(F.stddev_samp("advantage")).alias("advantages_std"),
        )
    )

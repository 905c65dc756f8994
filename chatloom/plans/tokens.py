"""Tokens, labels and masks: T1 to T26."""

from pyspark.sql import functions as F

from chatloom.functions import arrays as A
from chatloom.functions import chat as C
from chatloom.operators import samples as S
from chatloom.operators import trajectories as TR
from chatloom.operators import vocab as V
from chatloom.plans.chats import s_body, s_injected
from chatloom.plans.common import (
    S_TURNS,
    digest,
    query,
    r6,
    s_digest,
    s_encode,
    s_pad,
    s_r6,
    s_u,
    s_vocab,
    s_wsum,
    wsum,
)
from chatloom.plans.sources import S_PAIRS, preference_rows, s_pair_text
from chatloom.session import fresh_path, materialize
from chatloom.sources import tables as D
from chatloom.sources.readers import read_special_ids

CHAT_VOCAB = 2000
_EMPTY_INTS = "CAST([] AS INTEGER[])"


_STORED: dict[tuple, str] = {}


def _stored(spark, sf, name, build):
    """A vocabulary that is counted once in a session and kept, for as long as the table's files are the same."""
    file = F.struct(*[F.col(f"_metadata.file_{c}") for c in ("path", "size", "modification_time")])
    files = D.table(spark, sf, name).select(file.alias("f")).distinct()
    state = files.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("f"))).first()
    key = (spark.sparkContext.applicationId, name, *state)
    if key not in _STORED:
        path = fresh_path(spark, "vocab")
        V.write_vocab(build(), path)
        _STORED[key] = path
    return V.read_vocab(spark, _STORED[key])


def counted_vocab(spark, sf):
    return V.build_vocab(D.documents(spark, sf))


def doc_vocab(spark, sf):
    return _stored(spark, sf, "documents", lambda: counted_vocab(spark, sf))


def chat_vocab(spark, sf):
    table = D.table(spark, sf, "conversations")
    return _stored(spark, sf, "conversations", lambda: V.build_vocab(table, size=CHAT_VOCAB))


def doc_ids(spark, sf, max_len=None):
    docs = D.documents(spark, sf).select("doc_id", "text")
    return V.encode(docs, V.token_lookup(doc_vocab(spark, sf)), max_len=max_len)


S_DOC_VOCAB = s_vocab("documents", V.SIZE)
S_CHAT_VOCAB = s_vocab("conversations", CHAT_VOCAB)
S_DOC_IDS = f"{S_DOC_VOCAB}, {s_encode('documents', 'ids')}"


@query("t01_build_vocab", f"WITH {S_DOC_VOCAB} SELECT token, id, n AS count FROM vocab")
def t01(spark, sf):
    return counted_vocab(spark, sf)


@query(
    "t01_vocab_checks",
    f"""WITH {S_DOC_VOCAB} SELECT count(*) AS tokens, min(id) AS min_id, max(id) AS max_id,
  count(DISTINCT id) AS distinct_ids, max(id) >= {V.SIZE} AS beyond_size FROM vocab""",
)
def t01_checks(spark, sf):
    return V.vocab_checks(counted_vocab(spark, sf))


@query(
    "t02_encode",
    f"""WITH {S_DOC_IDS} SELECT doc_id, len(ids) AS tokens,
  len(list_filter(ids, lambda i: i = 1)) AS unknown, {s_digest('ids')} AS ids_md5 FROM ids""",
)
def t02(spark, sf):
    return doc_ids(spark, sf).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("tokens"),
        F.size(F.filter("ids", lambda i: i == V.UNK)).cast("bigint").alias("unknown"),
        digest("ids").alias("ids_md5"),
    )


@query(
    "t02_encode_large_vocab",
    f"""WITH {S_DOC_IDS} SELECT doc_id, len(ids) AS tokens, {s_digest('ids')} AS ids_md5 FROM ids""",
)
def t02_joined(spark, sf):
    """The way taken when the vocabulary exceeds the lookup bound."""
    docs = D.documents(spark, sf).select("doc_id", "text")
    ids = V.encode(docs, doc_vocab(spark, sf), how="join")
    return ids.select(
        "doc_id", F.size("ids").cast("bigint").alias("tokens"), digest("ids").alias("ids_md5")
    )


@query(
    "t02_encode_both_ways",
    f"""WITH {S_DOC_VOCAB}, odd AS (SELECT doc_id % 50 AS k, CASE WHEN doc_id % 7 = 3 THEN NULL WHEN doc_id % 7 = 5 THEN '' ELSE text END AS text,
  doc_id FROM documents), full_rows AS (SELECT doc_id, text FROM odd WHERE text IS NOT NULL),
{s_encode('full_rows', 'ids')}, way AS (SELECT unnest(['join', 'lookup']) AS how)
SELECT how, k, count(*) AS rows, count(ids) AS encoded, CAST(coalesce(sum(len(ids)), 0) AS BIGINT) AS tokens,
  CAST(coalesce(sum(list_sum(ids)), 0) AS BIGINT) AS id_sum FROM odd LEFT JOIN ids USING (doc_id), way GROUP BY how, k""",
)
def t02_both(spark, sf):
    """From a stored vocabulary, over null and empty texts and keys that repeat."""
    path = fresh_path(spark, "vocab")
    V.write_vocab(doc_vocab(spark, sf), path)
    vocab = V.read_vocab(spark, path)
    d = F.col("doc_id")
    text = F.when(d % 7 == 3, F.lit(None)).when(d % 7 == 5, F.lit("")).otherwise(F.col("text"))
    rows = D.documents(spark, sf).select((d % 50).alias("k"), text.alias("text"))
    total = F.aggregate("ids", F.lit(0).cast("bigint"), lambda a, i: a + i)
    out = [
        V.encode(rows, vocab, key="k", how=how)
        .groupBy(F.lit(how).alias("how"), "k")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count("ids").alias("encoded"),
            F.coalesce(F.sum(F.size("ids")), F.lit(0)).cast("bigint").alias("tokens"),
            F.coalesce(F.sum(total), F.lit(0)).alias("id_sum"),
        )
        for how in ("lookup", "join")
    ]
    return out[0].unionByName(out[1])


@query(
    "t02_tokenizer_udf",
    f"""WITH c AS (SELECT doc_id, list_transform(string_split(text, ''), lambda c: unicode(c)) AS ids FROM documents)
SELECT doc_id, len(ids) AS tokens, {s_digest('ids')} AS ids_md5 FROM c""",
)
def t02_udf(spark, sf):
    """A tokenizer of the user's own (here: code points) in place of the table."""
    run = V.tokenizer_udf(lambda: lambda text: [ord(c) for c in text])
    ids = D.documents(spark, sf).select("doc_id", run("text").alias("ids"))
    return ids.select(
        "doc_id", F.size("ids").cast("bigint").alias("tokens"), digest("ids").alias("ids_md5")
    )


@query(
    "t03_decode_large_vocab",
    f"""WITH {S_DOC_VOCAB}, {s_encode('documents', 'ids')},
p AS (SELECT doc_id, unnest(ids) AS id, generate_subscripts(ids, 1) AS pos FROM ids),
d AS (SELECT doc_id, string_agg(token, '' ORDER BY pos) AS text FROM p JOIN vocab USING (id) GROUP BY doc_id)
SELECT i.doc_id, md5(coalesce(d.text, '')) AS text_md5 FROM ids i LEFT JOIN d USING (doc_id)""",
)
def t03_joined(spark, sf):
    """With special tokens kept, by the way taken beyond the lookup bound."""
    vocab = materialize(doc_vocab(spark, sf))
    ids = V.encode(D.documents(spark, sf).select("doc_id", "text"), vocab)
    out = V.decode(ids, vocab, skip_special=False, how="join")
    return out.select("doc_id", F.md5("decoded").alias("text_md5"))


@query(
    "t03_decode",
    f"""WITH {S_DOC_VOCAB}, {s_encode('documents', 'ids')},
p AS (SELECT doc_id, unnest(ids) AS id, generate_subscripts(ids, 1) AS pos FROM ids),
d AS (SELECT doc_id, string_agg(token, '' ORDER BY pos) AS text FROM p JOIN vocab USING (id)
  WHERE id >= {len(V.SPECIALS)} GROUP BY doc_id)
SELECT i.doc_id, md5(coalesce(d.text, '')) AS text_md5 FROM ids i LEFT JOIN d USING (doc_id)""",
)
def t03(spark, sf):
    docs = D.documents(spark, sf).select("doc_id", "text")
    vocab = materialize(doc_vocab(spark, sf))  # read twice
    ids = V.encode(docs, vocab)
    return V.decode(ids, vocab).select("doc_id", F.md5("decoded").alias("text_md5"))


# ---- id rows made from the number rows -------------------------------------

S_ROLL = f"""base AS (SELECT vec_id, vec_id // 8 AS prompt_id, CAST(vec_id % 8 AS INTEGER) AS gen_id, vec_id // 64 AS batch_id, label,
  list_transform(embedding, lambda v: abs(CAST(v AS DOUBLE))) AS x FROM embeddings),
mid AS (SELECT *, list_transform(x, lambda v: -v) AS new_logps,
  list_transform(x, lambda v, i: -v * (CAST(0.9 AS DOUBLE) + CAST(0.02 AS DOUBLE) * ((i - 1) % 10))) AS old_logps,
  list_transform(x, lambda v: -v * CAST(1.1 AS DOUBLE) - CAST(0.01 AS DOUBLE)) AS ref_logps,
  list_transform(x, lambda v: CAST(floor(v * 1000) AS INTEGER) % 13) AS ids,
  (label - 4.5) / 2 + {s_u('vec_id', 'reward')} AS reward FROM base),
roll AS (SELECT *, coalesce(nullif(list_position(ids, {D.EOS}), 0), len(ids)) AS stop,
  list_transform(ids, lambda v, i: CAST(i <= coalesce(nullif(list_position(ids, {D.EOS}), 0), len(ids)) AS INTEGER)) AS mask FROM mid)"""


def _roll(select: str) -> str:
    return f"WITH {S_ROLL} SELECT vec_id, {select} FROM roll"


def _ints(spark, sf):
    return D.logged_rollouts(spark, sf)


def _array_query(name: str, sql: str, column):
    """A query of one id-array column over all number rows."""

    @query(name, _roll(f"{s_digest(sql)} AS ids_md5, len({sql}) AS width"))
    def run(spark, sf):
        rows = _ints(spark, sf).select("vec_id", column().alias("a"))
        return rows.select(
            "vec_id", digest("a").alias("ids_md5"), F.size("a").cast("bigint").alias("width")
        )

    return run


_ids = lambda: F.col("ids")

_array_query(
    "t04_frame_ids",
    "list_concat(list_concat([2], ids[1:48]), [3])",
    lambda: A.frame_ids(_ids(), V.BOS, V.EOS, 50),
)
_array_query("t05_pad_right", s_pad("ids", 70, 0), lambda: A.pad_right(_ids(), 70, 0))
_array_query(
    "t10_shift",
    "list_concat(list_concat(ids[1:len(ids) - 1], ids[2:]), mask[2:])",
    lambda: F.concat(
        A.shift(F.col("ids"), F.col("mask"))["x"],
        A.shift(F.col("ids"), F.col("mask"))["y"],
        A.shift(F.col("ids"), F.col("mask"))["m"].cast("array<int>"),
    ),
)
_array_query(
    "t12_keep_tail",
    "CASE WHEN label = 0 THEN ids ELSE ids[greatest(len(ids) - label * 8 + 1, 1):] END",
    lambda: A.keep_tail(_ids(), F.col("label") * 8),
)
_array_query(
    "t13_pad_left",
    "list_concat(list_transform(range(6), lambda k: 0), ids)",
    lambda: A.pad_left(_ids(), 70, 0),
)
_array_query(
    "t15_completion_mask", "mask", lambda: A.completion_mask(_ids(), D.EOS)
)
_array_query(
    "t26_append_once",
    "CASE WHEN ids[len(ids)] = 5 THEN ids ELSE list_append(ids, 5) END",
    lambda: A.append_once(_ids(), 5),
)
_array_query(
    "t24_remap_special_ids",
    "list_transform(ids, lambda v: CASE v WHEN 10 THEN 2 WHEN 11 THEN 3 ELSE v END)",
    lambda: A.remap_special_ids(_ids(), {10: 2, 11: 3, 4: 1}, 10),
)
@query(
    "t24_remap_saved_ids",
    f"""WITH {S_ROLL} SELECT vec_id, {s_digest('list_transform(ids, lambda v: CASE v WHEN 10 THEN 2 WHEN 12 THEN 5 ELSE v END)')} AS ids_md5 FROM roll""",
)
def t24_saved(spark, sf):
    """Ids moved to the places that a saved tokenizer configuration gives them."""
    path = fresh_path(spark, "tokenizer")
    saved = '{"added_tokens_decoder": {"2": {"content": "<a>"}, "5": {"content": "<c>"}, "40": {"content": "<b>"}}}'
    spark.range(1).select(F.lit(saved).alias("value")).write.text(path)
    known = {r.token: r.id for r in read_special_ids(spark, path).collect()}
    table = A.remap_table({"<a>": 10, "<b>": 11, "<c>": 12, "<d>": 9}, known, 10)
    rows = _ints(spark, sf).select("vec_id", A.remap_special_ids(F.col("ids"), table, 10).alias("ids"))
    return rows.select("vec_id", digest("ids").alias("ids_md5"))


_array_query(
    "t17_response_mask",
    "list_transform(ids[2:], lambda v, i: CAST(i - 1 >= 20 + label AND v <> 0 AS INTEGER))",
    lambda: A.response_mask(_ids(), F.col("label") + 20, 0),
)
# the mask opens at place `label`: 1 from there on
_OPEN_SQL = "list_transform(ids, lambda v, i: CAST(i > label * 5 AS INTEGER))"
_array_query(
    "t16_agent_mask",
    f"""list_transform(list_zip(ids[2:], ({_OPEN_SQL})[2:], list_transform(ids[2:], lambda v, i: i)),
  lambda e: CASE WHEN e[3] <= coalesce(nullif(list_position(list_transform(list_zip(ids[2:], ({_OPEN_SQL})[2:]),
    lambda z: z[1] = {D.EOS} AND z[2] = 1), TRUE), 0), len(ids)) THEN e[2] ELSE 0 END)""",
    lambda: A.agent_mask(
        F.transform("ids", lambda v, i: (i >= F.col("label") * 5).cast("int")), _ids(), D.EOS
    ),
)


@query(
    "t14_attention_mask",
    _roll(
        f"""{s_digest('list_transform(ids, lambda v: CAST(v <> 0 AS INTEGER))')} AS mask_md5,
  CAST(list_sum(list_transform(ids, lambda v: CAST(v <> 0 AS INTEGER))) AS BIGINT) AS real_len"""
    ),
)
def t14(spark, sf):
    mask = A.attention_mask(F.col("ids"), 0)
    return _ints(spark, sf).select(
        "vec_id",
        digest(mask).alias("mask_md5"),
        A.mask_sum(mask).cast("bigint").alias("real_len"),
    )


@query(
    "t18_response_len",
    f"WITH {S_ROLL} SELECT batch_id, count(*) AS rollouts, {s_r6('avg(stop)')} AS avg_len, sum(stop)::BIGINT AS total_len FROM roll GROUP BY batch_id",
)
def t18(spark, sf):
    size = A.response_len(F.col("ids"), D.EOS)
    return (
        _ints(spark, sf)
        .groupBy("batch_id")
        .agg(
            F.count(F.lit(1)).alias("rollouts"),
            r6(F.avg(size)).alias("avg_len"),
            F.sum(size).alias("total_len"),
        )
    )


_N = "label * 10"


@query(
    "t19_align_logps",
    _roll(
        f"""{s_wsum(f'''CASE WHEN 64 < {_N} THEN list_concat(list_transform(range({_N} - 64), lambda k: CAST(0 AS DOUBLE)), new_logps)
    WHEN label = 0 THEN CAST([] AS DOUBLE[]) ELSE new_logps[64 - {_N} + 1:] END''')} AS weighted, CAST({_N} AS BIGINT) AS width"""
    ),
)
def t19(spark, sf):
    a = A.align_logps(F.col("new_logps"), F.col("label") * 10)
    rows = _ints(spark, sf).select("vec_id", a.alias("a"))
    return rows.select("vec_id", wsum("a").alias("weighted"), F.size("a").cast("bigint").alias("width"))


@query(
    "t25_audit_token_range",
    f"""WITH {S_ROLL} SELECT vec_id, p - 1 AS position, ids[p] AS id
  FROM roll, unnest(range(1, 65)) AS r(p) WHERE ids[p] >= 11""",
)
def t25(spark, sf):
    out = V.audit_token_range(_ints(spark, sf), "ids", "vec_id", 11)
    return out.withColumn("position", F.col("position").cast("bigint"))


@query(
    "t25_token_range",
    _roll("list_min(ids) AS min_id, list_max(ids) AS max_id, ids[len(ids)] = 5 AS ends_with_mark"),
)
def t25_rows(spark, sf):
    return _ints(spark, sf).select(
        "vec_id",
        F.array_min("ids").alias("min_id"),
        F.array_max("ids").alias("max_id"),
        (F.element_at("ids", -1) == 5).alias("ends_with_mark"),
    )


@query(
    "t23_expand_generations",
    "SELECT conv_id, g AS gen_id, count(*) AS rows FROM (SELECT DISTINCT conv_id FROM conversations), unnest(range(8)) AS r(g) GROUP BY ALL",
)
def t23(spark, sf):
    prompts = D.table(spark, sf, "conversations").select("conv_id").distinct()
    return (
        TR.expand_generations(prompts, 8)
        .groupBy("conv_id", F.col("gen_id").cast("bigint").alias("gen_id"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


@query(
    "t22_pad_batch",
    f"""WITH {S_ROLL}, c AS (SELECT vec_id, batch_id, ids[1:stop] AS ids FROM roll),
w AS (SELECT batch_id, max(len(ids)) AS w FROM c GROUP BY batch_id)
SELECT vec_id, w AS width, {s_digest(s_pad('ids', 'w', 0))} AS ids_md5 FROM c JOIN w USING (batch_id)""",
)
def t22(spark, sf):
    cut = _ints(spark, sf).select(
        "vec_id", "batch_id", F.slice("ids", F.lit(1), A.response_len(F.col("ids"), D.EOS).cast("int")).alias("ids")
    )
    return TR.pad_batch(cut, {"ids": 0}).select(
        "vec_id", F.size("ids").cast("bigint").alias("width"), digest("ids").alias("ids_md5")
    )


# ---- sample tables ----------------------------------------------------------


@query(
    "t06_pretrain_samples",
    f"""WITH {S_DOC_VOCAB}, {s_encode('documents', 'cut', max_len=510)},
p AS (SELECT doc_id, {s_pad('list_concat(list_concat([2], ids), [3])', 512, 0)} AS ids FROM cut)
SELECT doc_id, {s_digest('ids')} AS ids_md5,
  {s_digest('list_transform(ids, lambda v: CASE WHEN v = 0 THEN -100 ELSE v END)')} AS labels_md5,
  CAST(list_sum(list_transform(ids, lambda v: CAST(v <> 0 AS INTEGER))) AS BIGINT) AS real_len FROM p""",
)
def t06(spark, sf):
    docs = D.documents(spark, sf)
    rows = S.pretrain_samples(docs, V.token_lookup(doc_vocab(spark, sf)))
    return rows.select(
        "doc_id",
        digest("input_ids").alias("ids_md5"),
        digest("labels").alias("labels_md5"),
        A.mask_sum(F.col("attention_mask")).cast("bigint").alias("real_len"),
    )


def s_spans(rows: str, key: str, out: str) -> str:
    """CTE ``out(key, ids, labels, mask)``: label = the latest marker to take effect
    at or before the position is a start (effects: start + 3, end + 2)."""
    return f"""{out}_p AS (SELECT {key}, unnest(ids) AS id, generate_subscripts(ids, 1) AS pos FROM {rows}),
{out}_m AS (SELECT *, CASE WHEN lag(id, 3) OVER w = {V.BOS} AND lag(id, 2) OVER w = {V.ASSISTANT} AND lag(id) OVER w = {V.NEWLINE} THEN pos END AS opens,
  CASE WHEN lag(id, 2) OVER w = {V.EOS} AND lag(id) OVER w = {V.NEWLINE} THEN pos END AS closes
  FROM {out}_p WINDOW w AS (PARTITION BY {key} ORDER BY pos)),
{out}_s AS (SELECT *, coalesce(max(opens) OVER w, 0) > coalesce(max(closes) OVER w, 0) AS inside
  FROM {out}_m WINDOW w AS (PARTITION BY {key} ORDER BY pos ROWS UNBOUNDED PRECEDING)),
{out} AS (SELECT {key}, list(id ORDER BY pos) AS ids, list(CASE WHEN inside THEN id ELSE -100 END ORDER BY pos) AS labels,
  list(CASE WHEN inside THEN 1 ELSE 0 END ORDER BY pos) AS mask FROM {out}_s GROUP BY {key})"""


def _chat_ids(spark, sf, max_len=512):
    texts = D.chats(spark, sf).select(
        "conv_id", C.render_chat(F.col("conversations")).alias("text")
    )
    lookup = V.token_lookup(chat_vocab(spark, sf))
    return S.chat_ids(texts, lookup, max_len, "text", "conv_id", "ids")


S_CHAT_IDS = f"""{S_CHAT_VOCAB}, r AS (SELECT conv_id, body AS text FROM ({s_body('conversations')})),
{s_encode('r', 'e', key='conv_id', max_len=512)}, p AS (SELECT conv_id, {s_pad('ids', 512, 0)} AS ids FROM e),
{s_spans('p', 'conv_id', 'l')}"""


@query(
    "t07_assistant_labels",
    f"""WITH {S_CHAT_IDS} SELECT conv_id, {s_digest('ids')} AS ids_md5, {s_digest('labels')} AS labels_md5,
  CAST(list_sum(mask) AS BIGINT) AS labelled FROM l""",
)
def t07(spark, sf):
    labels = A.assistant_labels(F.col("ids"), V.ASSISTANT_OPEN, V.ASSISTANT_CLOSE)
    rows = _chat_ids(spark, sf).select("conv_id", "ids", labels.alias("labels"))
    return rows.select(
        "conv_id",
        digest("ids").alias("ids_md5"),
        digest("labels").alias("labels_md5"),
        F.size(F.filter("labels", lambda x: x != A.IGNORED)).cast("bigint").alias("labelled"),
    )


@query(
    "t09_assistant_mask",
    f"WITH {S_CHAT_IDS} SELECT conv_id, {s_digest('mask')} AS mask_md5 FROM l",
)
def t09(spark, sf):
    labels = A.assistant_labels(F.col("ids"), V.ASSISTANT_OPEN, V.ASSISTANT_CLOSE)
    return _chat_ids(spark, sf).select("conv_id", digest(A.label_mask(labels)).alias("mask_md5"))


@query(
    "t08_sft_samples",
    f"""WITH {S_CHAT_VOCAB}, turns AS (SELECT conv_id, turn, role, {D.THINKING} AS text, {D.TOOLS} AS tools FROM conversations),
{s_injected(0.2, 'sft/system')}, b AS ({s_body()}),
r AS (SELECT conv_id, CASE WHEN {s_u('conv_id', 'sft/think')} > 0.2 THEN replace(body, {D.EMPTY_THINK}, '') ELSE body END AS text FROM b),
{s_encode('r', 'e', key='conv_id', max_len=1024)}, p AS (SELECT conv_id, {s_pad('ids', 1024, 0)} AS ids FROM e),
{s_spans('p', 'conv_id', 'l')}
SELECT conv_id, {s_digest('ids')} AS ids_md5, {s_digest('labels')} AS labels_md5,
  len(list_filter(ids, lambda v: v <> 0)) AS real_len FROM l""",
)
def t08(spark, sf):
    lookup = V.token_lookup(chat_vocab(spark, sf))
    rows = S.sft_samples(D.chats(spark, sf, text=D.THINKING), lookup)
    return rows.select(
        "conv_id",
        digest("input_ids").alias("ids_md5"),
        digest("labels").alias("labels_md5"),
        A.mask_sum(F.col("attention_mask")).cast("bigint").alias("real_len"),
    )


def s_sft(text: str, max_len: int) -> str:
    """CTEs up to ``l(conv_id, ids, labels, mask)`` of chats whose turns read ``text``."""
    return f"""{S_CHAT_VOCAB}, {S_TURNS.replace('turns AS', 'told AS')},
turns AS (SELECT conv_id, turn, role, {text} AS text, tools FROM told),
{s_injected(0.2, 'sft/system')}, b AS ({s_body()}),
r AS (SELECT conv_id, CASE WHEN {s_u('conv_id', 'sft/think')} > 0.2 THEN replace(body, {D.EMPTY_THINK}, '') ELSE body END AS text FROM b),
{s_encode('r', 'e', key='conv_id', max_len=max_len)}, p AS (SELECT conv_id, {s_pad('ids', max_len, 0)} AS ids FROM e),
{s_spans('p', 'conv_id', 'l')}"""


def _sft(spark, sf, **options):
    lookup = V.token_lookup(chat_vocab(spark, sf))
    rows = S.sft_samples(D.chats(spark, sf), lookup, **options)
    return rows.select(
        "conv_id",
        digest("input_ids").alias("ids_md5"),
        digest("labels").alias("labels_md5"),
        A.mask_sum(F.col("attention_mask")).cast("bigint").alias("real_len"),
        F.md5(F.coalesce("tools", F.lit(""))).alias("tools_md5"),
        F.size(F.filter(F.coalesce("tool_calls", F.array()), lambda c: c.isNotNull())).cast("bigint").alias("calls"),
    )


_S_SFT_OUT = f"""SELECT l.conv_id, {s_digest('ids')} AS ids_md5, {s_digest('labels')} AS labels_md5,
  len(list_filter(ids, lambda v: v <> 0)) AS real_len, t.tools_md5, t.calls FROM l JOIN (SELECT conv_id,
  md5(coalesce(arg_max(tools, turn) FILTER (role = 'system' AND tools <> ''), '')) AS tools_md5, count(tool_calls) AS calls
  FROM told GROUP BY conv_id) t USING (conv_id)"""
_S_COT = "CASE WHEN reasoning_content <> '' THEN '<think>' || chr(10) || reasoning_content || chr(10) || '</think>' || chr(10) || chr(10) || text ELSE text END"
_S_TOOLS = """text || CASE WHEN role = 'system' AND tools <> '' THEN chr(10) || '<tools>' || chr(10) || tools || chr(10) || '</tools>' ELSE '' END
  || CASE WHEN tool_calls <> '' THEN chr(10) || '<tool_call>' || chr(10) || tool_calls || chr(10) || '</tool_call>' ELSE '' END"""


@query("t08_sft_reasoning", f"WITH {s_sft(_S_COT, 1024)} {_S_SFT_OUT}")
def t08_cot(spark, sf):
    return _sft(spark, sf, use_cot=True)


@query("t08_sft_tool_chats", f"WITH {s_sft(_S_TOOLS, 1024)} {_S_SFT_OUT}")
def t08_tools(spark, sf):
    return _sft(spark, sf, render=C.render_tool_chat)


@query("t08_sft_long_context", f"WITH {s_sft('text', 32768)} {_S_SFT_OUT}")
def t08_long(spark, sf):
    return _sft(spark, sf, max_len=32768)


_PAIR_LEN = 4096


def s_side(side: str) -> str:
    return f"""{side}_r AS (SELECT pair_id, {s_pair_text(side)} AS text FROM pairs),
{s_encode(side + '_r', side + '_e', key='pair_id', max_len=_PAIR_LEN)},
{side}_p AS (SELECT pair_id, {s_pad('ids', _PAIR_LEN, 0)} AS ids FROM {side}_e),
{s_spans(side + '_p', 'pair_id', side + '_l')}"""


@query(
    "t11_preference_samples",
    f"""WITH {S_PAIRS}, {S_DOC_VOCAB}, {s_side('chosen')}, {s_side('rejected')}
SELECT c.pair_id, {s_digest(f'c.ids[1:{_PAIR_LEN - 1}]')} AS x_chosen_md5, {s_digest('c.ids[2:]')} AS y_chosen_md5,
  CAST(list_sum(c.mask[2:]) AS BIGINT) AS loss_chosen, {s_digest('r.ids[2:]')} AS y_rejected_md5,
  CAST(list_sum(r.mask[2:]) AS BIGINT) AS loss_rejected, {s_digest(f'r.ids[1:{_PAIR_LEN - 1}]')} AS x_rejected_md5,
  len(list_filter(c.ids[1:{_PAIR_LEN - 1}], lambda v: v <> 0)) AS real_chosen,
  len(list_filter(r.ids[1:{_PAIR_LEN - 1}], lambda v: v <> 0)) AS real_rejected FROM chosen_l c JOIN rejected_l r USING (pair_id)""",
)
def t11(spark, sf):
    lookup = V.token_lookup(doc_vocab(spark, sf))
    rows = S.preference_samples(preference_rows(spark, sf), lookup, _PAIR_LEN)
    return rows.select(
        "pair_id",
        digest("x_chosen").alias("x_chosen_md5"),
        digest("y_chosen").alias("y_chosen_md5"),
        A.ones(F.col("mask_chosen")).cast("bigint").alias("loss_chosen"),
        digest("y_rejected").alias("y_rejected_md5"),
        A.ones(F.col("mask_rejected")).cast("bigint").alias("loss_rejected"),
        digest("x_rejected").alias("x_rejected_md5"),
        A.ones(F.col("attention_mask_chosen")).cast("bigint").alias("real_chosen"),
        A.ones(F.col("attention_mask_rejected")).cast("bigint").alias("real_rejected"),
    )


@query(
    "t11_stack_sides",
    f"""WITH {S_PAIRS}, {S_DOC_VOCAB}, {s_side('chosen')}, {s_side('rejected')},
u AS (SELECT pair_id, 'chosen' AS side, ids, mask FROM chosen_l UNION ALL SELECT pair_id, 'rejected', ids, mask FROM rejected_l)
SELECT pair_id, side, {s_digest('ids[2:]')} AS y_md5, CAST(list_sum(mask[2:]) AS BIGINT) AS loss_tokens FROM u""",
)
def t11_stacked(spark, sf):
    lookup = V.token_lookup(doc_vocab(spark, sf))
    rows = S.stack_sides(S.preference_samples(preference_rows(spark, sf), lookup, _PAIR_LEN))
    return rows.select(
        "pair_id",
        "side",
        digest("y").alias("y_md5"),
        A.ones(F.col("mask")).cast("bigint").alias("loss_tokens"),
    )


# ---- trajectories -----------------------------------------------------------

_PART = "CASE WHEN turn % 6 = 0 THEN 'prompt' WHEN turn % 2 = 1 THEN 'model' ELSE 'tool' END"


def agent_turns(spark, sf):
    """Six turns of a chat to a rollout; model turns end with the end id and a pad."""
    rows = D.table(spark, sf, "conversations").select(
        "conv_id", F.floor(F.col("turn") / 6).cast("int").alias("gen_id"), "turn", F.expr(_PART).alias("part"), "text"
    )
    ids = V.encode(rows, V.token_lookup(chat_vocab(spark, sf)))
    tail = F.array(F.lit(V.EOS), F.lit(V.PAD))
    ids = ids.withColumn(
        "ids", F.when(F.col("part") == "model", F.concat("ids", tail)).otherwise(F.col("ids"))
    )
    logps = F.transform("ids", lambda i: -(i % 7) / F.lit(10.0))
    return ids.select(
        F.col("conv_id").alias("prompt_id"), "gen_id", "turn", "part", "ids", logps.alias("logps")
    )


S_AGENT = f"""{S_CHAT_VOCAB}, ct AS (SELECT conv_id || '-' || turn AS k, conv_id, CAST(turn // 6 AS INTEGER) AS gen_id, turn, {_PART} AS part, text FROM conversations),
{s_encode('ct', 'e', key='k')}, aturn AS (SELECT conv_id AS prompt_id, gen_id, turn, part,
  CASE WHEN part = 'model' THEN list_filter(ids, lambda i: i NOT IN (0, 3)) ELSE ids END AS ids FROM ct JOIN e USING (k)),
tr AS (SELECT prompt_id, gen_id, coalesce(flatten(list(ids ORDER BY turn) FILTER (part = 'prompt')), {_EMPTY_INTS}) AS p,
  coalesce(flatten(list(ids ORDER BY turn) FILTER (part <> 'prompt')), {_EMPTY_INTS}) AS r,
  coalesce(flatten(list(list_transform(ids, lambda i: CAST(part = 'model' AS INTEGER)) ORDER BY turn) FILTER (part <> 'prompt')), {_EMPTY_INTS}) AS m,
  coalesce(flatten(list(list_transform(ids, lambda i: CASE WHEN part = 'model' THEN -(i % 7) / CAST(10.0 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) ORDER BY turn) FILTER (part <> 'prompt')), CAST([] AS DOUBLE[])) AS lp
  FROM aturn GROUP BY ALL)"""


@query(
    "t20_trajectory",
    f"""WITH {S_AGENT} SELECT prompt_id, gen_id, {s_digest('p')} AS prompt_md5, {s_digest('r')} AS response_md5,
  {s_digest('m')} AS mask_md5, {s_wsum('lp')} AS logps FROM tr""",
)
def t20(spark, sf):
    rows = TR.trajectory(agent_turns(spark, sf), V.PAD, V.EOS)
    return rows.select(
        "prompt_id",
        "gen_id",
        digest("prompt_ids").alias("prompt_md5"),
        digest("response_ids").alias("response_md5"),
        digest("response_mask").alias("mask_md5"),
        wsum("response_logps").alias("logps"),
    )


_MAX = 200


S_PACKED = f"""WITH {S_AGENT}, k AS (SELECT prompt_id, gen_id, list_concat(p, r) AS ids,
  list_concat(list_transform(p, lambda i: 0), m) AS mask,
  list_concat(list_transform(range(greatest(len(p) - 1, 0)), lambda i: CAST(0 AS DOUBLE)), lp) AS lps FROM tr),
c AS (SELECT prompt_id, gen_id, CASE WHEN len(ids) > {_MAX} THEN ids[len(ids) - {_MAX} + 1:] ELSE ids END AS a,
  CASE WHEN len(ids) > {_MAX} THEN mask[len(ids) - {_MAX} + 1:] ELSE mask END AS m,
  CASE WHEN len(ids) > {_MAX} THEN lps[greatest(len(lps) - {_MAX - 1} + 1, 1):] ELSE lps END AS l FROM k)
SELECT prompt_id, gen_id, {s_digest('a')} AS ids_md5, {s_digest('m')} AS mask_md5, {s_wsum('l')} AS logps,
  CAST(coalesce(nullif(list_position(m, 1) - 1, -1), len(m)) AS BIGINT) AS prompt_len FROM c"""


@query("t21_pack_trajectory", S_PACKED)
def t21(spark, sf):
    rows = TR.trajectory(agent_turns(spark, sf), V.PAD, V.EOS)
    return _packed(TR.pack_trajectory(rows, _MAX))


@query("t21_pack_long_rollouts", S_PACKED)
def t21_long(spark, sf):
    """From turns that arrive in any order, dealt over many partitions."""
    rows = TR.trajectory(agent_turns(spark, sf).repartition(13, "turn"), V.PAD, V.EOS)
    return _packed(TR.pack_trajectory(rows, _MAX))


def _packed(rows):
    return rows.select(
        "prompt_id",
        "gen_id",
        digest("ids").alias("ids_md5"),
        digest("mask").alias("mask_md5"),
        wsum("old_logps").alias("logps"),
        "prompt_len",
    )

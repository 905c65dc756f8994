"""The queries of this package over the given tables, with their SQL where SQL can say it."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chatloom.llm import (
    align,
    common,
    decontaminate,
    html_text,
    negatives,
    ngram_join,
    packing,
    pii,
    quality,
    secrets,
    simhash,
    toxicity,
    urls,
    wavelet,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op6_quality_rules(spark, sf):
    docs = common.table(spark, sf, "documents").select("doc_id", "text")
    rules = quality.train(docs, common.table(spark, sf, "labels"))
    return quality.judge(docs, rules).select("doc_id", *quality.STATS, "base_failed", "kept")


@query
def op3_secret_scan(spark, sf):
    docs = common.table(spark, sf, "documents").select("doc_id", "text")
    return secrets.report(secrets.scan(docs)).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"
    )


@query
def op10_personal_data(spark, sf):
    docs = common.table(spark, sf, "documents").select("doc_id", "text")
    return pii.report(pii.find(docs)).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"
    )


@query
def op2_decontaminate(spark, sf):
    docs = common.table(spark, sf, "documents").select("doc_id", "text")
    items = common.table(spark, sf, "benchmark")
    return decontaminate.report(decontaminate.contamination(docs, items))


ORACLE["op2_decontaminate"] = r"""
WITH low AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
dw AS (
  SELECT doc_id, list_filter(string_split_regex(t, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM low),
iw AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS s
  FROM iw, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS g(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM win),
dwin AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM dw, sizes, unnest(generate_series(1, len(w) - n + 1)) AS g(i)),
hit AS (SELECT doc_id, i, dwin.n AS n, item_id FROM dwin JOIN win ON dwin.s = win.s AND dwin.n = win.n),
cover AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit FROM hit, unnest(generate_series(i, i + n - 1)) AS g(k) GROUP BY 1),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY 1)
SELECT dw.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN cover USING (doc_id) LEFT JOIN found USING (doc_id)
"""


@query
def op5_pack(spark, sf):
    docs = common.table(spark, sf, "documents").select("doc_id", "text")
    return packing.best_fit_packing(docs, vocabulary("byte_bpe_50k.json"))


@query
def op9_ngram_join(spark, sf):
    docs = common.table(spark, sf, "documents").select("doc_id", "text")
    return ngram_join.join(docs).select("doc_id", "n_shingles", "component_id")


ORACLE["op9_ngram_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS sh
  FROM w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS g(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (
  SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 75 * (a.n + b.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(doc_id, root) AS (
  SELECT doc_id, doc_id FROM w UNION SELECT e.y, r.root FROM r JOIN e ON e.x = r.doc_id)
SELECT r.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(root) AS component_id
FROM r LEFT JOIN n USING (doc_id) GROUP BY r.doc_id
"""


@query
def op7_main_text(spark, sf):
    return html_text.main_text(common.table(spark, sf, "pages"))


@query
def op8_url_filter(spark, sf):
    return urls.judge(common.table(spark, sf, "pages").select("page_id", "url"))


@query
def op1_wavelet_tokens(spark, sf):
    docs = common.table(spark, sf, "documents").select("doc_id", "text")
    return wavelet.encode_corpus(docs, vocabulary("word_bpe_49k.json"))


@query
def op4_toxicity(spark, sf):
    docs = common.table(spark, sf, "documents").select("doc_id", "text")
    lexicon, weights = toxicity.learn(docs, common.table(spark, sf, "labels"))
    return toxicity.score(docs, lexicon, weights)


@query
def op11_simhash(spark, sf):
    docs = common.table(spark, sf, "documents").select("doc_id", "text")
    return simhash.report(simhash.near_duplicates(docs))


@query
def op12_align(spark, sf):
    docs = common.table(spark, sf, "documents").select("doc_id", "text")
    return align.alignment(docs, vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


@query
def op13_hard_negatives(spark, sf):
    return negatives.mine(common.table(spark, sf, "embeddings"))


ORACLE["op13_hard_negatives"] = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label, list_inner_product(a.e, b.e)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, own, vec_id AS positive_id, score AS positive_score FROM s WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id,
  row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> p.own
  AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

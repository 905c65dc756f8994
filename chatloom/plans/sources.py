"""Sources and sinks: S1 to S9."""

from pyspark.sql import functions as F

from chatloom.functions import chat as C
from chatloom.operators.batching import shuffle_epoch
from chatloom.operators.chats import chat_pieces
from chatloom.operators.preference import preference_accuracy
from chatloom.plans.common import S_TURNS, query, r6, s_frame, s_r6, s_u
from chatloom.session import fresh_path
from chatloom.sources import quarantine, readers, tables as D
from chatloom.sources.epochs import manifest, open_epoch, store_epoch
from chatloom.sources.writers import write_epoch, write_samples


def _roundtrip(spark, df, reader, label):
    path = fresh_path(spark, label)
    df.write.json(path)
    return reader(spark, path)


@query(
    "s01_read_pretrain",
    "SELECT md5(text) AS text_md5, count(*) AS copies FROM documents GROUP BY 1",
)
def read_pretrain(spark, sf):
    docs = _roundtrip(
        spark, D.table(spark, sf, "documents").select("text"), readers.read_pretrain, "pretrain"
    )
    return docs.groupBy(F.md5("text").alias("text_md5")).agg(F.count(F.lit(1)).alias("copies"))


_RENDERED = f"""WITH {S_TURNS}, r AS (SELECT conv_id, string_agg({s_frame()}, '' ORDER BY turn) AS body,
  count(*) AS messages, count(tools) AS offers, count(tool_calls) AS callers FROM turns GROUP BY conv_id)"""


@query(
    "s02_read_sft",
    _RENDERED
    + " SELECT md5(body) AS body_md5, messages, offers, callers, count(*) AS copies FROM r GROUP BY ALL",
)
def read_sft(spark, sf):
    rows = _roundtrip(
        spark, D.chats(spark, sf).select("conversations"), readers.read_sft, "sft"
    )
    conv = F.col("conversations")
    return rows.groupBy(
        F.md5(C.render_chat(conv)).alias("body_md5"),
        F.size(conv).cast("bigint").alias("messages"),
        F.size(F.filter(conv, lambda m: m["tools"].isNotNull())).cast("bigint").alias("offers"),
        F.size(F.filter(conv, lambda m: m["tool_calls"].isNotNull())).cast("bigint").alias("callers"),
    ).agg(F.count(F.lit(1)).alias("copies"))


S_PAIRS = f"""pairs AS (SELECT c.doc_id // 2 AS pair_id, c.source AS subset, c.doc_id AS chosen_id,
  r.doc_id AS rejected_id, c.text AS chosen_text, r.text AS rejected_text,
  floor({s_u('c.doc_id', 'pref')} * 20) AS chosen_score, floor({s_u('r.doc_id', 'pref')} * 20) AS rejected_score
  FROM documents c JOIN documents r ON r.doc_id = c.doc_id + 1 WHERE c.doc_id % 2 = 0)"""


def preference_rows(spark, sf):
    """Chat pairs: the same request answered by either document of a pair."""
    ask = C.message("user", F.concat(F.lit("Write for "), F.col("subset")))
    return D.doc_pairs(spark, sf).select(
        "pair_id",
        F.array(ask, C.message("assistant", F.col("chosen_text"))).alias("chosen"),
        F.array(ask, C.message("assistant", F.col("rejected_text"))).alias("rejected"),
    )


def s_pair_text(side: str) -> str:
    ask = s_frame("'user'", "'Write for ' || subset")
    return f"({ask} || {s_frame(chr(39) + 'assistant' + chr(39), side + '_text')})"


@query(
    "s03_read_preference",
    f"""WITH {S_PAIRS} SELECT md5({s_pair_text('chosen')}) AS chosen_md5,
  md5({s_pair_text('rejected')}) AS rejected_md5, count(*) AS copies FROM pairs GROUP BY ALL""",
)
def read_preference(spark, sf):
    rows = _roundtrip(
        spark, preference_rows(spark, sf).drop("pair_id"), readers.read_preference, "preference"
    )
    return rows.groupBy(
        F.md5(C.render_chat(F.col("chosen"))).alias("chosen_md5"),
        F.md5(C.render_chat(F.col("rejected"))).alias("rejected_md5"),
    ).agg(F.count(F.lit(1)).alias("copies"))


@query(
    "s04_read_rl_prompts",
    _RENDERED + " SELECT md5(body) AS body_md5, messages, count(*) AS copies FROM r GROUP BY ALL",
)
def read_rl_prompts(spark, sf):
    rows = _roundtrip(
        spark, D.chats(spark, sf).select("conversations"), readers.read_rl_prompts, "rl"
    )
    conv = F.col("conversations")
    return rows.groupBy(
        F.md5(C.render_chat(conv)).alias("body_md5"),
        F.size(conv).cast("bigint").alias("messages"),
    ).agg(F.count(F.lit(1)).alias("copies"))


@query(
    "s05_read_agent_tasks",
    _RENDERED + " SELECT md5(body) AS body_md5, conv_id || '.5 x' AS gt, count(*) AS copies FROM r GROUP BY ALL",
)
def read_agent_tasks(spark, sf):
    rows = D.chats(spark, sf).select(
        "conversations",
        F.array(F.concat(F.col("conv_id").cast("string"), F.lit(".5")), F.lit("x")).alias("gt"),
    )
    tasks = _roundtrip(spark, rows, readers.read_agent_tasks, "agent")
    return tasks.groupBy(
        F.md5(C.render_chat(F.col("conversations"))).alias("body_md5"),
        F.array_join("gt", " ").alias("gt"),
    ).agg(F.count(F.lit(1)).alias("copies"))


@query(
    "s06_chats_from_turns",
    """SELECT conv_id, count(*) AS messages, string_agg(role, ' ' ORDER BY turn) AS roles,
  md5(string_agg(text, '|' ORDER BY turn)) AS text_md5 FROM conversations GROUP BY conv_id""",
)
def chats_from_turns(spark, sf):
    conv = F.col("conversations")
    return D.chats(spark, sf).select(
        "conv_id",
        F.size(conv).cast("bigint").alias("messages"),
        F.array_join(F.transform(conv, lambda m: m["role"]), " ").alias("roles"),
        F.md5(F.array_join(F.transform(conv, lambda m: m["content"]), "|")).alias("text_md5"),
    )


@query(
    "s06_long_conversations",
    """WITH p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS place FROM conversations),
n AS (SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id)
SELECT conv_id, CAST(place // 3 AS INTEGER) AS segment, (max(place) + 1) = max(n) AS last, count(*) AS messages,
  md5(string_agg(text, '|' ORDER BY turn)) AS text_md5 FROM p JOIN n USING (conv_id) GROUP BY conv_id, place // 3""",
)
def long_conversations(spark, sf):
    """Conversations in pieces, for those longer than a row may be."""
    rows = chat_pieces(D.turns(spark, sf), 3)
    conv = F.col("conversations")
    return rows.select(
        "conv_id",
        "segment",
        "last",
        F.size(conv).cast("bigint").alias("messages"),
        F.md5(F.array_join(F.transform(conv, lambda m: m["content"]), "|")).alias("text_md5"),
    )


@query(
    "s07_read_score_card",
    f"""WITH {S_PAIRS} SELECT 'seeded' AS model, subset,
  {s_r6('avg(CASE WHEN chosen_score > rejected_score THEN 1.0 ELSE 0.0 END)')} AS accuracy FROM pairs GROUP BY subset""",
)
def read_score_card(spark, sf):
    path = fresh_path(spark, "card")
    cells = preference_accuracy(D.doc_pairs(spark, sf)).where(~F.col("overall"))
    # one flat object, as score cards are: its size is the number of subsets
    card = cells.agg(
        F.concat(
            F.lit('{"model": "seeded", "chat_template": "tokenizer", '),
            F.array_join(
                F.collect_list(
                    F.concat(F.lit('"'), "subset", F.lit('": '), F.col("accuracy").cast("string"))
                ),
                ", ",
            ),
            F.lit("}"),
        ).alias("value")
    )
    card.write.text(path)
    return readers.read_score_card(spark, path).withColumn("accuracy", r6(F.col("accuracy")))


S_LINE = D.LOG_LINE.format(f="printf")


@query(
    "s08_read_log",
    f"SELECT md5({S_LINE}) AS line_md5, count(*) AS lines FROM events GROUP BY 1",
)
def read_log(spark, sf):
    path = fresh_path(spark, "log")
    D.log_lines(spark, sf).select("line").write.text(path)
    return (
        readers.read_log(spark, path)
        .groupBy(F.md5("line").alias("line_md5"))
        .agg(F.count("offset").alias("lines"))
    )


@query(
    "s08_log_offsets",
    f"""WITH l AS (SELECT event_id, {S_LINE} AS line FROM events)
SELECT event_id % 8 AS log, md5(line) AS line_md5, CAST(coalesce(sum(length(line) + 1) OVER (PARTITION BY event_id % 8
  ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset" FROM l""",
)
def log_offsets(spark, sf):
    path = fresh_path(spark, "log")
    lines = D.log_lines(spark, sf).select(
        "line", (F.col("offset") / 1000).cast("bigint").alias("event_id")
    ).withColumn("log", F.col("event_id") % 8)
    ordered = lines.repartition(8, "log").sortWithinPartitions("log", "event_id")
    ordered.select("line", "log").write.partitionBy("log").text(path)  # a file for each log
    rows = readers.read_log(spark, path)
    log = F.regexp_extract("run", r"log=(\d+)", 1).cast("bigint")
    return rows.select(log.alias("log"), F.md5("line").alias("line_md5"), "offset")


@query(
    "s10_with_ids",
    """SELECT lang, source, count(*) AS rows, count(*) AS ids, count(*) - 1 AS highest
  FROM documents GROUP BY lang, source""",
)
def ids_by_content(spark, sf):
    rows = readers.with_ids(D.table(spark, sf, "documents").select("lang", "source"), "id")
    number = F.regexp_extract("id", r"-(\d+)$", 1).cast("bigint")
    return rows.groupBy("lang", "source").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("id").alias("ids"), F.max(number).alias("highest")
    )


@query(
    "s09_write_epoch",
    """SELECT doc_id, row_number() OVER (ORDER BY md5('43:' || doc_id), doc_id) - 1 AS position,
  md5(text) AS text_md5 FROM documents""",
)
def epoch_written(spark, sf):
    """An epoch's order and its files from one shuffle."""
    path = fresh_path(spark, "epoch")
    write_epoch(D.table(spark, sf, "documents").select("doc_id", "text"), "doc_id", path, shards=8, epoch=1)
    back = spark.read.parquet(path)
    return back.select("doc_id", "position", F.md5("text").alias("text_md5"))


@query(
    "s09_write_samples",
    """SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) - 1 AS position,
  md5(text) AS text_md5 FROM documents""",
)
def samples_written(spark, sf):
    path = fresh_path(spark, "samples")
    ordered = shuffle_epoch(D.table(spark, sf, "documents"), "doc_id")
    write_samples(ordered.select("doc_id", "position", "text"), path, shards=8)
    back = spark.read.parquet(path)
    return back.select("doc_id", "position", F.md5("text").alias("text_md5"))


@query(
    "s09_epoch_manifest",
    """SELECT count(*) AS "rows", CAST(0 AS BIGINT) AS "first", count(*) - 1 AS "last", TRUE AS gapless, 0::BIGINT AS damaged
  FROM documents""",
)
def epoch_manifest(spark, sf):
    """The manifest of a stored epoch: its files follow one another, and none is damaged."""
    path = fresh_path(spark, "epoch")
    store_epoch(D.table(spark, sf, "documents"), "doc_id", path, shards=8)
    files = manifest(spark, path).where(F.col("file").isNotNull())
    return files.agg(
        F.sum("rows").alias("rows"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        (F.sum(F.col("last") - F.col("first") + 1) == F.max("last") + 1).alias("gapless"),
    ).crossJoin(open_epoch(spark, path).damaged().agg(F.count(F.lit(1)).alias("damaged")))


# Lines of a corpus, some of them broken, by document.
CORPUS_LINE = """CASE doc_id % 9 WHEN 1 THEN '{"text": "cut' WHEN 2 THEN '[1, 2]' WHEN 3 THEN '{"other": 1}' WHEN 4 THEN '{"text": " "}'
  WHEN 5 THEN '  ' WHEN 6 THEN '{"text": null}' ELSE NULL END"""


@query(
    "s01_quarantine",
    f"""WITH l AS (SELECT text, {CORPUS_LINE} AS broken, CASE doc_id % 9 WHEN 1 THEN 'not JSON' WHEN 2 THEN 'no object' WHEN 3 THEN 'missing: text'
  WHEN 4 THEN 'empty text' WHEN 5 THEN 'blank' WHEN 6 THEN 'missing: text' ELSE 'good' END AS reason FROM documents)
SELECT reason, count(*) AS lines, md5(coalesce(broken, text)) AS content_md5 FROM l GROUP BY ALL""",
)
def quarantined(spark, sf):
    """Every line of a corpus in one of two tables: the texts of good ones, the lines of bad ones."""
    path, out = fresh_path(spark, "corpus"), fresh_path(spark, "quarantine")
    docs = D.table(spark, sf, "documents")
    line = F.coalesce(F.expr(CORPUS_LINE), F.to_json(F.struct("text")))
    docs.select(line.alias("value")).write.text(path)
    good, bad = quarantine.read_pretrain(spark, path, out)
    both = good.select(F.lit("good").alias("reason"), F.col("text").alias("content")).unionByName(
        bad.select("reason", F.col("line").alias("content"))
    )
    return both.groupBy("reason", F.md5("content").alias("content_md5")).agg(F.count(F.lit(1)).alias("lines"))


@query(
    "s02_quarantine_chats",
    """WITH c AS (SELECT conv_id, bool_or(role = 'assistant' AND (conv_id + turn) % 7 = 1) AS broken FROM conversations GROUP BY conv_id)
SELECT CASE WHEN broken THEN 'bad tool calls' ELSE 'good' END AS reason, count(*) AS lines FROM c GROUP BY 1""",
)
def quarantined_chats(spark, sf):
    """Chats some of whose tool calls are no JSON."""
    path, out = fresh_path(spark, "chats"), fresh_path(spark, "quarantine")
    D.chats(spark, sf, calls=D.BROKEN_CALLS).select("conversations").write.json(path)
    quarantine.read_sft(spark, path, out)
    return quarantine.counts_of(spark, out)

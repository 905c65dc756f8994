"""Epoch order, shards, batches and schedules: B1 to B10."""

from pyspark.sql import functions as F

from chatloom.operators import batching as B
from chatloom.operators.groups import with_group_stats
from chatloom.plans.common import query, r6, s_r6
from chatloom.session import fresh_path
from chatloom.sources import tables as D
from chatloom.sources.epochs import open_epoch, store_epoch


def s_order(epoch: int = 0, key: str = "doc_id", source: str = "documents") -> str:
    return f"""o AS (SELECT {key}, row_number() OVER (ORDER BY md5('{42 + epoch}:' || {key}), {key}) - 1 AS position FROM {source})"""


def _docs(spark, sf):
    return D.table(spark, sf, "documents").select("doc_id")


@query("b01_shuffle_epoch", f"WITH {s_order(3)} SELECT doc_id, position FROM o")
def b01(spark, sf):
    return B.shuffle_epoch(_docs(spark, sf), "doc_id", epoch=3)


@query(
    "b02_shard",
    f"""WITH {s_order()}, n AS (SELECT count(*) AS n FROM documents), e AS (
  SELECT doc_id, position FROM o UNION ALL
  SELECT doc_id, position + n FROM o, n WHERE position + n < CAST(ceil(n / 7.0) AS BIGINT) * 7)
SELECT doc_id, position, CAST(position % 7 AS INTEGER) AS rank, position // 7 AS shard_position FROM e""",
)
def b02(spark, sf):
    return B.shard(B.shuffle_epoch(_docs(spark, sf), "doc_id"), None, 7, even=True)


@query("b03_batches", f"WITH {s_order()} SELECT position // 16 AS batch, count(*) AS size, min(position) AS first FROM o GROUP BY 1")
def b03(spark, sf):
    rows = B.batches(B.shuffle_epoch(_docs(spark, sf), "doc_id"), 16, "position")
    return rows.groupBy("batch").agg(
        F.count(F.lit(1)).alias("size"), F.min("position").alias("first")
    )


@query(
    "b04_skip_batches",
    f"WITH {s_order()} SELECT doc_id, position // 16 AS batch, position // 16 + 1 AS step FROM o WHERE position // 16 >= 3",
)
def b04(spark, sf):
    rows = B.batches(B.shuffle_epoch(_docs(spark, sf), "doc_id"), 16, "position")
    return B.skip_batches(rows, 3).select("doc_id", "batch", "step")


# Runs: one per source, with as many samples as it has documents.
_RUNS = "runs AS (SELECT source, count(*) AS n FROM documents GROUP BY source)"


def _runs(spark, sf):
    return D.table(spark, sf, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@query(
    "b05_batch_count",
    f"WITH {_RUNS} SELECT source, CAST(greatest(0, ceil(n / 16.0) - 2) AS BIGINT) AS batches FROM runs",
)
def b05(spark, sf):
    n = B.batch_count(F.col("n"), F.lit(16), F.lit(2))
    return _runs(spark, sf).select("source", n.cast("bigint").alias("batches"))


@query(
    "b06_rescale_step",
    """SELECT event_id, CASE WHEN 1 + event_id % 4 <> 1 + user_id % 3 THEN event_id * (1 + event_id % 4) // (1 + user_id % 3) ELSE event_id END AS step FROM events""",
)
def b06(spark, sf):
    """Checkpoint headers from events: step, workers then, workers now."""
    saved, now = 1 + F.col("event_id") % 4, 1 + F.col("user_id") % 3
    step = B.rescale_step(F.col("event_id"), saved, now)
    return D.table(spark, sf, "events").select("event_id", step.alias("step"))


@query(
    "b07_optimizer_steps",
    f"""WITH {_RUNS} SELECT source, greatest(1, n // 8 * 3) AS dropped, CAST(ceil(n / 8.0) * 3 AS BIGINT) AS flushed FROM runs""",
)
def b07(spark, sf):
    n, accum, epochs = F.col("n"), F.lit(8), F.lit(3)
    return _runs(spark, sf).select(
        "source",
        B.optimizer_steps(n, accum, epochs, flush_tail=False).cast("bigint").alias("dropped"),
        B.optimizer_steps(n, accum, epochs, flush_tail=True).cast("bigint").alias("flushed"),
    )


_WAVE = "(1 + cos(pi() * event_id / t))"


@query(
    "b08_lr_schedule",
    f"""WITH n AS (SELECT count(*) AS t FROM events) SELECT event_id AS step,
  {s_r6(f'CAST(500 AS DOUBLE) * (CAST(0.1 AS DOUBLE) + CAST(0.45 AS DOUBLE) * {_WAVE})')} AS cosine, {s_r6(f'50 + CAST(450 AS DOUBLE) * {_WAVE} / 2')} AS annealed FROM events, n""",
)
def b08(spark, sf):
    """A rate per logged step, in millionths."""
    events = D.table(spark, sf, "events").select(F.col("event_id").alias("step"))
    total = events.select(F.count(F.lit(1))).scalar()
    return events.select(
        "step",
        r6(B.lr_value(F.col("step"), total, 500.0)).alias("cosine"),
        r6(B.lr_value(F.col("step"), total, 500.0, "annealing")).alias("annealed"),
    )


@query(
    "b09_cadence",
    """WITH n AS (SELECT max(event_id) AS t FROM events) SELECT event_id AS step, event_id % 100 = 0 OR event_id = t AS logs,
  event_id % 500 = 0 OR event_id = t AS saves, event_id // 4 AS policy_version FROM events, n""",
)
def b09(spark, sf):
    events = D.table(spark, sf, "events").select(F.col("event_id").alias("step"))
    last = events.select(F.max("step")).scalar()
    out = B.cadence(events.withColumn("total", last), log=100, save=500, refresh=4)
    return out.drop("total")


@query(
    "b10_batch_plan",
    f"""WITH {s_order(1, 'conv_id', '(SELECT DISTINCT conv_id FROM conversations)')},
s AS (SELECT conv_id, CAST(position % 4 AS INTEGER) AS rank, position // 4 // 8 AS batch FROM o),
z AS (SELECT conv_id, sum(length(text)) AS chars FROM conversations GROUP BY conv_id)
SELECT conv_id, rank, batch, batch + 1 AS step, CAST(chars AS BIGINT) AS chars,
  CAST(max(chars) OVER (PARTITION BY rank, batch) AS BIGINT) AS padded_to FROM s JOIN z USING (conv_id) WHERE batch >= 1""",
)
def b10(spark, sf):
    """The plan of a resumed epoch, with the width each batch is padded to."""
    chats = (
        D.table(spark, sf, "conversations")
        .groupBy("conv_id")
        .agg(F.sum(F.length("text")).alias("chars"))
    )
    plan = B.batch_plan(chats, "conv_id", size=8, world=4, skip=1, epoch=1)
    wide = with_group_stats(plan, ["rank", "batch"], {"padded_to": F.max("chars")})
    return wide.select("conv_id", "rank", "batch", "step", "chars", "padded_to")


@query(
    "b04_resume_epoch",
    f"""WITH {s_order(2)}, n AS (SELECT count(*) AS n FROM documents), e AS (
  SELECT doc_id, position FROM o UNION ALL
  SELECT doc_id, position + n FROM o, n WHERE position + n < CAST(ceil(n / 3.0) AS BIGINT) * 3)
SELECT doc_id, md5(text) AS text_md5, position, CAST(position % 3 AS INTEGER) AS rank, position // 3 AS shard_position,
  position // 3 // 16 AS batch, position // 3 // 16 + 1 AS step
FROM e JOIN documents USING (doc_id) WHERE position // 3 // 16 >= 5""",
)
def b04_resume(spark, sf):
    """All workers of an epoch that is read from its files, from the sixth batch on."""
    path = fresh_path(spark, "epoch")
    store_epoch(D.table(spark, sf, "documents").select("doc_id", "text"), "doc_id", path, shards=8, epoch=2)
    rows = open_epoch(spark, path).steps(16, world=3, skip=5, even=True)
    return rows.select(
        "doc_id", F.md5("text").alias("text_md5"), "position", "rank", "shard_position", "batch", "step"
    )


@query(
    "b08_lr_table",
    f"""WITH n AS (SELECT count(*) AS t FROM events), s AS (SELECT event_id FROM events UNION ALL SELECT t FROM n)
SELECT event_id AS step, {s_r6(f'CAST(500 AS DOUBLE) * (CAST(0.1 AS DOUBLE) + CAST(0.45 AS DOUBLE) * {_WAVE})')} AS lr FROM s, n""",
)
def b08_table(spark, sf):
    """The schedule of a run of as many steps as there are events."""
    total = D.table(spark, sf, "events").count()
    return B.lr_schedule(spark, total, 500.0).select("step", r6(F.col("lr")).alias("lr"))

"""Training logs: L1 to L7."""

from pyspark.sql import functions as F

from chatloom.operators import logs as O
from chatloom.operators import markers as M
from chatloom.plans.common import query, r6, s_r6
from chatloom.session import fresh_path
from chatloom.sources import tables as D
from chatloom.streaming import latest
from chatloom.streaming import progress as P
from chatloom.streaming.logs import stream_log

S_LINES = f"lines AS (SELECT event_id, 'run' || user_id AS run, ts AS arrived, {D.LOG_LINE.format(f='printf')} AS line FROM events)"


def s_field(pattern: str, cast: str = "DOUBLE") -> str:
    return f"TRY_CAST(nullif(regexp_extract(line, '{pattern}', 1), '') AS {cast})"


S_PARSED = f"""parsed AS (SELECT event_id, run, arrived, {s_field('Epoch: ?[[]?([0-9]+)', 'INTEGER')} AS epoch,
  {s_field('(?:Step: |][(])([0-9]+)/', 'BIGINT')} AS step, {s_field('[0-9]/([0-9]+)(?:[),]|$)', 'BIGINT')} AS total_steps,
  {s_field('(?:[) ]loss:|, loss: |, Loss:)([-0-9.]+)')} AS loss, {s_field('Reward: ?([-0-9.]+)')} AS reward,
  {s_field('(?: lr: ?|LR: ?)([-+0-9.e]+)')} AS lr, {s_field('(?:Len: ?)([-0-9.]+)')} AS avg_response_len,
  {s_field('Actor Loss: ([-0-9.]+)')} AS actor_loss, CASE event_type_of WHEN 'view' THEN 'pretrain' WHEN 'purchase' THEN 'sft' WHEN 'error' THEN 'ppo' WHEN 'signup' THEN 'grpo' ELSE 'agent' END AS format
  FROM (SELECT l.*, e.event_type AS event_type_of FROM lines l JOIN events e USING (event_id)) WHERE line LIKE 'Epoch%')"""


@query(
    "l01_parse_log",
    f"""WITH {S_LINES}, {S_PARSED} SELECT event_id, run, format, epoch, step, total_steps, loss, reward, lr, avg_response_len, actor_loss FROM parsed""",
)
def l01(spark, sf):
    rows = O.parse_log(D.log_lines(spark, sf))
    return rows.select(
        (F.col("offset") / 1000).cast("bigint").alias("event_id"),
        "run", "format", "epoch", "step", "total_steps", "loss", "reward", "lr", "avg_response_len", "actor_loss",
    )


_MORE = {
    "logits_loss": "logits_loss: ([-0-9.]+)",
    "aux_loss": "aux_loss: ([-0-9.]+)",
    "critic_lr": "Critic LR: ([-+0-9.e]+)",
    "epoch_minutes": "epoch_[Tt]ime: ?([0-9.]+)min",
    "critic_loss": "Critic Loss: ([-0-9.]+)",
    "kl": ", KL: ?([-0-9.]+)",
    "kl_ref": "KL_ref: ([-0-9.]+)",
    "group_reward_std": "GrpStd:([-0-9.]+)",
    "advantages_std": "AdvStd:([-0-9.]+)",
    "advantages_mean": "AdvMean:([-0-9.]+)",
}
S_ALL = f"""{S_PARSED}, whole AS (SELECT p.*, {', '.join(f'{s_field(p)} AS {n}' for n, p in _MORE.items())}
  FROM parsed p JOIN lines USING (event_id))"""
_ALL = ["loss", "reward", "lr", "actor_loss", "avg_response_len", *_MORE]


@query("l01_all_metrics", f"WITH {S_LINES}, {S_ALL} SELECT event_id, {', '.join(_ALL)} FROM whole")
def l01_all(spark, sf):
    rows = O.parse_log(D.log_lines(spark, sf))
    return rows.select((F.col("offset") / 1000).cast("bigint").alias("event_id"), *_ALL)


@query(
    "l06_all_metrics",
    f"""WITH {S_LINES}, {S_ALL} SELECT run, epoch, step, metric, value FROM (
  UNPIVOT (SELECT run, epoch, step, {', '.join(_ALL)} FROM whole) ON {', '.join(_ALL)} INTO NAME metric VALUE value)""",
)
def l06_all(spark, sf):
    return O.metrics_long(O.parse_log(D.log_lines(spark, sf)))


@query(
    "l02_log_progress",
    f"""WITH {S_LINES}, {S_PARSED} SELECT l.run, max(step) AS max_step, count(step) AS step_lines, max(total_steps) AS total_steps,
  bool_or(line LIKE '%Task has finished%') AS finished FROM lines l LEFT JOIN parsed p USING (event_id) GROUP BY l.run""",
)
def l02(spark, sf):
    return O.log_progress(D.log_lines(spark, sf))


S_ONE = f"""one AS (SELECT event_id * {D.WIDE + 1} AS o, rpad(line, {D.WIDE}, '.') AS line FROM lines)"""


@query(
    "l03_log_markers",
    f"""WITH {S_LINES}, {S_ONE}, marks(marker) AS (VALUES {', '.join(f"('{m}')" for m in O.MARKERS)}),
w AS (SELECT string_agg(line || chr(10), '' ORDER BY o) AS body FROM one)
SELECT 'all' AS run, marker, CAST(strpos(reverse(body), reverse(marker)) + length(marker) - 1 AS BIGINT) AS from_end
FROM w, marks WHERE contains(body, marker)""",
)
def l03(spark, sf):
    return O.log_markers(D.one_log(spark, sf)).withColumn("from_end", F.col("from_end").cast("bigint"))


@query(
    "l04_log_tail",
    f"""WITH {S_LINES}, {S_ONE} SELECT 'all' AS run, right(string_agg(line || chr(10), '' ORDER BY o), 800) AS tail FROM one""",
)
def l04(spark, sf):
    return O.log_tail(D.one_log(spark, sf))


@query(
    "l05_eta",
    """WITH n AS (SELECT count(*) AS iters, min(ts) AS t0 FROM events),
s AS (SELECT event_id, iters, (epoch_us(ts) - epoch_us(t0)) // 1000000 AS spent FROM events, n)
SELECT event_id, CAST(floor(spent / (event_id + 1) * iters / 60) - floor(spent / 60) AS BIGINT) AS minutes_left FROM s""",
)
def l05(spark, sf):
    events = D.table(spark, sf, "events")
    iters = events.select(F.count(F.lit(1))).scalar()
    begin = events.select(F.unix_micros(F.min(F.col("ts").cast("timestamp")))).scalar()
    spent = F.floor((F.unix_micros(F.col("ts").cast("timestamp")) - begin) / 1000000)
    left = O.eta_minutes(spent, F.col("event_id"), iters)
    return events.select("event_id", left.cast("bigint").alias("minutes_left"))


@query(
    "l06_metrics_long",
    f"""WITH {S_LINES}, {S_PARSED} SELECT run, epoch, step, metric, value FROM (
  UNPIVOT (SELECT run, epoch, step, loss, reward, lr, actor_loss, avg_response_len FROM parsed) ON loss, reward, lr, actor_loss, avg_response_len INTO NAME metric VALUE value)""",
)
def l06(spark, sf):
    wanted = ["loss", "reward", "lr", "actor_loss", "avg_response_len"]
    rows = O.metrics_long(O.parse_log(D.log_lines(spark, sf)))
    return rows.where(F.col("metric").isin(*wanted))


@query(
    "l06_latest_steps",
    f"""WITH {S_LINES}, {S_PARSED}, twice AS (SELECT * FROM parsed UNION ALL
  SELECT event_id, run, arrived + INTERVAL 1 HOUR, epoch, step, total_steps, loss + 1, reward, lr, avg_response_len, actor_loss, format FROM parsed)
SELECT run, epoch, step, arg_max(loss, arrived) AS loss, count(*) AS arrivals FROM twice WHERE loss IS NOT NULL GROUP BY run, epoch, step""",
)
def l06_latest(spark, sf):
    """A resumed run reports its steps again an hour later: the latest line counts."""
    parsed = O.parse_log(D.log_lines(spark, sf)).where(F.col("loss").isNotNull())
    times = F.explode(F.array(F.lit(0), F.lit(1))).alias("again")
    both = parsed.select("run", "epoch", "step", "arrived", "loss", times).select(
        "run",
        "epoch",
        "step",
        (F.col("arrived") + F.make_interval(hours=F.col("again"))).alias("arrived"),
        (F.col("loss") + F.col("again")).alias("loss"),
    )
    return O.latest_steps(both).select("run", "epoch", "step", "loss", "arrivals")


_LATE = 30  # minutes a line may come late


@query(
    "l07_stream_log",
    f"""WITH {S_LINES}, {S_PARSED}, done AS (SELECT max(arrived) - INTERVAL {_LATE} MINUTE AS mark FROM parsed)
SELECT time_bucket(INTERVAL 10 MINUTE, arrived) AS window_start, run, count(*) AS steps, max(step) AS max_step,
  {s_r6('avg(loss)')} AS avg_value, {s_r6('max(loss)')} AS max_value FROM parsed, done
WHERE time_bucket(INTERVAL 10 MINUTE, arrived) + INTERVAL 10 MINUTE <= mark GROUP BY 1, 2""",
)
def l07(spark, sf):
    """Lines in files, every line twice as after a resumed run, read as a stream:
    the windows that closed."""
    base = fresh_path(spark, "stream")
    lines = D.log_lines(spark, sf)
    stamped = F.concat_ws(
        "\t", F.date_format("arrived", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), "run", "line"
    )
    lines.select(F.explode(F.array(stamped, stamped)).alias("value")).write.text(f"{base}/in")
    stream_log(
        spark, f"{base}/in", f"{base}/out", f"{base}/state", late=f"{_LATE} minutes"
    ).awaitTermination()
    out = spark.read.parquet(f"{base}/out")
    return out.select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        "run",
        "steps",
        "max_step",
        r6(F.col("avg_value")).alias("avg_value"),
        r6(F.col("max_value")).alias("max_value"),
    )


# A resumed run reports every step again an hour later, with another loss.
S_TWICE = f"""{S_LINES.replace('lines AS', 'firsts AS', 1)}, lines AS (SELECT * FROM firsts UNION ALL
  SELECT event_id, run, arrived + INTERVAL 1 HOUR, replace(replace(line, 'loss:', 'loss:7'), 'loss:7 ', 'loss: 7') FROM firsts)"""


@query(
    "l07_latest_steps",
    f"""WITH {S_TWICE}, {S_PARSED.replace('FROM (SELECT l.*', 'FROM (SELECT DISTINCT l.*')} SELECT run, epoch, step, arg_max(loss, arrived) AS loss,
  arg_max(reward, arrived) AS reward, count(*) AS arrivals FROM parsed GROUP BY run, epoch, step""",
)
def l07_latest(spark, sf):
    """Lines of a run and of its resumption in files, read as a stream of several batches: the later values stand."""
    base = fresh_path(spark, "latest")
    lines = D.log_lines(spark, sf)
    again = F.replace(F.replace(F.col("line"), F.lit("loss:"), F.lit("loss:7")), F.lit("loss:7 "), F.lit("loss: 7"))
    both = lines.select("arrived", "run", "line").unionByName(
        lines.select((F.col("arrived") + F.make_interval(hours=F.lit(1))).alias("arrived"), "run", again.alias("line"))
    )
    stamped = F.concat_ws("\t", F.date_format("arrived", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), "run", "line")
    day = F.to_date("arrived").alias("day")
    both.select(stamped.alias("value"), day).repartition(4, "day").drop("day").write.text(f"{base}/in")
    latest.stream_latest(
        spark, f"{base}/in", f"{base}/out", f"{base}/state", files_per_trigger=2, fold=2, late="36500 days"
    ).awaitTermination()
    return latest.read_latest(spark, f"{base}/out").select("run", "epoch", "step", "loss", "reward", "arrivals")


@query(
    "l03_marker_table",
    f"""WITH {S_LINES}, {S_ONE}, marks AS (SELECT DISTINCT substr(line, 1 + CAST(event_id % 40 AS BIGINT), 5 + CAST(event_id % 7 AS BIGINT)) AS marker FROM lines),
n AS (SELECT max(o + length(line) + 1) AS size FROM one),
hit AS (SELECT marker, max(o + length(line) - (strpos(reverse(line), reverse(marker)) + length(marker) - 1)) AS place
  FROM one JOIN marks ON contains(line, marker) WHERE marker <> '' GROUP BY marker)
SELECT 'all' AS run, marker, CAST(size - place AS BIGINT) AS from_end FROM hit, n""",
)
def l03_table(spark, sf):
    """As many markers as the lines have different pieces, in one pass over the log."""
    event = (F.col("offset") / 1000).cast("bigint")
    piece = F.substring("line", (1 + event % 40).cast("int"), (5 + event % 7).cast("int"))
    markers = D.log_lines(spark, sf).select(piece.alias("marker"))
    return M.find_markers(D.one_log(spark, sf), markers)


@query(
    "l02_live_progress",
    f"""WITH {S_LINES}, {S_PARSED}, r AS (SELECT l.run, max(step) AS max_step, count(step) AS step_lines, max(total_steps) AS total_steps,
  bool_or(line LIKE '%Task has finished%') AS finished, (epoch_us(max(l.arrived)) - epoch_us(min(l.arrived))) // 1000000 AS spent
  FROM lines l LEFT JOIN parsed p USING (event_id) GROUP BY l.run)
SELECT run, max_step, step_lines, total_steps, finished, CASE WHEN NOT finished THEN
  CAST(floor(spent / (max_step + 1) * total_steps / 60) - floor(spent / 60) AS BIGINT) END AS minutes_left FROM r""",
)
def l02_live(spark, sf):
    """Progress and time left of each run, from a stream."""
    base = fresh_path(spark, "progress")
    stamped = F.concat_ws("\t", F.date_format("arrived", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), "run", "line")
    D.log_lines(spark, sf).select(stamped.alias("value")).write.text(f"{base}/in")
    P.stream_progress(spark, f"{base}/in", f"{base}/out", f"{base}/state").awaitTermination()
    columns = ["run", "max_step", "step_lines", "total_steps", "finished", "minutes_left"]
    return P.read_progress(spark, f"{base}/out").select(columns)

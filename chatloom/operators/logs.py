"""Training logs: typed metrics from five line formats, progress and tails.

A log line is ``(run, offset, line)``, with ``offset`` the place of its first
character in the log; a stream adds ``arrived``.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.operators.groups import with_group_stats

# What a line may report, under which name it is kept, and in which
# of the five formats it occurs.
_NUM = r"([-+]?(?:\d+\.?\d*(?:[eE][-+]?\d+)?|nan|inf))"
METRICS = {
    "loss": (rf"(?:\) loss:|, loss: |, Loss:){_NUM}", "pretrain sft agent"),
    "logits_loss": (rf", logits_loss: {_NUM}", "sft"),
    "aux_loss": (rf", aux_loss: {_NUM}", "sft"),
    "lr": (rf"(?: lr:|, lr: |, LR: ?|Actor LR: ){_NUM}", "pretrain sft ppo grpo agent"),
    "critic_lr": (rf"Critic LR: {_NUM}", "ppo"),
    "epoch_minutes": (rf"epoch_[Tt]ime: ?{_NUM}min", "pretrain sft"),
    "actor_loss": (rf"Actor Loss: {_NUM}", "ppo grpo"),
    "critic_loss": (rf"Critic Loss: {_NUM}", "ppo"),
    "reward": (rf", Reward: ?{_NUM}", "ppo grpo agent"),
    "kl": (rf", KL: ?{_NUM}", "ppo agent"),
    "kl_ref": (rf", KL_ref: {_NUM}", "ppo"),
    "avg_response_len": (rf"(?:Avg Response Len: |AvgLen:){_NUM}", "ppo grpo agent"),
    "group_reward_std": (rf"GrpStd:{_NUM}", "agent"),
    "advantages_std": (rf"AdvStd:{_NUM}", "agent"),
    "advantages_mean": (rf"AdvMean:{_NUM}", "agent"),
}
_STEP = r"(?:\]\(|Step: )(\d+)/(\d+)"
# Texts that tell how a run ended.
MARKERS = [
    "Epoch 1 finished", "Epoch 2", "epochs done", "Training complete", "Traceback",
    "Error", "CUDA error", "OutOfMemory", "saved",
]
FINISHED = "Task has finished"


def _group(line: Column, pattern: str, n: int = 1) -> Column:
    return F.nullif(F.regexp_extract(line, pattern, n), F.lit(""))


def line_format(line: Column) -> Column:
    return (
        F.when(line.rlike(r"^Epoch:\[\d+/\d+\]\(\d+/\d+\) loss:"), F.lit("pretrain"))
        .when(line.rlike(r"^Epoch:\[\d+/\d+\]\(\d+/\d+\), loss: "), F.lit("sft"))
        .when(line.rlike(r"^Epoch: \d+, Step: \d+/\d+, Actor Loss: [^,]*, Critic Loss"), F.lit("ppo"))
        .when(line.rlike(r"^Epoch: \d+, Step: \d+/\d+, Actor Loss: "), F.lit("grpo"))
        .when(line.rlike(r"^Epoch:\[\d+/\d+\]\(\d+/\d+\), Reward:"), F.lit("agent"))
    )


def parse_log(lines: DataFrame) -> DataFrame:
    """Typed columns of every step line; other lines are left out."""
    line = F.col("line")
    found = lines.withColumn("format", line_format(line)).where(F.col("format").isNotNull())
    # a metric is only looked for in lines that can have it
    values = [
        F.when(F.col("format").isin(*formats.split()), _group(line, p)).try_cast("double").alias(n)
        for n, (p, formats) in METRICS.items()
    ]
    return found.select(
        *[c for c in lines.columns if c != "line"],
        "format",
        _group(line, r"Epoch:\s?\[?(\d+)").try_cast("int").alias("epoch"),
        _group(line, _STEP, 1).try_cast("bigint").alias("step"),
        _group(line, _STEP, 2).try_cast("bigint").alias("total_steps"),
        *values,
    )


def log_progress(lines: DataFrame, by: str = "run") -> DataFrame:
    """Highest step, number of step lines, total, and whether the run finished.
    A run without step lines is reported with zero lines."""
    step = _group(F.col("line"), _STEP, 1).try_cast("bigint")
    total = _group(F.col("line"), _STEP, 2).try_cast("bigint")
    return lines.groupBy(by).agg(
        F.max(step).alias("max_step"),
        F.count(step).alias("step_lines"),
        F.max(total).alias("total_steps"),
        F.bool_or(F.contains("line", F.lit(FINISHED))).alias("finished"),
    )


def last_place(text: Column, mark: Column) -> Column:
    """Zero-based place of the last occurrence of ``mark``; null if absent."""
    at = F.instr(F.reverse(text), F.reverse(mark))
    return F.when(at > 0, F.length(text) - at - F.length(mark) + 1)


def log_markers(lines: DataFrame, markers=None, by: str = "run") -> DataFrame:
    """Last occurrence of each marker, as distance from the end of the log.

    Markers are a fixed list, so a line meets them as an array; there is no
    join. Counts combine before the shuffle.
    """
    marks = F.array(*[F.lit(m) for m in (MARKERS if markers is None else markers)])
    end = F.col("offset") + F.length("line") + 1
    # Every line keeps one entry without a marker: it carries the log's length.
    seen = F.concat(
        F.array(F.lit(None).cast("string")),
        F.filter(marks, lambda m: F.contains(F.col("line"), m)),
    )
    per = (
        lines.select(by, "offset", "line", end.alias("end"), F.explode(seen).alias("marker"))
        .groupBy(by, "marker")
        .agg(
            F.max("end").alias("size"),
            F.max(F.col("offset") + last_place(F.col("line"), F.col("marker"))).alias("at"),
        )
    )
    # one row per run and marker: a fixed number of rows for each run
    return (
        per.groupBy(by)
        .agg(
            F.max("size").alias("size"),
            F.collect_list(
                F.when(F.col("marker").isNotNull(), F.struct("marker", "at"))
            ).alias("found"),
        )
        .select(by, "size", F.explode("found").alias("f"))
        .select(by, F.col("f.marker").alias("marker"), (F.col("size") - F.col("f.at")).alias("from_end"))
    )


def log_tail(lines: DataFrame, n: int = 800, by: str = "run") -> DataFrame:
    """The last ``n`` characters of each log. Only lines that reach into them are
    collected, at most ``n`` for a log."""
    end = F.col("offset") + F.length("line") + 1
    sized = with_group_stats(lines, [by], {"_size": F.max(end)})
    near = sized.where(end > F.col("_size") - n)
    text = F.array_join(
        F.transform(
            F.sort_array(F.collect_list(F.struct("offset", "line"))),
            lambda e: F.concat(e["line"], F.lit("\n")),
        ),
        "",
    )
    return near.groupBy(by).agg(F.right(text, F.lit(n)).alias("tail"))


def eta_minutes(spent: Column, step: Column, iters: Column) -> Column:
    """Whole minutes left, from seconds spent."""
    return F.floor(spent / (step + 1) * iters / 60) - F.floor(spent / 60)


def metrics_long(parsed: DataFrame, keys=None) -> DataFrame:
    """``(keys, metric, value)``; absent metrics give no row."""
    keys = ["run", "epoch", "step"] if keys is None else keys
    return parsed.unpivot(keys, list(METRICS), "metric", "value").where(F.col("value").isNotNull())


def latest_steps(parsed: DataFrame) -> DataFrame:
    """One row per (run, epoch, step): a resumed run repeats steps, the latest wins.
    ``arrivals`` tells how often the step was reported."""
    keys = ["run", "epoch", "step"]
    rest = [c for c in parsed.columns if c not in keys]
    return (
        parsed.groupBy(*keys)
        .agg(
            F.max_by(F.struct(*rest), F.col("arrived")).alias("r"),
            F.count(F.lit(1)).alias("arrivals"),
        )
        .select(*keys, "r.*", "arrivals")
    )

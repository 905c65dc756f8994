"""Progress of runs while they go on: steps, time left, and runs that have stalled.

One row of state for each run: highest step, step lines, total, first and last arrival, and
whether it has finished or stalled. Lines are cut to a few numbers before they reach it. A
run that says nothing for ``stall`` of processing time is reported once as stalled, by a timer
of its own, and as resumed when it speaks again; a finished run has no timer.

Each batch's events are written to a folder named by the batch's number, so a batch that is
run again overwrites its own. ``read_events`` gives all of them, ``read_progress`` the newest of each run;
when all lines have arrived, it equals ``logs.log_progress`` and ``logs.eta_minutes``.
"""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from chatloom.operators.logs import FINISHED, _STEP, _group, eta_minutes
from chatloom.streaming.latest import folders
from chatloom.streaming.logs import read_log_stream

STATE = "max_step long, step_lines long, total_steps long, first long, last long, finished boolean, stalled boolean"
EVENTS = f"run string, event string, {STATE}"
NONE = -1  # no number: pandas would turn a column of longs with a null into doubles


def cut(lines: DataFrame) -> DataFrame:
    """``run`` and the numbers of a line: step and total (``NONE`` if it has none), arrival in microseconds, and whether
    it says that the run has finished."""
    number = lambda k: F.coalesce(_group(F.col("line"), _STEP, k).try_cast("bigint"), F.lit(NONE))
    return lines.select(
        "run",
        F.unix_micros("arrived").alias("at"),
        number(1).alias("step"),
        number(2).alias("total"),
        F.contains("line", F.lit(FINISHED)).alias("finished"),
    )


def _advance(stall_ms: int):
    names = [c.split()[0] for c in STATE.split(", ")]

    def run(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        s = dict(zip(names, state.get, strict=True)) if state.exists else None
        if state.hasTimedOut:
            s["stalled"], event = True, "stalled"
        else:
            s = s or dict(zip(names, (NONE, 0, NONE, NONE, NONE, False, False), strict=True))
            event = "resumed" if s["stalled"] else "progress"
            was = s["finished"]
            for b in batches:
                s["max_step"] = max(s["max_step"], int(b["step"].max()))
                s["total_steps"] = max(s["total_steps"], int(b["total"].max()))
                s["step_lines"] += int((b["step"] != NONE).sum())
                low, high = int(b["at"].min()), int(b["at"].max())
                s["first"] = low if s["first"] == NONE else min(s["first"], low)
                s["last"] = max(s["last"], high)
                s["finished"] = s["finished"] or bool(b["finished"].any())
            s["stalled"] = False
            if s["finished"] and not was:
                event = "finished"
            if not s["finished"]:
                state.setTimeoutDuration(stall_ms)
        state.update(tuple(s[c] for c in names))
        yield pd.DataFrame([{"run": key[0], "event": event, **s}])

    return run


def progress(lines: DataFrame, stall_seconds: float = 600) -> DataFrame:
    """A stream of ``EVENTS``, for update mode."""
    return (
        cut(lines)
        .where(F.col("run").isNotNull() & F.col("at").isNotNull())
        .groupBy("run")
        .applyInPandasWithState(
            _advance(int(stall_seconds * 1000)), EVENTS, STATE, "update", GroupStateTimeout.ProcessingTimeTimeout
        )
    )


def _write(out: str):
    def write(rows: DataFrame, number: int):
        rows.write.mode("overwrite").parquet(f"{out}/batch-{number}")

    return write


def read_events(spark: SparkSession, out: str) -> DataFrame:
    """All events so far: ``batch``, ``run``, ``event``, step numbers (null if none), arrivals, and ``minutes_left``."""
    _, batches = folders(spark, out)
    names = [f"{out}/batch-{n}" for n in batches]
    rows = spark.read.schema(EVENTS).parquet(*names) if names else spark.createDataFrame([], EVENTS)
    known = lambda c: F.nullif(F.col(c), F.lit(NONE).cast("long"))
    spent = F.floor((F.col("last") - F.col("first")) / 1_000_000)
    batch = F.regexp_extract(F.col("_metadata.file_path"), r"/batch-(\d+)/", 1).cast("long") if names else F.lit(0)
    return rows.select(
        batch.alias("batch"),
        "run",
        "event",
        known("max_step").alias("max_step"),
        "step_lines",
        known("total_steps").alias("total_steps"),
        "finished",
        "stalled",
        F.timestamp_micros("first").alias("first"),
        F.timestamp_micros("last").alias("last"),
        F.when(
            ~F.col("finished"), eta_minutes(spent, known("max_step"), known("total_steps")).cast("long")
        ).alias("minutes_left"),
    )


def read_progress(spark: SparkSession, out: str) -> DataFrame:
    """The newest state of each run."""
    rows = read_events(spark, out)
    rest = [c for c in rows.columns if c not in ("batch", "run")]
    return rows.groupBy("run").agg(F.max_by(F.struct(*rest), "batch").alias("r")).select("run", "r.*")


def stream_progress(
    spark: SparkSession,
    path: str,
    out: str,
    checkpoint: str,
    stall_seconds: float = 600,
    every: str | None = None,
):
    """Start the query: with ``every``, a trigger interval, it goes on and its timers can fire; else one
    batch takes all that is there, and it ends. (With timers there is always a next batch, so
    a run over all that is available would not end.)"""
    writer = (
        progress(read_log_stream(spark, path), stall_seconds)
        .writeStream.outputMode("update")
        .foreachBatch(_write(out))
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(processingTime=every) if every else writer.trigger(once=True)).start()

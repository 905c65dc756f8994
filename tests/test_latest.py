import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F

from chatloom.operators import logs as O
from chatloom.streaming import latest

DAY = dt.datetime(2026, 1, 1)


def line(minute, step, loss, run="r1", epoch=1):
    text = f"Epoch:[{epoch}/2]({step}/100) loss:{loss:.3f} lr:0.000100 epoch_Time:3.0min:"
    return DAY + dt.timedelta(minutes=minute), run, text


def put(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(f"{t.isoformat()}\t{r}\t{x}\n" for t, r, x in lines))


def run(spark, tmp_path, **options):
    latest.stream_latest(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state", **options).awaitTermination()
    return sorted((r.run, r.step, r.loss, r.arrivals) for r in latest.read_latest(spark, f"{tmp_path}/out").collect())


def batch(spark, lines):
    rows = spark.createDataFrame(lines, "arrived timestamp, run string, line string")
    return sorted((r.run, r.step, r.loss, r.arrivals) for r in O.latest_steps(O.parse_log(rows)).collect())


def test_resumed_run_replaces_its_steps(spark, tmp_path):
    """Over several starts, batches, windows and merged tables: always the batch operator's rows."""
    parts = [
        [line(k, k, 5 - k / 10) for k in range(6)] + [line(0, 1, 9.0, run="r2")],
        [line(100 + k, 3 + k, 1 + k / 10) for k in range(6)],  # resumed at step 3, in another window
        [line(104, 4, 0.5), line(103, 3, 0.25), (DAY, "r1", "no step line")],  # again, in the same window
        [line(20, 5, 8.0)],  # comes late and is older than what stands
    ]
    seen = []
    for k, part in enumerate(parts):
        put(tmp_path / "in", f"{k}.txt", part)
        seen += part
        assert run(spark, tmp_path, late="1 day", fold=2) == batch(spark, seen)


def test_replayed_batch_changes_nothing(spark, tmp_path):
    put(tmp_path / "in", "a.txt", [line(k, k, 5.0) for k in range(5)])
    put(tmp_path / "in", "b.txt", [line(90 + k, k, 2.0) for k in range(3)])
    once = run(spark, tmp_path, files_per_trigger=1, late="1 day")
    # the commit of the last batches is lost: they run again and overwrite their own rows
    commits = sorted((tmp_path / "state" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    for c in commits[1:]:
        c.unlink()
        (c.parent / f".{c.name}.crc").unlink(missing_ok=True)
    assert run(spark, tmp_path, files_per_trigger=1, late="1 day") == once
    assert {r[2] for r in once} == {2.0, 5.0} and {r[3] for r in once} == {1, 2}
    found = latest._before(spark, f"{tmp_path}/out")
    rows = spark.createDataFrame(found.collect(), found.schema)  # held apart from the files that are overwritten
    for again in range(2):  # the sink itself
        latest.upsert(f"{tmp_path}/out")(rows.where(F.col("batch") == 1).drop("batch"), 1)
    assert sorted((r.run, r.step, r.loss, r.arrivals) for r in latest.read_latest(spark, f"{tmp_path}/out").collect()) == once


def test_merged_tables(spark, tmp_path):
    for k in range(7):
        put(tmp_path / "in", f"{k}.txt", [line(10 * k, s, k + s / 10) for s in range(4)])
    got = run(spark, tmp_path, files_per_trigger=1, fold=3, late="1 day")
    assert got == [("r1", s, pytest.approx(6 + s / 10), 7) for s in range(4)]
    merged, after = latest.folders(spark, f"{tmp_path}/out")
    assert merged >= 5 and len(after) < 3
    for k in range(merged):
        shutil.rmtree(tmp_path / "out" / f"batch-{k}", ignore_errors=True)  # older batches aren't needed
    assert sorted((r.run, r.step, r.loss, r.arrivals) for r in latest.read_latest(spark, f"{tmp_path}/out").collect()) == got


def test_windows_follow_the_latest_line(spark, tmp_path):
    put(tmp_path / "in", "a.txt", [line(1, 1, 5.0), line(2, 2, 4.0)])
    put(tmp_path / "in", "b.txt", [line(31, 2, 1.0)])
    run(spark, tmp_path, late="1 day")
    rows = latest.window_metrics(latest.read_latest(spark, f"{tmp_path}/out")).orderBy("window_start").collect()
    assert [(r.steps, r.max_step, r.avg_value) for r in rows] == [(1, 1, 5.0), (1, 2, 1.0)]


def test_nothing_yet(spark, tmp_path):
    assert latest.read_latest(spark, f"{tmp_path}/out").count() == 0


def test_state_and_shuffle_hold_a_row_s_values_once(spark):
    lines = spark.createDataFrame([], "arrived timestamp, run string, line string")
    rows = latest.changes(lines)
    for made in (rows, latest._merged(rows.withColumn("batch", F.lit(0).cast("long")))):
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        assert "max(struct(" in plan and "max_by(" not in plan


def test_a_merged_table_alone_is_not_merged_again(spark, tmp_path):
    put(tmp_path / "in", "a", [line(0, 1, 0.5), line(1, 2, 0.4), line(70, 1, 0.3)])
    out = str(tmp_path / "out")
    latest.stream_latest(spark, str(tmp_path / "in"), out, str(tmp_path / "state"), fold=1).awaitTermination()
    assert latest.folders(spark, out)[1] == []
    got = latest.read_latest(spark, out)
    assert sorted((r.step, r.loss, r.arrivals) for r in got.collect()) == [(1, 0.3, 2), (2, 0.4, 1)]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [") == 1


def test_no_state_is_kept_for_the_steps(spark, tmp_path):
    """What executors hold doesn't grow with the steps: no state store, and a batch writes its own lines' rows alone."""
    put(tmp_path / "in", "a.txt", [line(k, k, 5.0) for k in range(3)])
    put(tmp_path / "in", "b.txt", [line(2, 2, 4.0), line(3, 3, 1.0)])
    assert run(spark, tmp_path, files_per_trigger=1, late="1 day") == [
        ("r1", 0, 5.0, 1), ("r1", 1, 5.0, 1), ("r1", 2, 5.0, 2), ("r1", 3, 1.0, 1)
    ]
    assert not (tmp_path / "state" / "state").exists()
    rows = [spark.read.parquet(f"{tmp_path}/out/batch-{k}").groupBy().sum("arrivals").first()[0] for k in range(2)]
    assert sorted(rows) == [2, 3]
    (tmp_path / "state" / "state").mkdir()  # as an earlier version left it, with running counts beside it
    with pytest.raises(RuntimeError, match="anew"):
        run(spark, tmp_path, late="1 day")


def test_late_lines_are_left_out_as_with_state(spark, tmp_path):
    """A line of a window that the watermark has passed, one of the window it stands in, one of before 1970."""
    old = (dt.datetime(1969, 12, 31), *line(0, 9, 9.0)[1:])
    parts = [[line(10, 1, 5.0), old], [line(200, 2, 4.0)], [line(100, 3, 3.0), line(140, 4, 2.0), line(169, 5, 1.0)], [line(500, 6, 0.5)]]
    for k, part in enumerate(parts):
        put(tmp_path / "in", f"{k}.txt", part)
        got = run(spark, tmp_path, late="30 minutes", fold=3)
        rows = latest.changes(latest.read_log_stream(spark, f"{tmp_path}/in"), late="30 minutes")
        query = (
            rows.writeStream.outputMode("update").foreachBatch(
                lambda df, n: df.write.mode("overwrite").parquet(f"{tmp_path}/kept/{n}")
            ).option("checkpointLocation", f"{tmp_path}/kept_state").trigger(availableNow=True).start()
        )
        query.awaitTermination()
    kept = spark.read.parquet(*[str(p) for p in (tmp_path / "kept").iterdir()])
    assert sorted({r.step for r in kept.collect()}) == [r[1] for r in got] == [1, 2, 4, 5, 6]

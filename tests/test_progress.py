import datetime as dt
import time

from pyspark.sql import functions as F

from chatloom.operators import logs as O
from chatloom.streaming import progress as P

DAY = dt.datetime(2026, 1, 1)


def line(seconds, step=None, run="r1", text=None):
    text = text or f"Epoch:[1/2]({step}/100) loss:1.000 lr:0.000100 epoch_Time:3.0min:"
    return DAY + dt.timedelta(seconds=seconds), run, text


def put(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / f".{name}").write_text("".join(f"{t.isoformat()}\t{r}\t{x}\n" for t, r, x in lines))
    (folder / f".{name}").rename(folder / name)


def state(spark, out):
    rows = P.read_progress(spark, out).collect()
    return sorted((r.run, r.max_step, r.step_lines, r.total_steps, r.finished) for r in rows)


def batch(spark, lines):
    rows = spark.createDataFrame(lines, "arrived timestamp, run string, line string")
    return sorted((r.run, r.max_step, r.step_lines, r.total_steps, r.finished) for r in O.log_progress(rows).collect())


def test_equals_the_batch_operator(spark, tmp_path):
    parts = [
        [line(k, k) for k in range(5)] + [line(0, text="no step", run="r2")],
        [line(60, 3), line(90, 9), line(95, text="Task has finished", run="r3"), line(9, 4, run="r3")],
        [line(120, text="Task has finished")],
    ]
    seen = []
    for k, part in enumerate(parts):
        put(tmp_path / "in", f"{k}.txt", part)
        seen += part
        P.stream_progress(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
        assert state(spark, f"{tmp_path}/out") == batch(spark, seen)
        if k == 1:
            left = P.read_progress(spark, f"{tmp_path}/out").where("run = 'r1'").first().minutes_left
            assert left == 90 / 10 * 100 // 60 - 90 // 60
    events = [(r.run, r.event) for r in P.read_events(spark, f"{tmp_path}/out").orderBy("batch", "run").collect()]
    assert events == [("r1", "progress"), ("r2", "progress"), ("r1", "progress"), ("r3", "finished"), ("r1", "finished")]


def test_replay_changes_nothing(spark, tmp_path):
    put(tmp_path / "in", "a.txt", [line(k, k) for k in range(5)])
    P.stream_progress(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    put(tmp_path / "in", "b.txt", [line(9, 9)])
    P.stream_progress(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    once = state(spark, f"{tmp_path}/out")
    last = max((tmp_path / "state" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    P.stream_progress(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    assert state(spark, f"{tmp_path}/out") == once == [("r1", 9, 6, 100, False)]


def test_stalled_and_resumed(spark, tmp_path):
    put(tmp_path / "in", "a.txt", [line(0, 1), line(0, 1, run="r2"), line(1, text="Task has finished", run="r2")])
    query = P.stream_progress(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state", stall_seconds=1, every="1 second")
    events = lambda: [r.event for r in P.read_events(spark, f"{tmp_path}/out").where("run = 'r1'").orderBy("batch").collect()]

    def wait(wanted):
        end = time.time() + 90
        while events()[-1:] != [wanted] and time.time() < end:
            time.sleep(0.5)

    try:
        wait("stalled")
        assert events() == ["progress", "stalled"]
        put(tmp_path / "in", "b.txt", [line(60, 2)])
        wait("stalled" if events()[-1:] == ["resumed"] else "resumed")
    finally:
        query.stop()
    assert events()[:3] == ["progress", "stalled", "resumed"]
    other = [r.event for r in P.read_events(spark, f"{tmp_path}/out").where("run = 'r2'").collect()]
    assert other == ["finished"]  # no timer any more


def test_nothing_yet(spark, tmp_path):
    assert P.read_progress(spark, f"{tmp_path}/out").count() == 0
    assert P.read_events(spark, f"{tmp_path}/out").where(F.col("batch") > 0).count() == 0

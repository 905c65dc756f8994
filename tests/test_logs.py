import pytest
from pyspark.sql import functions as F

from chatloom.operators import logs as L
from chatloom.sources import readers
from chatloom.streaming.logs import stream_log

LINES = {
    "pretrain": "Epoch:[1/2](100/9751) loss:2.345678 lr:0.000500000000 epoch_Time:12.0min:",
    "sft": "Epoch:[2/3](7/10), loss: 2.3457, logits_loss: 2.3000, aux_loss: 0.0457, lr: 0.00050000, epoch_time: 1.5min",
    "ppo": "Epoch: 1, Step: 4/9751, Actor Loss: -0.123456, Critic Loss: 0.500000, Reward: -1.250000, KL: 0.010000, KL_ref: 0.020000, Avg Response Len: 12.50, Actor LR: 1.00e-06, Critic LR: 2.00e-06",
    "grpo": "Epoch: 2, Step: 5/8, Actor Loss: 0.100000, Reward: 1.500000, Avg Response Len: 31.25, LR: 3.00e-07",
    "agent": "Epoch:[1/1](4/10), Reward:0.1234, KL:-0.0010, GrpStd:0.5000, AdvStd:0.9000, Loss:nan, AvgLen:20.00, AdvMean:0.0000, LR:0.00000030",
    None: "Epoch 1 finished",
}


def lines(spark, texts, run="r"):
    at, rows = 0, []
    for t in texts:
        rows.append((run, at, t))
        at += len(t) + 1
    return spark.createDataFrame(rows, "run string, offset long, line string")


def test_five_formats(spark):
    got = {r.format: r for r in L.parse_log(lines(spark, LINES.values())).collect()}
    assert set(got) == {"pretrain", "sft", "ppo", "grpo", "agent"}
    p = got["pretrain"]
    assert (p.epoch, p.step, p.total_steps, p.loss, p.lr, p.epoch_minutes) == (1, 100, 9751, 2.345678, 0.0005, 12.0)
    s = got["sft"]
    assert (s.epoch, s.loss, s.logits_loss, s.aux_loss, s.lr, s.epoch_minutes) == (2, 2.3457, 2.3, 0.0457, 0.0005, 1.5)
    o = got["ppo"]
    assert (o.actor_loss, o.critic_loss, o.reward, o.kl, o.kl_ref, o.avg_response_len, o.lr, o.critic_lr, o.loss) == (
        -0.123456, 0.5, -1.25, 0.01, 0.02, 12.5, 1e-6, 2e-6, None,
    )
    g = got["grpo"]
    assert (g.epoch, g.step, g.actor_loss, g.reward, g.lr) == (2, 5, 0.1, 1.5, 3e-7)
    a = got["agent"]
    assert (a.reward, a.kl, a.group_reward_std, a.advantages_std, a.avg_response_len, a.lr) == (0.1234, -0.001, 0.5, 0.9, 20.0, 3e-7)
    assert a.loss != a.loss  # nan


def test_long_metrics(spark):
    rows = L.metrics_long(L.parse_log(lines(spark, [LINES["grpo"]]))).collect()
    assert {r.metric: r.value for r in rows} == {
        "actor_loss": 0.1, "reward": 1.5, "avg_response_len": 31.25, "lr": 3e-7,
    }


def test_progress(spark):
    log = lines(spark, [LINES["ppo"], LINES["grpo"], "Task has finished"]).unionByName(
        lines(spark, ["nothing here"], "empty")
    )
    got = {r.run: tuple(r)[1:] for r in L.log_progress(log).collect()}
    assert got == {"r": (5, 2, 9751, True), "empty": (None, 0, None, False)}


def test_markers_and_tail(spark):
    texts = ["saved here", "Error: CUDA error", "x" * 50, "Epoch 2 then Epoch 2 again", "end"]
    content = "\n".join(texts) + "\n"
    log = lines(spark, texts).repartition(3)
    got = {r.marker: r.from_end for r in L.log_markers(log).collect()}
    assert got == {m: len(content) - content.rfind(m) for m in L.MARKERS if m in content}
    for n in (1, 10, 60, 10_000):
        assert L.log_tail(log, n).first().tail == content[-n:]


def test_eta(one):
    assert one(L.eta_minutes(F.lit(605.0), F.lit(9), F.lit(100))) == 605 / 10 * 100 // 60 - 605 // 60


def test_log_file_offsets(spark, tmp_path):
    data = "première ligne\nEpoch 2\r\nbad ".encode() + b"\xff" + " byte\n\n日本\nlast".encode()
    path = tmp_path / "train.log"
    path.write_bytes(data)
    content = data.decode("utf-8", errors="replace").replace("\r\n", "\n")
    rows = readers.read_log(spark, str(path)).orderBy("offset").collect()
    assert [r.line for r in rows] == content.split("\n")
    for r in rows:
        assert content[r.offset : r.offset + len(r.line)] == r.line


def test_offsets_across_blocks(spark, tmp_path):
    texts = [f"line {i} " + "y" * (i % 70) for i in range(3000)]
    (tmp_path / "a.log").write_text("\n".join(texts) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        rows = readers.read_log(spark, str(tmp_path)).orderBy("offset").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [r.line for r in rows] == texts
    at = 0
    for r in rows:
        assert r.offset == at
        at += len(r.line) + 1


def stamp(minute, run, line):
    return f"2024-01-01T00:{minute:02d}:00\t{run}\t{line}"


def step(n, loss):
    return f"Epoch:[1/1]({n}/99) loss:{loss:.6f} lr:0.000500000000 epoch_Time:1.0min:"


def test_stream_over_two_files(spark, tmp_path):
    src, out, state = (tmp_path / n for n in ("in", "out", "state"))
    src.mkdir()
    first = [stamp(1, "a", step(1, 4.0)), stamp(2, "a", step(2, 2.0)), stamp(3, "b", step(1, 8.0)), stamp(3, "a", "noise")]
    (src / "1.txt").write_text("\n".join(first) + "\n")
    # the resumed run repeats step 2; the last line is later than the watermark allows for
    second = [stamp(4, "a", step(2, 2.0)), stamp(12, "a", step(3, 1.0)), stamp(59, "a", step(4, 1.0))]
    (src / "2.txt").write_text("\n".join(second) + "\n")
    query = stream_log(
        spark, str(src), str(out), str(state), files_per_trigger=1, width="10 minutes", late="20 minutes"
    )
    assert query.awaitTermination(120) in (True, None)
    rows = spark.read.parquet(str(out)).orderBy("window_start", "run").collect()
    assert [(r.window_start.minute, r.run, r.steps, r.max_step, r.avg_value, r.max_value) for r in rows] == [
        (0, "a", 2, 2, 3.0, 4.0),
        (0, "b", 1, 1, 8.0, 8.0),
        (10, "a", 1, 3, 1.0, 1.0),
    ]


def test_latest_wins_in_batch(spark):
    parsed = L.parse_log(
        spark.createDataFrame(
            [("r", 0, 1, step(1, 4.0)), ("r", 9, 5, step(1, 3.0)), ("r", 5, 2, step(2, 2.0))],
            "run string, offset long, arrived long, line string",
        )
    )
    got = {r.step: r.loss for r in L.latest_steps(parsed).collect()}
    assert got == {1: 3.0, 2: 2.0}


def test_tail_of_many_logs(spark):
    log = lines(spark, ["aa", "bb"], "x").unionByName(lines(spark, ["cc"], "y"))
    assert {r.run: r.tail for r in L.log_tail(log, 4).collect()} == {"x": "\nbb\n", "y": "cc\n"}

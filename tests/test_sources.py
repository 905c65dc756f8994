import json
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from chatloom import session
from chatloom.operators import vocab as V
from chatloom.sources import readers


def write(tmp_path, rows, name="in.jsonl"):
    path = tmp_path / name
    path.write_text("\n".join(r if isinstance(r, str) else json.dumps(r, ensure_ascii=False) for r in rows) + "\n")
    return str(path)


def test_pretrain(spark, tmp_path):
    path = write(tmp_path, [{"text": "你好"}, {"text": 12}, {"text": None}, {"other": 1}])
    assert [r.text for r in readers.read_pretrain(spark, path).collect()] == ["你好", "12", None, None]


def test_sft_fills_absent_fields(spark, tmp_path):
    path = write(tmp_path, [{"conversations": [{"role": "user", "content": "hi", "extra": 1}]}])
    m = readers.read_sft(spark, path).first().conversations[0]
    assert tuple(m) == ("user", "hi", None, None, None)


def test_preference_and_prompts(spark, tmp_path):
    side = [{"role": "user", "content": "q"}]
    path = write(tmp_path, [{"chosen": side, "rejected": side}])
    row = readers.read_preference(spark, path).first()
    assert row.chosen == row.rejected and row.chosen[0].content == "q"
    path = write(tmp_path, [{"conversations": side}], "p.jsonl")
    assert readers.read_rl_prompts(spark, path).first().conversations[0].role == "user"


def test_agent_tasks(spark, tmp_path):
    task = {"conversations": [{"role": "system", "content": "", "tools": "[1]"}], "gt": ["7.21", "x"], "more": {"a": 1}}
    rows = readers.read_agent_tasks(spark, write(tmp_path, [task]))
    row = rows.select("conversations", "gt", F.try_variant_get("row", "$.more.a", "int").alias("a")).first()
    assert (row.conversations[0].tools, row.gt, row.a) == ("[1]", ["7.21", "x"], 1)


def test_undeclared_fields_come_along(spark, tmp_path):
    line = {"conversations": [{"role": "user", "content": "hi", "lang": "en"}], "id": 7}
    path = write(tmp_path, [line])
    row = readers.read_sft(spark, path, extras=True)
    got = row.select(
        "conversations",
        F.variant_get("row", "$.id", "int").alias("id"),
        F.variant_get("row", "$.conversations[0].lang", "string").alias("lang"),
    ).first()
    assert got.conversations == readers.read_sft(spark, path).first().conversations
    assert (got.id, got.lang) == (7, "en")


@pytest.mark.parametrize("reader", [readers.read_sft, readers.read_agent_tasks, readers.read_pretrain])
def test_bad_lines_raise(spark, tmp_path, reader):
    path = write(tmp_path, [{"conversations": []}, "{broken"])
    with pytest.raises(Exception):
        reader(spark, path).collect()


@pytest.mark.parametrize("line", [{"conversations": "text", "gt": []}, {"conversations": [], "gt": {"a": 1}}, [1, 2], "7"])
def test_lines_of_another_shape_raise(spark, tmp_path, line):
    good = {"conversations": [], "gt": None}
    assert readers.read_agent_tasks(spark, write(tmp_path, [good])).first().gt is None
    (tmp_path / "more").mkdir()
    with pytest.raises(Exception, match="another type|no object"):
        readers.read_agent_tasks(spark, write(tmp_path / "more", [good, line])).collect()


def test_bad_stream_lines_are_counted(spark, tmp_path):
    from chatloom.streaming import logs

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("2024-01-01 00:00:00\tr\tx\nnever\tr\tx\nonly\ttwo\n\n")
    done = (
        logs.bad_lines(spark, str(tmp_path / "in"))
        .writeStream.format("memory").queryName("bad_lines").outputMode("complete").trigger(availableNow=True)
        .start()
    )
    done.awaitTermination()
    assert {tuple(r) for r in spark.table("bad_lines").collect()} == {("bad time", 1), ("too few fields", 2)}


def test_score_card(spark, tmp_path):
    card = {"model": "m", "model_type": "Seq. Classifier", "chat_template": "tokenizer", "a-b": 0.5, "c": 1}
    path = tmp_path / "card.json"
    path.write_text(json.dumps(card, indent=2))
    rows = readers.read_score_card(spark, str(path)).collect()
    assert {(r.model, r.subset, r.accuracy) for r in rows} == {("m", "a-b", 0.5), ("m", "c", 1.0)}


def test_special_ids(spark, tmp_path):
    saved = {str(i): {"content": t, "special": True} for t, i in V.REWARD_IDS.items()}
    path = tmp_path / "config.json"
    path.write_text(json.dumps({"add_bos_token": True, "added_tokens_decoder": saved}, indent=1))
    assert dict(readers.read_special_ids(spark, str(path)).collect()) == V.REWARD_IDS


class Context:
    def __init__(self, master):
        self.master, self.dir = master, None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, path):
        self.dir = path


def session_with(master, named=None):
    conf = SimpleNamespace(get=lambda key, default=None: named or default)
    return SimpleNamespace(conf=conf, sparkContext=Context(master))


def test_a_named_folder_is_used_and_a_cluster_must_name_one():
    assert session.shared_dir(session_with("yarn", "hdfs:/shared")) == "hdfs:/shared"
    with pytest.raises(RuntimeError):
        session.shared_dir(session_with("yarn"))
    local = session_with("local[2]")
    assert session.shared_dir(local) == session.shared_dir(local) != session.shared_dir(session_with("local[2]"))


def test_shared_folder_is_the_sessions(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert session.shared_dir(spark) == (named or spark.sparkContext.getCheckpointDir())
    a, b = session.fresh_path(spark, "t"), session.fresh_path(spark, "t")
    assert a != b and a.startswith(session.shared_dir(spark).rstrip("/"))


def test_spread_only_when_splits_are_few(spark):
    cores = spark.sparkContext.defaultParallelism
    assert session.spread(spark.range(10).coalesce(1), "id").rdd.getNumPartitions() == cores
    many = spark.range(0, 10, 1, cores + 3)
    assert session.spread(many, "id") is many


@pytest.mark.parametrize("rest", [" x", ", {}", "] [", "} {"])
def test_more_than_one_value_raises(spark, tmp_path, rest):
    path = write(tmp_path, ['{"conversations": [], "gt": []}' + rest])
    with pytest.raises(Exception, match="not JSON"):
        readers.read_agent_tasks(spark, path).collect()

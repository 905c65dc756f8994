import json

import pytest
from pyspark.sql import functions as F

from chatloom import schemas
from chatloom.sources import quarantine as Q


def chat(*messages, **more):
    return json.dumps({"conversations": [dict(zip(("role", "content", "tools", "tool_calls"), m, strict=False)) for m in messages], **more})


LINES = {
    chat(("user", "hi"), ("assistant", "yo"), extra=1): "good",
    "  " + chat(("user", "你好")) + " ": "good",
    chat(("user", "x", '[{"a": 1}]'), ("assistant", "y", None, "[]")): "good",
    "": "blank",
    " \t ": "blank",
    "{broken": "not JSON",
    '{"conversations": []} x': "not JSON",
    '{"conversations": []}, {}': "not JSON",
    '{"conversations": []}] [': "not JSON",
    '{"conversations": []}} {': "not JSON",
    "[1, 2]": "no object",
    "7": "no object",
    '{"other": 1}': "missing: conversations",
    '{"conversations": null}': "missing: conversations",
    '{"conversations": "text"}': "type: conversations",
    '{"conversations": []}': "empty conversation",
    chat(("", "x")): "message without role",
    chat(("user", "x", "{bad")): "bad tools",
    chat(("assistant", "x", None, "[{]")): "bad tool calls",
}


def put(tmp_path, lines, name="in.jsonl"):
    path = tmp_path / name
    path.write_bytes(b"\n".join(x if isinstance(x, bytes) else x.encode() for x in lines) + b"\n")
    return str(path)


def test_every_line_is_in_one_table(spark, tmp_path):
    lines = [*LINES, b'{"conversations": "\xff"}', *list(LINES)[:2]]
    good, bad = Q.read_sft(spark, put(tmp_path, lines), f"{tmp_path}/out")
    found = {r.line: r.reason for r in bad.collect()}
    want = {x: why for x, why in LINES.items() if why != "good"}
    assert {k: v for k, v in found.items() if "�" not in k} == want
    assert [v for k, v in found.items() if "�" in k] == ["not UTF-8"]
    assert good.count() == 5 and good.count() + bad.count() == len(lines)
    counts = {r.reason: r.lines for r in Q.counts_of(spark, f"{tmp_path}/out").collect()}
    assert counts["good"] == 5 and counts["blank"] == 2 and sum(counts.values()) == len(lines)
    first = good.where(F.size("conversations") == 2).select(F.col("conversations")[0]["content"].alias("c"))
    assert "hi" in {r.c for r in first.collect()}
    assert all(r.file.endswith("in.jsonl") for r in bad.collect())


def test_one_kind_alone(spark, tmp_path):
    good, bad = Q.read_pretrain(spark, put(tmp_path, ['{"text": "a"}', '{"text": 7}']), f"{tmp_path}/a")
    assert sorted(r.text for r in good.collect()) == ["7", "a"] and bad.count() == 0
    good, bad = Q.read_pretrain(spark, put(tmp_path, ['{"text": " "}', "x"], "b.jsonl"), f"{tmp_path}/b")
    assert good.count() == 0 and {r.reason for r in bad.collect()} == {"empty text", "not JSON"}
    good, bad = Q.read_pretrain(spark, put(tmp_path, [], "c.jsonl"), f"{tmp_path}/c")
    assert good.count() == 0 and [r.reason for r in bad.collect()] == ["blank"]  # the file's one empty line


def test_pairs_and_tasks(spark, tmp_path):
    side = lambda x: [{"role": "user", "content": x}]
    rows = [{"chosen": side("a"), "rejected": side("b")}, {"chosen": side("a"), "rejected": side("a")}, {"chosen": side("a")}, {"chosen": [], "rejected": side("b")}]
    good, bad = Q.read_preference(spark, put(tmp_path, map(json.dumps, rows)), f"{tmp_path}/p")
    assert good.first().rejected[0].content == "b" and good.count() == 1
    assert sorted(r.reason for r in bad.collect()) == ["empty side", "missing: rejected", "sides are equal"]
    rows = [{"conversations": side("q"), "gt": ["1"]}, {"conversations": side("q"), "gt": {"a": 1}}]
    good, bad = Q.read_agent_tasks(spark, put(tmp_path, map(json.dumps, rows), "t.jsonl"), f"{tmp_path}/t")
    assert good.first().gt == ["1"] and [r.reason for r in bad.collect()] == ["type: gt"]


def test_mended_lines_are_read_again(spark, tmp_path):
    _, bad = Q.read_pretrain(spark, put(tmp_path, ['{"text": "a"}', '{"text": "b"']), f"{tmp_path}/out")
    Q.replay(spark, f"{tmp_path}/out", f"{tmp_path}/again")
    mended = spark.read.text(f"{tmp_path}/again").select(F.concat("value", F.lit("}")))
    mended.write.text(f"{tmp_path}/mended")
    good, bad = Q.read_pretrain(spark, f"{tmp_path}/mended", f"{tmp_path}/second")
    assert [r.text for r in good.collect()] == ["b"] and bad.count() == 0


def test_half_written_is_refused(spark, tmp_path):
    path = put(tmp_path, ['{"text": "a"}'])
    with pytest.raises(ValueError, match="not whole"):
        Q.good_rows(spark, f"{tmp_path}/none", schemas.PRETRAIN)
    Q.split_lines(spark, path, f"{tmp_path}/out", schemas.PRETRAIN)
    with pytest.raises(Exception):
        Q.split_lines(spark, path, f"{tmp_path}/out", schemas.PRETRAIN)


def test_one_pass_over_the_files(spark, tmp_path):
    rules = {"long": lambda: F.length("text") < 5}
    counts = Q.split_lines(spark, put(tmp_path, ['{"text": "a"}', '{"text": "abcdefg"}']), f"{tmp_path}/out", schemas.PRETRAIN, rules=rules)
    assert {r.reason: r.lines for r in counts.collect()} == {"good": 1, "long": 1}
    assert {"/part=bad/" in f for f in Q.bad_lines(spark, f"{tmp_path}/out").inputFiles()} == {True}

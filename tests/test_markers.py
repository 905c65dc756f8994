import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chatloom.operators import logs as O
from chatloom.operators.markers import find_markers

LINES = ["Error: disk full", "CUDA error, Error", "", "日本 saved saved", "Epoch 2 aaaa", None]


def log(spark, lines=LINES, runs=("a", None)):
    rows, out = [], []
    for run in runs:
        at = 0
        for x in lines:
            rows.append((run, at, x))
            at += len(x or "") + 1
        out.append((run, "\n".join(x or "" for x in lines) + "\n"))
    return spark.createDataFrame(rows, "run string, offset long, line string").repartition(3), out


def table(spark, markers):
    return spark.createDataFrame([(m,) for m in markers], "marker string")


def brute(bodies, markers):
    found = []
    for run, body in bodies:
        for m in {m for m in markers if m and "\n" not in m}:
            if (at := body.rfind(m)) >= 0:
                found.append((run, m, len(body) - at))
    return sorted(found, key=str)


@pytest.mark.parametrize("block", [8_000_000, 12])
def test_equals_a_search_of_the_whole_log(spark, block):
    """In one automaton and in several; overlapping, nested, absent, repeated, null and empty markers."""
    markers = ["Error", "error", "Err", "rror", "saved", "日本", "aa", "a", "absent", "Error", "", None, "Epoch 2", "CUDA error"]
    lines, bodies = log(spark)
    got = find_markers(lines, table(spark, markers), block=block)
    assert sorted(((r.run, r.marker, r.from_end) for r in got.collect()), key=str) == brute(bodies, markers)


def test_ten_thousand_markers(spark):
    rng = random.Random(1)
    word = lambda n: "".join(rng.choice("abcd ") for _ in range(n))
    text = [word(120) for _ in range(300)]
    markers = [word(rng.randint(3, 9)) for _ in range(10_000)]
    lines, bodies = log(spark, text, runs=("r",))
    got = find_markers(lines, table(spark, markers))
    plan = got._jdf.queryExecution().executedPlan().toString()
    want = brute(bodies, markers)
    assert sorted(((r.run, r.marker, r.from_end) for r in got.collect()), key=str) == want and len(want) > 1000
    assert plan.count("MapInArrow") == 1 and "NestedLoop" not in plan and "Cartesian" not in plan


def test_the_short_list_gives_the_same(spark):
    lines, _ = log(spark, runs=("a", "b"))
    lines = lines.where(F.col("line").isNotNull())
    mine = find_markers(lines, table(spark, O.MARKERS))
    pairs = [sorted((r.run, r.marker, r.from_end) for r in x.collect()) for x in (mine, O.log_markers(lines))]
    assert pairs[0] == pairs[1] != []


def test_no_markers_no_lines(spark):
    lines, _ = log(spark)
    assert find_markers(lines, table(spark, [None, ""])).count() == 0
    assert find_markers(lines.limit(0), table(spark, ["a"])).count() == 0


def test_lines_in_any_order_overlapping_and_without_offset(spark):
    """The greatest place stands, also of lines that overlap or share an offset."""
    rows = [("r", 9, "xx"), ("r", 0, "ab........ab"), ("r", 5, "ab"), ("r", 5, "..ab"), ("r", None, "ab"), ("s", 4, "ab"), ("s", 0, "ab")]
    lines = spark.createDataFrame(rows, "run string, offset long, line string").coalesce(1)
    got = {(r.run, r.marker): r.from_end for r in find_markers(lines, table(spark, ["ab", "b", "xx"])).collect()}
    # logs end behind 13 and 7 characters
    assert got == {("r", "ab"): 3, ("r", "b"): 2, ("r", "xx"): 4, ("s", "ab"): 3, ("s", "b"): 2}


def test_a_hit_costs_no_look_at_earlier_ones():
    """A thousand hits of a marker in a task are compared once for each batch."""
    import pyarrow as pa

    from chatloom.operators import markers as M

    class Table:
        value = ["a"]

    compared = []

    def merge(last, key, seen, real=M._merge):
        compared.append(len(seen))
        real(last, key, seen)

    batch = pa.RecordBatch.from_pydict({"key": ["r"] * 100, "offset": list(range(0, 1100, 11)), "line": ["a" * 10] * 100})
    whole, M._merge = M._merge, merge
    try:
        out = list(M._searched("hits", Table)([batch, batch]))
    finally:
        M._merge = whole
    assert [r.to_pydict() for r in out] == [{"key": ["r"], "number": [0], "at": [1098]}]
    assert compared == [1, 1]


@pytest.mark.parametrize("factor", [None, 1])
def test_hashes_that_do_not_tell_texts_apart(spark, monkeypatch, factor):
    """With a factor of 1 the hash of a text is that of its letters in any order."""
    from chatloom.operators import markers as M

    if factor:
        monkeypatch.setattr(M, "FACTOR", factor)
    monkeypatch.setattr(M, "SLICE", 16)
    rng = random.Random(2)
    word = lambda n: "".join(rng.choice("abé") for _ in range(n))
    text = [word(rng.randint(0, 40)) for _ in range(60)]
    some = sorted({word(rng.randint(1, 37)) for _ in range(300)} | {"ab", "abab", text[0][:33]} - {""})
    for markers in (some, some[::3]):
        index = M._Index(pa.array(markers))
        assert factor is None or index.twins
        codes, begins = M._codes(pa.array(text))
        offsets = np.array(begins[:-1])
        for first, end in ((0, 60), (7, 31)):
            want = {}
            for at, x in zip(offsets[first:end].tolist(), text[first:end]):
                want.update({k: at + x.rfind(m) for k, m in enumerate(markers) if m in x})
            assert index.lasts(codes, begins, first, end, offsets) == want


def test_markers_pass_the_driver_packed_and_a_block_at_a_time(spark):
    """No list of Python strings, no broadcast join of the markers; blocks stay within bounds when beginnings are the same."""
    from chatloom.operators import markers as M

    for words in ([f"{k:05d}" for k in range(4000)], [f"the same beginning {k:05d}" for k in range(4000)]):
        size = sum(map(len, words))
        blocks = list(M._blocks(table(spark, words), size // 5))
        assert sorted(w for b in blocks for w in b.to_pylist()) == words and len(blocks) >= 5
        assert all(isinstance(b, pa.Array) and sum(map(len, b.to_pylist())) < size // 3 for b in blocks)
    lines, _ = log(spark)
    plan = find_markers(lines, table(spark, ["Error", "a"]))._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation" not in plan and "broadcast" not in plan.lower()


def test_an_index_is_small(spark):
    """Some 60 bytes a marker; an automaton takes over 400."""
    from chatloom.operators import markers as M

    rng = random.Random(3)
    index = M._Index(pa.array(sorted({f"{rng.random():.9f}"[2:] for _ in range(50_000)})))
    held = sum(x.nbytes for x in vars(index).values() if isinstance(x, np.ndarray) and x is not index.powers and x is not index.undone)
    assert held + sum(c[2].nbytes for c in index.classes) < 80 * len(index.hashes)


def test_logs_side_by_side_with_any_places(spark):
    """Many logs in a batch, null among them, long lines across slices, negative offsets."""
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]), 1000 * k - 50_000, "".join(rng.choice("xyzü") for _ in range(rng.choice([0, 5, 900])))) for k in range(100)]
    markers = ["x", "xy", "zzz", "üxü", "xyzx", "yyyyy", "xyzüx"]
    want = {}
    for run, at, text in sorted(rows, key=lambda r: r[1]):
        want.update({(run, m): at + text.rfind(m) for m in markers if m in text})
    ends = {run: max(at + len(x) + 1 for r, at, x in rows if r == run) for run in {r[0] for r in rows}}
    lines = spark.createDataFrame(rows, "run string, offset long, line string").repartition(2)
    got = {(r.run, r.marker): r.from_end for r in find_markers(lines, table(spark, markers)).collect()}
    assert got == {k: ends[k[0]] - at for k, at in want.items()}


def test_a_text_with_a_marker_s_hash_does_not_hide_an_earlier_place(monkeypatch):
    from chatloom.operators import markers as M

    monkeypatch.setattr(M, "FACTOR", 1)
    index = M._Index(pa.array(["ab", "aab"]))
    codes, begins = M._codes(pa.array(["xab", "aabx", "baba", "baa"]))
    assert not index.twins
    assert index.lasts(codes, begins, 0, 4, begins[:-1]) == {0: 8, 1: 3}
    assert index.lasts(codes, begins, 3, 4, begins[:-1]) == {}

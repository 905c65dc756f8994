import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chatloom.functions import arrays as A
from chatloom.operators import vocab as V

I = A.IGNORED
OPEN, CLOSE = [1, 2], [3, 4]
IDS = "ids array<int>"


def labels(one, ids, **kw):
    return one(A.assistant_labels(F.col("ids"), OPEN, CLOSE, **kw), schema=IDS, row=(ids,))


def test_closed_span(one):
    assert labels(one, [9, 1, 2, 7, 8, 3, 4, 9]) == [I, I, I, 7, 8, 3, 4, I]


def test_two_spans(one):
    ids = [1, 2, 7, 3, 4, 9, 1, 2, 8, 3, 4]
    assert labels(one, ids) == [I, I, 7, 3, 4, I, I, I, 8, 3, 4]


def test_open_span_takes_padding(one):
    assert labels(one, [1, 2, 7, 0, 0]) == [I, I, 7, 0, 0]
    assert labels(one, [1, 2, 7, 0, 0], mask_padding=0) == [I, I, 7, I, I]


def test_start_inside_a_span_is_text(one):
    assert labels(one, [1, 2, 7, 1, 2, 8, 3, 4, 9]) == [I, I, 7, 1, 2, 8, 3, 4, I]


def test_cut_end_marker_leaves_span_open(one):
    assert labels(one, [1, 2, 7, 3]) == [I, I, 7, 3]


def test_no_span_empty_span_and_empty_row(one):
    assert labels(one, [9, 9]) == [I, I]
    assert labels(one, [9, 1, 2]) == [I, I, I]
    assert labels(one, [1, 2, 3, 4, 9]) == [I, I, 3, 4, I]
    assert labels(one, []) == []
    assert labels(one, [1]) == [I]


def expected(ids):
    """Spans by a text pattern over one character per id."""
    text = "".join(map(str, ids))
    out = [I] * len(ids)
    for m in re.finditer("12(.*?(?:34|$))", text):
        out[m.start(1) : m.end(1)] = ids[m.start(1) : m.end(1)]
    return out


@settings(max_examples=6, deadline=None)
@given(st.lists(st.lists(st.integers(1, 5), max_size=25), min_size=30, max_size=60))
def test_random_rows(spark, rows):
    df = spark.createDataFrame([(r,) for r in rows], IDS)
    got = df.select("ids", A.assistant_labels(F.col("ids"), OPEN, CLOSE).alias("l")).collect()
    for r in got:
        assert r["l"] == expected(r["ids"])
        assert len(r["l"]) == len(r["ids"])


def test_chat_markers_of_the_vocabulary():
    names = V.SPECIALS + V.RESERVED
    assert [names[i] for i in V.ASSISTANT_OPEN] == ["<|im_start|>", "assistant", "\n"]
    assert [names[i] for i in V.ASSISTANT_CLOSE] == ["<|im_end|>", "\n"]
    assert V.PAD != V.EOS


def test_framing_and_padding(one):
    ids = F.col("ids")
    got = one(
        A.frame_ids(ids, 8, 9, 4),
        A.pad_right(ids, 5, 0),
        A.pad_left(ids, 5, 0),
        A.pad_right(ids, 2, 0),
        A.keep_tail(ids, 2),
        A.keep_tail(ids, 0),
        A.keep_tail(ids, 9),
        schema=IDS,
        row=([5, 6, 7],),
    )
    assert got == (
        [8, 5, 6, 9], [5, 6, 7, 0, 0], [0, 0, 5, 6, 7], [5, 6, 7], [6, 7], [5, 6, 7], [5, 6, 7],
    )


def test_masks(one):
    ids = F.col("ids")
    row = ([5, 9, 6, 9, 0],)
    assert one(A.completion_mask(ids, 9), schema=IDS, row=row) == [1, 1, 0, 0, 0]
    assert one(A.completion_mask(ids, 7), schema=IDS, row=row) == [1, 1, 1, 1, 1]
    assert one(A.attention_mask(ids, 0), schema=IDS, row=row) == [1, 1, 1, 1, 0]
    assert one(A.response_len(ids, 9), schema=IDS, row=row) == 2
    assert one(A.response_len(ids, 7), schema=IDS, row=row) == 5
    assert one(A.response_mask(ids, F.lit(1), 0), schema=IDS, row=row) == [0, 1, 1, 0]


def test_agent_mask_looks_inside_the_mask_only(one):
    schema = "mask array<int>, ids array<int>"
    call = A.agent_mask(F.col("mask"), F.col("ids"), 9)
    assert one(call, schema=schema, row=([0, 0, 1, 1, 1], [5, 9, 6, 9, 7])) == [0, 1, 1, 0]
    assert one(call, schema=schema, row=([0, 0, 1, 1, 1], [5, 9, 6, 7, 7])) == [0, 1, 1, 1]
    assert one(call, schema=schema, row=([0, 0, 0], [9, 9, 9])) == [0, 0]


def test_aligning_logps(one):
    lp, schema = F.col("lp"), "lp array<double>"
    row = ([-1.0, -2.0, -3.0],)
    assert one(A.align_logps(lp, F.lit(5)), schema=schema, row=row) == [0.0, 0.0, -1.0, -2.0, -3.0]
    assert one(A.align_logps(lp, F.lit(2)), schema=schema, row=row) == [-2.0, -3.0]
    assert one(A.align_logps(lp, F.lit(0)), schema=schema, row=row) == []


def test_shift_and_append(one):
    ids, mask = F.array(*map(F.lit, [1, 2, 3])), F.array(*map(F.lit, [0, 1, 1]))
    x, y, m = one(A.shift(ids, mask))
    assert (x, y, m) == ([1, 2], [2, 3], [1, 1])
    assert one(A.append_once(ids, 3)) == [1, 2, 3]
    assert one(A.append_once(ids, 4)) == [1, 2, 3, 4]
    assert one(A.append_once(F.array().cast("array<int>"), 4)) == [4]


def test_remap(one):
    current = {"<|reward|>": 92550, "<|im_end|>": 92545, "<s>": 1, "<new>": 92560}
    table = A.remap_table(current, V.REWARD_IDS, V.REWARD_VOCAB)
    assert table == {92550: 92527, 92545: 92542}
    ids = F.array(*map(F.lit, [1, 92550, 92560, 92527]))
    assert one(A.remap_special_ids(ids, table, V.REWARD_VOCAB)) == [1, 92527, 92560, 92527]

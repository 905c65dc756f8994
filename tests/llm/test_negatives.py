"""Hard negatives against brute force."""

import math
import random

import numpy as np
import pytest

from chatloom.llm import negatives


def brute(rows):
    """The contract, row by row."""
    fine = []
    for i, e, label in dict.fromkeys((i, tuple(e) if e is not None else None, y) for i, e, y in rows):
        if None in (i, e, label) or any(x is None or not math.isfinite(x) for x in e):
            continue
        fine.append((i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * float(np.float32(x))) for x in e]))
    out = []
    for i, label, v in fine:
        if i % 100:
            continue
        score = [(sum(a * b for a, b in zip(v, w, strict=False)), j, y) for j, y, w in fine if j != i]
        score.sort(key=lambda r: (-r[0], r[1]))
        for p, j, _ in [r for r in score if r[2] == label][:5]:
            found = [r for r in score if r[2] != label and 30 * p <= 100 * r[0] <= 90 * p][:10]
            out += [(i, j, k + 1, n[1], p, n[0]) for k, n in enumerate(found)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame(
        [(i, e, y, "x", 1, "k") for i, e, y in rows],
        "vec_id long, embedding array<float>, label int, v string, leaf int, share string",
    )


def vectors(n, width, seed, copies=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width)) / math.sqrt(width) + rng.normal(size=width) / math.sqrt(width)
    x[:copies] = x[0]
    return [(k * 10, [float(np.float32(c)) for c in row], int(rng.integers(0, 4))) for k, row in enumerate(x)]


@pytest.mark.parametrize("sizes", [{}, {"BLOCK": 16, "SHARE": 2, "QUERIES": 7}])
@pytest.mark.parametrize("width,copies", [(2, 0), (24, 0), (8, 150)])
def test_equals_brute_force(spark, monkeypatch, sizes, width, copies):
    """In one block, and in many blocks, shares, rounds and blocks of anchors; with copies of one vector."""
    for name, value in sizes.items():
        monkeypatch.setattr(negatives, name, value)
    if sizes:
        whole = negatives.blocks
        monkeypatch.setattr(negatives, "blocks", lambda *a: whole(*a, sample=200, block=16))
    rows = vectors(400, width, width, copies)
    got = negatives.mine(table(spark, rows))
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = brute(rows)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 300


def test_rows_that_take_no_part(spark):
    rng = random.Random(3)
    rows = vectors(60, 4, 5)
    rows += [(600 + k, e, y) for k, (e, y) in enumerate([(None, 1), ([1.0, None, 0.0, 0.0], 1), ([math.nan] * 4, 1), ([math.inf, 0.0, 0.0, 0.0], 1), ([1.0, 1.0, 1.0, 1.0], None)])]
    rows += [(None, [1.0] * 4, 1), (700, [0.0] * 4, 2), (701, [0.5, 0.5], 2), (702, [], 2)]
    rows += rows[:5]  # repeated rows
    rng.shuffle(rows)
    assert sorted(map(tuple, negatives.mine(table(spark, rows)).collect())) == brute(rows)


def test_few_rows(spark):
    assert negatives.mine(table(spark, [])).count() == 0
    one = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 2), (3, [0.5, 0.0], 1), (4, [0.25, 0.5], 3), (5, [0.26, 0.5], 3)]
    assert sorted(map(tuple, negatives.mine(table(spark, one)).collect())) == brute(one) != []
    one += [(2, [2.0, 0.0], 1), (6, [0.75, 0.0], 2)]
    assert sorted(map(tuple, negatives.mine(table(spark, one)).collect())) == brute(one) != []


def test_ranges_leave_blocks_out():
    """In a space of few dimensions most blocks are never scored, and no row is lost."""
    rng = np.random.default_rng(0)
    x = np.floor(256 * rng.normal(size=(20_000, 3)))
    reach = float(np.sqrt((x * x).sum(1).max())) + 1
    tree = negatives.Tree(x[:2000], reach, 20).close()
    leaf = tree.leaf_of(negatives.lifted(x, reach))
    assert tree.leaves > 40 and leaf.min() >= 0
    ids, labels = np.arange(len(x)), np.zeros(len(x), np.int64)
    none = np.zeros(1, np.int64)
    best = np.sort((x @ x[7]).astype(np.int64))[::-1]
    low, high = best[3000], best[2000]
    search = negatives.Search(tree, reach, x[7:8], none + 7, none + 1, none, none + low, none + high, False, 10)
    seen = 0
    for k in range(tree.leaves):
        rows = np.flatnonzero(leaf == k)
        if len(rows):
            to = negatives.distances(negatives.lifted(x[rows], reach), tree.points[tree.way[k]])
            seen += len(search._open(tree.way[k], to.min(0), to.max(0)))
            search.block(k, ids[rows], labels[rows], x[rows], to.min(0), to.max(0))
    assert seen < tree.leaves * 0.8
    assert sorted(search.found()[1].tolist(), reverse=True) == best[best <= high][:10].tolist()

"""Fingerprints, pivots and near duplicates against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash

from chatloom.llm import graph, simhash
from chatloom.session import materialize

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    runs = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows):
    """(doc_id, fingerprint, least id reachable) of (doc_id, fingerprint)."""
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if (rows[a][1] ^ rows[b][1]).bit_count() <= 4:
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[find(k)] = min([v for v in (least.get(find(k)), i) if v is not None], default=None)
    return sorted(((i, f"{f:016x}", least[find(k)]) for k, (i, f) in enumerate(rows)), key=str)


def texts():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeÄé") for _ in range(rng.randint(1, 6)))
    out = [None, "", " \t\n", "One", "one", "ONE two\nthree", "a b c d", "a\x0bb\x0cc\rd e", "\x1fa b\xa0c d"]
    for size in (30, 200, 400):
        base = [word() for _ in range(size)]
        for edits in (0, 0, 1, 1, 2, 4, 9):
            w = list(base)
            for _ in range(edits):
                w[rng.randrange(size)] = word()
            out.append(" ".join(w))
    return out


def test_equals_brute_force(spark, docs):
    rows = list(enumerate(texts())) + [(None, "One"), (3, "other text of some words"), (3, "One"), (None, "alone here")]
    got = simhash.report(simhash.near_duplicates(docs(rows)))
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    want = brute_components([(i, brute_fingerprint(t)) for i, t in rows])
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_long_text_and_many_hashes():
    rng = random.Random(2)
    text = " ".join(rng.choice("abcdefg") for _ in range(5000))
    own = simhash._hashes(text)
    got = simhash.majority(np.array(own, np.uint64), np.array([len(own)]))
    assert int(got[0]) == brute_fingerprint(text)


def neighbours(seed, n=140):
    """Fingerprints in chains and balls, and some far from all."""
    rng = random.Random(seed)
    flip = lambda x, k: x ^ sum(1 << b for b in rng.sample(range(64), k))
    out = {0, (1 << 64) - 1}
    for k in (1, 2, 3, 4, 5, 6):
        x = rng.getrandbits(64)
        for _ in range(n // 12):
            out.add(x)
            x = flip(x, k)
    centre = rng.getrandbits(64)
    out |= {flip(centre, rng.randint(1, 4)) for _ in range(n // 2)}
    out |= {flip(centre, rng.randint(6, 10)) for _ in range(n // 4)}
    return sorted(out)


@pytest.mark.parametrize("bucket", [0, 3, 512])
def test_links_lose_none(spark, bucket):
    """Whether keys are compared pair by pair, by points around, or some by each."""
    fps = neighbours(bucket)
    signed = [int(np.uint64(f).view(np.int64)) for f in fps]
    table = materialize(spark.createDataFrame([(f,) for f in signed], "fp long"))
    found = simhash.links(table, bucket).collect()
    back = dict(zip(signed, fps, strict=True))
    assert all((back[r.a] ^ back[r.b]).bit_count() <= 4 for r in found if bucket == 0)
    roots = {r.node: r.root for r in graph.components(spark.createDataFrame(found, "a long, b long")).collect()}
    mine = {}
    for s in signed:
        mine.setdefault(roots.get(s, s), set()).add(back[s])
    want = {}
    for k, _, root in brute_components(list(enumerate(fps))):
        want.setdefault(root, set()).add(fps[k])
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, want.values()))


@pytest.mark.parametrize("m", [6, 7, 8, 9])
def test_pivots_bound_the_distance(m):
    rng = random.Random(m)
    p = simhash.pivots(m)
    a = np.array([rng.getrandbits(64) for _ in range(300)], np.uint64)
    b = np.array([int(x) ^ sum(1 << i for i in rng.sample(range(64), k % 5)) for k, x in enumerate(a)], np.uint64)
    far = np.abs(p.table(a).astype(int) - p.table(b).astype(int)).max(1)
    assert (far <= np.bitwise_count(a ^ b)).all()
    assert (p.keys(a) == p.keys(b)).any(0).all()  # each near pair meets
    assert (np.abs(p.table(a[:-1]).astype(int) - p.table(a[1:])).max(1) > 4).mean() > 0.99


def test_segments_grow():
    assert [simhash.segment_count(n) for n in (0, 10**6, 10**10)] == sorted(
        simhash.segment_count(n) for n in (0, 10**6, 10**10)
    )
    assert simhash.segment_count(10**10) > simhash.segment_count(10**6)


def test_empty_and_components(spark, docs):
    assert simhash.near_duplicates(docs([])).count() == 0
    found = graph.components(
        spark.createDataFrame([(1, 2), (3, 2), (7, 9), (5, 5), (None, 1)] + [(20, k) for k in range(21, 60)], "a long, b long")
    )
    roots = {r.node: r.root for r in found.collect()}
    assert roots == {1: 1, 2: 1, 3: 1, 7: 7, 9: 7} | {k: 20 for k in range(20, 60)}


def test_many_copies(spark, docs):
    rows = [(k, "the same few words again and again") for k in range(3000)] + [(5000, "another text of its own kind here")]
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs(rows)).collect()}
    assert set(got.values()) == {0, 5000} and got[2999] == 0

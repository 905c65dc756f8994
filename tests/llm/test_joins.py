"""Near duplicates and decontamination against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa

from chatloom.llm import decontaminate, ngram_join
from chatloom.llm import shingles as sh

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def brute_components(rows):
    sets, root = [brute_set(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        r = find(k)
        least[r] = min([v for v in (least.get(r), i) if v is not None], default=None)
    return [(i, len(sets[k]), least[find(k)]) for k, (i, _) in enumerate(rows)]


def corpus(seed=3):
    """Short and long texts, a chain of edits, a group with a common passage, copies."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcde") for _ in range(rng.randint(1, 6)))
    rows = []
    for size in (1, 2, 4, 5, 6, 7, 8, 9, 10, 12, 15, 20, 30, 60, 200):
        base = [word() for _ in range(size)]
        for edits in (0, 0, 1, 1, 2, 3, 5):
            w = list(base)
            for _ in range(min(edits, size)):
                w[rng.randrange(len(w))] = word()
            rows.append(" ".join(w))
        rows.append(" ".join(base[:-1]))
        rows.append(" ".join([*base, word()]))
    chain = [word() for _ in range(80)]
    for _ in range(25):
        chain = list(chain)
        chain[rng.randrange(80)] = word()
        rows.append("\n".join(chain).upper())
    passage = [word() for _ in range(40)]
    rows += [" ".join(passage + [word() for _ in range(rng.choice([3, 12, 40]))]) for _ in range(40)]
    rows += ["same text of six words here"] * 30 + ["", "  \n", "one"]
    rng.shuffle(rows)
    return [(i * 3, t) for i, t in enumerate(rows)]


def test_components(docs):
    rows = corpus()
    got = ngram_join.join(docs([*rows, (2000, None)])).collect()
    want = brute_components([*rows, (2000, None)])
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(want)


def test_slices_share_a_class(docs, monkeypatch):
    monkeypatch.setattr(ngram_join, "SLICE", 500)
    monkeypatch.setattr(ngram_join, "EMIT", 100)
    rows = corpus(8)
    got = ngram_join.join(docs(rows).repartition(5)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(brute_components(rows))


def test_one_of_each(docs):
    rows = corpus()
    odd = [(0, "an id that comes twice with another text"), (900, "twin row of two"), (900, "twin row of two")]
    odd += [(None, "a text without an id here"), (None, "a text without an id here"), (901, None), (902, None)]
    df = docs(rows + odd)
    kept = ngram_join.one_of_each(df)
    assert kept.columns == df.columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    firsts = {(i, t) for (i, t), (_, n, c) in zip(rows, brute_components(rows), strict=True) if i == c or not n}
    assert set(got) == firsts | set(odd)
    assert got.count((900, "twin row of two")) == 1 and got.count((None, "a text without an id here")) == 1


def test_join_of_nothing(docs):
    assert ngram_join.join(docs([])).count() == 0
    assert ngram_join.one_of_each(docs([])).count() == 0
    assert ngram_join.one_of_each(docs([(1, None), (2, "")])).count() == 2


def test_signatures_lose_no_pair():
    """Partners share a signature, and neither has more unshared segments than it may."""
    rng = np.random.default_rng(0)
    new = lambda n: rng.integers(0, 1 << 63, n, dtype=np.uint64)
    seen = 0
    for n in [*range(1, 45), 120, 400]:
        a = np.unique(new(n))
        for lost in range(n // 3 + 1):
            for added in range(n // 3 + 1):
                b = np.unique(np.concatenate([rng.permutation(a)[lost:], new(added)]))
                common = len(np.intersect1d(a, b))
                if not len(b) or lost + added == 0 or 4 * common < 3 * (len(a) + len(b) - common):
                    continue
                seen += 1
                k = sh.band(min(len(a), len(b)))
                for x, y in ((a, b), (b, a)):
                    most = dict(sh.windows_of(len(x)))[k]
                    shared = len(np.intersect1d(sh.signatures(x, k), sh.signatures(y, k)))
                    assert len(a) + len(b) - 2 * common <= most and shared
                    assert sh.by_deletion(k) or len(sh.signatures(x, k)) - shared <= most
    assert seen > 1000


def test_sets_of_odd_texts():
    texts = ["", None, "a", "A b", "a b c\td", "a b c d e", "é É x y z", " a  b c d e f a b c d e f ", "x" * 5000]
    got = []
    for _, data, edges in sh.batches_of(pa.array(texts, pa.string()), limit=20):
        got += sh.shingle_sets(data, edges)
    assert [len(s) for s in got] == [len(brute_set(t)) for t in texts]


def brute_contamination(docs, items, window=13):
    word = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    wins = {}
    for i, t in items:
        w = word(t)
        size = min(window, len(w))
        for k in range(len(w) - size + 1 if w else 0):
            wins.setdefault(tuple(w[k : k + size]), set()).add(str(i))
    out = []
    for i, t in docs:
        w, hit, found = word(t), set(), set()
        for size in {len(x) for x in wins}:
            for k in range(len(w) - size + 1):
                if tuple(w[k : k + size]) in wins:
                    hit |= set(range(k, k + size))
                    found |= wins[tuple(w[k : k + size])]
        ids = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(found), ids, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def test_contamination(spark, docs):
    rng = random.Random(6)
    text = lambda n: " ".join(rng.choice(["aa", "b", "cc1", "É", "dd"]) for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate((1, 2, 3, 5, 12, 13, 14, 30, 40))]
    items += [(50, items[7][1]), (51, None), (52, "?!"), (7, items[7][1])]
    held = lambda: (rng.choice(items)[1] or "").upper()
    rows = [(100 + k, f"{text(rng.randint(0, 60))}, {held()}" if k % 3 else text(200)) for k in range(60)]
    rows += [(1, None), (2, ""), (100, "again b"), (100, "again b"), (100, items[8][1])]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.report(decontaminate.contamination(docs(rows), table)).collect()
    assert sorted(map(tuple, got)) == sorted(brute_contamination(rows, items))
    for some, none in ((rows, []), ([], items)):
        made = decontaminate.contamination(docs(some), spark.createDataFrame(none, "item_id long, text string"))
        assert made.count() == len(some) and made.where("contaminated").count() == 0

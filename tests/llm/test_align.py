"""Cross-tokenizer alignment against brute force over whole texts."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from chatloom.llm import align
from chatloom.llm.queries import vocabulary

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def paths():
    return vocabulary(A), vocabulary(B)


def texts():
    rng = random.Random(4)
    signs = "ab  \n\t.,'1é日本ſ\x00\x1c\xa0　'😀<s>"
    odd = ["".join(rng.choice(signs) for _ in range(rng.randint(1, 60))) for _ in range(60)]
    word = lambda: "".join(rng.choice("aeiounrstlkdmé") for _ in range(rng.randint(1, 12)))
    prose = [rng.choice([" ", "  ", "\n", ". "]).join(word() for _ in range(rng.randint(1, 80))) for _ in range(20)]
    fixed = [None, "", " ", "  ", "a", " a", "a ", "<s> hi</s><|endoftext|>", "a▁b", "x▁ y", "\n \n", "é é", "same text", "same text"]
    return fixed + odd + prose


def brute(path_a, path_b, rows):
    """(doc_id, sums, groups text) by encoding whole texts and walking over the bytes."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(path_a), SentencePieceProcessor(model_file=path_b)
    a.encode_special_tokens = True
    back = {s: k for k, s in align.SIGNS.items()}

    def bytes_a(i):
        return bytes(back[c] for c in a.id_to_token(i))

    def bytes_b(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    found, df = [], Counter()
    for i, t in rows:
        groups = []
        if t:
            ia, ib = a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)
            ta, tb = [bytes_a(x) for x in ia], [bytes_b(x) for x in ib]
            if b"".join(ta) == b"".join(tb) == (" " + t).encode():
                ends = [set(np.cumsum([len(x) for x in side]).tolist()) for side in (ta, tb)]
                at = [0, 0]
                for cut in sorted(ends[0] & ends[1]):
                    own = []
                    for side, ids, pieces in ((0, ia, ta), (1, ib, tb)):
                        k, done = at[side], sum(len(x) for x in pieces[: at[side]])
                        while done < cut:
                            done += len(pieces[at[side]])
                            at[side] += 1
                        own.append(ids[k : at[side]])
                    groups.append(own)
        links = [(x, y) for ga, gb in groups for x in ga for y in gb]
        df.update(set(links))
        found.append((i, groups, links))
    best = {}
    for (x, _), n in df.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for i, groups, links in found:
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        out.append(
            (
                i,
                sum(len(x) for x, _ in groups),
                sum(len(y) for _, y in groups),
                len(groups),
                len(links),
                sum(df[p] == best[p[0]] for p in links),
                sum(df[p] for p in links),
                hashlib.sha256(text.encode()).hexdigest() if groups else "",
            )
        )
    return sorted(out, key=str)


@pytest.mark.parametrize("table", [align.TABLE, 700])
def test_equals_brute_force(spark, docs, paths, table):
    """With all counts in one block, and with blocks of 700 pairs."""
    rows = [*enumerate(texts()), (None, "a null id"), (None, None), (3, "other text"), (3, "other text")]
    got = align.alignment(docs(rows), *paths, table=table)
    assert got.columns == align.OUT
    assert sorted(map(tuple, got.collect()), key=str) == brute(*paths, rows)


def test_groups_give_the_text_back(spark, docs, paths):
    rows = list(enumerate(texts()))
    own = align.aligner(*paths)
    kept = 0
    for r in align.groups(docs(rows), *paths).collect():
        whole = (" " + (rows[r.doc_id][1] or "")).encode()
        at = 0
        for g in r.groups:
            part = whole[g.start : g.end]
            assert g.start == at and b"".join(own.bytes_a[i] for i in g.a) == part
            assert b"".join(own.bytes_b[i] for i in g.b) == part
            at = g.end
        kept += at == len(whole)
    assert kept > 80


def test_full_cache_and_counts_handed_on(spark, docs, paths, monkeypatch):
    own = align.Aligner(*paths)
    once = [align.Aligner(*paths).totals([t], (np.empty(0, np.int64),) * 2 + (np.empty(0, bool),)) for t in texts()]
    monkeypatch.setattr(align, "CACHE", 20)
    for t, want in zip(texts(), once, strict=True):
        got = own.totals([t], (np.empty(0, np.int64),) * 2 + (np.empty(0, bool),))
        assert all(list(got[k]) == list(want[k]) for k in want)


def test_long_text(paths):
    """A text of 300,000 words, and a passage of 200,000 letters, are linear."""
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    own = align.Aligner(*paths)
    none = (np.empty(0, np.int64),) * 2 + (np.empty(0, bool),)
    got = own.totals([" ".join(words * 1000), "".join(rng.choice("abcdefgh") for _ in range(200_000))], none)
    assert got["n_a"][0] == 1000 * own.totals([" ".join(words)], none)["n_a"][0]
    assert got["n_links"].min() > 0


def test_empty_table(spark, docs, paths):
    assert align.alignment(docs([]), *paths).collect() == []
    assert [r.groups for r in align.groups(docs([(1, None)]), *paths).collect()] == [[]]


def test_texts_are_aligned_once(spark, docs, paths):
    """Counts and scores come from the written table of aligned texts: neither reads texts again."""
    found = align.aligned(docs([(1, "some words, and some words"), (2, None)]), *paths)
    assert "text" not in found.columns
    rows = {r.doc_id: r for r in found.collect()}
    links = np.frombuffer(rows[1].links, "<i8")
    assert len(links) * 8 == len(rows[1].pairs) and links.sum() == rows[1].n_links and rows[2].pairs == b""
    base = align.aligner(*paths).base
    counts = {r.a * base + r.b: r["count"] for r in align.pair_counts(found, base).collect()}
    assert counts == dict.fromkeys(np.frombuffer(rows[1].pairs, "<i8").tolist(), 1)


@pytest.mark.parametrize("expand", [1, 3, 10, 1000])
def test_parts_of_a_batch(monkeypatch, expand):
    rng = np.random.default_rng(5)
    sizes = np.array([0, 4, 0, 0, 1, 20, 2, 0, 3, 0])
    values = rng.integers(0, 1 << 40, sizes.sum())
    blobs = align._blobs(sizes, values)
    assert [len(x) for x in blobs.to_pylist()] == (8 * sizes).tolist()
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(sizes))), blobs], names=["doc_id", "pairs"])
    monkeypatch.setattr(align, "EXPAND", expand)
    parts = [(p.column("doc_id").to_pylist(), held.tolist(), align._numbers(p.column("pairs")).tolist()) for p, held in align._held([batch.slice(1), batch.slice(0, 0)])]
    assert sum((ids for ids, _, _ in parts), []) == list(range(1, len(sizes)))
    assert sum((held for _, held, _ in parts), []) == sizes[1:].tolist()
    assert sum((n for _, _, n in parts), []) == values.tolist()
    assert all(sum(held) == len(n) for _, held, n in parts)
    assert all(sum(held) <= expand or len(held) == 1 for _, held, _ in parts)

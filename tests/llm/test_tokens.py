"""Token ids, shards and packing: exact round trips, and bounds."""

import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from chatloom.llm import html_text, packing, toxicity, wavelet
from chatloom.llm import shingles as sh
from chatloom.llm.tokens import RUN_ROWS, Encoder, runs, slices
from chatloom.session import fresh_path

WORDS, BYTES = (public_tokenizers.path(f) for f in ("word_bpe_49k.json", "byte_bpe_50k.json"))
ODD = [
    "",
    " ",
    "\n",
    "a ",
    "a  b",
    " a",
    "a \nb",
    "a\n b",
    "foo.\nBar baz\n",
    "don't <|endoftext|>x <|startoftext|> y",
    "é É é  x y \x1cz 　你好​",
    "THE End... || 12 345",
]


def odd_texts(n=1500, seed=1):
    rng = random.Random(seed)
    parts = [
        "a", "B", " ", "  ", "\n", "'s", "'", "<|endoftext|>", "9", "é", "é", "\x1c", " ", " ", ".", ",",
        "|", "Σ", "\t", "\x85", "你", "​", "it", "THE", "İ",
    ]
    return ODD + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(n)]


@pytest.mark.parametrize(("path", "kind"), [(WORDS, "words"), (BYTES, "bytes")])
def test_encoder_is_the_tokenizer(path, kind):
    texts, enc = odd_texts(), Encoder(path, kind)
    want = [e.ids for e in Tokenizer.from_file(path).encode_batch_fast(texts, add_special_tokens=False)]
    for _ in range(2):  # the second time from the cache
        at = 0
        for a, b in slices(texts, 400):
            ids, counts = enc.encode(texts[a:b])
            edges = np.concatenate([[0], np.cumsum(counts)])
            for i in range(b - a):
                assert ids[edges[i] : edges[i + 1]].tolist() == want[a + i], texts[a + i]
            at = b
        assert at == len(texts)


FOREIGN = [
    "a", "B", "foo", "À", "ß", "Þ", "×", "÷", " ", " ", "  ", "\n", "\t", "\r\n", "\x0b", "\x1c", "\x85", "\xa0", "\u1680",
    "\u2003", "\u2028", "\u202f", "\u205f", "\u3000", "\u200b", "'s", "'", "’", "…", "«", "²", "½", "42", "٣", ".", ",", "|", "_",
    "<|endoftext|>", "<|", "<", "<|ENDOFTEXT|>", "你好", "Σ", "İ", "\u212a", "\u0301", "e\u0301", "да", "😀", "\x00", "\x7f", "한",
]


@pytest.mark.parametrize(("path", "kind"), [(WORDS, "words"), (BYTES, "bytes")])
def test_encoder_on_any_script(path, kind):
    rng = random.Random(7)
    enc, tokenizer = Encoder(path, kind), Tokenizer.from_file(path)
    for k in range(40):
        signs = FOREIGN if k % 2 else [*rng.sample(FOREIGN, 8), " ", "\n", "a"]
        texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 14))) for _ in range(rng.choice([1, 300]))]
        want = [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        ids, counts = enc.encode_column(pa.array(["before", *texts, "after"]).slice(1, len(texts)))
        edges = np.concatenate([[0], np.cumsum(counts)])
        assert [ids[a:b].tolist() for a, b in zip(edges, edges[1:])] == want, texts


@pytest.mark.parametrize(("path", "kind"), [(WORDS, "words"), (BYTES, "bytes")])
def test_words_are_asked_once_whatever_marks_follow(path, kind):
    """What is asked of the tokenizer and kept grows with words and marks, not with their combinations."""
    words = [a + b for a in ("ba", "lo", "mi", "né") for b in ("ra", "ß", "tu", "ko")]
    marks = ["", ",", ".", "!!", " |", ".\nAnd", ";\n" + words[0]]
    text = " ".join(w + m for w in words for m in marks)
    enc = Encoder(path, kind)
    enc.encode([text, text])
    assert len(enc.cache) <= len(words) + 12


def test_runs_of_texts():
    texts = ["x" * 10, None, "", "é" * 5, "y" * 100, "z", None, "end"]
    table = pa.table({"doc_id": list(range(8)), "text": texts})
    for size in (1, 10, 25, 1000):
        got = list(runs(table.to_batches(max_chunksize=3), size))
        rows = [r for b in got for r in b.to_pylist()]
        assert [r["doc_id"] for r in rows] == list(range(8))
        assert [r["text"] for r in rows] == [t or "" for t in texts]
        for b in got:  # no more than its last text goes beyond the size
            assert sum(len(t.encode()) for t in b.column("text").to_pylist()[:-1]) < size
    assert len(list(runs(table.to_batches(max_chunksize=3), 1000))) == 1
    assert len(list(runs(iter([pa.record_batch({"text": [""] * (RUN_ROWS + 5)})] * 3)))) > 1


def test_wavelet_matrix_answers():
    rng = np.random.default_rng(2)
    for n, top in ((1, 1), (7, 3), (1000, 50), (5000, 49407), (1300, 2)):
        ids = rng.integers(0, top + 1, n).astype(np.uint16)
        shard = wavelet.WaveletMatrix(wavelet.build(ids, np.array([4]), np.array([n]), (3, 1)))
        assert (shard.decode() == ids).all() and shard.header["part"] == 3
        for i in rng.integers(0, n, 20):
            assert shard.access(int(i)) == ids[i]
        for token in {int(ids[0]), int(ids[-1]), 60000}:
            at = np.flatnonzero(ids == token)
            a, b = sorted(rng.integers(0, n + 1, 2).tolist())
            assert shard.count(token) == len(at)
            assert shard.count(token, a, b) == int((ids[a:b] == token).sum())
            for k in {0, len(at) // 2, len(at) - 1}:
                assert shard.find(token, k) == (int(at[k]) if 0 <= k < len(at) else None)
            assert shard.find(token, len(at)) is None


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_shards_of_a_corpus(spark, docs, monkeypatch):
    monkeypatch.setattr(wavelet, "SHARD_TOKENS", 40)
    monkeypatch.setattr(wavelet, "PARTITION_ROWS", 15)
    rows = [(i * 7 % 101, t) for i, t in enumerate(odd_texts(80))] + [(None, "null id"), (5000, None), (3, "again")]
    rows += [(3, "again"), (9999, "word " * 3000)]
    got = wavelet.encode_corpus(docs(rows), WORDS).collect()
    assert len(got) == len(rows)
    tokenizer = Tokenizer.from_file(WORDS)
    ids = lambda t: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
    want = sorted((-1 if i is None else i, len(ids(t)), crc(ids(t))) for i, t in rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [-1 if r.doc_id is None else r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order)
    folder = fresh_path(spark, "wavelet")
    made = wavelet.write_shards(docs(rows), WORDS, folder)
    assert made.count() > 3
    word = ids("word")[0]
    found = wavelet.find_token(spark, folder, word).collect()
    assert sum(r.occurrences for r in found) == sum(ids(t).count(word) for _, t in rows)
    assert wavelet.encode_corpus(docs([]), WORDS).count() == 0


def brute_bins(sizes, capacity):
    """The least number of bins, by trying."""
    best = len(sizes)
    sizes = sorted(sizes, reverse=True)

    def place(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(sizes):
            best = len(bins)
            return
        for i in range(len(bins)):
            if bins[i] + sizes[k] <= capacity:
                place(k + 1, [*bins[:i], bins[i] + sizes[k], *bins[i + 1 :]])
        place(k + 1, [*bins, sizes[k]])

    place(0, [])
    return best


def test_bounds_and_best_fit():
    rng = np.random.default_rng(5)
    met = 0
    for _ in range(150):
        sizes = rng.integers(1, 21, rng.integers(1, 9))
        optimum = brute_bins(sizes.tolist(), 20)
        bound = packing.lower_bound(np.bincount(sizes, minlength=21), 20)
        where, offset, left = packing.best_fit(np.sort(sizes)[::-1], 20)
        assert bound <= optimum <= len(left)
        met += bound == optimum
        used = np.bincount(where, weights=np.sort(sizes)[::-1])
        assert (used + left == 20).all() and (used <= 20).all()
    assert met > 120
    # too large for each other: more than their sum over the capacity
    assert packing.lower_bound(np.bincount([11] * 6, minlength=21), 20) == 6


def test_cut():
    assert packing.cut(1) == [(0, 1)]
    assert packing.cut(2048) == [(0, 2048)]
    assert packing.cut(2049) == [(0, 1), (1, 2048)]
    assert packing.cut(5000) == [(0, 904), (904, 2048), (2952, 2048)]


def test_packing_a_corpus(docs):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["alpha", "beta", "x", "1"]) for _ in range(rng.randint(0, 900))) for _ in range(120)]
    rows = [*enumerate(texts), (500, None), (501, ""), (502, "long " * 9000), (3, texts[3]), (None, "no id")]
    got = packing.pack(packing.pieces(docs(rows), BYTES), pool=16).collect()
    tokenizer = Tokenizer.from_file(BYTES)
    want = []
    for i, t in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        want += [(i or -1, k, a, n, crc(ids[a : a + n])) for k, (a, n) in enumerate(packing.cut(len(ids)))]
    assert sorted((r.doc_id or -1, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    hist = np.bincount([r.length for r in got], minlength=packing.CAPACITY + 1)
    assert len(sequences) <= packing.lower_bound(hist) + 1
    assert packing.best_fit_packing(docs([]), BYTES).count() == 0


def test_large_ids_beside_a_null(spark, docs):
    """Ids beyond 2^53 and the least and the largest long come back as they are, and null as null."""
    ids = [None, -(1 << 63), (1 << 53) + 1, (1 << 53) + 3, (1 << 63) - 1]
    rows = [(i, f"some text {k}") for k, i in enumerate(ids)]
    table = docs(rows).coalesce(1)
    key = lambda i: (i is not None, i or 0)
    got = wavelet.encode_corpus(table, WORDS).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted(ids, key=key)
    for made in (
        packing.best_fit_packing(table, BYTES),
        toxicity.score(table, {}, None),
        html_text.main_text(table.select(F.col("doc_id").alias("page_id"), F.lit("u").alias("url"), F.col("text").alias("html"))).withColumnRenamed("page_id", "doc_id"),
    ):
        assert sorted((r.doc_id for r in made.collect()), key=key) == sorted(ids, key=key)


def test_arrays_of_a_run_are_small():
    """A worker's arrays follow the run, not the batch: one of 8 MB of text."""
    rng = random.Random(3)
    made = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(5000)]
    texts = pa.array([" ".join(rng.choices(made, k=300)) for _ in range(4000)])
    enc = Encoder(BYTES, "bytes")
    enc.encode([" ".join(made)])
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), texts], names=["doc_id", "text"])

    def cut():
        return sum(len(packing._cut_all(enc, r, packing.CAPACITY)) for r in runs([batch]))

    def sets():
        return sum(len(sh.shingle_sets(data, edges)) for _, data, edges in sh.batches_of(texts))

    for work in (cut, sets):  # 43 and 81 MB in runs of 4 and 2 MB
        work()
        tracemalloc.start()
        assert work() == len(texts)
        assert tracemalloc.get_traced_memory()[1] < 20_000_000
        tracemalloc.stop()

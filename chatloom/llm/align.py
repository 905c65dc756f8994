"""Cross-tokenizer alignment by interval coalescing.

Two tokenizers cut the same bytes, a space and the text. The tokens of both are laid over
the bytes as intervals and sorted by their start (``lexsort``); the running maximum of the
ends (``maximum.accumulate``) tells where all that began has ended: a token that starts
there opens a new group. So a group is the shortest run of bytes at whose two ends both
tokenizers cut. Each token of A in a group is linked with each token of B in it.

Both tokenizers always cut before a space that follows another sign than white space (A by
its pattern, B since no piece of it has a space after another sign, which is checked). The
passages between such cuts are aligned once each and kept in a bounded cache, many new ones
in one coalescing; a text is a row of passages.

Texts are aligned once: a written table holds each one's sums, groups and distinct id pairs.
An id pair's count is the number of documents that hold it linked. Tasks count the pairs of
that table before the shuffle. The counts come back to its rows as sorted arrays, broadcast in
blocks of at most ``TABLE`` pairs; if there are several blocks, the table is read once for
each and partial sums are added by (id, digest of the text).

Defined results: texts that are null or empty, or whose bytes a tokenizer doesn't give
back, have no tokens, no groups and no links; special tokens' strings inside a text are
plain text; repeated rows are documents of their own, with equal results; an empty table
gives no rows; other columns stay out of the way.
"""

import hashlib
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import written
from chatloom.llm.tokens import ASCII_SPACES, BEFORE_SPACE, CUT, SIGNS, slices
from chatloom.session import materialize

CACHE = 400_000  # passages a Python worker keeps, some 300 bytes each
HELD = 2_000_000  # pairs that a task counts before it hands them on
TABLE = 4_000_000  # pairs of a broadcast block, 17 bytes each
RUN = 2_000  # passages that are encoded at once
EXPAND = 1 << 21  # links laid out at once
SPACE = "▁"  # B's sign for a space
BYTE = re.compile(r"<0x([0-9A-F]{2})>")

SUMS = ("n_a", "n_b", "n_groups", "n_links")
SCORES = ("n_best", "count_sum")


class _Grown:
    """An array that grows."""

    def __init__(self, dtype):
        self.n, self.room = 0, np.empty(1 << 14, dtype)

    def add(self, values):
        end = self.n + len(values)
        if end > len(self.room):
            bigger = np.empty(max(end, 2 * len(self.room)), self.room.dtype)
            bigger[: self.n] = self.room[: self.n]
            self.room = bigger
        self.room[self.n : end] = values
        self.n = end

    def __call__(self) -> np.ndarray:
        return self.room[: self.n]


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of all elements of the rows that begin at ``starts``."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def coalesce(start_a, end_a, start_b, end_b) -> tuple[np.ndarray, np.ndarray]:
    """The group of each interval of A and of B, numbered from 0 in order of bytes."""
    start, end = np.concatenate([start_a, start_b]), np.concatenate([end_a, end_b])
    order = np.lexsort((end, start))
    reach = np.maximum.accumulate(end[order])
    opens = np.ones(len(order), bool)
    opens[1:] = start[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(opens) - 1
    return group[: len(start_a)], group[len(start_a) :]


def distinct(group: np.ndarray, ids: np.ndarray, base: int):
    """(group, id, times) of the distinct ids of each group, sorted by group."""
    both, times = counted(group * base + ids)
    return both // base, both % base, times


class _Codes(dict):
    """Numbers new passages in order and remembers them."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, key):
        self[key] = n = len(self)
        self.new.append(key)
        return n

    def taken(self) -> list[str]:
        new, self.new = self.new, []
        return new


class Aligner:
    """Passages of both tokenizers, aligned."""

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        back = {sign: byte for byte, sign in SIGNS.items()}
        names = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        self.bytes_a = [bytes(back.get(c, 0) for c in t) for t in names]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(m[1], 16)]) if (m := BYTE.fullmatch(p)) else p.replace(SPACE, " ").encode() for p in pieces
        ]
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces):
            raise ValueError(f"{path_b}: a piece goes on over the beginning of a word")
        self.size_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.size_b = np.array([len(x) for x in self.bytes_b], np.int64)
        self.base = len(self.bytes_b)  # a pair is a * base + b
        self.blank = self.b.piece_to_id(SPACE)
        self.names = [f"{i}{m}".encode() for i in range(max(len(names), self.base)) for m in ",|;"]
        self.reset()

    def reset(self):
        self.codes = _Codes()
        self.known = 0
        self.ok = _Grown(bool)
        self.sums = {k: _Grown(np.int64) for k in SUMS}
        self.token, self.mark, self.places = _Grown(np.int32), _Grown(np.int8), _Grown(np.int64)
        self.text: list[bytes] = []
        self.key, self.times = _Grown(np.int64), _Grown(np.int64)  # distinct pairs, passage by passage
        self.first, self.count = _Grown(np.int64), _Grown(np.int64)

    @staticmethod
    def passages(text: str) -> list[str]:
        """The passages of a space and ``text``, each without the space it begins with."""
        whole = " " + text
        if any(a in whole for a in ASCII_SPACES) or (not text.isascii() and BEFORE_SPACE.search(whole)):
            return [p[1:] for p in CUT.split(whole)]
        return text.split(" ")

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Passage codes of all texts in a row, and where each text begins and ends among them. A
        text without tokens has none."""
        if self.known > CACHE:
            self.reset()
        chunks: list[str] = []
        sizes = np.empty(len(texts), np.int64)
        for i, text in enumerate(texts):
            parts = self.passages(text) if text else []
            sizes[i] = len(parts)
            chunks += parts
        flat = np.fromiter(map(self.codes.__getitem__, chunks), np.int64, len(chunks))
        new = self.codes.taken()
        for a, b in slices(new):
            self._learn(new[a:b])
        bad = np.concatenate([[0], np.cumsum(~self.ok()[flat])])
        ends = np.cumsum(sizes)
        fine = bad[ends] == bad[ends - sizes]
        if not fine.all():
            flat, sizes = flat[np.repeat(fine, sizes)], np.where(fine, sizes, 0)
        return flat, np.concatenate([[0], np.cumsum(sizes)])

    def _ids(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of A and of B in a row, passage by passage.

        Passages that begin and end with another sign than white space are encoded in runs,
        since both tokenizers cut between them.
        """
        rows: list[str] = []
        joined: list[str] = []
        for c in chunks:
            if c and not c[0].isspace() and not c[-1].isspace() and len(joined) < RUN:
                joined.append(c)
                continue
            if joined:
                rows.append(" ".join(joined))
                joined = []
            if c and not c[0].isspace() and not c[-1].isspace():
                joined.append(c)
            else:
                rows.append(c)
        if joined:
            rows.append(" ".join(joined))
        of_a = self.a.encode_batch_fast([" " + c for c in rows], add_special_tokens=False)
        of_b = self.b.encode(rows, num_threads=1)
        ids_b = [x if c else [self.blank] for c, x in zip(rows, of_b, strict=True)]
        return _joined([e.ids for e in of_a]), _joined(ids_b)

    def _learn(self, chunks: list[str]):
        a, b = self._ids(chunks)
        want = [(" " + c).encode() for c in chunks]
        edge = np.concatenate([[0], np.cumsum([len(w) for w in want])])
        n, ok = len(chunks), np.ones(len(chunks), bool)
        whole = b"".join(want)
        if any(b"".join(map(x.__getitem__, i.tolist())) != whole for x, i in ((self.bytes_a, a), (self.bytes_b, b))):
            # some passage isn't given back: learn each on its own, and those without it together
            if n > 1:
                for half in (chunks[: n // 2], chunks[n // 2 :]):
                    self._learn(half)
                return
            ok[:] = False
            a = b = np.empty(0, np.int64)
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        group_a, group_b = coalesce(end_a - self.size_a[a], end_a, end_b - self.size_b[b], end_b)
        chunk_a = np.searchsorted(edge, end_a) - 1  # no token goes over a passage's edge
        chunk_b = np.searchsorted(edge, end_b) - 1
        groups = int(group_a[-1]) + 1 if len(group_a) else 0
        chunk = np.zeros(groups, np.int64)
        chunk[group_a] = chunk_a
        in_a, in_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
        self.ok.add(ok)
        for name, values, at in (("n_a", None, chunk_a), ("n_b", None, chunk_b), ("n_groups", None, chunk), ("n_links", in_a * in_b, chunk)):
            self.sums[name].add(np.bincount(at, values, minlength=n).astype(np.int64))
        owner, key, times = self._pairs(group_a, a, group_b, b, chunk)
        counts = np.bincount(owner, minlength=n)
        self.first.add(self.key.n + np.cumsum(counts) - counts)
        self.count.add(counts)
        self.key.add(key)
        self.times.add(times)
        # the tokens of a group, A's before B's, with what stands behind each
        side = np.repeat([0, 1], [len(a), len(b)])
        group = np.concatenate([group_a, group_b])
        order = np.argsort(2 * group + side, kind="stable")
        last = np.ones(len(order), bool)
        last[:-1] = (2 * group + side)[order][1:] != (2 * group + side)[order][:-1]
        self.token.add(np.concatenate([a, b])[order])
        self.mark.add(np.where(last, side[order] + 1, 0))
        sizes = np.bincount(chunk_a, minlength=n) + np.bincount(chunk_b, minlength=n)
        self.places.add(self.token.n - sizes.sum() + np.cumsum(sizes))
        self.known += n

    def group_texts(self) -> list[bytes]:
        """The groups of each passage as ``a1,a2|b1;a3|b2,b3;``."""
        done = len(self.text)
        if done < self.known:
            begin = int(self.places()[done - 1]) if done else 0
            token, mark = self.token()[begin:], self.mark()[begin:]
            parts = list(map(self.names.__getitem__, (3 * token + mark).tolist()))
            i = 0
            for j in (self.places()[done:] - begin).tolist():
                self.text.append(b"".join(parts[i:j]))
                i = j
        return self.text

    def _pairs(self, group_a, a, group_b, b, chunk):
        """(passage, pair, links) of the distinct pairs of each passage, sorted."""
        ga, a, ta = distinct(group_a, a, len(self.bytes_a))
        gb, b, tb = distinct(group_b, b, self.base)
        with_b = np.bincount(gb, minlength=len(chunk))
        first_b = np.cumsum(with_b) - with_b
        reach = with_b[ga]  # of each id of A, the ids of B in its group
        total = np.concatenate([[0], np.cumsum(reach)])
        span, parts, i = len(self.bytes_a) * self.base, [], 0
        while i < len(ga):
            j = max(i + 1, int(np.searchsorted(total, total[i] + EXPAND, "right")) - 1)
            at = ragged(first_b[ga[i:j]], reach[i:j])
            own = np.repeat(np.arange(i, j), reach[i:j])
            parts.append(_summed(chunk[ga[own]] * span + a[own] * self.base + b[at], ta[own] * tb[at]))
            i = j
        if not parts:
            return (np.empty(0, np.int64),) * 3
        both, times = _summed(*map(np.concatenate, zip(*parts, strict=True)))
        return both // span, both % span, times

    def aligned(self, texts: list[str | None]):
        """The sums and groups of each text; and how many distinct pairs it holds linked, these text after
        text, sorted in each, and the links of each."""
        flat, edge = self.encode(texts)
        out = {}
        for name, values in self.sums.items():
            run = np.concatenate([[0], np.cumsum(values()[flat])])
            out[name] = run[edge[1:]] - run[edge[:-1]]
        codes = flat.tolist()
        text = self.group_texts().__getitem__
        joined = (b"".join(map(text, codes[i:j])) for i, j in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True))
        out["groups_sha256"] = [hashlib.sha256(x[:-1]).hexdigest() if x else "" for x in joined]
        doc = np.repeat(np.arange(len(texts)), np.diff(edge))
        once, often = counted(doc * (self.known + 1) + flat)
        doc, code = once // (self.known + 1), once % (self.known + 1)
        size = self.count()[code]
        at = ragged(self.first()[code], size)
        span = len(self.bytes_a) * self.base
        key, links = _summed(np.repeat(doc, size) * span + self.key()[at], self.times()[at] * np.repeat(often, size))
        return out, np.bincount(key // span, minlength=len(texts)), key % span, links

    def totals(self, texts: list[str | None], table) -> dict[str, np.ndarray]:
        """Sums of each text, and those of the counts in ``table`` (sorted pairs, counts, whether
        highest)."""
        out, *pairs = self.aligned(texts)
        return out | dict(zip(SCORES, scores(*pairs, table), strict=True))


def scores(held: np.ndarray, key: np.ndarray, links: np.ndarray, table) -> tuple[np.ndarray, np.ndarray]:
    """``SCORES`` of texts that hold so many distinct pairs each, by the counts in ``table``."""
    keys, counts, best = table
    if not len(keys):
        return (np.zeros(len(held), np.int64),) * 2
    at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
    links = np.where(keys[at] == key, links, 0)
    edge = np.concatenate([[0], np.cumsum(held)])
    runs = (np.concatenate([[0], np.cumsum(x)]) for x in (links * best[at], links * counts[at]))
    return tuple(run[edge[1:]] - run[edge[:-1]] for run in runs)


def counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values, and how often each is there."""
    values = np.sort(values)
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.empty(0, np.int64)
    return values[first], np.diff(first, append=len(values))


def _joined(rows: list[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(rows), np.int64, sum(map(len, rows)))


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys, and the sum of each one's values."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(values[order], first)


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """The aligner of this Python worker."""
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


def _texts_of(batch):
    texts = batch.column("text").to_pylist()
    for a, b in slices([t or "" for t in texts]):
        yield a, b, texts[a:b]


def _blobs(sizes: np.ndarray, values: np.ndarray) -> pa.Array:
    """Rows of ``sizes`` numbers each as bytes: a table's arrays would go through Spark number by number."""
    edges = 8 * np.concatenate([[0], np.cumsum(sizes)])
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(sizes), [None, pa.py_buffer(edges), pa.py_buffer(values.astype("<i8"))]
    ).cast(pa.binary())


def _numbers(column: pa.Array) -> np.ndarray:
    """The numbers of all rows of ``_blobs``."""
    column = column.cast(pa.large_binary())
    _, edges, data = column.buffers()
    edges = np.frombuffer(edges, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, "<i8", (edges[-1] - edges[0]) // 8, edges[0]) if data is not None else np.empty(0, "<i8")


def _held(batches):
    """Parts of batches of ``ALIGNED`` of about ``EXPAND`` pairs, with how many pairs each row has."""
    for batch in batches:
        held = pc.binary_length(batch.column("pairs")).to_numpy(zero_copy_only=False).astype(np.int64) // 8
        ends, i = np.cumsum(held), 0
        while i < len(batch):
            done = ends[i - 1] if i else 0
            j = max(i + 1, int(np.searchsorted(ends, done + EXPAND, "right")))
            yield batch.slice(i, j - i), held[i:j]
            i = j


ALIGNED = f"doc_id long, h long, {', '.join(f'{k} long' for k in SUMS)}, groups_sha256 string, pairs binary, links binary"


def aligned(df: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``ALIGNED`` of each row of ``df``: ``h`` is a digest of the text, ``pairs`` its distinct id pairs, sorted, and
    ``links`` how often each is linked, as bytes."""

    def run(batches):
        own = aligner(path_a, path_b)
        for batch in batches:
            for a, b, texts in _texts_of(batch):
                got, held, key, links = own.aligned(texts)
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("h"),
                        *(pa.array(got[k]) for k in SUMS),
                        pa.array(got["groups_sha256"], pa.string()),
                        _blobs(held, key),
                        _blobs(held, links),
                    ],
                    names=["doc_id", "h", *SUMS, "groups_sha256", "pairs", "links"],
                )

    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"), "text")
    return rows.mapInArrow(run, ALIGNED)


def pair_counts(found: DataFrame, base: int) -> DataFrame:
    """(``a``, ``b``, ``count``, ``best``) of each id pair in ``ALIGNED``: the documents that hold it, and whether no
    pair of this ``a`` has more. A written table."""

    def hand_on(keys, counts):
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["pair", "count"])

    def run(batches):
        parts, n = [], 0
        for part, _ in _held(batches):
            keys, counts = counted(_numbers(part.column("pairs")))
            parts.append((keys, counts.astype(np.int64)))
            n += len(keys)
            if n > 2 * HELD:
                parts = [_summed(*map(np.concatenate, zip(*parts, strict=True)))]
                n = len(parts[0][0])
                if n > HELD:
                    yield hand_on(*parts[0])
                    parts, n = [], 0
        if parts:
            yield hand_on(*_summed(*map(np.concatenate, zip(*parts, strict=True))))

    counts = found.select("pairs").mapInArrow(run, "pair long, count long").groupBy("pair").agg(F.sum("count").alias("count"))
    ids = F.expr(f"pair div {base}").alias("a"), F.expr(f"pair % {base}").alias("b")
    pairs = materialize(counts.select(*ids, "count"))
    most = F.broadcast(materialize(pairs.groupBy("a").agg(F.max("count").alias("most"))))  # a row for each id of A
    return materialize(pairs.join(most, "a").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best")))


def _arrays(pairs: DataFrame, base: int):
    """A block of counts as sorted arrays, for broadcast."""
    rows = pairs.select((F.col("a") * base + F.col("b")).alias("pair"), "count", "best").toArrow()
    pair, count, best = (rows.column(k).to_numpy() for k in range(3))
    order = np.argsort(pair)
    return pair[order], count[order], best[order].astype(bool)


OUT = ["doc_id", *SUMS, *SCORES, "groups_sha256"]


def _scored(found: DataFrame, table) -> DataFrame:
    """``OUT`` and ``h`` of ``ALIGNED``, by the counts of one broadcast block."""
    kept = ["doc_id", "h", *SUMS, "groups_sha256"]

    def run(batches):
        for part, held in _held(batches):
            sums = scores(held, *(_numbers(part.column(c)) for c in ("pairs", "links")), table.value)
            yield pa.RecordBatch.from_arrays(
                [*map(part.column, kept), *map(pa.array, sums)], names=[*kept, *SCORES]
            )

    kinds = ", ".join(f"{k} {'string' if k == 'groups_sha256' else 'long'}" for k in (*kept, *SCORES))
    return found.mapInArrow(run, kinds)


def alignment(df: DataFrame, path_a: str, path_b: str, table: int = TABLE) -> DataFrame:
    """``OUT`` of each row of ``df`` (``doc_id``, ``text``)."""
    spark = df.sparkSession
    base = aligner(path_a, path_b).base
    found = written(aligned(df, path_a, path_b))
    pairs = pair_counts(found, base)
    blocks = max(1, -(-pairs.count() // table))
    parts = []
    for k in range(blocks):
        own = pairs.where(F.pmod(F.xxhash64("a", "b"), F.lit(blocks)) == k)
        parts.append(_scored(found, spark.sparkContext.broadcast(_arrays(own, base))))
    if blocks == 1:
        return parts[0].select(OUT)
    # every block has every document; a block's sums are equal in repeated rows
    sums = SCORES
    tables = [written(p.withColumn("block", F.lit(k))) for k, p in enumerate(parts)]
    rest = tables[1].select("doc_id", "h", "block", *sums)
    for t in tables[2:]:
        rest = rest.unionByName(t.select("doc_id", "h", "block", *sums))
    each = rest.groupBy("doc_id", "h", "block").agg(*(F.max(c).alias(c) for c in sums))
    more = materialize(
        each.groupBy(F.col("doc_id").alias("_id"), F.col("h").alias("_h")).agg(*(F.sum(c).alias(f"_{c}") for c in sums))
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("h").eqNullSafe(F.col("_h"))
    total = {c: (F.col(c) + F.col(f"_{c}")).alias(c) for c in sums}
    return tables[0].join(more, same, "left").select(*[total.get(c, F.col(c)) for c in OUT])


GROUPS = "array<struct<start:long,end:long,a:array<int>,b:array<int>>>"


def groups(df: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(``doc_id``, ``groups``): the groups of each text, as byte ranges of a space and the text, with the
    ids of both tokenizers in order."""

    def row(own, codes):
        out, at = [], 0
        for c in codes:
            for part in own.group_texts()[c].decode()[:-1].split(";"):
                a, b = ([int(x) for x in side.split(",")] for side in part.split("|"))
                end = at + int(own.size_a[a].sum())
                out.append({"start": at, "end": end, "a": a, "b": b})
                at = end
        return out

    kind = pa.list_(
        pa.struct([("start", pa.int64()), ("end", pa.int64()), ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))])
    )

    def run(batches):
        own = aligner(path_a, path_b)
        for batch in batches:
            for a, b, texts in _texts_of(batch):
                flat, edge = own.encode(texts)
                rows = [row(own, flat[i:j].tolist()) for i, j in zip(edge[:-1], edge[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.slice(a, b - a).column("doc_id"), pa.array(rows, kind)], names=["doc_id", "groups"]
                )

    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, f"doc_id long, groups {GROUPS}")

"""Token ids of whole texts, for tasks.

Texts are cut where the tokenizer always ends a token: a batch of texts is one array of bytes,
and numpy finds where its pieces begin. Letters (ASCII and composed Latin ones), digits, marks
and single white space are the tokenizer's own words; what stands between two spaces and holds
anything else is one piece, and the tokenizer cuts it. Ids of a piece don't depend on its
neighbours: those of each distinct piece are asked of the tokenizer once and kept in a bounded
cache. The results are those of ``Tokenizer.encode`` on the whole text.
"""

import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHE = {"words": 1_000_000, "bytes": 500_000}  # pieces a Python worker keeps, 200 and 130 MB when full
IDS_OF_A_PIECE = 8  # on average, before a cache counts as full: pieces of scripts without spaces are long
RUN, RUN_ROWS = 1 << 20, 1 << 16  # bytes of texts, and texts, that are encoded at once, about: 60 bytes of arrays for each
ASCII_SPACES = [a + " " for a in " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f"]
BEFORE_SPACE = re.compile(r"\s ")
CUT = re.compile(r"(?<=\S)(?= )")

# Classes of bytes: HARD and HIGH (beyond ASCII) are left to the tokenizer, WHITE and above is white space.
LETTER, DIGIT, MARK, HARD, HIGH, WHITE, PYTHON_WHITE, SPACE = range(8)


def _classes(kind: str) -> np.ndarray:
    out = np.full(256, HARD, np.uint8)
    for c in map(chr, range(33, 127)):
        if c != "'":  # contractions
            out[ord(c)] = LETTER if c.isalpha() else DIGIT if c.isdigit() else MARK
    out[128:], out[9:14], out[32] = HIGH, WHITE, SPACE
    if kind == "bytes":
        out[28:32] = PYTHON_WHITE  # to some patterns white space, to others not
    return out


CLASSES = {kind: _classes(kind) for kind in CACHE}
LATIN = 0xC3  # the byte before the second byte of U+00C0 to U+00FF
LATIN_LETTER = np.isin(np.arange(256), [b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7)])
LATIN_UPPER = LATIN_LETTER & (np.arange(256) < 0x9F)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _byte_signs() -> dict[int, str]:
    """How byte-level vocabularies write a byte: itself if it prints, else a sign from 256 on."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(others)}


SIGNS = _byte_signs()
SIGN_POINTS = np.array([ord(SIGNS[b]) for b in range(256)], "<u4")


class _Cache(dict):
    """Numbers new keys in order and remembers them."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


def _ends_white(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character beyond ASCII that ends before each place is white space."""
    a, b, c = (data[np.maximum(at - k, 0)] for k in (1, 2, 3))
    return (
        ((b == 0xC2) & ((a == 0x85) | (a == 0xA0)))
        | ((c == 0xE2) & (b == 0x80) & ((a <= 0x8A) | (a == 0xA8) | (a == 0xA9) | (a == 0xAF)))
        | ((c == 0xE2) & (b == 0x81) & (a == 0x9F))
        | ((c == 0xE1) & (b == 0x9A) & (a == 0x80))
        | ((c == 0xE3) & (b == 0x80) & (a == 0x80))
    )


class Encoder:
    """Ids of texts. ``kind`` is "words" for a vocabulary that drops white space and
    lower-cases, "bytes" for a byte-level one that joins a space to the next word."""

    def __init__(self, path: str, kind: str):
        from tokenizers import Tokenizer

        self.tokenizer, self.kind = Tokenizer.from_file(path), kind
        self.limit = CACHE[kind]
        self._reset()

    def _reset(self):
        self.cache, self.table = _Cache(), _Ragged()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row (uint16), and the number of ids of each text."""
        return self.encode_column(pa.array(texts, pa.large_string()))

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``encode`` of an Arrow array of strings without nulls."""
        if len(self.cache) > self.limit or self.table.n > IDS_OF_A_PIECE * self.limit:
            self._reset()
        texts = texts.cast(pa.large_string())
        _, edges, data = texts.buffers()
        edges = np.frombuffer(edges, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        if not len(texts) or edges[0] == edges[-1]:
            return np.empty(0, np.uint16), np.zeros(len(texts), np.int64)
        data, edges = np.frombuffer(data, np.uint8)[edges[0] : edges[-1]], edges - edges[0]
        data, begins, hard = self._pieces(data, edges[:-1])
        offsets = np.append(begins, len(data)).astype(np.int32)
        coded = pa.BinaryArray.from_buffers(
            pa.binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(data)]
        ).dictionary_encode()
        pieces = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        of_piece = coded.indices.to_numpy()
        known = len(self.cache)
        codes = np.fromiter(map(self.cache.__getitem__, pieces), np.int32, len(pieces))
        new = np.flatnonzero(codes >= known)
        if len(new):
            left = np.zeros(len(pieces), bool)
            left[of_piece[hard]] = True
            self._fill([pieces[i] for i in new.tolist()], left[new])
        codes = codes[of_piece]
        sizes, at = self.table.sizes()[codes], self.table.starts()[codes]
        ends = np.cumsum(sizes, dtype=np.int64)
        places = np.repeat((at - (ends - sizes)).astype(np.int32), sizes)  # of a run of texts, far below 2**31
        places += np.arange(len(places), dtype=np.int32)
        edge = np.concatenate([[0], ends])[np.searchsorted(begins, edges)]
        return self.table.flat()[places], np.diff(edge)

    def _pieces(self, data: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bytes (in lower case if the vocabulary is), where pieces begin, and which the tokenizer has to cut."""
        n, words = len(data), self.kind == "words"
        kind = CLASSES[self.kind][data]
        latin = np.flatnonzero(data[:-1] == LATIN)
        latin = latin[LATIN_LETTER[data[latin + 1]]]
        kind[latin] = kind[latin + 1] = LETTER
        cut = np.zeros(n, bool)
        cut[firsts[firsts < n]] = True
        before = np.empty(n, np.uint8)
        before[1:] = kind[:-1]
        before[cut] = HARD  # no white space before a text
        white = np.flatnonzero(kind == WHITE)
        left_over = (kind == HARD) | (kind == HIGH)
        if words:  # white space always cuts, and goes
            cut |= (kind >= WHITE) | (before == WHITE)
        else:  # a space after anything but white space cuts, other white space if it stands alone
            left_over |= (kind == PYTHON_WHITE) | ((kind >= WHITE) & (before >= WHITE))
            after = np.minimum(white + 1, n - 1)
            ends_text = (white + 1 == n) | cut[after]
            white = white[(before[white] <= HARD) & (ends_text | (kind[after] <= HARD))]
            space = (kind == SPACE) & (before < WHITE)
            foreign = np.flatnonzero(space & (before == HIGH))
            space[foreign] = ~_ends_white(data, foreign)
            cut |= space
            cut[white] = True
            cut[white[white + 1 < n] + 1] = True
        special = np.flatnonzero(data[:-1] == ord("<"))
        left_over[special[data[special + 1] == ord("|")]] = True
        change = (kind != before) & (before != SPACE)
        if words:  # digits are single
            change |= (kind == DIGIT) & (before == DIGIT)
        begins = np.flatnonzero(cut | change)
        is_cut = cut[begins]
        stretch = np.cumsum(is_cut) - 1  # between two cuts
        hard = np.zeros(int(stretch[-1]) + 1, bool)
        hard[np.searchsorted(begins[is_cut], np.flatnonzero(left_over), "right") - 1] = True
        hard = hard[stretch]
        keep = is_cut | ~hard
        begins, hard = begins[keep], hard[keep]
        if words:
            low = LOWER[data]
            upper = latin[LATIN_UPPER[data[latin + 1]]]
            low[upper + 1] += 0x20
            if hard.any():
                np.copyto(low, data, where=np.repeat(hard, np.diff(begins, append=n)))
            data = low
        return data, begins, hard

    def _fill(self, pieces: list[bytes], hard: np.ndarray):
        own = b"\0".join(p for p, h in zip(pieces, hard.tolist(), strict=True) if not h)
        if self.kind == "words":
            own = own.translate(None, b" \t\n\v\f\r")
        signs = SIGN_POINTS[np.frombuffer(own, np.uint8)].tobytes().decode("utf-32-le").split(SIGNS[0])
        tokenize = self.tokenizer.model.tokenize
        ids = [[t.id for t in tokenize(s)] for s in signs]
        if hard.any():
            texts = [pieces[i].decode() for i in np.flatnonzero(hard).tolist()]
            cut = iter(self.tokenizer.encode_batch_fast(texts, add_special_tokens=False))
            whole = iter(ids)
            ids = [next(cut).ids if h else next(whole) for h in hard.tolist()]
        self.table.add(ids)


class _Ragged:
    """Rows of ids in one growing array."""

    def __init__(self):
        self.n, self.rows = 0, 0
        self._flat = np.empty(1 << 16, np.uint16)
        self._starts = np.empty(1 << 14, np.int32)
        self._sizes = np.empty(1 << 14, np.int32)

    def add(self, lists: list[list[int]]):
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.fromiter(chain.from_iterable(lists), np.uint16, int(sizes.sum()))
        self._flat = _room(self._flat, self.n + len(flat))
        self._starts = _room(self._starts, self.rows + len(sizes))
        self._sizes = _room(self._sizes, self.rows + len(sizes))
        self._flat[self.n : self.n + len(flat)] = flat
        self._starts[self.rows : self.rows + len(sizes)] = self.n + np.cumsum(sizes) - sizes
        self._sizes[self.rows : self.rows + len(sizes)] = sizes
        self.n, self.rows = self.n + len(flat), self.rows + len(sizes)

    def flat(self):
        return self._flat[: self.n]

    def starts(self):
        return self._starts[: self.rows]

    def sizes(self):
        return self._sizes[: self.rows]


def _room(a: np.ndarray, n: int) -> np.ndarray:
    if n <= len(a):
        return a
    out = np.empty(max(n, 2 * len(a)), a.dtype)
    out[: len(a)] = a
    return out


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, kind: str, limit: int | None = None) -> Encoder:
    """The encoder of this Python worker, which keeps ``limit`` chunks."""
    if (path, kind) not in _ENCODERS:
        _ENCODERS[path, kind] = Encoder(path, kind)
    _ENCODERS[path, kind].limit = limit or CACHE[kind]
    return _ENCODERS[path, kind]


def release() -> None:
    """Let the encoders of this Python worker go, and what Arrow keeps of freed batches: for tasks of
    other work that it is kept on for."""
    _ENCODERS.clear()
    pa.default_memory_pool().release_unused()


def runs(batches, size: int = RUN):
    """Batches joined, or cut, to about ``size`` bytes of ``text``, which has no nulls then."""
    held, n, rows = [], 0, 0
    for batch in batches:
        texts = batch.column("text").fill_null("")
        batch = batch.set_column(batch.schema.get_field_index("text"), "text", texts)
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        begin = done = 0
        while begin < len(batch):
            end = min(int(np.searchsorted(ends, done + size - n)) + 1, len(batch))
            held.append(batch.slice(begin, end - begin))
            n, rows = n + int(ends[end - 1]) - done, rows + end - begin
            begin, done = end, int(ends[end - 1])
            if n >= size or rows >= RUN_ROWS:
                yield pa.concat_batches(held)
                held, n, rows = [], 0, 0
    if held:
        yield pa.concat_batches(held)


def slices(texts: list[str], chars: int = 1 << 20):
    """(begin, end) of runs of about ``chars`` characters, so that work on a batch of very
    long texts stays bounded."""
    begin = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= chars:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)

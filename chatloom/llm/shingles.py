"""Shingle sets of many texts at once, and their signatures, for tasks.

A batch of texts is one array of bytes. Words end at ASCII white space, so they can be
found, lower-cased and hashed by whole-array steps, whatever the length of a text. A
shingle is five words; a text of fewer is one shingle. Shingles are 64-bit digests.
"""

from functools import cache

import numpy as np

SHINGLE = 5
RUN = 1 << 19  # bytes of texts that are hashed at once, about: some 50 bytes of arrays for each
_M = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: a bijection of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _M[0]
    x = (x ^ (x >> np.uint64(27))) * _M[1]
    return x ^ (x >> np.uint64(31))


@cache
def _byte_table() -> tuple[np.ndarray, np.ndarray]:
    low = np.arange(256, dtype=np.uint8)
    low[65:91] += 32
    value = mix(low.astype(np.uint64) + np.uint64(1))
    space = np.zeros(256, bool)
    space[[9, 10, 11, 12, 13, 32]] = True
    return value, space


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, 1 << 20)
        for name, b in (("up", _BASE), ("down", _BASE_INV)):
            a = np.full(size, b, np.uint64)
            a[0] = 1
            _POWERS[name] = np.cumprod(a)
    return _POWERS["up"][:n], _POWERS["down"][:n]


_K = mix(np.arange(101, 101 + SHINGLE, dtype=np.uint64)) | np.uint64(1)


def word_hashes(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Digest of each word, and the number of words before each edge. ``edges`` are the
    ``len + 1`` places where texts begin and end in ``data``."""
    value, space = _byte_table()
    n = len(data)
    inside = ~space[data]
    cut = np.zeros(n + 1, bool)  # a word can't go on over the edge of a text
    cut[edges] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | cut[1:n]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | cut[1:n]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    up, down = _powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(value[data] * up[:n], out=sums[1:])
    words = mix((sums[stops] - sums[starts]) * down[starts])
    return words, np.searchsorted(starts, edges)


def shingle_sets(data: np.ndarray, edges: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingles of each text."""
    words, at = word_hashes(data, edges)
    total = len(words)
    full = np.zeros(max(total, 1), np.uint64)
    for k in range(SHINGLE):
        if total > k:
            full[: total - k] += words[k:] * _K[k]
    full = mix(full)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= SHINGLE:
            s = np.sort(full[a : b - SHINGLE + 1])
            keep = np.empty(len(s), bool)
            keep[0] = True
            np.not_equal(s[1:], s[:-1], out=keep[1:])
            out.append(s[keep])
        elif b > a:
            short = (words[a:b] * _K[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            out.append(mix(np.array([short], np.uint64)))
        else:
            out.append(full[:0])
    return out


def digest(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed numbers."""
    a = mix(s).sum(dtype=np.uint64) + np.uint64(len(s))
    b = mix(s ^ _BASE).sum(dtype=np.uint64)
    both = mix(np.array([a, b], np.uint64)).view(np.int64)
    return int(both[0]), int(both[1])


def batches_of(column, limit: int = RUN):
    """(first row, data, edges) of runs of an Arrow string column, of about ``limit`` bytes;
    a null is empty."""
    import pyarrow as pa

    for chunk in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        text = chunk.fill_null("").cast(pa.large_string())
        _, offsets, buffer = text.buffers()
        offs = np.frombuffer(offsets, np.int64)[text.offset : text.offset + len(text) + 1]
        data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.empty(0, np.uint8)
        i = 0
        while i < len(text):
            j = int(np.searchsorted(offs, offs[i] + limit, "right")) - 1
            j = min(max(j, i + 1), len(text))
            yield i, data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
            i = j


# Size bands grow by 4/3, so that sets of a Jaccard similarity of 3/4 are in the same or in
# neighbouring bands. Window k takes the sets of bands k and k + 1; it is there for the
# pairs whose smaller set is of band k.
@cache
def band_bounds() -> np.ndarray:
    """The least size of each band."""
    out, num, den = [], 1, 1
    while num // den < 1 << 40:
        out.append(-(-num // den))
        num, den = num * 4, den * 3
    return np.array(out, np.int64)


def band(n: int) -> int:
    return int(np.searchsorted(band_bounds(), n, "right")) - 1


def most_difference(n: int, k: int) -> int:
    """The largest symmetric difference between a set of ``n`` and a partner in window k;
    -1 where it can have none."""
    if band(n) == k:
        return n // 3  # the partner has at most 4n/3
    below = int(band_bounds()[k + 1]) - 1  # the largest size of band k
    if k < 0 or 4 * below < 3 * n or below < band_bounds()[k]:
        return -1
    return (n + min(n, below)) // 7


def segments(k: int) -> int:
    """Segments of the universe in window k: half more than a pair there may differ in, and
    some for small sets."""
    return int(band_bounds()[k + 1]) // 2 + 16


def by_deletion(k: int) -> bool:
    """Whether window k indexes one-deletion neighbourhoods."""
    return int(band_bounds()[k + 1]) // 3 <= 1


def signatures(s: np.ndarray, k: int) -> np.ndarray:
    """Signatures of a sorted set in window k; equal in two sets where a segment is.

    A window whose pairs differ in at most one shingle takes the whole universe as one
    segment and indexes its one-deletion neighbourhood: fewer and rarer signatures than
    single shingles. All others split the universe and index each segment that isn't
    empty. Two sets that have too few of those to spend the difference on get a
    signature in common.
    """
    salt = mix(np.array([k + 7], np.uint64))[0]
    most = most_difference(len(s), k)
    if by_deletion(k):
        total = mix(s).sum(dtype=np.uint64)
        return mix(np.concatenate([[total], total - mix(s)]) ^ salt)
    m = np.uint64(segments(k))
    seg = ((s >> np.uint64(32)) * m) >> np.uint64(32)
    first = np.flatnonzero(np.concatenate([[True], seg[1:] != seg[:-1]]))
    sums = np.add.reduceat(mix(s ^ salt), first)
    out = mix(sums ^ mix(seg[first] + salt))
    if len(out) <= most:
        out = np.concatenate([out, mix(np.array([salt ^ np.uint64(1)], np.uint64))])
    return out


def windows_of(n: int) -> list[tuple[int, int]]:
    """(window, largest difference) in which a set of ``n`` can have a partner."""
    own = band(n)
    found = [(k, most_difference(n, k)) for k in (own, own - 1) if k >= 0]
    return [(k, h) for k, h in found if h >= 1]

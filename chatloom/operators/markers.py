"""Markers of any number in logs of any length: one index of the markers, one pass.

``logs.log_markers`` tests each line against each marker of a short list. Here the markers are a
table; tasks make an index of it once per Python worker and read each line once,
whatever their number. The index is arrays of numbers: a marker is found by a rolling hash of its
characters. Of each place of a text, the hash of its next 1, 2, 4, 8, ... characters tells whether
a marker of that length or more may begin there, and only such places are looked up, in each
length that markers have. What counts in the end, the last place of a marker in a batch, is
compared character by character; a task hands on the last place of each (run, marker) it
has seen, so what is shuffled doesn't grow with the lines. A table of more than ``BLOCK``
characters is dealt into several indexes by the beginnings of the markers; these pass the
driver one at a time as packed text, and lines are read once for each.
"""

import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.session import materialize, shared_dir

BLOCK = 12_000_000  # characters of the markers of an index: some 70 MB in its worker
HELD = 200_000  # places a task gathers before it hands them on
SLICE = 1 << 18  # places of a text that are looked up at a time
FACTOR = 0x9E3779B97F4A7C55  # of the rolling hash; odd, so that it can be undone
MIX = np.uint64(0xD6E8FEB86659FD93)  # brings all bits of a hash into its highest ones
NOWHERE = np.iinfo(np.int64).min

_INDEXES: dict[str, object] = {}


def _codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All characters as numbers, and where each text begins among them (and the last one ends)."""
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, places, data = texts.buffers()
    if not len(texts) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    ends = np.frombuffer(places, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]
    ends -= ends[0]
    if not data.size or data.max() < 128:
        return data, ends
    chars = np.zeros(data.size + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=chars[1:])
    return np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32), chars[ends]


class _Index:
    """Markers (distinct, none empty) by their hashes, numbered by length."""

    def __init__(self, words: pa.Array):
        sizes = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        self.order = None  # the place in ``words`` of each number, if these don't come by length
        if (np.diff(sizes) < 0).any():
            self.order = np.argsort(sizes, kind="stable")
            sizes, words = sizes[self.order], words.take(pa.array(self.order))
        self.codes, self.at = _codes(words)
        self.longest, count = int(sizes[-1]), len(sizes)
        self.powers = np.cumprod(np.full(SLICE + self.longest + 1, FACTOR, np.uint64))
        self.undone = np.cumprod(np.full(SLICE + self.longest + 1, pow(FACTOR, -1, 1 << 64), np.uint64))
        heads = 1 << (np.frexp(sizes)[1].astype(np.int64) - 1)  # the largest power of two up to the length
        self.hashes, begun, i = np.empty(count, np.uint64), np.empty(count, np.uint64), 0
        while i < count:
            j = max(i + 1, int(np.searchsorted(self.at, self.at[i] + SLICE, "right")) - 1)
            sums, at = self._sums(self.codes[self.at[i] : self.at[j]]), self.at[i:j] - self.at[i]
            self.hashes[i:j] = (sums[at + sizes[i:j]] - sums[at]) * self.undone[at]
            begun[i:j] = (sums[at + heads[i:j]] - sums[at]) * self.undone[at]
            i = j
        self.classes = []
        for head in np.unique(heads):
            of = np.flatnonzero(heads == head)
            bits = int(min(24, max(10, (4 * len(of)).bit_length())))
            seen = np.zeros(1 << bits, bool)
            seen[self._slot(begun[of], bits)] = True
            lengths, firsts = np.unique(sizes[of], return_index=True)
            bounds = [*(firsts + of[0]).tolist(), int(of[-1]) + 1]
            self.classes.append((int(head), bits, seen, [*zip(lengths.tolist(), bounds, bounds[1:])]))
        self.bits = max(10, (2 * count).bit_length())
        self.slots = np.full(1 << self.bits, -1, np.int32)
        left, slot = np.arange(count, dtype=np.int32), self._slot(self.hashes, self.bits)
        while left.size:
            free = self.slots[slot] < 0
            self.slots[slot[free]] = left[free]
            beside = self.slots[slot] != left
            left, slot = left[beside], (slot[beside] + 1) & (len(self.slots) - 1)
        ordered = np.sort(self.hashes)
        self.twins = bool((ordered[1:] == ordered[:-1]).any())  # markers that only their characters tell apart
        self.last = np.full(count, NOWHERE)  # the greatest place of each number, within ``lasts``

    def _sums(self, codes):
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum((codes + np.uint64(1)) * self.powers[: len(codes)], out=sums[1:])
        return sums

    @staticmethod
    def _slot(hashes, bits):
        return ((hashes * MIX) >> np.uint64(64 - bits)).view(np.int64)

    def _hits(self, codes, begins, a, b, stop):
        """(line, place, number) of what may be a marker and begins in ``a`` to ``b``; lines end at ``stop``."""
        text = codes[a : min(b + self.longest, stop)]
        sums = self._sums(text)
        i, j = np.searchsorted(begins, a, "right") - 1, np.searchsorted(begins, b, "left")
        line = np.repeat(np.arange(i, j), np.diff(np.clip(begins[i : j + 1], a, b)))
        places, numbers = [], []
        for head, bits, seen, lengths in self.classes:
            some = min(b - a, len(text) - head + 1)
            if some <= 0:
                continue
            begun = sums[head : head + some] - sums[:some]
            begun *= self.undone[:some]
            at = np.flatnonzero(seen.take(self._slot(begun, bits)))
            room = begins[line[at] + 1] - a - at
            base, undone = sums[at], self.undone[at]
            for length, low, high in lengths:
                hashes = (sums.take(at + length, mode="clip") - base) * undone
                slot, rest = self._slot(hashes, self.bits), None
                while True:
                    found = self.slots.take(slot)
                    full = np.flatnonzero(found >= 0)
                    if not full.size:
                        break
                    found, hashes, slot = found[full], hashes[full], slot[full]
                    rest = full if rest is None else rest[full]
                    hit = (self.hashes.take(found) == hashes) & (found >= low) & (found < high)
                    good = hit & (room[rest] >= length)
                    places.append(at[rest[good]])
                    numbers.append(found[good])
                    more = np.arange(len(hit)) if self.twins else np.flatnonzero(~hit)
                    rest, hashes, slot = rest[more], hashes[more], (slot[more] + 1) & (len(self.slots) - 1)
        if not places:
            return (np.zeros(0, np.int64),) * 3
        at, number = np.concatenate(places), np.concatenate(numbers)
        return line[at], at + a, number

    def _same(self, codes, at, number):
        """Whether the characters from ``at`` on are the marker's."""
        sizes = self.at[number + 1] - self.at[number]
        same = np.ones(len(at), bool)
        for k in range(int(sizes.max(initial=0))):
            longer = np.flatnonzero(same & (sizes > k))
            same[longer] = codes[at[longer] + k] == self.codes[self.at[number[longer]] + k]
        return same

    def lasts(self, codes, begins, first, end, offsets) -> dict[int, int]:
        """The last place of each marker in the lines ``first`` to ``end``, of one log."""
        a, stop = int(begins[first]), int(begins[end])
        for sure in (self.twins, True):
            kept = []
            for b in range(a, stop, SLICE):
                line, at, number = self._hits(codes, begins, b, min(b + SLICE, stop), stop)
                if sure and len(at):
                    good = self._same(codes, at, number)
                    line, at, number = line[good], at[good], number[good]
                place = offsets[line] + at - begins[line]
                np.maximum.at(self.last, number, place)
                best = self.last[number] == place
                kept.append((number[best], place[best], at[best]))
            if not kept:
                return {}
            number, place, at = (np.concatenate(x) for x in zip(*kept, strict=True))
            best = self.last[number] == place
            self.last[number] = NOWHERE
            number, place, at = number[best], place[best], at[best]
            if sure or self._same(codes, at, number).all():
                break  # else some hash met another text's: compare all
        if self.order is not None:
            number = self.order[number]
        return dict(zip(number.tolist(), place.tolist(), strict=True))


def _index(name: str, words) -> _Index:
    """The index of this Python worker; the last one asked for is kept."""
    if name not in _INDEXES:
        _INDEXES.clear()
        _INDEXES[name] = _Index(pa.array(words, pa.string()) if isinstance(words, list) else words)
    return _INDEXES[name]


def _blocks(markers: DataFrame, block: int) -> Iterator[pa.Array]:
    """The distinct markers, by length in arrays of about ``block`` characters; only one is on the driver at a time."""
    rows = markers.select("marker").where(F.coalesce(F.length("marker"), F.lit(0)) > 0).distinct()
    try:
        shared_dir(markers.sparkSession)
    except RuntimeError:
        pass  # a cluster without a shared folder: each array is made from the table anew
    else:
        rows = materialize(rows)
    size = rows.agg(F.coalesce(F.sum(F.length("marker")), F.lit(0)).alias("n")).first().n
    parts = max(1, -(-size // block))
    dealt = F.lit(0)
    if parts > 1:
        # by beginnings, so that a place of a text is looked up for one index alone; if these are too uneven, by the whole
        head = F.pow(F.lit(2.0), F.floor(F.log2(F.length("marker").cast("double")))).cast("int")
        by_head, by_all = (F.pmod(F.xxhash64(x), F.lit(parts)) for x in (F.left("marker", head), F.col("marker")))
        largest = rows.groupBy(by_head).agg(F.sum(F.length("marker")).alias("n")).agg(F.max("n")).first()[0]
        dealt = by_head if 2 * largest <= 3 * block else by_all
    for k in range(parts):
        part = rows.where(dealt == k).toArrow()["marker"]
        part = part.cast(pa.string()).combine_chunks() if part.num_chunks else pa.array([], pa.string())
        yield part.take(pc.sort_indices(pc.utf8_length(part)))


def find_markers(lines: DataFrame, markers: DataFrame, by: str = "run", block: int = BLOCK) -> DataFrame:
    """(``by``, ``marker``, ``from_end``): the last occurrence of each of the ``markers`` (a table with a column ``marker``) in
    each log, as the distance of its first character from the log's end. Markers that a
    log lacks give no row; null and empty markers are left out, and repeated ones count once.

    ``lines`` are (``by``, ``offset``, ``line``); a null line is empty.
    """
    spark = lines.sparkSession
    kind = dict(lines.dtypes)[by]
    rows = lines.select(
        F.col(by).alias("key"), F.col("offset").cast("long").alias("offset"), F.coalesce("line", F.lit("")).alias("line")
    )
    found = None
    for words in _blocks(markers, block):
        if not len(words):
            continue
        table = spark.sparkContext.broadcast(words)
        part = rows.mapInArrow(_spelled(uuid.uuid4().hex, table), f"key {kind}, marker string, at long")
        part = part.groupBy("key", "marker").agg(F.max("at").alias("at"))
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], f"{by} {kind}, marker string, from_end long")
    sizes = rows.groupBy("key").agg(F.max(F.col("offset") + F.length("line") + 1).alias("size"))
    same = found["key"].eqNullSafe(sizes["key"])
    return found.join(sizes, same).select(
        found["key"].alias(by), "marker", (F.col("size") - F.col("at")).alias("from_end")
    )


def _spelled(name, table):
    """``_searched`` with the markers themselves for their numbers."""

    def run(batches):
        for found in _searched(name, table)(batches):
            marker = table.value.take(found.column("number"))
            yield pa.RecordBatch.from_arrays([found.column("key"), marker, found.column("at")], names=["key", "marker", "at"])

    return run


def _searched(name, table):
    def run(batches):
        index = _index(name, table.value)
        last: dict[object, dict[int, int]] = {}
        kind = None
        for batch in batches:
            kind = batch.schema.field("key").type
            batch = batch.filter(pc.is_valid(batch.column("offset")))
            keys = batch.column("key").dictionary_encode(null_encoding="encode")
            codes = keys.indices.to_numpy()
            if len(keys.dictionary) > 1:  # lines of a log side by side
                order = np.argsort(codes, kind="stable")
                batch, codes = batch.take(pa.array(order)), codes[order]
            text, begins = _codes(batch.column("line"))
            offsets = batch.column("offset").to_numpy()
            bounds = [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist(), len(codes)]
            names = keys.dictionary.to_pylist()
            for first, end in zip(bounds, bounds[1:]):
                if first < end:
                    _merge(last, names[codes[first]], index.lasts(text, begins, first, end, offsets))
            if sum(map(len, last.values())) > HELD:
                yield _handed(last, kind)
                last = {}
        if any(last.values()):
            yield _handed(last, kind)

    return run


def _merge(last, key, seen):
    have = last.setdefault(key, seen)
    if have is not seen:
        for number, at in seen.items():
            if have.get(number, NOWHERE) < at:
                have[number] = at


def _handed(last, kind):
    counts = np.fromiter(map(len, last.values()), np.int64, len(last))
    numbers = np.fromiter(chain.from_iterable(last.values()), np.int32, counts.sum())
    at = np.fromiter(chain.from_iterable(d.values() for d in last.values()), np.int64, counts.sum())
    keys = pa.array(list(last), kind).take(pa.array(np.repeat(np.arange(len(last)), counts)))
    return pa.RecordBatch.from_arrays([keys, pa.array(numbers), pa.array(at)], names=["key", "number", "at"])

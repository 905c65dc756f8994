"""SimHash near duplicates by pivot distance tables, exact at ``LIMIT`` differing bits.

Fingerprints. A text's words are lower-cased and cut at ASCII white space; each run of four
words is a shingle, repeats included, hashed by XXH64 with seed 42. A bit is set where over
half of the hashes have it.

Pivots. ``SPREAD`` references lie anywhere in the space. Others come in families: 64 bits
fall into segments, and a family's references are the base reference with a pattern
changed inside one segment. The table of a fingerprint holds its Hamming distances to all
of them. Two facts follow from the triangle inequality:

* no coordinate of two fingerprints differs by more than their distance, so a pair goes
  whose largest coordinate difference is above the limit;
* what a family's distances lie off the base's depends on its segment alone, and with ``m``
  segments a pair of at most four differing bits agrees in all the coordinates of m - 4
  families at least. These coordinates, for each choice of m - 4 families, are the keys by
  which pairs meet; ``m`` grows with the number of fingerprints, so that keys stay rare.

Fingerprints of a key lie side by side in a sorted partition and are compared there, array
by array; pairs never become rows. A key that over ``BUCKET`` fingerprints have, as in a
large group of near copies, is left out of that: each of its fingerprints names all
the points within two bits of it instead. Two fingerprints are at most four bits apart
if and only if they share such a point; a point has at most 2,081 of them, and its
fingerprints are linked with the least one, which loses no link. The work for hot keys is
linear in their fingerprints.

Equal fingerprints are one class from the start, so copies are never compared.

Defined results: null and empty texts, and those of white space, have the fingerprint
zero, which links like any other; a text of one to three words is one shingle; repeated
rows and rows that share an id are members of their own text's class; a null id is a
member, too, but names a component only if no other id is in it; an empty table gives no
rows; other columns stay out of the way.
"""

from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chatloom.llm.common import written
from chatloom.llm.graph import components, small
from chatloom.llm.shingles import mix
from chatloom.session import materialize

WORDS = 4
SEED = 42
LIMIT = 4
BITS = 64
SPREAD = 32  # references anywhere in the space
BUCKET = 512  # fingerprints of a key that are compared pair by pair
CROWD = 16  # fingerprints that a key should have at most, were they even
HASHES = 1 << 20  # of a run of texts

_BYTES = np.uint64(0x0101010101010101)


def _hashes(text: str) -> list[int]:
    words = text.encode().lower().split()  # bytes: A-Z and ASCII white space alone
    if not words:
        return []
    if len(words) <= WORDS:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: 1 - WORDS].tolist()
    return [digest(joined[a:b], SEED) for a, b in zip(starts, ends[WORDS - 1 :].tolist(), strict=True)]


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The bits that over half of each run of hashes have; zero for an empty run.

    Eight bits of a hash are counted at once, each in a byte of its own, over at most 255
    hashes; these counts are then added up.
    """
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    first = (np.cumsum(counts) - counts)[full]
    blocks = -(-counts[full] // 255)
    own = np.cumsum(blocks) - blocks
    at = np.repeat(first - 255 * own, blocks) + 255 * np.arange(blocks.sum())
    most = counts[full][:, None]
    for k in range(8):
        sums = np.add.reduceat((hashes >> np.uint64(k)) & _BYTES, at)
        ones = np.add.reduceat(sums.view(np.uint8).reshape(-1, 8).astype(np.int64), own)
        places = np.arange(0, BITS, 8, dtype=np.uint64) + np.uint64(k)
        out[full] |= ((2 * ones > most).astype(np.uint64) << places).sum(1, dtype=np.uint64)
    return out


def fingerprints(df: DataFrame) -> DataFrame:
    """(``doc_id``, ``fp``): the fingerprint of each text, as a signed long."""

    def flush(hashes, counts):
        return majority(np.array(hashes, np.uint64), np.array(counts, np.int64)).view(np.int64)

    def run(batches):
        for batch in batches:
            done, hashes, counts = [], [], []
            for text in batch.column("text"):
                own = _hashes(text.as_py() or "")
                hashes += own
                counts.append(len(own))
                if len(hashes) > HASHES:
                    done.append(flush(hashes, counts))
                    hashes, counts = [], []
            done.append(flush(hashes, counts))
            fp = pa.array(np.concatenate(done))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), fp], names=["doc_id", "fp"])

    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, fp long")


def segment_count(n: int) -> int:
    """The fewest segments whose keys are rare among ``n`` fingerprints. A family of patterns
    tells most, not all, of its segment's bits, which three bits of each key allow for."""
    m = LIMIT + 2
    while m < 12 and n > CROWD << (BITS * (m - LIMIT) // m - 3):
        m += 1
    return m


class Pivots:
    """References and distance tables for ``m`` segments."""

    def __init__(self, m: int):
        edges = [BITS * k // m for k in range(m + 1)]
        self.base = mix(np.array([SEED], np.uint64))
        families = []
        for a, b in zip(edges, edges[1:], strict=False):
            place = np.arange(b - a)
            # the whole segment, its alternate halves, and each other bit alone
            masks = [place >= 0, *((place >> k) & 1 == 0 for k in range(3)), *(place == k for k in range(0, b - a, 2))]
            families.append([sum(1 << int(a + i) for i in place[mask]) for mask in masks])
        self.families = [self.base ^ np.array(f, np.uint64) for f in families]
        self.spread = mix(np.arange(1, SPREAD + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        self.choices = list(combinations(range(m), m - LIMIT))
        self.all = np.concatenate([self.spread, self.base, *self.families])

    def table(self, fp: np.ndarray, pivots: np.ndarray | None = None) -> np.ndarray:
        pivots = self.all if pivots is None else pivots
        return np.bitwise_count(fp[:, None] ^ pivots[None, :]).astype(np.int8)

    def keys(self, fp: np.ndarray) -> np.ndarray:
        """A row for each choice of families: a digest of their coordinates."""
        base = self.table(fp, self.base)
        parts = []
        for k, family in enumerate(self.families):
            total = np.full(len(fp), k + 1, np.uint64)
            for column in (self.table(fp, family) - base).T:
                total = mix(total * np.uint64(131) + column.astype(np.uint64))
            parts.append(total)
        return np.stack(
            [mix(sum((parts[k] for k in c), np.full(len(fp), t, np.uint64))) for t, c in enumerate(self.choices)]
        )


@cache
def pivots(m: int) -> Pivots:
    return Pivots(m)


def _close(key: np.ndarray, fp: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within runs of equal keys: (member, least fingerprint that it reaches there)."""
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.append(start, len(key)))
    behind = np.repeat(start + size, size) - np.arange(len(key)) - 1  # members of the run that follow
    left = np.flatnonzero(behind)
    table = None
    xs, ys = [], []
    step = 1
    while len(left):
        if table is None:
            table = pivots(m).table(fp)
        x, y = left, left + step
        for part in (slice(0, 8), slice(8, SPREAD), slice(SPREAD, None)):
            apart = np.abs(table[x, part] - table[y, part]).max(1)
            x, y = x[apart <= LIMIT], y[apart <= LIMIT]
        near = np.bitwise_count(fp[x] ^ fp[y]) <= LIMIT
        xs.append(x[near])
        ys.append(y[near])
        step += 1
        left = left[behind[left] >= step]
    if not xs:
        return fp[:0], fp[:0]
    x, y = np.concatenate(xs), np.concatenate(ys)
    root = np.arange(len(fp))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    moved = np.flatnonzero(root != np.arange(len(fp)))
    return fp[moved], fp[root[moved]]


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])


def _compare(m: int):
    def run(batches):
        key, fp = np.empty(0, np.int64), np.empty(0, np.uint64)
        for batch in batches:
            key = np.concatenate([key, batch.column("key").to_numpy()])
            fp = np.concatenate([fp, batch.column("fp").to_numpy().view(np.uint64)])
            if not len(key):
                continue
            cut = int(np.searchsorted(key, key[-1]))  # the last run may go on
            if cut:
                yield _pairs(*_close(key[:cut], fp[:cut], m))
                key, fp = key[cut:], fp[cut:]
        if len(key):
            yield _pairs(*_close(key, fp, m))

    return run


@cache
def _ball() -> np.ndarray:
    one = np.uint64(1) << np.arange(BITS, dtype=np.uint64)
    a, b = np.triu_indices(BITS, 1)
    return np.concatenate([np.zeros(1, np.uint64), one, one[a] ^ one[b]])


def _points(batches):
    for batch in batches:
        fp = batch.column("fp").to_numpy().view(np.uint64)
        for a in range(0, len(fp), 256):
            own = fp[a : a + 256]
            points = (own[:, None] ^ _ball()[None, :]).ravel().view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(points), pa.array(np.repeat(own, len(_ball())).view(np.int64))], names=["point", "fp"]
            )


def links(classes: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(``a``, ``b``) that join all fingerprints of a written table with distinct ``fp`` whose
    distance is at most ``LIMIT``."""
    m = segment_count(classes.count())

    def keyed(batches):
        for batch in batches:
            fp = batch.column("fp").to_numpy()
            keys = pivots(m).keys(fp.view(np.uint64)).view(np.int64)
            for row in keys:
                yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(fp)], names=["key", "fp"])

    rows = materialize(classes.select("fp").mapInArrow(keyed, "key long, fp long"))
    hot = small(materialize(rows.groupBy("key").count().where(F.col("count") > bucket).select("key")))
    even = rows.join(hot, "key", "left_anti").repartition("key").sortWithinPartitions("key")
    near = even.mapInArrow(_compare(m), "a long, b long")
    crowd = materialize(rows.join(hot, "key", "left_semi").select("fp").distinct())
    least = F.min("fp").over(Window.partitionBy("point"))
    around = crowd.mapInArrow(_points, "point long, fp long").select(F.col("fp").alias("a"), least.alias("b"))
    return near.unionByName(around.where("a <> b").distinct())


def near_duplicates(df: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(``doc_id``, ``fp``, ``component_id``) of each row of ``df`` (``doc_id``, ``text``)."""
    own = written(fingerprints(df))
    classes = materialize(own.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("rows")))
    roots = components(links(classes, bucket)).withColumnRenamed("node", "fp")
    linked = materialize(classes.join(small(roots), "fp"))
    least = materialize(linked.groupBy("root").agg(F.min("first").alias("component_id")))
    named = linked.join(small(least), "root").select("fp", "component_id")
    # a fingerprint that is linked to none, and that one row has, needs no look-up
    alone = classes.where("rows > 1").join(small(roots.select("fp")), "fp", "left_anti")
    names = materialize(named.unionByName(alone.select("fp", F.col("first").alias("component_id"))))
    return own.join(small(names), "fp", "left").select(
        "doc_id", "fp", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def report(df: DataFrame) -> DataFrame:
    """Fingerprints as 16 lower-case hex digits."""
    return df.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

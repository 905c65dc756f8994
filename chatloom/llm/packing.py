"""Best-fit packing certified by dual-feasible bounds.

Documents become ids and an end id; only those longer than a sequence are cut. Pieces
are dealt over pools of a bounded size. In each pool best-fit decreasing packs them, and
dual-feasible functions of the lengths give a lower bound of the pool's sequences. A pool
that meets its bound is certified: its sequences stand, but for one that isn't full. A
pool with a gap, and what the certified ones leave over, give the pieces of their
sequences that aren't full back; these are dealt anew over fewer pools and packed again,
until all of it fits one pool or a round saves nothing.

Only ids of pieces and their lengths travel, never tokens. A pool is dealt by a digest
of (document, piece), so one huge document doesn't land in one pool.

Defined results: a null or empty text is a piece of one id, the end id; repeated rows are
packed as often as they come (pieces of rows that agree in id and place are
interchangeable); null ids are packed like others; an empty table gives no rows.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import written
from chatloom.llm.tokens import encoder, runs
from chatloom.session import materialize

CAPACITY = 2048
POOL = 4096  # pieces of a pool, about
ROUNDS = 6
END_ID = 0

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = f"{PIECES}, sequence_id long, offset long, open boolean"


def cut(n_ids: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; the first may be shorter."""
    first = n_ids % capacity or min(n_ids, capacity)
    starts = [0, *range(first, n_ids, capacity)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], n_ids], strict=True)]


def pieces(df: DataFrame, path: str, capacity: int = CAPACITY, cache: int | None = None) -> DataFrame:
    """``PIECES`` of (``doc_id``, ``text``), tokenized in tasks, batch by batch."""

    def run(batches):
        enc = encoder(path, "bytes", cache)
        for batch in runs(batches):  # Arrow alone: pandas would turn long ids with a null into doubles
            yield _cut_all(enc, batch, capacity)

    return df.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)


def _cut_all(enc, batch, capacity):
    ids, counts = enc.encode_column(batch.column("text"))
    ids = np.insert(ids, np.cumsum(counts), END_ID).astype("<u4")
    rows, at = [], 0
    for row, n in enumerate((counts + 1).tolist()):
        rows += [
            (row, k, start, size, zlib.crc32(ids[at + start : at + start + size]))
            for k, (start, size) in enumerate(cut(n, capacity))
        ]
        at += n
    row, *columns = (np.array(c, np.int64) for c in zip(*rows, strict=True))
    columns[0] = columns[0].astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id").take(pa.array(row)), *map(pa.array, columns)], names=["doc_id", "piece", "start", "length", "ids_crc32"]
    )


def lower_bound(hist: np.ndarray, capacity: int = CAPACITY) -> int:
    """The best bound on sequences that two families of dual-feasible functions give, from
    the number of pieces of each length.

    ``U(e)`` counts lengths above C-e as C, those below e as 0; ``u(k)`` rounds the
    result to multiples of C/k where it isn't one of C/(k+1). Each is summed over the
    lengths.
    """
    size = np.arange(capacity + 1)
    cuts = np.unique(np.concatenate([[0], size[1 : capacity // 2 + 1][hist[1 : capacity // 2 + 1] > 0]]))
    best = 0
    for e in cuts:
        u = np.where(size > capacity - e, capacity, np.where(size < e, 0, size))
        best = max(best, -(-int((hist * u).sum()) // capacity))
    for k in range(1, 21):
        exact = size * (k + 1) % capacity == 0
        scaled = np.where(exact, size * k, size * (k + 1) // capacity * capacity)  # times 1/k
        best = max(best, -(-int((hist * scaled).sum()) // (capacity * k)))
    return best


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each length, taken in the given (decreasing) order, and what
    is left of each bin. The bins of each remaining size are a stack, and the sizes in
    use are the bits of a number: the best fit is its lowest bit from the length on."""
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, used = 0, []
    where, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, n in enumerate(lengths.tolist()):
        rest = mask >> n
        if rest:
            left = n + (rest & -rest).bit_length() - 1
            b = stacks[left].pop()
            if not stacks[left]:
                mask ^= 1 << left
        else:
            left, b = capacity, len(used)
            used.append(0)
        where[i], offset[i] = b, capacity - left
        left -= n
        used[b] = capacity - left
        if left:
            stacks[left].append(b)
            mask |= 1 << left
    return where, offset, capacity - np.array(used, np.int64)


def pack_pool(rows: pa.Table, pool: int, last: bool, capacity: int = CAPACITY) -> pa.Table:
    """Pack one pool; ``open`` marks pieces that go to the next round."""
    ids = rows.column("doc_id")
    by = [rows.column(c).to_numpy() for c in ("ids_crc32", "piece")]
    none = ids.is_null().to_numpy()
    order = np.lexsort((*by, ids.fill_null(0).to_numpy(), none, -rows.column("length").to_numpy()))
    rows = rows.select(["doc_id", "piece", "start", "length", "ids_crc32"]).take(order)
    lengths = rows.column("length").to_numpy()
    where, offset, left = best_fit(lengths, capacity)
    certified = len(left) == lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
    free = np.zeros(len(left), bool)
    if not last:
        if certified:
            free[np.argmax(left)] = left.max() > 0
        else:
            free = left > 0
    for name, values in (("sequence_id", (pool << 24) + where), ("offset", offset), ("open", free[where])):
        rows = rows.append_column(name, pa.array(values))
    return rows


def pack(parts: DataFrame, capacity: int = CAPACITY, pool: int = POOL, rounds: int = ROUNDS) -> DataFrame:
    """``PACKED`` without ``open``: a sequence and a place for each piece.

    A pool number is (round, pool); a pool holds far less than 2**24 pieces.
    """
    parts = written(parts)
    # Full pieces are sequences of their own; negative numbers can't meet a pool's.
    done = [
        parts.where(F.col("length") == capacity).select(
            "*",
            (-1 - F.monotonically_increasing_id()).alias("sequence_id"),
            F.lit(0).cast("long").alias("offset"),
        )
    ]
    left = parts.where(F.col("length") < capacity)
    columns = done[0].columns
    n = left.count()
    for k in range(rounds):
        pools = max(1, -(-n // pool))
        last = pools == 1 or k == rounds - 1
        key = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.lit(k)), F.lit(pools))
        number = F.lit(k << 32) + key
        packed = materialize(
            left.select("*", number.alias("pool"))
            .groupBy("pool")
            .applyInArrow(_packer(last, capacity), PACKED)
        )
        done.append(packed.where(~F.col("open")).select(columns))
        if last:
            break
        left = packed.where("open").select(parts.columns)
        n = left.count()
        if not n:
            break
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def _packer(last: bool, capacity: int):
    def run(key, rows):
        return pack_pool(rows, key[0].as_py(), last, capacity)

    return run


def certificate(packed: DataFrame, capacity: int = CAPACITY) -> tuple[int, int]:
    """(sequences, lower bound for all pieces), from counts by length and by sequence."""
    hist = np.zeros(capacity + 1, np.int64)
    for r in packed.groupBy("length").count().collect():  # at most ``capacity`` rows
        hist[r["length"]] = r["count"]
    return packed.where("offset = 0").count(), lower_bound(hist, capacity)


def best_fit_packing(df: DataFrame, path: str, capacity: int = CAPACITY, cache: int | None = None) -> DataFrame:
    """``cache`` is the number of chunks that a worker's encoder keeps; the result doesn't depend on it."""
    return pack(pieces(df, path, capacity, cache), capacity)

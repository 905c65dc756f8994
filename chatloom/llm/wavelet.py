"""Token ids in shards, each a wavelet matrix in one compressed file.

A shard holds the ids of some documents in ascending id order. Ids are numbered densely
over the shard's own alphabet, and the bits of these numbers are kept in planes from
the highest down: each plane holds one bit per token, and the next plane takes the
tokens with a 0 first, then those with a 1, in order. Counts of ones before each block
of 512 bits make ``rank`` a look-up and ``select`` a binary search, so a shard answers what
token stands at a place, how often a token occurs in a range, and where its k-th
occurrence is, without being expanded.

File: ``WVM1``, length of a JSON header as 4 bytes, the header, then the zstd-compressed
sections it names: ids and lengths of the documents, the alphabet, the planes.

Documents are dealt by ranges of (id, digest of the text) and sorted, so a shard is made
in one task; a task cuts a new shard when one is full. File names follow from the
partition's number, and a file is moved to its name when it is whole: a repeated task
writes the same file again.

Defined results: null and empty texts have the end id alone; null ids come first; rows of
equal id follow a digest of the text, repeated rows one another; an empty table makes
no file.
"""

import json
import struct
import uuid
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatloom.llm.common import written
from chatloom.llm.tokens import encoder, runs
from chatloom.session import fresh_path

END_ID = 1
SHARD_TOKENS = 1 << 21  # tokens of a shard, about
PARTITION_ROWS = 4_000  # documents dealt to a task, about; it cuts shards by their tokens
RUN = 1 << 21  # bytes of texts encoded at once, about: well below a shard
BLOCK = 512
MAGIC = b"WVM1"


def _planes(codes: np.ndarray, levels: int) -> tuple[list[bytes], list[int]]:
    planes, zeros, n = [], [], len(codes)
    for level in range(levels - 1, -1, -1):
        plane = np.packbits((codes & np.uint16(1 << level)) != 0, bitorder="little")
        planes.append(plane.tobytes())
        zeros.append(n - int(np.bitwise_count(plane).sum()))
        if level:  # a plane is a mask of Arrow's as it is
            ones, none = (pa.BooleanArray.from_buffers(pa.bool_(), n, [None, pa.py_buffer(x)]) for x in (plane, ~plane))
            parts = pa.array(codes)
            codes = np.concatenate([parts.filter(none).to_numpy(), parts.filter(ones).to_numpy()])
    return planes, zeros


def build(
    ids: np.ndarray, doc_ids: np.ndarray, lengths: np.ndarray, name: tuple[int, int] = (0, 0), nulls: int = 0
) -> bytes:
    """The file of a shard; the first ``nulls`` documents have a null id."""
    import zstandard

    seen = np.zeros(1 << 16, bool)
    seen[ids] = True
    alphabet = np.flatnonzero(seen).astype(np.uint16)
    number = np.zeros(1 << 16, np.uint16)
    number[alphabet] = np.arange(len(alphabet))
    levels = max(1, int(len(alphabet) - 1).bit_length())
    planes, zeros = _planes(number[ids], levels)
    pack = zstandard.ZstdCompressor(level=1).compress
    sections = [
        pack(doc_ids.astype("<i8").tobytes()),
        pack(lengths.astype("<u4").tobytes()),
        pack(alphabet.astype("<u2").tobytes()),
        *map(pack, planes),
    ]
    header = json.dumps(
        {
            "part": name[0],
            "seq": name[1],
            "tokens": len(ids),
            "docs": len(doc_ids),
            "nulls": nulls,
            "zeros": zeros,
            "sizes": [len(s) for s in sections],
        }
    ).encode()
    return b"".join([MAGIC, struct.pack("<I", len(header)), header, *sections])


class WaveletMatrix:
    """A shard opened from its file's bytes."""

    def __init__(self, data: bytes):
        import zstandard

        if data[:4] != MAGIC:
            raise ValueError("not a shard")
        (size,) = struct.unpack("<I", data[4:8])
        self.header = json.loads(data[8 : 8 + size])
        self.n, self.zeros = self.header["tokens"], self.header["zeros"]
        unpack, at, parts = zstandard.ZstdDecompressor().decompress, 8 + size, []
        for s in self.header["sizes"]:
            parts.append(unpack(data[at : at + s]))
            at += s
        self.doc_ids = np.frombuffer(parts[0], "<i8")
        self.lengths = np.frombuffer(parts[1], "<u4")
        self.alphabet = np.frombuffer(parts[2], "<u2")
        self.planes = [np.frombuffer(p, np.uint8) for p in parts[3:]]
        self._directory = None

    def decode(self) -> np.ndarray:
        """All ids, from the lowest plane up."""
        codes = np.zeros(self.n, np.uint16)
        for level, (plane, zeros) in enumerate(zip(self.planes[::-1], self.zeros[::-1], strict=True)):
            bits = np.unpackbits(plane, count=self.n, bitorder="little").view(bool)
            above = np.empty(self.n, np.uint16)
            above[~bits] = codes[:zeros]
            above[bits] = codes[zeros:] | np.uint16(1 << level)
            codes = above
        return self.alphabet[codes]

    def _blocks(self, level: int) -> np.ndarray:
        """Ones before each block of a plane."""
        if self._directory is None:
            self._directory = []
            for plane in self.planes:
                size = -(-len(plane) // (BLOCK // 8)) * (BLOCK // 8)
                padded = np.zeros(size, np.uint8)
                padded[: len(plane)] = plane
                ones = np.bitwise_count(padded).reshape(-1, BLOCK // 8).sum(1, dtype=np.int64)
                self._directory.append(np.concatenate([[0], np.cumsum(ones)]))
        return self._directory[level]

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level][i >> 3] >> (i & 7)) & 1

    def _rank1(self, level: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        block, rest = divmod(i, BLOCK)
        ones = int(self._blocks(level)[block])
        if rest:
            begin = block * BLOCK // 8
            part = self.planes[level][begin : begin + -(-rest // 8)]
            ones += int(np.unpackbits(part, count=rest, bitorder="little").sum())
        return ones

    def _select(self, level: int, bit: int, k: int) -> int:
        """Place of the k-th (from 0) one or zero of a plane."""
        before = self._blocks(level)
        if not bit:
            before = np.arange(len(before)) * BLOCK - before
        block = int(np.searchsorted(before, k, "right")) - 1
        begin = block * BLOCK // 8
        bits = np.unpackbits(self.planes[level][begin : begin + BLOCK // 8], bitorder="little")
        return block * BLOCK + int(np.flatnonzero(bits == bit)[k - int(before[block])])

    def access(self, i: int) -> int:
        """The id at place ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        code = 0
        for level, zeros in enumerate(self.zeros):
            bit, ones = self._bit(level, i), self._rank1(level, i)
            code = code << 1 | bit
            i = zeros + ones if bit else i - ones
        return int(self.alphabet[code])

    def _code(self, token: int) -> int | None:
        at = int(np.searchsorted(self.alphabet, token))
        return at if at < len(self.alphabet) and self.alphabet[at] == token else None

    def count(self, token: int, begin: int = 0, end: int | None = None) -> int:
        """Occurrences of ``token`` in a range of places."""
        code, end = self._code(token), self.n if end is None else end
        if code is None:
            return 0
        for level, zeros in enumerate(self.zeros):
            a, b = self._rank1(level, begin), self._rank1(level, end)
            if code >> (len(self.zeros) - 1 - level) & 1:
                begin, end = zeros + a, zeros + b
            else:
                begin, end = begin - a, end - b
        return end - begin

    def find(self, token: int, k: int) -> int | None:
        """Place of the k-th (from 0) occurrence of ``token``."""
        if k < 0 or k >= self.count(token):
            return None
        code, begin = self._code(token), 0
        bits = [code >> (len(self.zeros) - 1 - level) & 1 for level in range(len(self.zeros))]
        for level, (bit, zeros) in enumerate(zip(bits, self.zeros, strict=True)):
            ones = self._rank1(level, begin)
            begin = zeros + ones if bit else begin - ones
        at = begin + k
        for level in range(len(self.zeros) - 1, -1, -1):
            at = self._select(level, bits[level], at - self.zeros[level] if bits[level] else at)
        return at


def _put(uri: str, data: bytes) -> None:
    """Write a file whole or not at all, to the shared folder's file system."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    draft = f"{path.rpartition('/')[0]}/_{uuid.uuid4().hex}"
    with system.open_output_stream(draft) as out:
        out.write(data)
    system.move(draft, path)


def write_shards(df: DataFrame, vocabulary: str, folder: str) -> DataFrame:
    """Encode (``doc_id``, ``text``) and write shards; a row (``part``, ``seq``, ``tokens``, ``docs``) for each."""
    size = df.count()
    digest = F.xxhash64(F.coalesce("text", F.lit("")))
    order = [F.col("doc_id").asc_nulls_first(), F.col("digest")]
    rows = (
        df.select(F.col("doc_id").cast("long").alias("doc_id"), "text", digest.alias("digest"))
        .repartitionByRange(max(1, -(-size // PARTITION_ROWS)), *order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
    )

    def run(batches):
        from pyspark import TaskContext

        part, seq, held = TaskContext.get().partitionId(), 0, []
        enc, tokens = encoder(vocabulary, "words"), 0
        for batch in runs(batches, RUN):  # Arrow alone: pandas would turn long ids with a null into doubles
            none = batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
            keys = batch.column("doc_id").fill_null(0).to_numpy()
            ids, counts = enc.encode_column(batch.column("text"))
            ids = np.insert(ids, np.cumsum(counts), END_ID)
            held.append((ids, keys, counts + 1, none))
            tokens += len(ids)
            if tokens >= SHARD_TOKENS:
                yield _shard(folder, part, seq, held)
                seq, tokens, held = seq + 1, 0, []
        if held:
            yield _shard(folder, part, seq, held)

    return written(rows.mapInArrow(run, "part int, seq int, tokens long, docs long"))


def _shard(folder, part, seq, held):
    ids, keys, counts, none = (np.concatenate(x) for x in zip(*held, strict=True))
    _put(f"{folder}/part-{part:06d}-{seq:06d}.wvm", build(ids, keys, counts, (part, seq), int(none.sum())))
    kinds = ("part", pa.int32()), ("seq", pa.int32()), ("tokens", pa.int64()), ("docs", pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array([x], t) for x, (_, t) in zip((part, seq, len(ids), len(keys)), kinds, strict=True)], schema=pa.schema(kinds)
    )


def shards(spark: SparkSession, folder: str) -> DataFrame:
    """The files of a folder as (``path``, ``content``)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.wvm").load(folder)
    return files.select("path", "content")


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(``part``, ``seq``, ``doc_id``, ``before``, ``n_tokens``, ``ids_crc32``) of each document of the shards;
    ``before`` counts ids of the shard that come earlier."""

    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                shard = WaveletMatrix(content.as_py())
                ids = shard.decode().astype("<u4")
                ends = np.cumsum(shard.lengths, dtype=np.int64)
                starts = ends - shard.lengths
                crcs = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                n = len(starts)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(pa.array(np.full(n, shard.header[k], np.int32)) for k in ("part", "seq")),
                        pa.array(shard.doc_ids, mask=np.arange(n) < shard.header["nulls"]),
                        pa.array(starts),
                        pa.array(shard.lengths.astype(np.int64)),
                        pa.array(crcs, pa.int64()),
                    ],
                    names=["part", "seq", "doc_id", "before", "n_tokens", "ids_crc32"],
                )

    return shards(spark, folder).mapInArrow(
        run, "part int, seq int, doc_id long, before long, n_tokens long, ids_crc32 long"
    )


def find_token(spark: SparkSession, folder: str, token: int, most: int = 10) -> DataFrame:
    """(``part``, ``seq``, ``occurrences``, ``first``): how often a token occurs in each shard, and the places of
    its first ``most`` occurrences, from the planes."""

    def run(batches):
        for batch in batches:
            for content in batch["content"]:
                shard = WaveletMatrix(content)
                n = shard.count(token)
                yield pd.DataFrame(
                    {
                        "part": [shard.header["part"]],
                        "seq": [shard.header["seq"]],
                        "occurrences": [n],
                        "first": [[shard.find(token, k) for k in range(min(n, most))]],
                    }
                )

    return shards(spark, folder).mapInPandas(run, "part int, seq int, occurrences long, first array<long>")


def encode_corpus(df: DataFrame, vocabulary: str) -> DataFrame:
    """Write the shards, read them back: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``.

    Places of shards are a running sum over their list, a row for each file.
    """
    spark = df.sparkSession
    folder = fresh_path(spark, "wavelet")
    made = write_shards(df, vocabulary, folder)
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if made.isEmpty():
        return spark.createDataFrame([], schema)
    running = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    bases = made.select("part", "seq", F.coalesce(F.sum("tokens").over(running), F.lit(0)).alias("base"))
    return (
        written(read_documents(spark, folder), rows=4)
        .join(bases, ["part", "seq"])
        .select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
    )

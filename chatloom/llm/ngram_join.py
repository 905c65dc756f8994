"""N-gram Jaccard join at 0.75, exact: universe partition, pigeonhole, verification.

A text's set holds its distinct shingles of five words. Sets are dealt into bands by size
and compared in windows of two bands (``shingles``). In a window the universe is hashed
into more segments than two partners may differ in, so partners agree in some; windows
with a difference of one index the set and its one-deletion neighbourhood instead.

1. Every set sends its segment signatures, packed as 32-bit keys, to slices of the key
   space. A slice finds the keys that several sets have. A set is active where so many of
   its segments are shared that the others don't exceed the largest difference.
2. Active sets are written. Allocation by cost: each keeps its rarest shared signatures, as
   many as remain of the largest difference plus one after its unshared segments, which
   no partner can have. The rarest signature two partners share is among those of both.
3. Among the sets of a signature the most central one leads; each is verified with its
   leader, exactly. Sets that a verified link connects needn't be compared again; what is
   left apart is compared with the leader's other members, pair by pair, where sizes,
   covers (the shingles that any other active set has) and what each has in common with
   the leader leave a link possible.
4. Links join components (alternating large and small stars).

Equal sets are one class from the start, so copies are never expanded into pairs.

Shingles and sets are told apart by 64-bit digests, classes by 128 bits.

Defined results: null and empty texts have an empty set and link with nothing; a text of
fewer than five words is one shingle; repeated rows and rows with equal ids are members of
the class of their text; null ids are members, too, but never name a component unless a
class has no other id; an empty table gives no rows.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.llm import shingles as sh
from chatloom.llm.common import written
from chatloom.llm.tokens import release
from chatloom.session import materialize

SLICE = 2_500_000  # signatures of a slice, about: some 100 MB in its task
EMIT = 600_000  # signatures a task gathers before it hands them on
BROADCAST_ROWS = 500_000  # ids of 8 bytes
OVERLAP, OF = 75, 100


BLOB = pa.schema(
    [("slice", pa.int32()), *((c, pa.binary()) for c in ("keys", "refs", "wins", "sizes", "needs"))]
)


def _sets_of(batch):
    """(row, set) of an Arrow batch with a ``text`` column."""
    for first, data, edges in sh.batches_of(batch.column("text")):
        for i, s in enumerate(sh.shingle_sets(data, edges)):
            yield first + i, s


def classes(df: DataFrame) -> DataFrame:
    """(``doc_id``, ``h``, ``n``, ``ref``, ``d2``) of each row: ``h`` is a digest of the text, ``ref`` and
    ``d2`` are that of its set, null for an empty one."""

    def run(batches):
        release()
        for batch in batches:
            rows = [(len(s), *(sh.digest(s) if len(s) else (None, None))) for _, s in _sets_of(batch)]
            n, a, b = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("h"),
                    *(pa.array(x, pa.int64()) for x in (n, a, b)),
                ],
                names=["doc_id", "h", "n", "ref", "d2"],
            )

    return df.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_digest().alias("h")).mapInArrow(
        run, "doc_id long, h long, n long, ref long, d2 long"
    )


def text_digest() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


class _Members:
    """Signatures of (set, window) members, gathered until they are handed on by slice."""

    def __init__(self, slices: int):
        self.slices, self.seen = slices, set()
        self._clear()

    def _clear(self):
        self.sigs, self.info, self.n = [], [], 0
        self.seen.clear()

    def add(self, s: np.ndarray):
        ref = sh.digest(s)[0]
        if ref in self.seen:
            return
        self.seen.add(ref)
        for k, most in sh.windows_of(len(s)):
            sigs = sh.signatures(s, k)
            self.sigs.append(sigs)
            # at least so many shared signatures make the set active in the window
            need = 1 if sh.by_deletion(k) else len(sigs) - most
            self.info.append((ref, k, len(sigs), need))
            self.n += len(sigs)

    def hand_on(self):
        if not self.info:
            return
        refs, wins, counts, needs = (np.array(x) for x in zip(*self.info, strict=True))
        sigs = np.concatenate(self.sigs)
        owner = np.repeat(np.arange(len(refs)), counts)
        part = ((sigs >> np.uint64(32)) % np.uint64(self.slices)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        part, owner, keys = part[order], owner[order], sigs[order].astype(np.uint32)
        edge = np.searchsorted(part, np.arange(self.slices + 1))
        told = np.zeros(len(refs), bool)
        rows = []
        for p in range(self.slices):
            a, b = edge[p], edge[p + 1]
            if a == b:
                continue
            own, size = np.unique(owner[a:b], return_counts=True)
            need = np.where(told[own], -1, needs[own])  # told once, in one slice
            told[own] = True
            rows.append(
                (
                    p,
                    keys[a:b].tobytes(),
                    refs[own].astype(np.int64).tobytes(),
                    wins[own].astype(np.int16).tobytes(),
                    size.astype(np.uint32).tobytes(),
                    need.astype(np.int32).tobytes(),
                )
            )
        self._clear()
        yield pa.RecordBatch.from_pylist(
            [dict(zip(BLOB.names, r, strict=True)) for r in rows], schema=BLOB
        )


def _shared(table: pa.Table) -> pa.Table:
    """Per (set, window): how many of its keys in this slice other sets have."""

    def column(name, dtype):
        parts = [np.frombuffer(x.as_py(), dtype) for x in table[name]]
        return np.concatenate(parts) if parts else np.empty(0, dtype)

    refs, wins = column("refs", np.int64), column("wins", np.int16)
    sizes, needs = column("sizes", np.uint32), column("needs", np.int32)
    keys = column("keys", np.uint32)
    order = np.argsort(keys, kind="stable")
    sorted_keys = keys[order]
    del keys
    same = sorted_keys[1:] == sorted_keys[:-1]
    run = np.zeros(len(order), bool)
    run[1:] |= same
    run[:-1] |= same
    owner = np.repeat(np.arange(len(refs), dtype=np.int32), sizes)[order[run]]
    key, ref, win = sorted_keys[run], refs[owner], wins[owner]
    # a set may come from several tasks; it counts once
    by = np.lexsort((win, ref, key))
    key, ref, win = key[by], ref[by], win[by]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (ref[1:] != ref[:-1]) | (win[1:] != win[:-1])
    key, ref, win = key[new], ref[new], win[new]
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, int)
    size = np.diff(np.append(start, len(key)))
    # of several sets: the first and the last ref of the key differ
    several = np.repeat(ref[start] != ref[start + size - 1], size) if len(key) else np.empty(0, bool)
    counts = (
        pd.DataFrame({"ref": ref[several], "win": win[several], "shared": 1})
        .groupby(["ref", "win"], sort=False)["shared"]
        .sum()
        .reset_index()
    )
    told = needs >= 0
    counts["need"] = -1
    tell = pd.DataFrame({"ref": refs[told], "win": wins[told], "shared": 0, "need": needs[told]})
    out = pd.concat([counts, tell], ignore_index=True)
    return pa.Table.from_pandas(
        out.astype({"ref": "int64", "win": "int16", "shared": "int32", "need": "int32"})[["ref", "win", "shared", "need"]],
        preserve_index=False,
    )


def active(df: DataFrame, slices: int) -> DataFrame:
    """(``ref``) of sets that may have a partner, from all texts."""

    def run(batches):
        members = _Members(slices)
        for batch in batches:
            for _, s in _sets_of(batch):
                if len(s):
                    members.add(s)
                    if members.n >= EMIT:
                        yield from members.hand_on()
        yield from members.hand_on()

    blobs = df.select("text").mapInArrow(
        run, "slice int, keys binary, refs binary, wins binary, sizes binary, needs binary"
    )
    counts = blobs.groupBy("slice").applyInArrow(_shared, "ref long, win short, shared int, need int")
    total = counts.groupBy("ref", "win").agg(F.sum("shared").alias("shared"), F.max("need").alias("need"))
    return total.where((F.col("shared") > 0) & (F.col("shared") >= F.col("need"))).select("ref").distinct()


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    return F.broadcast(df) if df.count() <= rows else df


def active_sets(df: DataFrame, own: DataFrame, refs: DataFrame) -> DataFrame:
    """(``ref``, ``n``, ``s``): sorted shingles as bytes, once for each active set.

    One document stands for a class; only the texts of such documents are read again.
    """
    picked = materialize(
        own.join(refs, "ref", "left_semi").groupBy("ref").agg(F.min("doc_id").alias("pick")).where("pick is not null")
    )
    unnamed = own.join(refs, "ref", "left_semi").groupBy("ref").agg(F.min("doc_id").alias("m")).where("m is null")
    ids = small(picked.select(F.col("pick").alias("doc_id")))
    texts = df.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    named = texts.join(ids, "doc_id", "left_semi")
    nameless = texts.where("doc_id is null")
    wanted = picked.select("ref").unionByName(unnamed.select("ref"))

    def run(batches):
        for batch in batches:
            rows = [(sh.digest(s)[0], len(s), s.tobytes()) for _, s in _sets_of(batch) if len(s)]
            if rows:
                ref, n, s = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ref, pa.int64()), pa.array(n, pa.int64()), pa.array(s, pa.binary())],
                    names=["ref", "n", "s"],
                )

    sets = named.unionByName(nameless).select("text").mapInArrow(run, "ref long, n long, s binary")
    return sets.join(wanted, "ref", "left_semi").dropDuplicates(["ref"])


def covered_sets(sets: DataFrame) -> DataFrame:
    """Add ``cover``, the shingles of a set that another active set has, too; sets go whose
    cover is too small for any partner.

    A partner shares no shingle beyond the cover of either side, which bounds a pair's
    intersection before anything of it is read.
    """

    def run(batches):
        for batch in batches:
            for ref, blob in zip(batch.column("ref").to_pylist(), batch.column("s").to_pylist(), strict=True):
                s = np.frombuffer(blob, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s), pa.array(np.full(len(s), ref, np.int64))], names=["h", "ref"]
                )

    single = (
        sets.select("ref", "s")
        .mapInArrow(run, "h long, ref long")
        .groupBy("h")
        .agg(F.count(F.lit(1)).alias("times"), F.min("ref").alias("ref"))
        .where("times = 1")
        .groupBy("ref")
        .agg(F.count(F.lit(1)).alias("own"))
    )
    out = sets.join(single, "ref", "left").withColumn("cover", F.col("n") - F.coalesce("own", F.lit(0)))
    return out.where(OF * F.col("cover") >= OVERLAP * F.col("n")).drop("own")


def possible(n, cover, other_n, other_cover) -> Column:
    """Whether sizes and covers of two sets leave a link possible."""
    most = F.least(F.col(cover), F.col(other_cover))
    return OF * most >= OVERLAP * (F.col(n) + F.col(other_n) - most)


def kept_signatures(sets: DataFrame) -> DataFrame:
    """(``sig``, ``ref``, ``n``, ``cover``, ``central``): the signatures that allocation keeps.

    Segments that no other active set has come first and cost nothing. ``central`` sums the
    frequencies of a set's signatures: the set that most others were made from has the
    largest.
    """

    def run(batches):
        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("ref", "s", "cover"))
            for ref, blob, cover in zip(*columns, strict=True):
                s = np.frombuffer(blob, np.uint64)
                for k, most in sh.windows_of(len(s)):
                    sigs = sh.signatures(s, k)
                    budget = len(sigs) if sh.by_deletion(k) else most + 1
                    out.append((sigs.view(np.int64), ref, k, len(s), len(sigs), budget, cover))
                    if sum(len(x[0]) for x in out[-64:]) > EMIT // 4:
                        yield _rows(out)
                        out = []
            if out:
                yield _rows(out)

    rows = sets.select("ref", "s", "cover").mapInArrow(
        run, "sig long, ref long, win short, n int, total int, budget int, cover int"
    )
    rows = written(rows)
    freq = rows.groupBy("sig").agg(F.count(F.lit(1)).alias("freq")).where("freq > 1")
    shared = rows.join(freq, "sig")
    member = Window.partitionBy("ref", "win")
    order = member.orderBy("freq", "sig")
    return (
        shared.withColumn("alone", F.col("total") - F.count(F.lit(1)).over(member))
        .withColumn("central", F.sum("freq").over(member))
        .withColumn("place", F.row_number().over(order))
        .where(
            F.when(F.col("budget") == F.col("total"), True).otherwise(
                F.col("place") + F.col("alone") <= F.col("budget")
            )
        )
        .select("sig", "ref", "n", "cover", "central")
    )


def _rows(out):
    sizes = [len(x[0]) for x in out]
    each = lambda i, t: pa.array(np.repeat(np.array([x[i] for x in out], t), sizes))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([x[0] for x in out])),
            each(1, np.int64),
            each(2, np.int16),
            each(3, np.int32),
            each(4, np.int32),
            each(5, np.int32),
            each(6, np.int32),
        ],
        names=["sig", "ref", "win", "n", "total", "budget", "cover"],
    )


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(``a``, ``b``, ``common``, ``na``, ``nb``) of distinct pairs, with the exact intersection."""
    left = sets.select(F.col("ref").alias("a"), F.col("s").alias("sa"))
    right = sets.select(F.col("ref").alias("b"), F.col("s").alias("sb"))

    def run(batches):
        last, prev = None, None
        for batch in batches:
            rows = []
            for a, b, sa, sb in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "sa", "sb")), strict=True):
                if last != b:
                    last, prev = b, np.frombuffer(sb, np.uint64)
                x = np.frombuffer(sa, np.uint64)
                at = np.searchsorted(prev, x)
                at[at == len(prev)] = 0
                rows.append((a, b, int((prev[at] == x).sum()), len(x), len(prev)))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["a", "b", "common", "na", "nb"]
                )

    return pairs.join(left, "a").join(right, "b").mapInArrow(
        run, "a long, b long, common long, na long, nb long"
    )


def linked() -> Column:
    return OF * F.col("common") >= OVERLAP * (F.col("na") + F.col("nb") - F.col("common"))


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(``ref``, ``root``): alternating large-star and small-star rounds over (``a``, ``b``).

    Ends when a round changes nothing; each round is written, so lineage stays short.
    """
    edges = links.select("a", "b").where("a <> b").distinct()
    edges = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")))
    before = None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        m = large.groupBy("u").agg(F.min("v").alias("m"))
        small_ = large.join(m, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        edges = materialize(small_.where("u <> v").distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components not settled after {rounds} rounds")
    roots = edges.select(F.col("u").alias("ref"), F.col("v").alias("root"))
    return materialize(
        roots.unionByName(roots.select(F.col("root").alias("ref"), "root")).distinct()
    )


def all_links(sets: DataFrame) -> DataFrame:
    """(``a``, ``b``) that join all sets of a similarity of at least 0.75 into components."""
    kept = materialize(kept_signatures(sets))
    lead = (
        kept.groupBy("sig")
        .agg(F.min(F.struct((-F.col("central")).alias("c"), "ref", "n", "cover")).alias("l"), F.count(F.lit(1)).alias("size"))
        .where("size > 1")
        .select("sig", F.col("l.ref").alias("lead"), F.col("l.n").alias("ln"), F.col("l.cover").alias("lc"))
    )
    # Members of a leader, once for all the signatures that they have in common with it.
    runs = materialize(kept.join(lead, "sig").select("lead", "ln", "lc", "ref", "n", "cover").distinct())
    pair = lambda x, y: (F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
    star = runs.where((F.col("ref") != F.col("lead")) & possible("n", "cover", "ln", "lc"))
    first = written(verify(star.select(*pair("ref", "lead")).distinct(), sets))
    links = first.where(linked()).select("a", "b")
    comp = components(links)

    # What is left apart: members of another component than their leader's.
    lead_root = comp.select(F.col("ref").alias("lead"), F.col("root").alias("lead_root"))
    known = first.select("a", "b", "common")
    both = known.unionByName(known.select(F.col("b").alias("a"), F.col("a").alias("b"), "common"))
    place = materialize(
        runs.join(comp, "ref", "left")
        .join(lead_root, "lead", "left")
        .join(both.select(F.col("a").alias("ref"), F.col("b").alias("lead"), "common"), ["ref", "lead"], "left")
        .select(
            "lead",
            "ref",
            "n",
            "cover",
            F.coalesce("root", "ref").alias("root"),
            F.coalesce("lead_root", "lead").alias("lead_root"),
            # shingles in common with the leader, and those beyond it that another set may have
            F.when(F.col("ref") == F.col("lead"), F.col("n")).otherwise(F.col("common")).alias("inside"),
            F.when(F.col("ref") == F.col("lead"), 0)
            .otherwise(F.col("cover") - F.col("common"))
            .alias("beyond"),
        )
    )
    side = lambda c: [F.col(x).alias(f"{c}_{x}") for x in ("ref", "n", "cover", "root", "inside", "beyond")]
    away = F.col("root") != F.col("lead_root")
    left = place.where(away).select("lead", *side("x"))
    # what two sets share lies in the leader or beyond it
    most = F.least("x_inside", "y_inside") + F.least("x_beyond", "y_beyond")
    near = OF * most >= OVERLAP * (F.col("x_n") + F.col("y_n") - most)
    pairs = left.join(place.select("lead", *side("y"), away.alias("y_away")), "lead").where(
        (F.col("x_root") != F.col("y_root"))
        & (~F.col("y_away") | (F.col("x_ref") < F.col("y_ref")))
        & possible("x_n", "x_cover", "y_n", "y_cover")
        & F.coalesce(near, F.lit(True))
    )
    pairs = pairs.select(*pair("x_ref", "y_ref")).distinct().join(known, ["a", "b"], "left_anti")
    second = written(verify(pairs, sets))
    return links.unionByName(second.where(linked()).select("a", "b"))


def join(df: DataFrame) -> DataFrame:
    """(``doc_id``, ``h``, ``n_shingles``, ``root``, ``component_id``) of each row; ``root`` numbers
    components and is null for an empty set."""
    own = written(classes(df))
    total = own.agg(F.sum("n")).first()[0] or 0
    refs = written(active(df, max(1, -(-total // SLICE))))
    sets = written(covered_sets(written(active_sets(df, own, refs))))
    roots = components(all_links(sets))
    named = own.where("ref is not null").groupBy("ref", "d2").agg(F.min("doc_id").alias("first"))
    # a class outside all links is its own root
    rooted = named.join(roots, "ref", "left").withColumn("root", F.coalesce("root", "ref"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    final = rooted.join(least, "root").select("ref", "d2", "root", "component_id")
    out = own.join(final, ["ref", "d2"], "left")
    return out.select(
        "doc_id",
        "h",
        F.col("n").alias("n_shingles"),
        "root",
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )


def one_of_each(df: DataFrame) -> DataFrame:
    """The rows of ``df`` less all but one of each component: the one of the smallest id.

    Rows are dropped by (id, digest of the text), a list of 16-byte keys that is
    broadcast while it is small. Only rows that are repeated as a whole are shuffled.
    """
    found = materialize(join(df)).where("root is not null")
    keys = found.groupBy("root", "doc_id", "h").agg(F.count(F.lit(1)).alias("times"))
    first = keys.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")).alias("f")
    )
    keys = materialize(
        keys.join(first, "root").select(
            F.col("doc_id").alias("_id"),
            F.col("h").alias("_h"),
            "times",
            (F.col("doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("h") == F.col("f.h"))).alias("stays"),
        )
    )
    rows = df.select(
        F.struct("*").alias("_row"), F.col("doc_id").cast("long").alias("_doc"), text_digest().alias("_text")
    )
    same = F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_h"))
    kept = rows.join(small(keys.where(~F.col("stays")).select("_id", "_h")), same, "left_anti")
    again = small(keys.where("stays and times > 1").select("_id", "_h"))
    once = kept.join(again, same, "left_anti")
    several = kept.join(again, same, "left_semi").dropDuplicates(["_doc", "_text"])
    return once.unionByName(several).select("_row.*")

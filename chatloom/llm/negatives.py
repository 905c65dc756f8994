"""Hard negatives by a multiway hyperplane tree (GNAT style), exact.

Scores are inner products of whole numbers. With ``M`` at least every row's length, a row
gets one more coordinate that brings its length to ``M``, and an anchor's extra coordinate
is zero; then ``distance^2 = |anchor|^2 + M^2 - 2 * score``, so a window of scores is an
annulus around the anchor in a metric space.

Tree. A bounded sample of the rows (``SAMPLE``) gives its split points: at each node,
candidates far from those already taken. A row goes to the nearest split point, down to a
leaf; all rows are dealt, and a leaf's rows lie in blocks of about ``BLOCK`` rows, so
a leaf of very many rows, such as copies of one vector, is many blocks. With every split
point on a row's way, and its siblings, stand the least and the largest distance of
the block's rows to it, taken from all of its rows. A block in whose ranges no row can be
in a window's annulus, by the triangle inequality for any of the split points, is left out
for that anchor; in the others all scores are computed.

Search. Anchors are a stated query set: blocks of them meet blocks of rows in bounded groups
of (block of anchors, share of the blocks). A group keeps the best rows of each window so
far, whose worst one narrows the window for the blocks that follow, and hands on these
alone; shares are searched in rounds, each of which narrows the windows of the next. First
the positives (same label, any score), then the negatives of each positive's window
(another label).

Defined results: rows without label, without vector, or with a null or non-finite component
take no part, nor do rows without id, or with a component of 16,384 and more in size (its
scores might not fit a long). Where an id is divisible by ``relabel``, the label first
becomes the next of ``labels``. A shorter vector counts as filled with zeros. Rows repeated
as a whole count once; rows that share an id but not the rest are rows of their own, yet
never each other's positive. A positive score below zero has no window, zero has the score zero
alone. Fewer partners than asked for give fewer rows. An empty table gives none. Other
columns stay out of the way.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.llm.common import written
from chatloom.session import materialize

SAMPLE = 20_000  # rows that the split points are chosen from, about
FANOUT = 16  # split points of a node
BLOCK = 2_048  # rows of a block, about
SHARE = 256  # blocks of a group: half a million rows
ROUND = 4  # growth of the shares that a round searches
QUERIES = 8_192  # anchors of a block
LARGEST = 1 << 22  # of a component, in size
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH, OF = 30, 90, 100

_NONE = np.iinfo(np.int64).min


def usable(df: DataFrame, relabel: int = 7, labels: int = 10) -> DataFrame:
    """(``vec_id``, ``label``, ``v``) of the rows that take part, ``v`` as whole numbers."""
    x = F.transform("embedding", lambda c: F.floor(c.cast("double") * 256))
    fine = F.forall(
        "embedding", lambda c: F.coalesce(F.abs(c.cast("double")) < LARGEST // 256, F.lit(False))
    )
    moved = F.when(F.col("vec_id") % relabel == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding")
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull())
    return rows.where(fine).select("vec_id", moved.alias("label"), x.cast("array<int>").alias("v")).distinct()


def _matrix(column, width: int) -> np.ndarray:
    """Rows of an Arrow list column, filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


class Tree:
    """Split points and where they lead. A node is the list of its split points; ``child`` of
    a split point is a node, or a leaf number as -1 - leaf."""

    def __init__(self, sample: np.ndarray, reach: float, leaf: float, seed: int = 1):
        """``leaf``: a node of fewer sample rows is a leaf."""
        self.leaf = max(leaf, 2 * FANOUT)
        self.points: list[np.ndarray] = []
        self.nodes: list[list[int]] = []
        self.child: list[int] = []
        self.leaves = 0
        self.way: dict[int, list[int]] = {}  # of a leaf: its split points' siblings, all levels
        rng = np.random.default_rng(seed)
        x = lifted(sample, reach) if len(sample) else np.zeros((1, 2))
        self._grow(np.unique(x, axis=0), [], rng)

    def _grow(self, x, way, rng) -> int:
        """The node's number, or that of its leaf."""
        if len(x) < self.leaf:
            if not self.nodes:  # all in one leaf: one split point, for its ranges
                self.nodes.append([0])
                self.points.append(x[0])
                self.child.append(-1)
                self.way[0] = [0]
                self.leaves = 1
                return 0
            self.leaves += 1
            self.way[self.leaves - 1] = way
            return -self.leaves
        some = x[rng.permutation(len(x))[: 8 * FANOUT]]
        taken, far = [0], np.linalg.norm(some - some[0], axis=1)
        while len(taken) < FANOUT:
            taken.append(int(far.argmax()))
            far = np.minimum(far, np.linalg.norm(some - some[taken[-1]], axis=1))
        node, first = len(self.nodes), len(self.points)
        own = list(range(first, first + FANOUT))
        self.nodes.append(own)
        self.points += list(some[taken])
        self.child += [0] * FANOUT
        near = distances(x, some[taken]).argmin(1)
        for k in range(FANOUT):
            self.child[first + k] = self._grow(x[near == k], way + own, rng)
        return node

    def close(self) -> "Tree":
        self.points = np.array(self.points)
        return self

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each lifted row."""
        at, leaf = np.zeros(len(x), np.int64), np.full(len(x), -1)
        child = np.array(self.child)
        while (open_ := np.flatnonzero(leaf < 0)).size:
            for node in np.unique(at[open_]):
                rows = open_[at[open_] == node]
                own = np.array(self.nodes[node])
                to = child[own[distances(x[rows], self.points[own]).argmin(1)]]
                done = to < 0
                leaf[rows[done]] = -1 - to[done]
                at[rows[~done]] = to[~done]
        return leaf


def lifted(v: np.ndarray, reach: float) -> np.ndarray:
    """Rows with one more coordinate, all of length ``reach``."""
    rest = np.sqrt(np.maximum(reach * reach - (v * v).sum(1), 0))
    return np.concatenate([v, rest[:, None]], axis=1)


def distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    square = (x * x).sum(1)[:, None] + (points * points).sum(1)[None, :] - 2 * x @ points.T
    return np.sqrt(np.maximum(square, 0))


BLOCKS = "leaf int, n int, ids binary, labels binary, vectors binary, low binary, high binary"


def blocks(rows: DataFrame, width: int, reach: float, sample: int = SAMPLE, block: int = BLOCK):
    """The tree and its table of blocks: ids, labels, vectors and ranges, as bytes."""
    n = rows.count()
    some = rows.where(F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(max(n, 1))) < sample).select("v").limit(2 * sample)
    some = _matrix(some.toArrow().column("v"), width)
    tree = Tree(some, reach, block * len(some) / max(n, 1)).close()

    def deal(batches):
        for batch in batches:
            leaf = tree.leaf_of(lifted(_matrix(batch.column("v"), width), reach)) if len(batch) else np.empty(0, int)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(leaf.astype(np.int32))], names=["vec_id", "label", "v", "leaf"]
            )

    dealt = materialize(rows.mapInArrow(deal, "vec_id long, label long, v array<int>, leaf int"))
    # as many shares of a leaf as its rows fill blocks; a row for each leaf of the tree at most
    fills = {r.leaf: -(-r["count"] // block) for r in dealt.groupBy("leaf").count().collect()}
    share = F.element_at(F.array(*[F.lit(fills.get(k, 1)) for k in range(tree.leaves)]), F.col("leaf") + 1)
    key = F.pmod(F.xxhash64("vec_id", "label"), share).cast("int")

    def build(table):
        table = table.sort_by([("vec_id", "ascending"), ("label", "ascending")])
        v = _matrix(table.column("v"), width)
        leaf = table.column("leaf")[0].as_py()
        to = distances(lifted(v, reach), tree.points[tree.way[leaf]])
        return pa.table(
            {
                "leaf": pa.array([leaf], pa.int32()),
                "n": pa.array([len(v)], pa.int32()),
                "ids": [table.column("vec_id").to_numpy().tobytes()],
                "labels": [table.column("label").to_numpy().tobytes()],
                "vectors": [v.astype(np.int32).tobytes()],
                "low": [to.min(0).tobytes()],
                "high": [to.max(0).tobytes()],
            }
        )

    built = materialize(dealt.withColumn("share", key).groupBy("leaf", "share").applyInArrow(build, BLOCKS))
    return tree, built


class Best:
    """The best ``k`` (score, id) of each window so far, ties by smaller id."""

    def __init__(self, windows: int, k: int):
        self.score = np.full((k, windows), _NONE)
        self.id = np.full((k, windows), np.iinfo(np.int64).max)

    def floor(self) -> np.ndarray:
        """The score that a row must reach to count."""
        return self.score[-1]

    def add(self, columns: np.ndarray, score: np.ndarray, ids: np.ndarray):
        score = np.concatenate([self.score[:, columns], score])
        ids = np.concatenate([self.id[:, columns], ids])
        order = np.lexsort((ids, ~score), axis=0)[: len(self.score)]
        self.score[:, columns] = np.take_along_axis(score, order, 0)
        self.id[:, columns] = np.take_along_axis(ids, order, 0)


class Search:
    """Windows of one block of anchors over blocks of rows."""

    def __init__(self, tree: Tree, reach: float, vectors, ids, labels, owner, low, high, same: bool, k: int):
        """``owner`` is each window's anchor, sorted; ``low`` and ``high`` are its scores, inclusive."""
        self.tree, self.vectors, self.ids, self.labels = tree, vectors, ids, labels
        self.owner, self.low, self.high, self.same = owner, low, high, same
        self.best = Best(len(owner), k)
        square = (vectors * vectors).sum(1)
        self.square = (square + reach * reach)[owner]
        anchors = np.concatenate([vectors, np.zeros((len(vectors), 1))], axis=1)
        self.to = distances(anchors, tree.points)
        self.slack = 1e-6 * (1 + np.sqrt(square) + reach)  # of computed distances

    def _open(self, way, low, high) -> np.ndarray:
        """Windows whose annulus meets every range of a block."""
        to = self.to[:, way]
        near = np.maximum(to - high, low - to).max(1) - self.slack
        far = (to + high).min(1) + self.slack
        least = np.maximum(self.low, self.best.floor())
        outer = np.sqrt(np.maximum(self.square - 2 * least.astype(float), 0))
        inner = np.sqrt(np.maximum(self.square - 2 * self.high.astype(float), 0))
        return np.flatnonzero((self.low <= self.high) & (near[self.owner] <= outer) & (far[self.owner] >= inner))

    def block(self, leaf, ids, labels, vectors, low, high):
        open_ = self._open(self.tree.way[leaf], low, high)
        n, k = len(ids), len(self.best.score)
        place = (n - 1 - np.arange(n))[:, None]  # rows are sorted by id: of equal scores the first is the best
        for a in range(0, len(open_), 512):
            some = open_[a : a + 512]
            who, column = np.unique(self.owner[some], return_inverse=True)
            score = (vectors @ self.vectors[who].T).astype(np.int64)
            if self.same:
                fits = (labels[:, None] == self.labels[who]) & (ids[:, None] != self.ids[who])
            else:
                fits = labels[:, None] != self.labels[who]
            score = np.where(fits, score, _NONE)
            for k0 in range(0, len(some), 128):
                own, at = some[k0 : k0 + 128], column[k0 : k0 + 128]
                s = score[:, at]
                least = np.maximum(self.low[own], self.best.floor()[own])
                key = np.where((s >= least) & (s <= self.high[own]) & (s != _NONE), s * n + place, _NONE)
                if n > k:
                    key = np.partition(key, n - k, axis=0)[n - k :]
                none = key == _NONE
                rows = n - 1 - key % n
                self.best.add(own, np.where(none, _NONE, key // n), np.where(none, np.iinfo(np.int64).max, ids[rows]))

    def found(self):
        """(window, score, id) of all that were found."""
        rank, window = np.nonzero(self.best.score != _NONE)
        return window, self.best.score[rank, window], self.best.id[rank, window]


def _arrays(row, width):
    n = row["n"]
    return (
        row["leaf"],
        np.frombuffer(row["ids"], np.int64),
        np.frombuffer(row["labels"], np.int64),
        np.frombuffer(row["vectors"], np.int32).reshape(n, width).astype(np.float64),
        np.frombuffer(row["low"]),
        np.frombuffer(row["high"]),
    )


def search(windows: DataFrame, tree: Tree, table: DataFrame, width: int, reach: float, same: bool, k: int) -> DataFrame:
    """(``anchor``, ``window``, ``row_id``, ``score``): the best ``k`` rows of each window by each group.

    ``windows`` is written: ``anchor`` (a digest), ``anchor_id``, ``anchor_label``, ``v`` and the arrays ``low`` and ``high``.
    """
    askers = max(1, -(-windows.count() // QUERIES))
    shares = [r.share for r in table.select("share").distinct().collect()]  # numbers of groups
    asker = F.pmod("anchor", F.lit(askers)).cast("int")
    left = windows.withColumn("asker", asker).withColumn("share", F.explode(F.array(*map(F.lit, shares)).cast("array<int>")))
    right = table.withColumn("asker", F.explode(F.sequence(F.lit(0), F.lit(askers - 1))))
    schema = pa.schema([(c, pa.int64()) for c in ("anchor", "window", "row_id", "score")])
    columns = ("leaf", "n", "ids", "labels", "vectors", "low", "high")

    def run(asking, rows):
        if not len(asking) or not len(rows):
            return schema.empty_table()
        anchor, ids, labels = (asking.column(c).to_numpy() for c in ("anchor", "anchor_id", "anchor_label"))
        low, high = (asking.column(c).combine_chunks() for c in ("low", "high"))
        sizes = low.value_lengths().to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(len(ids)), sizes)
        window = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        ends = (x.flatten().to_numpy(zero_copy_only=False) for x in (low, high))
        own = Search(tree, reach, _matrix(asking.column("v"), width), ids, labels, owner, *ends, same, k)
        for i in range(len(rows)):
            own.block(*_arrays({c: rows.column(c)[i].as_py() for c in columns}, width))
        w, score, row = own.found()
        return pa.table([anchor[owner[w]], window[w] + 1, row, score], schema=schema)

    kind = "anchor long, window long, row_id long, score long"
    return left.groupBy("asker", "share").cogroup(right.groupBy("asker", "share")).applyInArrow(run, kind)


def first(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` rows of each window of all groups, with ``rank`` from 1."""
    window = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "row_id")
    return found.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def best(windows: DataFrame, tree: Tree, table: DataFrame, width: int, reach: float, same: bool, k: int) -> DataFrame:
    """The best ``k`` rows of each window, as a written table: ``search`` over growing numbers of
    shares. What a round has found narrows the windows of the next one, so that the
    rows handed on stay few, whatever the number of shares."""
    shares = max(1, -(-table.count() // SHARE))
    table = table.withColumn("share", F.pmod(F.xxhash64("leaf", "ids"), F.lit(shares)).cast("int"))
    done, to, out = 0, 1, None
    while done < shares:
        part = table.where((F.col("share") >= done) & (F.col("share") < to))
        found = search(windows, tree, part, width, reach, same, k)
        if out is not None:
            found = found.unionByName(out.drop("rank"))
        out = materialize(first(found, k))
        done, to = to, to * ROUND
        if done < shares:
            floors = out.where(F.col("rank") == k).groupBy("anchor").agg(
                F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("floor")  # one of each window
            )
            floor = lambda x, i: F.greatest(x, F.try_element_at("floor", (i + 1).cast("long")))
            windows = materialize(
                windows.join(floors, "anchor", "left").withColumn("low", F.transform("low", floor)).drop("floor")
            )
    return out


def _floor(numerator: str) -> Column:
    return F.expr(f"({numerator} - pmod({numerator}, {OF})) div {OF}")


def mine(df: DataFrame, every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """(``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``) of ``df`` (``vec_id``,
    ``embedding``, ``label``); rows whose id is divisible by ``every`` are the anchors."""
    rows = written(usable(df))
    size = rows.agg(
        F.max(F.size("v")).alias("width"),
        F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)).alias("square"),
    ).first()
    width, reach = max(size["width"] or 1, 1), float(np.sqrt(size["square"] or 0)) * (1 + 1e-9) + 1
    tree, table = blocks(rows, width, reach)
    anchors = rows.where(F.col("vec_id") % every == 0).select(
        F.xxhash64("vec_id", "label", "v").alias("anchor"),
        F.col("vec_id").alias("anchor_id"),
        F.col("label").alias("anchor_label"),
        "v",
    )
    whole = [F.array(F.lit(x).cast("long")).alias(c) for c, x in (("low", -(1 << 61)), ("high", 1 << 61))]
    near = best(materialize(anchors.select("*", *whole)), tree, table, width, reach, True, positives)
    # 30 p <= 100 n <= 90 p over whole numbers
    low, high = -_floor(f"(-{LOW} * score)"), _floor(f"({HIGH} * score)")
    ranges = near.groupBy("anchor").agg(
        F.sort_array(F.collect_list(F.struct(F.col("rank"), low.alias("low"), high.alias("high")))).alias("r")
    )
    windows = anchors.join(ranges, "anchor").select(
        "anchor", "anchor_id", "anchor_label", "v", F.col("r.low").alias("low"), F.col("r.high").alias("high")
    )
    found = best(materialize(windows), tree, table, width, reach, False, negatives)
    named = near.select(
        "anchor",
        F.col("rank").cast("long").alias("window"),
        F.col("row_id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    return (
        found.join(named, ["anchor", "window"])
        .join(anchors.select("anchor", "anchor_id"), "anchor")
        .select(
            "anchor_id",
            "positive_id",
            F.col("rank").cast("int").alias("rank"),
            F.col("row_id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
    )

"""Benchmark decontamination by a prefix-filtered set join.

A window is 13 consecutive words of a benchmark item, or all of a shorter item. Its set
is made of word shingles. A document holds a window only if it holds all of its shingles,
so for containment 1 the necessary prefix of a window, its shingles by rarity, is the
rarest one. Rarity is counted over all documents.

1. One pass over the documents cuts them into words and keeps the places of shingles that
   some window has, and a row with each document's number of words. Shingles are made in the
   row and looked up in a table of digests; neither words nor texts go on.
2. Rarity and prefixes come from that table. Places of prefix shingles give candidates; a
   positional bound (the window must begin and end inside the document) comes first.
3. Documents with a candidate are read again, and the words at its place are compared
   with the window's, as text.

Defined results: null and empty texts have no words and no hits; items without words
have no windows; null item ids count as no item; repeated documents get equal results,
repeated items count once; other columns stay out of the way.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import NOT_ITEM_WORD, ascii_lower, whole, words
from chatloom.session import materialize

WINDOW = 13
SHINGLE = 5  # words; a shorter window is its own shingle
BROADCAST_ROWS = 500_000  # rows of at most 40 bytes
LAST = 0  # stands behind a document's shingles; its row keeps the number of words


def item_words(text: str) -> Column:
    return words(ascii_lower(whole(text)), NOT_ITEM_WORD)


def digest(w: Column, start: Column, n: int) -> Column:
    """64-bit digest of ``n`` words from the 1-based ``start``."""
    return F.xxhash64(F.lit(n), *[F.element_at(w, start + i) for i in range(n)])


def shingles(w: Column, n: int) -> Column:
    return F.when(F.size(w) < n, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: digest(w, i, n))
    )


def windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows of each item: (``item``, ``w``, ``len``)."""
    rows = items.select(
        F.col("item_id").cast("string").alias("item"), item_words("text").alias("iw")
    ).where((F.size("iw") > 0) & F.col("item").isNotNull())
    size = F.least(F.lit(window), F.size("iw"))
    return (
        rows.select(
            "item",
            "iw",
            size.alias("len"),
            F.explode(F.sequence(F.lit(1), F.size("iw") - size + 1)).alias("at"),
        )
        .select("item", F.slice("iw", F.col("at"), F.col("len")).alias("w"), "len")
        .distinct()
    )


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, whose rows have a greatest size, marked for broadcast if it has at most ``rows`` rows."""
    return F.broadcast(df) if df.count() <= rows else df


def text_digest(text: str = "text") -> Column:
    return F.xxhash64(whole(text))


def _before(n: Column, sizes: list[int], k: Column) -> Column:
    """How many shingles of a text of ``n`` words stand before those of ``k`` words."""
    less = [F.when(k > size, F.greatest(n - (size - 1), F.lit(0))).otherwise(0) for size in sizes]
    return sum(less, F.lit(0))


def places(docs: DataFrame, known: DataFrame, sizes: list[int], text: str) -> DataFrame:
    """(``doc_id``, ``_digest``, ``n``, ``pos``, ``h``) of shingles in ``known`` (``h``), and a row of each
    document, behind its shingles. The one pass over all texts; written."""
    own = docs.select("doc_id", text_digest(text).alias("_digest"), item_words(text).alias("w"))
    hashes = F.concat(*[shingles(F.col("w"), k) for k in sizes], F.array(F.lit(LAST).cast("long")))
    rows = own.select("doc_id", "_digest", F.size("w").alias("n"), F.posexplode(hashes).alias("pos", "h"))
    last = docs.sparkSession.range(1).select(F.lit(LAST).cast("long").alias("h"))
    return materialize(rows.join(small(materialize(known.unionByName(last).distinct())), "h"))


def hits(docs: DataFrame, items: DataFrame, window: int = WINDOW, text: str = "text"):
    """(``doc_id``, ``_digest``, ``n``) of each document, and (``doc_id``, ``_digest``, ``start``, ``len``, ``item``) for each
    window that it holds; two tables."""
    held = windows(items, window).select("item", "len", "w", F.array_join("w", " ").alias("s"))
    held = materialize(held)
    one = held.select("s", "w", "len").dropDuplicates(["s", "len"])
    sizes = sorted({min(SHINGLE, r["len"]) for r in one.select("len").distinct().collect()}) or [SHINGLE]
    k = F.least(F.lit(SHINGLE), F.col("len"))
    hashes = F.coalesce(*[F.when(k == size, shingles(F.col("w"), size)) for size in sizes])
    tokens = materialize(one.select("s", "len", F.posexplode(hashes).alias("offset", "h")))
    found = places(docs, tokens.select("h"), sizes, text)
    n = F.col("n")
    behind = _before(n, sizes, F.lit(SHINGLE + 1))
    every = found.where(F.col("pos") == behind).select("doc_id", "_digest", "n")
    found = found.where(F.col("pos") < behind)
    rarity = found.groupBy("h").agg(F.count(F.lit(1)).alias("df"))
    # The rarest shingle of each window; a window with a shingle that no document has can't occur.
    prefix = materialize(
        tokens.join(rarity, "h", "left")
        .groupBy("s", "len")
        .agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "offset", "h")).alias("p"))
        .where("p.df > 0")
        .select(F.col("p.h").alias("h"), F.col("p.offset").alias("offset"), "len")
        .distinct()
    )
    start = F.col("pos") - _before(n, sizes, k) - F.col("offset")
    candidates = (
        found.join(small(prefix), "h")
        .select("doc_id", "_digest", "n", start.alias("start"), "len")
        .where((F.col("start") >= 0) & (F.col("start") + F.col("len") <= n))
        .groupBy(F.col("doc_id").alias("_id"), F.col("_digest").alias("_d"))
        .agg(F.collect_set(F.struct("start", "len")).alias("at"))
    )
    candidates = materialize(candidates)
    # The keys are looked up before any text is moved.
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_digest") == F.col("_d"))
    named = docs.select("doc_id", text_digest(text).alias("_digest"), F.col(text).alias("text"))
    again = named.join(small(candidates.select("_id", "_d")), same, "left_semi").dropDuplicates(["doc_id", "_digest"])
    cut = F.transform(
        "at", lambda c: F.struct(c["start"].alias("start"), c["len"].alias("len"), F.array_join(F.slice("w", c["start"] + 1, c["len"]), " ").alias("s"))
    )
    texts = (
        again.join(candidates, same)
        .select("doc_id", "_digest", "at", item_words("text").alias("w"))
        .select("doc_id", "_digest", F.explode(cut).alias("c"))
        .select("doc_id", "_digest", "c.*")
    )
    return every, texts.join(held.select("s", "len", "item"), ["s", "len"]).select(
        "doc_id", "_digest", "start", "len", "item"
    )


def contamination(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """Per document: ``doc_id``, ``_digest``, ``n_words``, ``n_hit``, ``items`` (sorted ids as strings) and
    ``contaminated``. ``_digest`` is that of the text and tells documents of one id apart."""
    every, all_hits = hits(docs, items, text=text)
    per = all_hits.groupBy("doc_id", "_digest").agg(
        F.sort_array(F.collect_set(F.struct("start", "len"))).alias("spans"),
        F.sort_array(F.collect_set("item")).alias("items"),
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(F.lit(0), s["start"] + s["len"] - F.greatest(a["end"], s["start"]))).alias("n"),
            F.greatest(a["end"], s["start"] + s["len"]).alias("end"),
        ),
        lambda a: a["n"],
    )
    per = materialize(
        per.select(
            F.col("doc_id").alias("_id"),
            F.col("_digest").alias("_d"),
            covered.cast("long").alias("_hit"),
            F.col("items").alias("_items"),
        )
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_digest") == F.col("_d"))
    return (
        every.select("doc_id", "_digest", F.col("n").cast("long").alias("n_words"))
        .join(per, same, "left")
        .select(
            "doc_id",
            "_digest",
            "n_words",
            F.coalesce("_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce("_items", F.array().cast("array<string>")).alias("items"),
        )
        .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
    )


def report(df: DataFrame) -> DataFrame:
    return df.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )

"""Column helpers that the operators of this package share.

Texts are handled whole; a null text counts as empty. Where a result has to come
back to its document by a join, the key is (id, digest of the text): rows that share
an id but not the text stay apart, repeated rows get the same result.
"""

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.session import materialize

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANK = r"[\x20\x09-\x0D]+"
NOT_ITEM_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ASCII_ONLY = r"^[\x00-\x7F]*+$"
CHUNK = 256  # matches whose places are summed in one fold

FOUND = "array<struct<start:bigint,end:bigint,s:string>>"
SPAN = "array<struct<start:bigint,rank:int,end:bigint,kind:string>>"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def _batches(spark: SparkSession, rows: int):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def written(df: DataFrame, rows: int = 500) -> DataFrame:
    """``df`` written and read again, with at most ``rows`` rows in an Arrow batch: for tasks
    whose rows may be texts, sets or files of megabytes."""
    with _batches(df.sparkSession, rows):
        return materialize(df)


def whole(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def empty(kind: str) -> Column:
    return F.array().cast(kind)


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else. ``lower`` does just that on an ASCII text, and is
    much faster than ``translate``."""
    return F.when(text.rlike(ASCII_ONLY), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def words(text: Column, separator: str = BLANK) -> Column:
    """Non-empty pieces of ``text`` between separators."""
    return F.filter(F.split(text, separator), lambda w: w != "")


def once(value: Column, fn) -> Column:
    """``fn(value)`` with the value computed once."""
    return F.transform(F.array(value), fn)[0]


def running(pieces: Column) -> Column:
    """``array<struct<gap, s>>`` to places: each ``s`` begins ``gap`` code points after
    the end of the one before.

    The fold goes over chunks, so a text of very many matches doesn't copy its
    array for each of them.
    """
    length = lambda x: (x["gap"] + F.char_length(x["s"])).cast("long")

    def chunked(pieces):
        size = F.size(pieces)
        return F.when(size == 0, F.array().cast("array<array<struct<gap:int,s:string>>>")).otherwise(
            F.transform(
                F.sequence(F.lit(0), F.floor((size - 1) / CHUNK).cast("int")),
                lambda c: F.slice(pieces, c * CHUNK + 1, F.lit(CHUNK)),
            )
        )

    def step(acc, x):
        at, end = acc["end"] + x["gap"], acc["end"] + length(x)
        one = F.struct(at.alias("start"), end.alias("end"), x["s"].alias("s"))
        return F.struct(end.alias("end"), F.concat(acc["out"], F.array(one)).alias("out"))

    def inner(chunk, offset):
        zero = F.struct(offset.alias("end"), empty(FOUND).alias("out"))
        return F.aggregate(chunk, zero, step, lambda acc: acc["out"])

    def placed(chunks):
        totals = F.transform(
            chunks, lambda ch: F.aggregate(ch, F.lit(0).cast("long"), lambda a, x: a + length(x))
        )
        offsets = F.aggregate(
            totals,
            F.array(F.lit(0).cast("long")),
            lambda a, n: F.concat(a, F.array(F.element_at(a, -1) + n)),
        )
        return F.flatten(F.zip_with(chunks, F.slice(offsets, F.lit(1), F.size(chunks)), inner))

    return once(once(pieces, chunked), placed)


def matches(text: Column, pattern: str, guard: str) -> Column:
    """Leftmost non-overlapping matches of ``pattern`` as ``array<struct<start, end, s>>``,
    in code points, end exclusive.

    ``split`` and ``regexp_extract_all`` walk over the same matches, so the pieces
    between them give the places. Only texts in which ``guard`` is found are looked
    through, once by each. ``pattern`` must not match the empty string.
    """

    def pieces(found):
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
        return F.zip_with(
            gaps, found, lambda g, s: F.struct(F.char_length(g).alias("gap"), s.alias("s"))
        )

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.when(text.rlike(guard), running(once(found, pieces))).otherwise(empty(FOUND))


def as_spans(found: Column, kind: str, rank: int) -> Column:
    return F.transform(
        found,
        lambda x: F.struct(
            x["start"].alias("start"),
            F.lit(rank).alias("rank"),
            x["end"].alias("end"),
            F.lit(kind).alias("kind"),
        ),
    )


def joined(spans: Column) -> Column:
    """``kind:start:end`` by start, then rank of the kind, comma-joined."""
    return F.array_join(
        F.transform(
            F.sort_array(spans), lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])
        ),
        ",",
    )


def labelled_sample(labels: DataFrame, label: str, size: int) -> DataFrame:
    """(``_id``, ``_label``) of about ``size`` labelled ids, drawn by a digest of the id.

    An id appears once for each of its labels, 0 or 1, however often it is repeated;
    null ids are left out.
    """
    rows = (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
        .select(F.col("doc_id").alias("_id"), F.col(label).alias("_label"))
        .distinct()
    )
    n = rows.count()
    return rows.where(F.pmod(F.xxhash64("_id"), F.lit(max(n, 1))) < size)

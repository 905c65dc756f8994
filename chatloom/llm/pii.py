"""Personal data: checked base patterns, and identifiers found by bootstrapped context.

Base kinds are patterns whose matches are checked afterwards. What they match seeds the
bootstrap: candidate identifiers are tokens with a digit that no base span overlaps, and the
base spans themselves, whatever their characters. A lexical pattern is the two words before
an instance; a second, narrower one is these words together with the instance's shape.
Patterns and instances form a graph. Scores go back and forth on it: a pattern is as good
as the mean score of its identifiers (smoothed), an identifier as good as its patterns taken
together (noisy or), seeds stay at 1. After each round, identifiers that were accepted
support patterns as seeds do, and patterns need enough support to score. Identifiers that
good patterns reach are added as spans of kind ``found``.

The scan is done once, in the row of the text, and written; the graph is made of distinct
(pattern, identifier) pairs, so copies of a document count once, and each round is two
joins and two aggregations that combine on the map side.

Defined results: null and empty texts have no spans; a corpus without seeds adds none;
equal starts are ordered by kind; repeated rows give repeated results.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import SPAN, as_spans, empty, joined, matches, whole
from chatloom.session import materialize

# Possessive repeats keep Java's matcher iterative, so that a long text can't exhaust
# its stack; the look-behind (or the end of the last match) stops it from trying every
# place inside a run that has failed from its beginning.
EMAIL = (
    r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
IP = r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ["email", "ip", "card", "phone", "found"]

TOKEN = r"(?<![A-Za-z0-9@._+/-])(?=[A-Za-z@._+/-]*+[0-9])[A-Za-z0-9@._+/-]{5,}"
ROUNDS = 3
MIN_SEEDS = 3  # distinct seeds, or identifiers accepted before, a pattern must have
MIN_SCORE = 0.8  # of a pattern, and of an identifier
CONTEXT = 80  # code points before a candidate in which its two words are looked for


def digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]+", "")


def luhn(s: Column) -> Column:
    """Whether the digits of ``s`` have a right check digit."""
    d = digits(s)
    values = F.transform(
        F.sequence(F.lit(1), F.char_length(d)),
        lambda i: F.ascii(F.substr(d, i, F.lit(1))) - 48,
    )
    n = F.char_length(d)
    total = F.aggregate(
        F.transform(
            values,
            lambda v, i: F.when((n - i) % 2 == 1, v).otherwise(
                F.when(v > 4, 2 * v - 9).otherwise(2 * v)
            ),
        ),
        F.lit(0),
        lambda a, v: a + v,
    )
    return total % 10 == 0


def base(text: Column) -> dict[str, Column]:
    """Matches of each base kind, checked."""
    n = lambda x: F.char_length(digits(x["s"]))
    small = lambda p: F.char_length(F.regexp_replace(p, "^0+", "")) <= 3
    return {
        "email": matches(text, EMAIL, r"@[A-Za-z0-9-]+\.[A-Za-z0-9-]"),
        "ip": F.filter(
            matches(text, IP, r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]"),
            lambda x: F.forall(
                F.split(x["s"], r"\."),
                lambda p: F.when(small(p), p.cast("decimal(38,0)") <= 255).otherwise(False),
            ),
        ),
        "card": F.filter(
            matches(text, CARD, r"[0-9](?:[\x20-]?[0-9]){11}"),
            lambda x: F.when(n(x).between(12, 19), luhn(x["s"])).otherwise(False),
        ),
        "phone": F.filter(matches(text, PHONE, r"\+[0-9]"), lambda x: n(x).between(9, 15)),
    }


def instances(text: Column, spans: Column) -> Column:
    """``array<struct<start, end, id, words, shape>>`` of (start, end, s) ``spans``: the two words
    before each, null if there aren't any, and its shape."""

    def one(x):
        before = F.substr(
            text, F.greatest(x["start"] - CONTEXT + 1, F.lit(1)), F.least(x["start"], F.lit(CONTEXT))
        )
        pair = F.regexp_extract(
            F.lower(before), r"([^\x20\x09-\x0D]+)[\x20\x09-\x0D]+([^\x20\x09-\x0D]+)\P{L}*$", 0
        )
        shape = F.regexp_replace(
            F.regexp_replace(F.regexp_replace(x["s"], "[A-Z]+", "A"), "[a-z]+", "a"), "[0-9]+", "9"
        )
        return F.struct(
            x["start"].alias("start"),
            x["end"].alias("end"),
            F.rtrim(x["s"], F.lit("./-+_")).alias("id"),
            F.when(pair != "", F.regexp_replace(pair, r"[\x20\x09-\x0D]+", " ")).alias("words"),
            shape.alias("shape"),
        )

    return F.transform(spans, one)


def scan(df: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """``key``, a digest of the text, ``n_<kind>``, base spans, candidates outside them, and
    seeds: the instances of the base spans."""
    t = whole(text)
    found = base(t)
    none = empty("array<struct<start:bigint,end:bigint,s:string>>")
    taken = F.concat(*[F.col(f"_{k}") for k in found])
    free = lambda a: ~F.exists(taken, lambda b: (a["start"] < b["end"]) & (b["start"] < a["end"]))
    guard = t.rlike(r"[0-9]")
    out = df.withColumns(
        {f"_{k}": c if k == "email" else F.when(guard, c).otherwise(none) for k, c in found.items()}
    )
    return out.select(
        *key,
        F.xxhash64(t).alias("_digest"),
        *[F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in found],
        F.concat(*[as_spans(F.col(f"_{k}"), k, i) for i, k in enumerate(found)]).alias("base"),
        instances(t, taken).alias("seeds"),
        F.when(guard, instances(t, F.filter(matches(t, TOKEN, TOKEN), free)))
        .otherwise(empty("array<struct<start:bigint,end:bigint,id:string,words:string,shape:string>>"))
        .alias("cands"),
    )


def bootstrap(
    edges: DataFrame, seeds: DataFrame, rounds: int = ROUNDS, min_seeds: int = MIN_SEEDS
) -> DataFrame:
    """(``id``, ``score``) of identifiers, seeds left out, that reach ``MIN_SCORE``.

    ``edges`` are (pattern, id), ``seeds`` are (id); both may hold repeats and nulls.
    """
    seeds = seeds.where(F.col("id").isNotNull()).select("id", F.lit(True).alias("seed")).distinct()
    edges = materialize(
        edges.where(F.col("id").isNotNull() & F.col("pattern").isNotNull())
        .distinct()
        .join(seeds, "id", "left")
        .withColumn("seed", F.col("seed").isNotNull())
    )
    scored = edges.select("pattern", "id", F.col("seed").cast("double").alias("score"), "seed")
    for _ in range(rounds):
        # what was accepted in the round before supports a pattern as a seed does
        patterns = scored.groupBy("pattern").agg(
            (F.sum("score") / (F.count("id") + 1)).alias("p_score"), F.count_if("seed").alias("support")
        )
        ids = (
            edges.where(~F.col("seed"))
            .join(patterns.where(F.col("support") >= min_seeds).drop("support"), "pattern")
            .groupBy("id")
            .agg((1 - F.exp(F.sum(F.log(1 - F.least("p_score", F.lit(0.999)))))).alias("score"),
                 F.max("p_score").alias("best"))
        )
        ids = materialize(ids)
        good = (F.col("score") >= MIN_SCORE) & (F.col("best") >= MIN_SCORE)
        scored = edges.join(ids, "id", "left").select(
            "pattern",
            "id",
            F.when(F.col("seed") | good, 1.0).otherwise(F.coalesce("score", F.lit(0.0))).alias("score"),
            (F.col("seed") | F.coalesce(good, F.lit(False))).alias("seed"),
        )
    return ids.where((F.col("score") >= MIN_SCORE) & (F.col("best") >= MIN_SCORE)).select("id", "score")


def find(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_<kind>``, ``base`` and ``all`` spans of each row."""
    rows = materialize(scan(df, [key], text))
    use = rows.where(F.size("cands") > 0).select(
        key, "_digest", F.explode("cands").alias("c")
    ).select(key, "_digest", "c.*")
    known = rows.where(F.size("seeds") > 0).select(F.explode("seeds").alias("c")).select("c.*")
    seen = use.select("id", "words", "shape").unionByName(known.select("id", "words", "shape")).where("words IS NOT NULL")
    both = F.array("words", F.concat_ws("\t", "words", "shape"))
    edges = seen.select(F.explode(both).alias("pattern"), "id")
    ids = bootstrap(edges, known.select("id")).select("id")
    extra = (
        use.join(ids, "id")
        .groupBy(key, "_digest")
        .agg(
            F.collect_set(
                F.struct(
                    "start",
                    F.lit(KINDS.index("found")).alias("rank"),
                    (F.col("start") + F.char_length("id")).alias("end"),
                    F.lit("found").alias("kind"),
                )
            ).alias("_extra")
        )
        .select(F.col(key).alias("_id"), F.col("_digest").alias("_d"), "_extra")
    )
    same = F.col(key).eqNullSafe(F.col("_id")) & (F.col("_digest") == F.col("_d"))
    free = F.filter(
        F.coalesce("_extra", empty(SPAN)),
        lambda a: ~F.exists("base", lambda b: (a["start"] < b["end"]) & (b["start"] < a["end"])),
    )
    return (
        rows.join(extra, same, "left")
        .withColumn("all", F.concat("base", free))
        .drop("_id", "_d", "_digest", "_extra", "seeds", "cands")
    )


def report(df: DataFrame) -> DataFrame:
    return df.withColumn("base_sha256", F.sha2(joined(F.col("base")), 256)).withColumn(
        "spans", joined(F.col("all"))
    )

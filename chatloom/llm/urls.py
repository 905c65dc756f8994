"""URL filters: host and path rules, and a ratio of character language models.

A rule is a host and a path prefix; it fits the host and its subdomains, and the longest
one wins. Other URLs are judged by two models of characters, of accepted and of
rejected URLs, learned from the URLs that rules judge. A model is of variable order: the
probability of a character after its context is interpolated with that after shorter
ones (Witten and Bell's smoothing), down to an even one. A URL's score is the mean over
its characters of the difference of logarithms; the cut is calibrated on a quarter of
the judged URLs that the models haven't seen.

Counts are made per distinct URL, digits as one sign. The alphabet has 38 signs, so a
table of n-grams has at most 38**ORDER rows however many URLs there are; it is
broadcast while it has at most ``BROADCAST_ROWS``, and joined by shuffle beyond.

Defined results: a null URL, and one without ``://``, has an empty host and path and, as no
rule fits it, the models' verdict on an empty text, which is ``allow``; where one of the
classes has no URLs, both models are even and all is allowed; repeated rows repeat.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import UPPER
from chatloom.session import materialize

RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]
ORDER = 4
SIGNS = 38  # a-z, 0 for digits, ten marks and ~ for all else
BROADCAST_ROWS = 500_000
EVEN = 1.0 / SIGNS


def host(url: Column) -> Column:
    rest = F.regexp_extract(url, r"^(?s).*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, UPPER, UPPER.lower()), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s).*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_and_verdict(h: Column, p: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does."""
    name = verdict = F.lit(None).cast("string")
    for rule_host, rule_path, said in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((h == rule_host) | h.endswith("." + rule_host)) & p.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(said)).otherwise(verdict)
    return name, verdict


def signs(h: Column, p: Column) -> Column:
    """Host and path in the models' alphabet."""
    text = F.regexp_replace(F.lower(F.concat(h, p)), "[0-9]+", "0")
    return F.regexp_replace(text, r"[^a-z0./_%=&+:-]", "~")


def grams(df: DataFrame, text: str, order: int = ORDER) -> DataFrame:
    """A row for each character: the character after its context of ``order - 1``."""
    padded = F.concat(F.lit("^" * (order - 1)), F.col(text))
    return df.withColumn("_padded", padded).select(
        *df.columns,
        F.explode(
            F.when(
                F.char_length(text) > 0,
                F.transform(
                    F.sequence(F.lit(1), F.char_length(text)),
                    lambda i: F.substr("_padded", i, F.lit(order)),
                ),
            )
        ).alias("gram"),
    )


def model(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(``gram``, ``ratio``) for each gram of ``counts`` (``gram``, ``yes``, ``no``): the logarithm of the
    two models' quotient. Shorter contexts are sums over the longest ones."""
    out = counts
    for size in range(1, order + 1):
        key = F.substring("gram", order - size + 1, size)
        level = (
            counts.groupBy(key.alias("_k"))
            .agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
            .withColumn("_c", F.substring("_k", 1, size - 1))
        )
        context = level.groupBy("_c").agg(
            F.sum("yes").alias("_yes"),
            F.sum("no").alias("_no"),
            F.count_if(F.col("yes") > 0).alias("_kinds_yes"),
            F.count_if(F.col("no") > 0).alias("_kinds_no"),
        )
        level = level.join(context, "_c").select(
            F.col("_k").alias(f"_k{size}"),
            *[
                F.struct(F.col(c).alias("n"), F.col(f"_{c}").alias("all"), F.col(f"_kinds_{c}").alias("kinds")).alias(
                    f"{c}{size}"
                )
                for c in ("yes", "no")
            ],
        )
        out = out.join(level, key == F.col(f"_k{size}"), "left").drop(f"_k{size}")

    def probability(c):
        p = F.lit(EVEN)
        for size in range(1, order + 1):
            s = F.col(f"{c}{size}")
            p = F.when(s["all"] > 0, (s["n"] + s["kinds"] * p) / (s["all"] + s["kinds"])).otherwise(p)
        return p

    return out.select("gram", (F.log(probability("yes")) - F.log(probability("no"))).alias("ratio"))


def _cut(scored: DataFrame) -> float:
    """The score that parts the judged URLs with the least sum of both classes' errors;
    half-way between neighbouring candidates, 0 where a class is missing."""
    shares = [k / 100 for k in range(101)]
    got = {
        r["verdict"]: sorted(r["q"])
        for r in scored.groupBy("verdict").agg(F.percentile_approx("score", shares, 10000).alias("q")).collect()
    }
    yes, no = got.get("allow"), got.get("block")
    if not yes or not no:
        return 0.0
    values = sorted({*yes, *no})
    cuts = [(a + b) / 2 for a, b in zip(values, values[1:], strict=False)] or [0.0]
    errors = lambda c: sum(v < c for v in yes) + sum(v >= c for v in no)
    return min(cuts, key=lambda c: (errors(c), abs(c)))


def judge(pages: DataFrame, rules=RULES, order: int = ORDER) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``score``."""
    h, p = host(F.col("url")), path(F.col("url"))
    rows = pages.select("page_id", h.alias("host"), p.alias("path"))
    name, verdict = rule_and_verdict(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns(
        {"rule": name, "ruled": verdict, "_text": signs(F.col("host"), F.col("path"))}
    )
    held = F.crc32("_text") % 4 == 0
    texts = materialize(
        rows.groupBy("_text")
        .agg(F.max(F.col("ruled") == "allow").alias("yes"), F.max(F.col("ruled") == "block").alias("no"))
        .withColumn("held", held)
    )
    each = grams(texts, "_text", order)
    learn = lambda c: F.count_if(F.col(c) & ~F.col("held"))
    counts = materialize(each.groupBy("gram").agg(learn("yes").alias("yes"), learn("no").alias("no")))
    if any(not counts.agg(F.sum(c)).first()[0] for c in ("yes", "no")):
        counts = counts.withColumns({"yes": F.lit(0), "no": F.lit(0)})
    table = materialize(model(counts, order))
    if table.count() <= BROADCAST_ROWS:
        table = F.broadcast(table)
    scored = materialize(each.select("_text", "gram").join(table, "gram").groupBy("_text").agg(F.avg("ratio").alias("score")))
    judged = texts.where("held").join(scored, "_text")
    cut = _cut(
        judged.where("yes or no").select("score", F.when(F.col("yes"), "allow").otherwise("block").alias("verdict"))
    )
    out = rows.join(scored, "_text", "left").withColumn("score", F.coalesce("score", F.lit(0.0)))
    by_model = F.when((F.col("_text") == "") | (F.col("score") >= cut), "allow").otherwise("block")
    return out.select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", by_model).alias("verdict"), "score"
    )

"""Quality rules: base rules, and a decision list learned by sequential covering.

Statistics of a text are expressions within its row. A list of rules is learned from
labelled statistics: each rule is a conjunction of thresholds, grown by information
gain on two thirds of the labelled rows and pruned on the other third; the rows it
covers go, and the next rule is grown on the rest. What each step needs from Spark
are counts by (feature, bin, label), a table of fixed size. The outcome is an ordered
``CASE`` expression over the statistics.

Defined results: null and empty texts have no words and fail the base rules; a table
without labels gives an empty list, so that the base rules alone decide; labels other
than 0 and 1 are left out; repeated labels count repeatedly; extra columns stay.
"""

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import BLANK, labelled_sample, whole, words
from chatloom.session import materialize

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
BINS = 32  # thresholds tried for each feature
MAX_RULES, MAX_TERMS = 8, 4
MIN_PRECISION = 0.95  # of a rule on the pruning rows, to keep clean texts
MIN_COVER = 5  # rejected rows a rule must find on the growing rows
SAMPLE = 20_000  # labelled rows to learn from, about; a table of 16-byte rows

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def with_stats(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the statistics of each text (``STATS`` as bigint) and the features of the rules.

    Windows of three words are compared by a 64-bit digest of their words; they are
    sorted within the row, so a text of n words costs n log n.
    """
    t = whole(text)
    split = df.withColumn("_w", words(t)).withColumn(
        "_h",
        F.when(F.size("_w") < 3, F.array().cast("array<bigint>")).otherwise(
            F.transform(
                F.sequence(F.lit(1), F.size("_w") - 2),
                lambda i: F.xxhash64(
                    F.element_at("_w", i), F.element_at("_w", i + 1), F.element_at("_w", i + 2)
                ),
            )
        ),
    )
    # window starts whose digest occurs again, in order; none for most texts
    marked = split.withColumn(
        "_s",
        F.when(
            F.size("_h") > F.size(F.array_distinct("_h")),
            F.sort_array(
                F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
            ),
        ),
    ).withColumn(
        "_p",
        F.sort_array(
            F.transform(
                F.filter(
                    "_s",
                    lambda x, k: F.get("_s", k - 1)["h"].eqNullSafe(x["h"])
                    | F.get("_s", k + 1)["h"].eqNullSafe(x["h"]),
                ),
                lambda x: x["i"],
            )
        ),
    )
    lines = F.filter(F.split(t, "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
    covered = F.aggregate(
        "_p",
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda a, p: F.struct(
            (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last")
        ),
        lambda a: a["n"],
    )
    out = marked.withColumns(
        {
            "_lines": lines,
            "n_words": F.size("_w").cast("long"),
            "word_chars": F.char_length(F.regexp_replace(t, BLANK, "")).cast("long"),
            "n_symbols": (
                F.char_length(t) - F.char_length(F.regexp_replace(t, "[#*$%&|<>]+", ""))
            ).cast("long"),
            "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
            "_upper": F.char_length(t) - F.char_length(F.regexp_replace(t, r"\p{Lu}+", "")),
            "_marks": F.char_length(t) - F.char_length(F.regexp_replace(t, "[!?]+", "")),
            "_digits": F.char_length(t) - F.char_length(F.regexp_replace(t, "[0-9]+", "")),
        }
    ).withColumn(
        "n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long")
    )
    n, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    features = {
        "f_words": F.col("n_words").cast("double"),
        "f_word_chars": F.col("word_chars") / n,
        "f_symbols": F.col("n_symbols") / n,
        "f_dup_lines": F.col("n_dup_lines") / F.greatest(F.size("_lines"), F.lit(1)),
        "f_repeat": F.col("n_repeat_words") / n,
        "f_upper": F.col("_upper") / chars,
        "f_marks": F.col("_marks") / n,
        "f_digits": F.col("_digits") / chars,
    }
    hidden = ["_w", "_h", "_s", "_p", "_lines", "_upper", "_marks", "_digits"]
    return out.withColumns(features).drop(*hidden)


FEATURES = [
    "f_words",
    "f_word_chars",
    "f_symbols",
    "f_dup_lines",
    "f_repeat",
    "f_upper",
    "f_marks",
    "f_digits",
]


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


@dataclass(frozen=True)
class Term:
    feature: str
    op: str  # ">" or "<="
    value: float

    def column(self) -> Column:
        c = F.col(self.feature)
        return c > self.value if self.op == ">" else c <= self.value

    def __str__(self):
        return f"{self.feature} {self.op} {self.value!r}"


def any_of(rules: list[list[Term]]) -> Column:
    """The ordered list as a condition: true where some rule covers the row."""
    out = F.lit(False)
    for rule in reversed(rules):
        out = F.when(covers(rule), F.lit(True)).otherwise(out)
    return out


def covers(rule: list[Term]) -> Column:
    out = F.lit(True)
    for term in rule:
        out = out & term.column()
    return out


def as_case(rules: list[list[Term]]) -> str:
    """The list as SQL text."""
    when = "".join(f" WHEN {' AND '.join(map(str, r))} THEN true" for r in rules)
    return f"CASE{when} ELSE false END" if rules else "false"


def learn_rules(labelled: DataFrame, label: str = "quality", key: str = "doc_id") -> list[list[Term]]:
    """Ordered rules that find rows of ``label`` 0 among those that pass the base rules.

    ``labelled`` holds the features, ``key`` and ``label``. Growing and pruning rows are
    told apart by crc32 of the key. The driver gets counts by (feature, bin, label), some
    hundreds of rows in a step.
    """
    rows = labelled.select(
        *FEATURES,
        base_failed().alias("failed"),
        (F.col(label) == 0).alias("bad"),
        (F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % 3 == 0).alias("prune"),
    )
    # Filtered after it is written: a filter before would pull all expressions into itself.
    rows = materialize(rows).where(~F.col("failed") & F.col("bad").isNotNull())
    cuts = {}
    shares = [(k + 1) / (BINS + 1) for k in range(BINS)]
    # Quantiles of each class, so that a rare class gets thresholds of its own.
    got = rows.groupBy("bad").agg(
        *[F.percentile_approx(f, shares, 10000).alias(f) for f in FEATURES]
    ).collect()
    if len(got) < 2:
        return []
    for f in FEATURES:
        cuts[f] = sorted({v for r in got for v in r[f]})
    binned = materialize(
        rows.select(
            "bad",
            "prune",
            *FEATURES,
            F.array(*[_bin(f, cuts[f]) for f in FEATURES]).alias("bins"),
        )
    )
    rules: list[list[Term]] = []
    while len(rules) < MAX_RULES:
        left = binned.where(~any_of(rules))
        rule = _grow(left, cuts)
        rule = _prune(left, rule) if rule else None
        if not rule:
            break
        rules.append(rule)
    return rules


def _bin(feature: str, cuts: list[float]) -> Column:
    """Number of cuts below the value."""
    return F.size(F.filter(F.lit(cuts), lambda c: c < F.col(feature)))


def _grow(left: DataFrame, cuts: dict[str, list[float]]) -> list[Term]:
    rule: list[Term] = []
    while len(rule) < MAX_TERMS:
        counts = (
            left.where(~F.col("prune") & covers(rule))
            .select("bad", F.posexplode("bins").alias("f", "bin"))
            .groupBy("f", "bin")
            .agg(
                F.count_if(F.col("bad")).alias("bad"), F.count_if(~F.col("bad")).alias("good")
            )
            .collect()
        )
        table = {f: {} for f in FEATURES}
        for r in counts:
            table[FEATURES[r["f"]]][r["bin"]] = (r["bad"], r["good"])
        some = next(iter(table.values()))
        p0, n0 = (sum(v[k] for v in some.values()) for k in (0, 1))
        if p0 < MIN_COVER or n0 == 0:
            break
        best, term = 1e-9, None
        for f in FEATURES:
            low_p = low_n = 0
            for b, cut in enumerate(cuts[f]):  # rows of bins 0..b have value <= cut
                p, n = table[f].get(b, (0, 0))
                low_p, low_n = low_p + p, low_n + n
                for op, p1, n1 in (("<=", low_p, low_n), (">", p0 - low_p, n0 - low_n)):
                    if p1 >= MIN_COVER:
                        gain = p1 * (math.log2(p1 / (p1 + n1)) - math.log2(p0 / (p0 + n0)))
                        if gain > best:
                            # half-way to the next cut: a margin where values are far apart
                            above = cuts[f][b + 1] if b + 1 < len(cuts[f]) else cut
                            best, term = gain, Term(f, op, (cut + above) / 2)
        if term is None:
            break
        rule.append(term)
    return rule


def _prune(left: DataFrame, rule: list[Term]) -> list[Term] | None:
    """The beginning of the rule with the best worth on the pruning rows, if it is
    precise enough there."""
    heads = [rule[: k + 1] for k in range(len(rule))]
    sums = left.where("prune").agg(
        *[
            F.count_if((F.col("bad") == bad) & covers(head))
            for head in heads
            for bad in (True, False)
        ]
    ).first()
    worth = []
    for k, head in enumerate(heads):
        p, n = sums[2 * k], sums[2 * k + 1]
        if p and p / (p + n) >= MIN_PRECISION:
            worth.append(((p + 1) / (p + n + 2), -k, head))
    return max(worth, key=lambda w: w[:2])[2] if worth else None


def judge(df: DataFrame, rules: list[list[Term]], text: str = "text") -> DataFrame:
    """Add the statistics, ``base_failed`` and ``kept`` to ``df``."""
    return (
        with_stats(df, text)
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & ~any_of(rules))
    )


def train(docs: DataFrame, labels: DataFrame) -> list[list[Term]]:
    """Learn from the labelled documents that pass the base rules, at most about
    ``SAMPLE`` of them."""
    marks = labelled_sample(labels, "quality", SAMPLE)
    rows = docs.select("doc_id", "text").join(
        F.broadcast(marks), F.col("doc_id") == F.col("_id")
    )
    return learn_rules(with_stats(rows.select("doc_id", "text", "_label")), label="_label")


def kept_rows(judged: DataFrame, row: str = "_row") -> DataFrame:
    """The rows in struct ``row`` that are kept. The condition stands in a generator, since
    a filter would be pushed down and take the statistics' expressions with it."""
    kind = judged.schema[row].dataType.simpleString()
    return judged.select(F.inline(F.when(F.col("kept"), F.array(row)).otherwise(F.array().cast(f"array<{kind}>"))))

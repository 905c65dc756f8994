"""Toxicity by a weighted finite-state grammar over clauses.

Words become signs by lexicons: insults, which are learned with their weights from
labelled texts (whole words, and beginnings of words, so that inflected forms are met),
and targets, intents, verbs of violence, negations and verbs of reported speech, which
are fixed. Small transducers read the signs of a clause and are composed in order:

* ``threatened`` makes a threat of a verb of violence that follows an intent and has a target;
* ``reported`` passes signs on, and lowers weights after a verb of saying, or inside quotes;
* ``negated`` passes signs on, and lowers weights of the few signs after a negation;
* ``targeted`` raises an insult or a threat that stands with a target in its clause;
* ``sum`` adds up what is left.

A text's score is a logistic function of the total and the largest clause weight, of
the number of matched clauses and of the total of threats, fitted on labelled rows outside
the held-out fold. A threat counts as an insult of the lexicon's median weight in the
first three; the fourth learns how much more, or less, threats tell.

Learning uses at most about ``SAMPLE`` labelled documents of each class; words are counted by
Spark, the driver gets the lexicon of at most ``LEXICON`` entries. Scoring is done in the
text's batch; nothing is shuffled.

Defined results: null and empty texts match nothing and get the score of no match; without
labels of both classes nothing is learned and all scores are ``PRIOR``; repeated rows
repeat; labels, language, source and id are no input of a score.
"""

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import labelled_sample, whole
from chatloom.session import materialize

SAMPLE = 8_000  # labelled documents of each class
LEXICON = 2_000
PREFIXES = (4, 5, 6)
MIN_DOCS = 3  # toxic documents an entry must be in, at least
MIN_PURITY = 0.95
CHANCE = 1.0  # entries, at most, that may be expected to pass by chance
SAME = 0.9  # of a shorter entry's texts, for a longer one to stand for it
PRIOR = 0.1
THRESHOLD = 0.7

# Targets, negations and verbs of saying in English, German, French and Spanish.
TARGETS = frozenset(
    "you your u ur he she they him her them these those everyone "
    "du dich dir ihr euch sie er "
    "tu toi vous il elle ils elles "
    "tú te ti usted ustedes vosotros él ella ellos".split()
)
NEGATIONS = frozenset(
    "not no never isn't aren't wasn't don't doesn't didn't without hardly "
    "nicht kein keine keinen nie niemals "
    "pas jamais aucun aucune "
    "nunca jamás ningún ninguna".split()
)
SAYING = frozenset(
    "said says say called calls wrote writes quoted claimed "
    "sagte sagt nannte schrieb "
    "dit disait écrit appelait "
    "dijo dice escribió llamó".split()
)
# Object forms that may stand before the verb, and what makes a threat.
OBJECTS = frozenset("dich dir euch te ti vous os".split())
INTENTS = frozenset(
    "will i'll we'll gonna going shall "
    "werde werden wird "
    "vais va allons vont "
    "voy vamos va van".split()
)
VIOLENT = frozenset(
    "kill hurt murder stab shoot strangle choke beat "
    "töten umbringen erschießen erstechen schlagen verletzen "
    "tuer blesser frapper étrangler poignarder "
    "matar herir golpear apuñalar estrangular".split()
)
NEGATED, REPORTED, TARGETED = 0.35, 0.5, 1.25
REACH = 3  # words that a negation covers, and between a verb of violence and its target

WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[.!?;:\n\"“”«»]")
CLAUSE_END = frozenset(".!?;\n")
QUOTES = frozenset("\"“”«»")


def threatened(signs, weight: float):
    """Verbs of violence become threats of ``weight`` if an intent stands before and a target by them."""
    signs = list(signs)
    meant = False
    for k, (word, kind, own) in enumerate(signs):
        meant = meant or kind == "intent"
        aimed = any(kind == "target" for _, kind, _ in signs[k + 1 : k + 1 + REACH]) or any(
            w in OBJECTS for w, _, _ in signs[max(k - REACH, 0) : k]
        )
        if kind == "violent" and meant and aimed:
            yield word, "threat", weight
        else:
            yield word, kind, own


def reported(signs):
    """(word, kind, weight) with weights lowered inside quotes and after a verb of saying."""
    quoted = said = False
    for word, kind, weight in signs:
        if kind == "quote":
            quoted = not quoted
        elif kind == "say":
            said = True
        yield word, kind, weight * REPORTED if quoted or said else weight


def negated(signs):
    left = 0
    for word, kind, weight in signs:
        yield word, kind, weight * NEGATED if left else weight
        left = REACH if kind == "not" else max(0, left - 1)


def targeted(signs):
    signs = list(signs)
    factor = TARGETED if any(kind == "target" for _, kind, _ in signs) else 1.0
    for word, kind, weight in signs:
        yield word, kind, weight * factor


def clause_weights(signs, threat: float) -> tuple[float, float]:
    """The composition of the transducers, summed: over all signs, and over threats."""
    out = list(targeted(negated(reported(threatened(signs, threat)))))
    return sum(weight for *_, weight in out), sum(weight for _, kind, weight in out if kind == "threat")


class Grammar:
    """Lexicon of an executor: entries are words, or beginnings that end in ``*``."""

    def __init__(self, lexicon: dict[str, float]):
        self.words = {w: v for w, v in lexicon.items() if not w.endswith("*")}
        self.heads = {w[:-1]: v for w, v in lexicon.items() if w.endswith("*")}
        self.sizes = sorted({len(h) for h in self.heads})
        self.threat = float(np.median([*lexicon.values()])) if lexicon else 1.0
        found = sorted([*map(re.escape, self.words), *map(re.escape, self.heads), *VIOLENT])
        self.any = re.compile(rf"\b(?:{'|'.join(found)})")

    def weight(self, word: str) -> float:
        if word in self.words:
            return self.words[word]
        return max((self.heads.get(word[:n], 0.0) for n in self.sizes), default=0.0)

    def clauses(self, text: str) -> list[float]:
        """Weights of the clauses that hold a lexicon entry or a threat."""
        return [weight for weight, _ in self.matched(text)]

    def matched(self, text: str) -> list[tuple[float, float]]:
        """Of the clauses that hold a lexicon entry or a threat, the weight and that of threats."""
        low = text.lower()
        if not self.any.search(low):
            return []
        out, signs, hit, open_quote = [], [], False, False
        for m in WORD.finditer(low):
            w = m[0]
            if w in CLAUSE_END:
                if hit:
                    out.append(clause_weights(signs, self.threat))
                # a quotation goes on over the end of a clause
                signs, hit = [("", "quote", 0.0)] if open_quote else [], False
            elif w in QUOTES:
                open_quote = not open_quote
                signs.append((w, "quote", 0.0))
            elif (v := self.weight(w)) > 0:
                signs.append((w, "insult", v))
                hit = True
            elif w in VIOLENT:
                signs.append((w, "violent", 0.0))
                hit = True
            elif w in INTENTS:
                signs.append((w, "intent", 0.0))
            elif w in TARGETS:
                signs.append((w, "target", 0.0))
            elif w in NEGATIONS:
                signs.append((w, "not", 0.0))
            elif w in SAYING:
                signs.append((w, "say", 0.0))
            else:
                signs.append((w, "", 0.0))
        if hit:
            out.append(clause_weights(signs, self.threat))
        return [(weight, threat) for weight, threat in out if weight > 0]

    def features(self, text: str) -> list[float]:
        matched = self.matched(text)
        found = [weight for weight, _ in matched]
        threats = sum(threat for _, threat in matched)
        return [np.log1p(sum(found)), max(found, default=0.0), np.log1p(len(found)), np.log1p(threats)]


def learn_lexicon(rows: DataFrame) -> dict[str, float]:
    """Weights of words and beginnings of words from (``text``, ``_label``): the logarithm of their odds
    in toxic texts.

    An entry has to be met in toxic texts more often than chance allows, by a bound on the
    binomial tail for as many units as are tested: counts decide, not shares of all toxic
    texts, so that the words of a small language have their place.
    Of texts that agree in the least digest of their long words, mostly copies, one counts.
    """
    words = F.array_distinct(F.filter(F.split(F.lower(whole("text")), r"[^\p{L}']+"), lambda w: F.char_length(w) > 2))
    long = F.filter("w", lambda w: F.char_length(w) > 7)
    sketch = F.coalesce(F.array_min(F.transform(long, lambda w: F.xxhash64(w))), F.xxhash64("text"))
    single = rows.select("_label", "text", words.alias("w")).groupBy("_label", sketch.alias("sketch")).agg(
        F.min(F.struct("text", "w"))["w"].alias("w")
    )
    counts = (
        single.select("_label", F.explode(F.array_distinct(F.concat("w", *[_head(n) for n in PREFIXES]))).alias("unit"))
        .groupBy("unit")
        .agg(F.count_if(F.col("_label") == 1).alias("toxic"), F.count_if(F.col("_label") == 0).alias("clean"))
    )
    counts = materialize(counts.where(F.col("toxic") + F.col("clean") >= MIN_DOCS))
    sizes = {r["_label"]: r["count"] for r in single.groupBy("_label").count().collect()}
    if len(sizes) < 2:
        return {}
    base = sizes[1] / (sizes[0] + sizes[1])
    n = F.col("toxic") + F.col("clean")
    share = F.col("toxic") / n
    rest = F.when(F.col("clean") > 0, F.col("clean") * F.log((1 - share) / (1 - base))).otherwise(F.lit(0.0))
    surprise = F.col("toxic") * F.log(share / base) + rest  # Chernoff: at least -log of the tail
    passing = (F.col("toxic") >= MIN_DOCS) & (share >= MIN_PURITY) & (share > base)
    best = counts.where(passing).withColumn("surprise", surprise)
    best = best.where(F.col("surprise") >= float(np.log(max(counts.count(), 1) / CHANCE)))
    best = best.orderBy(F.desc("surprise"), F.length("unit"), "unit").limit(LEXICON).collect()
    return choose({r["unit"]: (r["toxic"], r["clean"]) for r in best})


def choose(counts: dict[str, tuple[int, int]]) -> dict[str, float]:
    """Entries without their kin: a longer one stands for a shorter one that is met in hardly
    more texts, and any other beginning for the longer ones that it covers."""
    stem = lambda u: u.rstrip("*")
    kept = {}
    for u, (toxic, _) in counts.items():
        longer = any(
            len(stem(v)) > len(stem(u)) and v.startswith(stem(u)) and n >= SAME * toxic for v, (n, _) in counts.items()
        )
        if u.endswith("*"):
            exact = len(stem(u)) < 5 and counts.get(stem(u), (0, 0))[0] >= SAME * toxic
        else:
            exact = len(u) >= 5 and counts.get(u + "*", (0, 0))[0] >= toxic
        if not longer and not exact:
            kept[u] = counts[u]
    heads = [stem(u) for u in kept if u.endswith("*")]
    covered = lambda u: any(stem(u).startswith(h) and u != h + "*" for h in heads)
    return {
        u: round(float(np.log((toxic + 0.5) / (clean + 0.5))), 3) for u, (toxic, clean) in kept.items() if not covered(u)
    }


def _head(n: int):
    """Beginnings of ``n`` letters of the words that have as many."""
    long = F.filter("w", lambda x: F.char_length(x) >= n)
    return F.transform(long, lambda x: F.concat(F.substring(x, 1, n), F.lit("*")))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Weights of a logistic function, by Newton's steps with a ridge."""
    a = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(a.shape[1])
    ridge = np.diag([1e-3] + [1e-1] * x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p))[:, None]).T @ a + ridge
        step = np.linalg.solve(h, a.T @ (y - p) - ridge @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def learn(docs: DataFrame, labels: DataFrame) -> tuple[dict[str, float], list[float] | None]:
    """Lexicon and weights, from labelled rows outside the held-out fold."""
    train = labels.where(~held_out())
    parts = [labelled_sample(train.where(F.col("toxic") == c), "toxic", SAMPLE) for c in (1, 0)]
    marks = materialize(parts[0].unionByName(parts[1]))
    rows = docs.select("doc_id", "text").join(F.broadcast(marks), F.col("doc_id") == F.col("_id"))
    rows = materialize(rows.select("text", "_label"))
    lexicon = learn_lexicon(rows)

    def run(batches):
        grammar = Grammar(lexicon)
        for b in batches:
            x = [grammar.features(t) for t in b["text"].fillna("")]
            yield pd.DataFrame(x, columns=["a", "b", "c", "d"]).assign(y=b["_label"].to_numpy())

    got = rows.mapInPandas(run, "a double, b double, c double, d double, y int").collect()  # the sample
    y = np.array([r["y"] for r in got], float)
    if not len(y) or y.min() == y.max():
        return lexicon, None
    return lexicon, fit(np.array([[r["a"], r["b"], r["c"], r["d"]] for r in got]), y).tolist()


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def score(df: DataFrame, lexicon: dict[str, float], weights: list[float] | None) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted``, ``n_clauses``."""

    def run(batches):
        grammar, w = Grammar(lexicon), None if weights is None else np.array(weights)
        for b in batches:
            x = np.array([grammar.features(t or "") for t in b.column("text").to_pylist()]).reshape(-1, 4)
            s = np.full(len(x), PRIOR) if w is None else 1 / (1 + np.exp(-np.clip(w[0] + x @ w[1:], -30, 30)))
            more = s, (s >= THRESHOLD).astype(np.int32), np.rint(np.expm1(x[:, 2])).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), *map(pa.array, more)],
                names=["doc_id", "held_out", "score", "predicted", "n_clauses"],
            )

    # Arrow alone: pandas would turn a column of long ids with a null into doubles
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, n_clauses long")

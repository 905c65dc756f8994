"""Secret scans: base patterns, and sliding-window entropy over candidate strings.

Base kinds are patterns whose matches are checked afterwards. The method looks at
candidate runs of token characters. A window slides over a run; counts of its
characters are kept up by one addition and one removal a step, and Shannon entropy
follows from them (``log2(w) - sum(c * log2(c)) / w``). A window whose entropy reaches
the threshold of its run's character class, or of its own, belongs to a secret (its own
counts if it holds letters and digits, no mark, and lies in no plain word); windows that overlap or
touch make one span. What the allow list matches in a run (runs of letters alone and of
digits alone as a whole) and what base spans cover is blanked out first; a window holds
no blank, so the rest of the run is still scanned.

All of it happens in the row of the text, in expressions; nothing is shuffled. Most texts
hold neither a run nor a name of an assignment: each is looked for once, by what is cheap.

Defined results: null and empty texts have no spans; equal starts are ordered by kind;
repeated rows give repeated results; other columns stay.
"""

import math
import string
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import SPAN, as_spans, empty, joined, matches, once, whole

ASSIGN = (
    r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
    r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"[\x22']?\x20*[:=]\x20*[\x22']?"
)
ASSIGN_VALUE = r"[A-Za-z0-9+/_.=-]+"
#: one of them is in whatever ``ASSIGN`` matches, put in lower case
ASSIGN_WORDS = ["password", "passwd", "secret", "token", "key"]
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ["assign", "access", "hex", "entropy"]

SCALE = 1 << 20
WINDOW = 20
#: token characters, one by one: Java's regex looks a list of signs up in a table, and tries ranges in turn
SIGN = string.ascii_letters + string.digits + "+/_-"
RUN = f"[{SIGN}]{{20,}}"  # as long as the window
#: whether a text holds a run, in one pass: shorter ones are stepped over, not tried again at each character
HAS_RUN = f"^(?:[{SIGN}]{{0,19}}+[^{SIGN}]++)*+[{SIGN}]{{20}}"
#: least bits of a window, by class: hex digits, letters and digits, and with marks
BITS = {"hex": 2.9, "alnum": 3.6, "marked": 3.9}
#: runs that look random and aren't secret
ALLOW = [
    r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",  # UUID
    # keyboard and alphabet rows, to their ends
    r"(?i)abcdefghij(?:klmnopqrstuvwxyz)?|0123456789|qwertyuiop(?:asdfghjkl(?:zxcvbnm)?)?",
    r"^[A-Za-z]+(?:[-_/][A-Za-z]+)*+[-_/]?[0-9]{0,4}$",  # compound words
    r"^[0-9_/+-]+$",  # dates, phone and card numbers
]

#: characters of the parts of a run that are a word with a number, such as a path's
PLAIN = r"(?:\G(?!^)|(?<![A-Za-z0-9])(?=[A-Za-z]++[0-9]{0,4}(?![A-Za-z0-9])))[A-Za-z0-9]"
#: what a character adds to the signs of its window: digits, letters, letters beyond hex, others
DIGIT, LETTER, BEYOND, OTHER = 1, 1 << 8, 1 << 16, 1 << 24
SIGNS = [
    DIGIT if c in "0123456789"
    else LETTER if c in "abcdefABCDEF"
    else LETTER + BEYOND if c.isalpha()
    else OTHER
    for c in map(chr, range(128))
]


def base(text: Column) -> dict[str, Column]:
    """Matches of each base kind, checked."""
    assign = matches(text, ASSIGN + ASSIGN_VALUE, ASSIGN + ASSIGN_VALUE)
    return {
        # group 2 is what follows the opening; the opening is matched again, in place
        "assign": F.filter(
            assign, lambda x: F.char_length(F.regexp_replace(x["s"], "^" + ASSIGN, "")) >= 6
        ),
        "access": matches(text, ACCESS, r"AKIA[A-Z0-9]{16}"),
        "hex": matches(text, HEX, r"[0-9a-f]{24}"),
    }


def names_assigned(text: Column) -> Column:
    """Whether a word of an assignment is in the text; no assignment is without."""
    low = F.lower(text)
    return reduce(or_, [F.contains(low, F.lit(w)) for w in ASSIGN_WORDS])


def most_of(bits: float) -> int:
    """Most ``sum(c * log2(c))`` of a window with so many bits, in 2**-20 bits."""
    return int((math.log2(WINDOW) - bits) * WINDOW * SCALE)


def entropy_windows(s: Column, most: Column, window: int = WINDOW, own: Column | None = None) -> Column:
    """Spans of an ASCII text where windows overlap or touch whose ``sum(c * log2(c))`` is
    at most ``most``, in 2**-20 bits: ``array<struct<start, end>>``. Windows that hold a
    blank don't count. With ``own``, a text of the same length, windows that hold letters
    and digits of it and nothing else are also held against the bits of their own class.

    Counts are kept up incrementally, one addition and one removal a step, in whole
    numbers, so that no error gathers over a long run.
    """
    chars = F.transform(F.filter(F.split(s, ""), lambda c: c != ""), F.ascii)
    signs = F.lit(SIGNS)
    if own is None:
        kinds = F.transform(chars, lambda c: F.lit(OTHER))
    else:
        kinds = F.transform(F.filter(F.split(own, ""), lambda c: c != ""), lambda c: F.get(signs, F.ascii(c)))
    steps = once(
        F.struct(chars.alias("c"), kinds.alias("k")),
        lambda all_: F.transform(
            all_["c"],
            lambda c, i: F.struct(
                c.alias("come"),
                F.get(all_["c"], i - window).alias("go"),
                (F.get(all_["k"], i) - F.coalesce(F.get(all_["k"], i - window), F.lit(0))).alias("signs"),
                i.alias("i"),
            ),
        ),
    )
    gain = F.lit([round(c * math.log2(c) * SCALE) if c else 0 for c in range(window + 2)])

    def bump(counts, code, by):
        value = F.get(counts, code) + by
        return F.concat(
            F.slice(counts, F.lit(1), code), F.array(value), F.slice(counts, code + 2, F.lit(128))
        )

    def step(acc, x):
        gone = F.get(acc["counts"], x["go"])  # null while the window fills
        left = F.when(x["go"].isNull(), acc["counts"]).otherwise(bump(acc["counts"], x["go"], -1))
        less = F.coalesce(F.get(gain, gone) - F.get(gain, gone - 1), F.lit(0))
        n = F.get(left, x["come"])
        more = F.get(gain, n + 1) - F.get(gain, n)
        return F.struct(
            bump(left, x["come"], 1).alias("counts"),
            (acc["total"] - less + more).alias("total"),
            F.when(x["come"] == 32, x["i"]).otherwise(acc["blank"]).alias("blank"),
            (acc["signs"] + x["signs"]).alias("signs"),
            acc["from"].alias("from"),
            acc["to"].alias("to"),
            acc["out"].alias("out"),
            x["i"].alias("i"),
        )

    def by_own_class(acc):
        x = acc["signs"]
        mixed = (x < OTHER) & (x.bitwiseAND(BEYOND - LETTER) > 0) & (x.bitwiseAND(LETTER - DIGIT) > 0)
        least = F.when(x < BEYOND, most_of(BITS["hex"])).otherwise(most_of(BITS["alnum"]))
        return mixed & (acc["total"] <= least)

    def note(acc):
        """Extend the open span by a window that qualifies, or close it and open another."""
        start, end = acc["i"] - (window - 1), acc["i"] + 1
        hit = (start > acc["blank"]) & ((acc["total"] <= most) | by_own_class(acc))
        apart = hit & (start > acc["to"])
        closed = F.array(F.struct(acc["from"].alias("start"), acc["to"].alias("end")))
        return F.struct(
            acc["counts"].alias("counts"),
            acc["total"].alias("total"),
            acc["blank"].alias("blank"),
            acc["signs"].alias("signs"),
            F.when(apart, start).otherwise(acc["from"]).alias("from"),
            F.when(hit, end).otherwise(acc["to"]).alias("to"),
            F.when(apart & (acc["to"] > 0), F.concat(acc["out"], closed))
            .otherwise(acc["out"])
            .alias("out"),
            acc["i"].alias("i"),
        )

    zero = F.struct(
        F.array_repeat(F.lit(0), 128).alias("counts"),
        F.lit(0).cast("long").alias("total"),
        F.lit(-1).alias("blank"),
        F.lit(0).alias("signs"),
        F.lit(0).alias("from"),
        F.lit(-1).alias("to"),
        F.array().cast("array<struct<start:int,end:int>>").alias("out"),
        F.lit(0).alias("i"),
    )
    last = lambda acc: F.when(
        acc["to"] > 0,
        F.concat(
            acc["out"],
            F.array(F.struct(acc["from"].alias("start"), acc["to"].alias("end"))),
        ),
    ).otherwise(acc["out"])
    return F.aggregate(steps, zero, lambda acc, x: once(step(acc, x), note), last)


def blanked(s: Column, spans: Column) -> Column:
    """``s`` with what spans (``start``, ``end``) cover put as blanks."""
    n = lambda x: (x["end"] - x["start"]).cast("int")
    return F.aggregate(
        spans,
        s,
        lambda acc, x: F.overlay(acc, F.repeat(F.lit(" "), n(x)), (x["start"] + 1).cast("int"), n(x)),
    )


def entropy_spans(text: Column, taken: Column, allow: list[str] | None = None) -> Column:
    """Spans of high entropy outside the spans of ``taken`` and outside what ``allow`` matches."""
    allowed = ALLOW if allow is None else allow

    def open_part(x):
        """The run with allowed pieces and its part of ``taken`` blanked."""
        over = F.filter(taken, lambda b: (x["start"] < b["end"]) & (b["start"] < x["end"]))
        covers = [
            F.transform(
                over,
                lambda b: F.struct(
                    F.greatest(b["start"] - x["start"], F.lit(0)).alias("start"),
                    (F.least(b["end"], x["end"]) - x["start"]).alias("end"),
                ),
            )
        ]
        covers += [
            F.transform(matches(x["s"], p, p), lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end")))
            for p in allowed
        ]
        return F.struct(
            x["start"].alias("start"), x["s"].alias("s"), blanked(x["s"], F.concat(*covers)).alias("left")
        )

    runs = F.filter(F.transform(matches(text, RUN, RUN), open_part), lambda x: x["left"].rlike(RUN))

    def most(s):
        return (
            F.when(s.rlike("^[0-9A-Fa-f]+$"), most_of(BITS["hex"]))
            .when(s.rlike("^[0-9A-Za-z]+$"), most_of(BITS["alnum"]))
            .otherwise(most_of(BITS["marked"]))
        )

    return F.flatten(
        F.transform(
            runs,
            lambda x: F.transform(
                entropy_windows(x["left"], most(x["s"]), own=F.regexp_replace(x["left"], PLAIN, ".")),
                lambda w: F.struct(
                    (x["start"] + w["start"]).alias("start"),
                    F.lit(KINDS.index("entropy")).alias("rank"),
                    (x["start"] + w["end"]).alias("end"),
                    F.lit("entropy").alias("kind"),
                ),
            ),
        )
    )


def scan(df: DataFrame, text: str = "text", allow: list[str] | None = None) -> DataFrame:
    """Add ``n_assign``, ``n_access``, ``n_hex``, ``base`` and ``all``: spans as
    ``array<struct<start, rank, end, kind>>``."""
    t = whole(text)
    found = {k: as_spans(c, k, i) for i, (k, c) in enumerate(base(t).items())}
    # what access and hex match is a run, or in one
    guards = {"assign": names_assigned(t), "access": F.col("_run"), "hex": F.col("_run")}
    none = empty(SPAN)
    return (
        df.withColumn("_run", t.rlike(HAS_RUN))
        .withColumns({f"_{k}": F.when(guards[k], c).otherwise(none) for k, c in found.items()})
        .withColumn("base", F.concat(*[F.col(f"_{k}") for k in found]))
        .withColumn(
            "all",
            F.concat("base", F.when(F.col("_run"), entropy_spans(t, F.col("base"), allow)).otherwise(none)),
        )
        .withColumns({f"n_{k}": F.size(f"_{k}").cast("long") for k in found})
        .drop("_run", *[f"_{k}" for k in found])
    )


def report(df: DataFrame) -> DataFrame:
    """Digest columns of ``scan``."""
    return df.withColumn("base_sha256", F.sha2(joined(F.col("base")), 256)).withColumn(
        "spans", joined(F.col("all"))
    )


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with each span, or group of overlapping ones, put as ``mark``."""
    start = F.struct(F.lit(0).cast("long").alias("end"), F.lit("").alias("out"))

    def step(acc, x):
        between = F.substr(text, acc["end"] + 1, x["start"] - acc["end"])
        return F.struct(
            F.greatest(acc["end"], x["end"]).alias("end"),
            F.when(x["start"] < acc["end"], acc["out"])
            .otherwise(F.concat(acc["out"], between, F.lit(mark)))
            .alias("out"),
        )

    done = F.aggregate(
        F.sort_array(spans),
        start,
        step,
        lambda acc: F.concat(acc["out"], F.substr(text, acc["end"] + 1, F.char_length(text))),
    )
    return F.when(F.size(spans) == 0, text).otherwise(done)

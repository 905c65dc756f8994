import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chatloom.functions import text as T

SAMPLES = [
    "Hello wörld, 你好 x_1!",
    "　 a\x1c b \n",
    "é ½ ① ١٢ ",
    "",
    "\x85 tab\tend ",
    "don't—stop 😀😀",
]


def test_strip_is_pythons(spark):
    rows = spark.createDataFrame([(s,) for s in SAMPLES], "s string")
    got = [r[0] for r in rows.select(T.strip(F.col("s"))).collect()]
    assert got == [s.strip() for s in SAMPLES]


def test_words_are_pythons(spark):
    rows = spark.createDataFrame([(s,) for s in SAMPLES], "s string")
    got = [r[0] for r in rows.select(T.words(F.col("s"))).collect()]
    assert got == [re.findall(r"\w+|[^\w\s]", s.lower()) for s in SAMPLES]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="ab <>/\n你", max_size=12), min_size=20, max_size=40))
def test_counts_and_cuts(spark, texts):
    c = F.col("s")
    rows = spark.createDataFrame([(s,) for s in texts], "s string").select(
        c, T.count_of(c, "ab"), T.after_first(c, "<"), T.after_last(c, "<"), T.before_first(c, "<")
    )
    for s, n, first, last, before in rows.collect():
        assert n == s.count("ab")
        assert first == (s.split("<", 1)[1] if "<" in s else s)
        assert last == s.split("<")[-1]
        assert before == s.split("<")[0]


def test_uniform_ignores_partitions(spark):
    def draws(parts):
        rows = spark.range(500).repartition(parts).select("id", T.uniform(F.col("id"), 7))
        return dict(rows.collect())

    a = draws(1)
    assert a == draws(4) == draws(17)
    assert 0.4 < sum(a.values()) / 500 < 0.6 and all(0 <= v < 1 for v in a.values())

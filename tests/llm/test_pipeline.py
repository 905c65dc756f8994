"""The pipeline and the registered queries."""

import math
import random
import re

import __spark_entry__
import corpus_pipeline
import numpy as np
import oracle
import public_tokenizers
import pytest
from test_joins import brute_components, brute_contamination
from test_scans import WORDS, brute_quality, brute_secrets, corpus
from tokenizers import Tokenizer

from chatloom.llm import packing, quality, secrets
from chatloom.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def test_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= {*__spark_entry__.queries()}
    assert {*ORACLE} <= {*__spark_entry__.oracle_sql()}
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules",
        "n-gram Jaccard join",
        "benchmark decontamination",
        "secret scans",
        "best-fit packing",
    ]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, name):
    problem, rows, _ = oracle.compare(spark, oracle.database(SF), name, QUERIES[name], ORACLE[name], SF)
    assert problem is None and rows


def holds(term, n_words, text):
    w, chars, symbols, dups, repeat = brute_quality(text)
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    value = {
        "f_words": w,
        "f_word_chars": chars / max(w, 1),
        "f_symbols": symbols / max(w, 1),
        "f_dup_lines": dups / max(len(lines), 1),
        "f_repeat": repeat / max(w, 1),
        "f_upper": sum(c.isupper() for c in text) / max(chars, 1),
        "f_marks": len(re.findall("[!?]", text)) / max(w, 1),
        "f_digits": len(re.findall("[0-9]", text)) / max(chars, 1),
    }[term.feature]
    return value > term.value if term.op == ">" else value <= term.value


def mask(text):
    out, end = "", 0
    for a, _, _, b in sorted(brute_secrets(text)):
        if a >= end:
            out += text[end:a] + "[SECRET]"
        end = max(end, b)
    return out + text[end:]


def test_pipeline_against_brute_force(spark, tmp_path):
    rng = random.Random(12)
    made = corpus()
    items = [(i, " ".join(rng.choice("pqrstuvw") * 3 for _ in range(20))) for i in range(4)]
    rows = [(i, t) for i, t, _ in made]
    rows += [(1000 + i, t + " tail") for i, t in rows[1:40:3]]  # near copies
    rows += [(2000 + i, t) for i, t in rows[2:20:5]]
    rows += [(3000 + i, f"{t} {items[i % 4][1]}") for i, t, _ in corpus(60, 5) if i % 4]  # contaminated
    rows += [(4000 + i, f"{t} token = \"{i:024x}\" end") for i, t, _ in corpus(40, 6) if i % 4]
    rows += [(5000, None), (5001, ""), (5002, "few words")]
    docs = spark.createDataFrame(
        [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    labels = spark.createDataFrame([(i, q) for i, _, q in made], "doc_id long, quality int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    rules = quality.train(docs, labels)
    left = []
    for i, t in rows:
        n, _, _, _, repeat = brute_quality(t)
        failed = n < quality.MIN_WORDS or 100 * repeat > quality.MAX_REPEAT_PERCENT * n
        if not failed and not any(all(holds(term, n, t) for term in rule) for rule in rules):
            left.append((i, t))
    assert 150 < len(left) < len(rows)
    for _, t in left:  # the method's spans are tested elsewhere
        assert not [m for m in re.finditer(secrets.RUN, mask(t)) if re.search("[0-9]", m[0])]
    left = [(i, t) for (i, t), (_, _, c) in zip(left, brute_components(left), strict=True) if i == c]
    bad = {r[0] for r in brute_contamination(left, items) if r[5]}
    assert bad
    left = [(i, mask(t)) for i, t in left if i not in bad]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for i, t in left:
        n = len(tokenizer.encode(t, add_special_tokens=False).ids) + 1
        want += [(i, k, a, size) for k, (a, size) in enumerate(packing.cut(n))]
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length) for r in got) == sorted(want)
    hist = np.bincount([r.length for r in got], minlength=packing.CAPACITY + 1)
    assert len({r.sequence_id for r in got}) <= packing.lower_bound(hist) + 1
    assert math.isclose(len(got), len(want))


def test_stages_keep_columns(spark, tmp_path):
    docs = spark.createDataFrame(
        [(1, "x y", None, "s", 3, "more"), (None, None, "en", None, None, None)],
        "doc_id long, text string, lang string, source string, n_chars long, kept string",
    )
    spark.createDataFrame([(1, 0)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns
        assert stage(spark, docs.where("false"), str(tmp_path)).count() == 0

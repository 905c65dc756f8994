import pytest
from pyspark.sql import functions as F

from chatloom.functions import arrays as A
from chatloom.operators import samples as S
from chatloom.operators import trajectories as TR
from chatloom.operators import vocab as V

TEXTS = [
    (0, "the cat sat. The cat, the mat\n\nthe end"),
    (1, "你好 world  two  blanks"),
    (2, ""),
    (3, "<|im_start|>user\nassistants assistant<|im_end|>\n"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(TEXTS, "doc_id long, text string")


def test_tokens_join_back(spark, docs):
    got = docs.select("text", F.array_join(V.tokens(F.col("text")), "").alias("back")).collect()
    assert all(r.text == r.back for r in got)
    special = docs.where("doc_id = 3").select(V.tokens(F.col("text"))).first()[0]
    assert special == ["<|im_start|>", "user", "\n", "assistants", " assistant", "<|im_end|>", "\n"]


def test_special_tokens_stay_whole(one):
    text = F.lit("a <think>b</think> <x <|im_start|><|im_end|>1<2")
    assert one(V.tokens(text)) == [
        "a", " ", "<think>", "b", "</think>", " ", "<", "x", " ", "<|im_start|>", "<|im_end|>", "1", "<", "2",
    ]


def test_vocabulary_order_and_size(docs):
    size = len(V.SPECIALS + V.RESERVED) + 3
    rows = V.build_vocab(docs, size=size).orderBy("id").collect()
    assert [r.id for r in rows] == list(range(size))
    assert [r.token for r in rows][: len(V.SPECIALS)] == V.SPECIALS
    top = [(r.token, r["count"]) for r in rows[-3:]]
    assert top == [(" ", 2), (" cat", 2), (" the", 1)] or top[0][1] >= top[1][1] >= top[2][1]
    checks = V.vocab_checks(V.build_vocab(docs, size=size), size).first()
    assert (checks.tokens, checks.distinct_ids, checks.beyond_size) == (size, size, False)


@pytest.mark.parametrize("how", ["lookup", "join"])
@pytest.mark.parametrize("max_len", [None, 4])
def test_encoding_ways_agree(docs, how, max_len):
    vocab = V.build_vocab(docs, size=30).cache()
    ids = {t: i for t, i in vocab.select("token", "id").collect()}
    got = V.encode(docs, vocab, max_len=max_len, how=how)
    pairs = got.select("doc_id", V.tokens(F.col("text")).alias("t"), "ids").collect()
    assert len(pairs) == len(TEXTS)
    for r in pairs:
        assert r.ids == [ids.get(t, V.UNK) for t in r.t][:max_len]


@pytest.mark.parametrize("how", ["lookup", "join"])
def test_decoding(docs, how):
    vocab = V.build_vocab(docs).cache()
    ids = V.encode(docs, vocab)
    whole = V.decode(ids, vocab, skip_special=False, how=how)
    assert {r.doc_id: r.decoded for r in whole.collect()} == dict(TEXTS)
    bare = V.decode(ids, vocab, how=how).where("doc_id = 3").first().decoded
    assert bare == "user\nassistants assistant\n"


@pytest.mark.parametrize("how", ["lookup", "join"])
def test_nulls_empty_texts_and_repeated_keys(spark, docs, how):
    vocab = V.build_vocab(docs, size=30).cache()
    rows = spark.createDataFrame(
        [(1, "the cat"), (1, "a dog"), (1, "the cat"), (2, ""), (3, None), (None, "cat")], "doc_id long, text string"
    )
    ids = {t: i for t, i in vocab.select("token", "id").collect()}
    got = V.encode(rows, vocab, how=how)
    assert got.columns == ["doc_id", "text", "ids"]
    want = {t: [ids.get(x, V.UNK) for x in x] for t, x in (("", []),)} | {
        r.text: [ids.get(t, V.UNK) for t in r.t]
        for r in rows.where("text is not null").select("text", V.tokens(F.col("text")).alias("t")).collect()
    }
    seen = got.collect()
    assert len(seen) == 6 and all(r.ids == want.get(r.text) for r in seen)
    back = V.decode(got, vocab, skip_special=False, how=how).collect()
    names = {i: t for t, i in ids.items()}
    assert len(back) == 6
    for r in back:
        assert r.decoded == (None if r.ids is None else "".join(names[i] for i in r.ids))
    odd = spark.createDataFrame([(1, [0, 999, -1, 14])], "doc_id long, ids array<int>")
    assert V.decode(odd, vocab, how=how).first().decoded == "tool"


def test_large_tables_are_refused_by_lookup(spark, docs, monkeypatch):
    monkeypatch.setattr(V, "MAX_LOOKUP", 20)
    small = V.build_vocab(docs, size=20)
    assert V.token_lookup(small) is not None
    large = V.build_vocab(docs, size=24)
    assert [r.id for r in large.orderBy("id").collect()] == list(range(24))
    assert small.exceptAll(large).count() == 0
    with pytest.raises(ValueError, match="how="):
        V.encode(docs, large)
    with pytest.raises(ValueError, match="how="):
        V.decode(docs.select("doc_id", F.array().cast("array<int>").alias("ids")), large)


def test_pretrain_rows(spark, docs):
    with_null = docs.unionByName(spark.createDataFrame([(9, None)], "doc_id long, text string"))
    rows = S.pretrain_samples(with_null, V.build_vocab(docs), max_len=8).orderBy("doc_id").collect()
    assert [r.doc_id for r in rows] == [0, 1, 2, 3]
    for r in rows:
        assert len(r.input_ids) == len(r.labels) == len(r.attention_mask) == 8
        assert r.input_ids[0] == V.BOS and V.EOS in r.input_ids
        assert all((i == V.PAD) == (l == A.IGNORED) == (m == 0) for i, l, m in zip(r.input_ids, r.labels, r.attention_mask))
    assert rows[2].input_ids == [V.BOS, V.EOS, 0, 0, 0, 0, 0, 0]
    counts = S.text_counts(with_null).first()
    assert (counts.documents, counts.without_text) == (5, 1)


CONV = "array<struct<role:string,content:string,reasoning_content:string,tools:string,tool_calls:string>>"


def chats(spark, text="yes it is", reasoning=None):
    conv = [("user", "is it?", None, None, None), ("assistant", text, reasoning, None, None)]
    return spark.createDataFrame(
        [(1, conv)], f"conv_id long, conversations {CONV}"
    )


def test_sft_rows(spark):
    corpus = spark.createDataFrame([("yes it is is it?",), ("why",)], "text string")
    vocab = V.build_vocab(corpus).cache()
    r = S.sft_samples(chats(spark), vocab, max_len=40, ratio=0.0).first()
    spoken = [i for i, l in zip(r.input_ids, r.labels) if l != A.IGNORED]
    back = {i: t for t, i in vocab.select("token", "id").collect()}
    assert "".join(back[i] for i in spoken) == "yes it is<|im_end|>\n"
    assert len(r.input_ids) == len(r.labels) == 40 and sum(r.attention_mask) == 16
    cot = S.sft_samples(chats(spark, reasoning="why"), vocab, max_len=40, ratio=0.0, use_cot=True).first()
    assert [back[i] for i in cot.input_ids][9:15] == ["assistant", "\n", "<think>", "\n", "why", "\n"]


def test_cut_sft_row(spark):
    vocab = V.build_vocab(spark.createDataFrame([("yes it is",)], "text string"))
    open_ = S.sft_samples(chats(spark), vocab, max_len=14, ratio=0.0).first()
    assert open_.labels[-3:] == open_.input_ids[-3:] and sum(l != A.IGNORED for l in open_.labels) == 3


def test_preference_rows(spark):
    vocab = V.build_vocab(spark.createDataFrame([("good bad",)], "text string"))
    conv = lambda a: [("user", "q", None, None, None), ("assistant", a, None, None, None)]
    pairs = spark.createDataFrame(
        [(1, conv("good"), conv("bad bad"))], f"pair_id long, chosen {CONV}, rejected {CONV}"
    )
    r = S.preference_samples(pairs, vocab, max_len=24).first()
    for side in ("chosen", "rejected"):
        x, y, m = r[f"x_{side}"], r[f"y_{side}"], r[f"mask_{side}"]
        assert len(x) == len(y) == len(m) == len(r[f"attention_mask_{side}"]) == 23
        assert x[1:] == y[:-1]
    assert sum(r.mask_chosen) == 3 and sum(r.mask_rejected) == 4


TURNS = "prompt_id long, gen_id int, turn int, part string, ids array<int>, logps array<double>"


def test_trajectory_and_packing(spark):
    turns = spark.createDataFrame(
        [
            (1, 0, 2, "tool", [40, 41], None),
            (1, 0, 0, "prompt", [10, 11, 12], None),
            (1, 0, 1, "model", [20, 21, 3, 0], [-0.1, -0.2, -0.3, -0.4]),
            (1, 0, 3, "model", [22], [-0.5]),
            (2, 0, 0, "prompt", [10], None),
        ],
        TURNS,
    )
    rows = {r.prompt_id: r for r in TR.trajectory(turns, pad=0, eos=3).collect()}
    assert rows[1].prompt_ids == [10, 11, 12]
    assert rows[1].response_ids == [20, 21, 40, 41, 22]
    assert rows[1].response_mask == [1, 1, 0, 0, 1]
    assert rows[1].response_logps == [-0.1, -0.2, 0.0, 0.0, -0.5]
    packed = {r.prompt_id: r for r in TR.pack_trajectory(TR.trajectory(turns, 0, 3)).collect()}
    assert packed[1].ids == [10, 11, 12, 20, 21, 40, 41, 22]
    assert packed[1].mask == [0, 0, 0, 1, 1, 0, 0, 1] and packed[1].prompt_len == 3
    assert packed[1].old_logps == [0.0, 0.0, -0.1, -0.2, 0.0, 0.0, -0.5]
    assert packed[2].prompt_len == 1 and packed[2].old_logps == []
    cut = {r.prompt_id: r for r in TR.pack_trajectory(TR.trajectory(turns, 0, 3), 4).collect()}
    assert cut[1].ids == [21, 40, 41, 22] and cut[1].old_logps == [0.0, 0.0, -0.5] and cut[1].prompt_len == 0


@pytest.mark.parametrize("max_total", [2, 7, 30, 60, 500])
@pytest.mark.parametrize("prompt", [True, False])
def test_long_rollouts_pack_by_hand(spark, max_total, prompt):
    i = F.col("id")
    turns = spark.range(40).select(
        F.lit(1).cast("long").alias("prompt_id"),
        F.lit(0).alias("gen_id"),
        (i * 2).cast("int").alias("turn"),
        F.when((i == 0) & F.lit(prompt), "prompt").when(i % 3 == 0, "tool").otherwise("model").alias("part"),
        F.transform(F.sequence(F.lit(0), i % 4), lambda k: (i * 10 + k + 5).cast("int")).alias("ids"),
        F.transform(F.sequence(F.lit(0), i % 4), lambda k: -(i * 10 + k) / 7.0).alias("logps"),
    ).repartition(5)
    whole = TR.trajectory(turns, 0, 3)
    assert whole.count() == 1
    row, packed = whole.first(), TR.pack_trajectory(whole, max_total).first()
    ids = row.prompt_ids + row.response_ids
    mask = [0] * len(row.prompt_ids) + row.response_mask
    logps = [0.0] * max(len(row.prompt_ids) - 1, 0) + row.response_logps
    if len(ids) > max_total:
        ids, mask, logps = ids[-max_total:], mask[-max_total:], logps[-(max_total - 1) :]
    assert packed.ids == ids and packed.mask == mask and packed.old_logps == logps


def test_padding_to_the_longest(spark):
    rows = spark.createDataFrame(
        [(0, [1], [-1.0]), (0, [1, 2, 3], [-1.0, -2.0]), (1, [4], [])],
        "batch_id long, ids array<int>, lp array<double>",
    )
    got = TR.pad_batch(rows, {"ids": 0, "lp": 0.0}).orderBy("batch_id", "ids").collect()
    assert [r.ids for r in got] == [[1, 0, 0], [1, 2, 3], [4]]
    assert [r.lp for r in got] == [[-1.0, 0.0], [-1.0, -2.0], []]


def test_generations_and_audit(spark):
    prompts = spark.createDataFrame([(7,)], "prompt_id long")
    assert [r.gen_id for r in TR.expand_generations(prompts, 3).collect()] == [0, 1, 2]
    rows = spark.createDataFrame([(1, [5, 99, 2, -1])], "doc_id long, ids array<int>")
    got = [(r.position, r.id) for r in V.audit_token_range(rows, vocab_size=10).collect()]
    assert got == [(1, 99), (3, -1)]


def test_joined_vocabulary_neither_sorts_places_nor_holds_all_texts(spark, docs, monkeypatch):
    """Items of a group meet the table once; texts that repeat and groups of one give the same ids."""
    counted = V.build_vocab(docs)
    vocab = spark.createDataFrame(counted.collect(), counted.schema)
    rows = docs.unionByName(docs).select("doc_id", "text")
    want = sorted(map(tuple, V.encode(rows, vocab).select("doc_id", "ids").collect()))
    for group in (1, 500):
        monkeypatch.setattr(V, "GROUP", group)
        got = V.encode(rows, vocab, how="join")
        assert sorted(map(tuple, got.select("doc_id", "ids").collect())) == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "ObjectHashAggregate" not in plan and "posexplode" not in plan
    back = V.decode(got, vocab, skip_special=False, how="join")
    assert "collect_list" not in back._jdf.queryExecution().executedPlan().toString()
    assert {r.decoded for r in back.collect()} == {t for _, t in TEXTS}


def test_preference_masks_are_laid_out_by_span(spark):
    """Equal to the labels' mask for no, closed, open and several spans; no place of a row is looked at."""
    o, c = V.ASSISTANT_OPEN, V.ASSISTANT_CLOSE
    rows = [[], [5, 6], [*o], [*o, 8, 9], [*o, 8, *c], [7, *o, 8, *c, 7, *o, 9, 9, *c, 7], [*o, *c, *o, 7], None]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "k int, ids array<int>")
    ids = F.col("ids")
    mask = A.padded_mask(ids, 24, o, c)
    for r in df.select(A.label_mask(A.padded_labels(ids, 24, V.PAD, o, c)).alias("a"), mask.alias("b"), A.ones(mask).alias("n")).collect():
        assert r.a == r.b and (r.a is None or r.n == sum(r.a))
    conv = [("user", "q", None, None, None), ("assistant", "a", None, None, None)]
    pairs = spark.createDataFrame([(1, conv, conv)], f"pair_id long, chosen {CONV}, rejected {CONV}")
    vocab = V.token_lookup(V.build_vocab(spark.createDataFrame([("good bad",)], "text string")))
    plan = S.preference_samples(pairs, vocab, max_len=24)._jdf.queryExecution().optimizedPlan().toString()
    assert f" = {A.IGNORED}" not in plan


def test_own_tokenizer_packs_its_ids(spark):
    """Null and empty texts, and at most some 4 bytes an id beside the text itself, with no id held as a Python number."""
    import tracemalloc

    import pyarrow as pa

    rows = spark.createDataFrame([(0, "ab"), (1, None), (2, ""), (3, "\U0001f600é")], "k int, text string")
    run = V.tokenizer_udf(lambda: lambda text: (ord(c) for c in text))
    got = {r.k: r.ids for r in rows.select("k", run("text").alias("ids")).collect()}
    assert got == {0: [97, 98], 1: None, 2: [], 3: [0x1F600, 0xE9]}
    assert rows.limit(0).select(run("text")).collect() == []
    texts = pa.array(["一" * 1000] * 1000)
    tracemalloc.start()
    out = next(run.func(iter([texts])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(out) == 1000 and len(out.values) == 1_000_000 and peak < 12_000_000

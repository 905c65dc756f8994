"""Vocabulary, token ids and text back from ids.

Token pattern: words and marks with the blank in front of them, special texts,
single blanks. Joining the tokens of a text gives the text back.
"""

import json
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.functions.text import BLANK, WORD
from chatloom.operators.groups import rank_in_group

# Reserved tokens, in id order from 0.
SPECIALS = [
    "<pad>", "<unk>", "<|im_start|>", "<|im_end|>", "<think>", "</think>",
    "<answer>", "</answer>", "<tool_call>", "</tool_call>",
]
RESERVED = ["\n", "system", "user", "assistant", "tool"]
PAD, UNK, BOS, EOS = 0, 1, 2, 3
NEWLINE, ASSISTANT = len(SPECIALS), len(SPECIALS) + 3
ASSISTANT_OPEN = [BOS, ASSISTANT, NEWLINE]  # <|im_start|>assistant\n
ASSISTANT_CLOSE = [EOS, NEWLINE]  # <|im_end|>\n

# A mark takes the blank before it, except "<", which may open a special token.
_SPECIAL = "|".join(s[1:].replace("|", r"\|") for s in SPECIALS)
TOKEN = rf" ?[{WORD}]+| ?[^{WORD}{BLANK}<]|<(?:{_SPECIAL})|<|[{BLANK}]"
SIZE = 6400
# Saved special ids and vocabulary size of the reward scorer.
REWARD_IDS = {
    "<unk>": 0, "<s>": 1, "</s>": 2, "<|reward|>": 92527, "<|plugin|>": 92538,
    "<|interpreter|>": 92539, "<|action_end|>": 92540, "<|action_start|>": 92541,
    "<|im_end|>": 92542, "<|im_start|>": 92543,
}
REWARD_VOCAB = 92544
MAX_LOOKUP = 100_000  # entries a plan may carry; larger tables are joined
BUCKETS = 8192
GROUP = 500  # texts that are looked up together by a join


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def build_vocab(df: DataFrame, text: str = "text", size: int = SIZE) -> DataFrame:
    """Reserved tokens, then the most frequent ones: ``(token, id, count)``.

    Counts combine before the shuffle; the listing is a top-k, never a full sort.
    """
    fixed = SPECIALS + RESERVED
    counted = (
        df.select(F.explode(tokens(F.col(text))).alias("token"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    top = (
        counted.where(~F.col("token").isin(*fixed))
        .orderBy(F.desc("count"), "token")
        .limit(size - len(fixed))
    )
    if size <= MAX_LOOKUP:
        listed = top.agg(
            F.sort_array(F.collect_list(F.struct((-F.col("count")).alias("c"), "token"))).alias("l")
        ).select(F.posexplode("l").alias("at", "e"))
        frequent = listed.select(
            F.col("e.token").alias("token"),
            (F.col("at") + len(fixed)).cast("int").alias("id"),
            (-F.col("e.c")).alias("count"),
        )
    else:  # numbered by ranges, never in one array
        placed = rank_in_group(top, [], [F.desc("count"), F.asc("token")], "at", how="spread")
        frequent = placed.select("token", (F.col("at") + len(fixed)).cast("int").alias("id"), "count")
    reserved = df.sparkSession.createDataFrame(
        [(t, i) for i, t in enumerate(fixed)], "token string, id int"
    )
    return reserved.withColumn("count", F.lit(None).cast("bigint")).unionByName(frequent)


def write_vocab(vocab: DataFrame, path: str) -> None:
    """Keep a vocabulary: counting a corpus once serves every job that encodes with it."""
    vocab.select("token", "id", "count").write.mode("errorifexists").parquet(path)


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("token string, id int, count bigint").parquet(path)


def _bucket(token: Column) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(BUCKETS)).cast("int")


def _rows(vocab: DataFrame, columns: list) -> list:
    """The rows of a table that a plan may carry."""
    rows = vocab.select(*columns).limit(MAX_LOOKUP + 1).collect()
    if len(rows) > MAX_LOOKUP:
        raise ValueError(f'the vocabulary has more than {MAX_LOOKUP} entries: use how="join"')
    return rows


def token_lookup(vocab: DataFrame) -> Callable[[Column], Column]:
    """``token -> id`` as a column function; a table of more than ``MAX_LOOKUP`` entries is
    refused.

    The bounded table becomes a constant: an array of small maps, one per hash
    bucket, so a lookup costs one array access and a map of a few entries. No
    shuffle, no join, no exploded tokens.
    """
    table = [{} for _ in range(BUCKETS)]
    for r in _rows(vocab, ["token", "id", _bucket(F.col("token")).alias("b")]):
        table[r["b"]][r["token"]] = r["id"]
    constant = F.from_json(F.lit(json.dumps(table, ensure_ascii=False)), "array<map<string,int>>")
    return lambda t: F.coalesce(
        F.try_element_at(F.get(constant, _bucket(t)), t), F.lit(UNK)
    )


def _way(how: str) -> bool:
    if how not in ("lookup", "join"):
        raise ValueError(f"how must be lookup or join, not {how}")
    return how == "join"


def encode(
    df: DataFrame,
    vocab: DataFrame | Callable[[Column], Column],
    text: str = "text",
    key: str = "doc_id",
    out: str = "ids",
    max_len: int | None = None,
    how: str = "lookup",
) -> DataFrame:
    """Add the token ids of ``text``; unknown tokens get the unknown id, a null text has null
    ids. ``vocab`` is a table, or a lookup made from one for use in several places.

    ``how="lookup"`` carries the table in the plan, ``how="join"`` joins tables of any size;
    both give the same ids, whatever ``key`` says of the rows.
    """

    def cut(t):  # cut first: no lookups for dropped tokens
        return tokens(t) if max_len is None else F.slice(tokens(t), 1, max_len)

    if _way(how):
        table = vocab.select(F.col("token").alias("_x"), F.col("id").alias("_y"))
        return _by_join(df, text, cut, table, out, UNK)
    lookup = token_lookup(vocab) if isinstance(vocab, DataFrame) else vocab
    return df.withColumn(out, F.transform(cut(F.col(text)), lookup))


def _by_join(df: DataFrame, source: str, items: Callable[[Column], Column], table: DataFrame, out: str, default, done=None) -> DataFrame:
    """The array ``items(source)`` with each item ``_x`` replaced by its ``_y`` of ``table``, or the default.

    Equal sources are looked up once, in groups of some ``GROUP`` of them: the different
    items of a group meet the table, so what is joined are few of the items and none of
    their places, and each group takes its own small table along. Rows meet their result,
    or what ``done`` makes of it, by the source's digest, so keys of rows play no part and a
    null stays null.
    """
    text = F.col(source).cast("string")
    rows = df.withColumn("_d", F.unhex(F.sha2(text, 256)))  # null for a null
    groups = max(1, -(-df.count() // GROUP))
    unlike = rows.where(F.col("_d").isNotNull()).groupBy("_d").agg(F.any_value(source).alias("_s"))
    placed = unlike.withColumn("_g", F.pmod(F.xxhash64("_d"), F.lit(groups))).repartition("_g")
    uses = placed.select("_g", F.explode(items(F.col("_s"))).alias("_x")).where(F.col("_x").isNotNull()).distinct()
    known = uses.join(table, "_x").select(F.col("_g").alias("_k"), "_x", "_y")
    kinds = dict(known.dtypes)
    found = (
        placed.select("_g", "_d", items(F.col("_s")).alias("_items"))
        .groupBy("_g")
        .cogroup(known.groupBy("_k"))
        .applyInArrow(_replaced(default), f"_d binary, _found array<{kinds['_y']}>")
    )
    if done is not None:
        found = found.select("_d", done(F.col("_found")).alias("_found"))
    return rows.join(found, "_d", "left").select(
        *[c for c in df.columns if c != out], F.col("_found").alias(out)
    )


def _replaced(default):
    def run(group: pa.Table, known: pa.Table) -> pa.Table:
        arrays = group["_items"].combine_chunks()
        at = pc.index_in(arrays.values, known["_x"].combine_chunks())
        new = known["_y"].combine_chunks().take(at)
        if default is not None:
            new = pc.fill_null(new, default)
        found = pa.ListArray.from_arrays(arrays.offsets, new)
        return pa.table({"_d": group["_d"], "_found": found})

    return run


def decode(
    df: DataFrame,
    vocab: DataFrame,
    ids: str = "ids",
    key: str = "doc_id",
    out: str = "decoded",
    skip_special: bool = True,
    how: str = "lookup",
) -> DataFrame:
    """Text of the ids; special tokens are left out on request, unknown ids always. Null ids
    have a null text. ``how`` as in ``encode``."""
    skipped = SPECIALS if skip_special else []
    if _way(how):
        table = vocab.where(~F.col("token").isin(*skipped, "")).select(
            F.col("id").alias("_x"), F.col("token").alias("_y")
        )
        # array_join leaves nulls out
        return _by_join(df, ids, lambda i: i, table, out, None, lambda texts: F.array_join(texts, ""))
    table = [{} for _ in range(BUCKETS)]
    for r in _rows(vocab, ["token", "id"]):
        if r["token"] not in skipped:
            table[r["id"] % BUCKETS][str(r["id"])] = r["token"]
    constant = F.from_json(F.lit(json.dumps(table, ensure_ascii=False)), "array<map<string,string>>")
    texts = F.transform(
        F.col(ids),
        lambda i: F.try_element_at(F.get(constant, F.pmod(i, F.lit(BUCKETS))), i.cast("string")),
    )
    return df.withColumn(out, F.array_join(texts, ""))


def tokenizer_udf(load: Callable[[], Callable[[str], list[int]]]):
    """A tokenizer of the user's own: ``load()`` runs once per Python worker and
    returns ``text -> ids``; rows reach it in Arrow batches.

    A text's ids are packed into 32-bit integers before the next text is read, and go
    back as an Arrow array: a batch's ids never stand as Python numbers, or in pandas.
    """

    @F.arrow_udf("array<int>")
    def encode_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokenize = load()
        for texts in batches:
            ids, ends, nulls = array("i"), np.zeros(len(texts) + 1, np.int64), np.zeros(len(texts), bool)
            for k, text in enumerate(texts):
                t = text.as_py()
                if t is None:
                    nulls[k] = True
                else:
                    ids.extend(tokenize(t))
                ends[k + 1] = len(ids)
            yield _lists(ids, ends, nulls)

    return encode_batches


def _lists(ids: array, ends: np.ndarray, nulls: np.ndarray) -> pa.Array:
    flat = pa.array(np.asarray(ids, np.int32))
    return pa.ListArray.from_arrays(pa.array(ends).cast(pa.int32()), flat, mask=pa.array(nulls))  # or raises


def vocab_checks(vocab: DataFrame, size: int = SIZE) -> DataFrame:
    """Size, id range, gaps and repeats of a vocabulary table."""
    return vocab.agg(
        F.count(F.lit(1)).alias("tokens"),
        F.min("id").alias("min_id"),
        F.max("id").alias("max_id"),
        F.count_distinct("id").alias("distinct_ids"),
        (F.max("id") >= size).alias("beyond_size"),
    )


def audit_token_range(
    df: DataFrame, ids: str = "ids", key: str = "doc_id", vocab_size: int = SIZE
) -> DataFrame:
    """One row per id outside the vocabulary: where it stands and what it is."""
    return df.select(key, F.posexplode(ids).alias("position", "id")).where(
        (F.col("id") >= vocab_size) | (F.col("id") < 0)
    )

"""Sample tables: pretraining, fine-tuning and preference rows.

All of them are narrow: one row in, one row out, no shuffle. Every table carries
``input_ids``, ``labels`` or a loss mask, and ``attention_mask``.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.functions import arrays as A
from chatloom.functions import chat as C
from chatloom.operators import vocab as V
from chatloom.operators.chats import inject_system, with_reasoning


def pretrain_samples(
    docs: DataFrame, vocab: DataFrame, max_len: int = 512, key: str = "doc_id"
) -> DataFrame:
    """Framed, padded ids of each document; padding carries no label."""
    ids = V.encode(docs.where(F.col("text").isNotNull()), vocab, key=key, max_len=max_len - 2)
    framed = A.pad_right(A.frame_ids(F.col("ids"), V.BOS, V.EOS, max_len), max_len, V.PAD)
    return ids.select(key, framed.alias("input_ids")).select(
        key,
        "input_ids",
        A.pad_to_ignored(F.col("input_ids"), V.PAD).alias("labels"),
        A.attention_mask(F.col("input_ids"), V.PAD).alias("attention_mask"),
    )


def text_counts(docs: DataFrame) -> DataFrame:
    """Documents, and those left out for having no text."""
    return docs.agg(
        F.count(F.lit(1)).alias("documents"),
        F.count_if(F.col("text").isNull()).alias("without_text"),
    )


def chat_columns(ids, max_len: int, mask_padding: bool = False) -> dict:
    """Padded ids, labels and attention mask of a chat row, from its real ids."""
    rest = F.greatest(F.lit(max_len) - F.size(ids), F.lit(0))
    return {
        "input_ids": A.pad_right(ids, max_len, V.PAD),
        "labels": A.padded_labels(
            ids, max_len, V.PAD, V.ASSISTANT_OPEN, V.ASSISTANT_CLOSE, mask_padding
        ),
        "attention_mask": F.concat(
            A.attention_mask(ids, V.PAD), F.array_repeat(F.lit(0).cast("tinyint"), rest)
        ),
    }


def chat_ids(
    texts: DataFrame, vocab: DataFrame, max_len: int, text: str, key: str, out: str
) -> DataFrame:
    ids = V.encode(texts, vocab, text=text, key=key, out=out, max_len=max_len)
    return ids.withColumn(out, A.pad_right(F.col(out), max_len, V.PAD))


def sft_samples(
    chats: DataFrame,
    vocab: DataFrame,
    max_len: int = 1024,
    use_cot: bool = False,
    ratio: float = 0.2,
    keep_think: float = 0.2,
    seed="sft",
    name: str = "Assistant",
    mask_padding: bool = False,
    render=C.render_chat,
) -> DataFrame:
    """Chat samples with loss on the assistant's spans only; tools and calls come along.

    A sample is its first ``max_len`` ids. ``render`` makes the text from the messages;
    ``chat.render_tool_chat`` puts tools and calls into it.
    """
    ready = inject_system(chats, ratio, f"{seed}/system", name)
    conv = F.col("conversations")
    said = with_reasoning(conv) if use_cot else conv
    text = C.drop_empty_think(render(said), F.col("conv_id"), keep_think, f"{seed}/think")
    texts = ready.select(
        "conv_id", text.alias("text"), C.tool_schema(conv).alias("tools"), C.tool_calls(conv).alias("tool_calls")
    )
    ids = V.encode(texts, vocab, text="text", key="conv_id", out="_ids", max_len=max_len)
    padded = chat_columns(F.col("_ids"), max_len, mask_padding)
    return ids.select(
        "conv_id", *[padded[c].alias(c) for c in ("input_ids", "labels", "attention_mask")], "tools", "tool_calls"
    )


def preference_samples(
    pairs: DataFrame,
    vocab: DataFrame,
    max_len: int = 4096,
    keep_think: float = 0.2,
    seed="pair",
    key: str = "pair_id",
    render=C.render_chat,
) -> DataFrame:
    """Both sides of each pair in next-token form with assistant loss masks. The
    two sides draw the empty-think removal independently."""
    out = pairs
    for side in ("chosen", "rejected"):
        text = C.drop_empty_think(
            render(F.col(side)), F.col(key), keep_think, f"{seed}/{side}"
        )
        out = V.encode(
            out.withColumn("_text", text), vocab, text="_text", key=key, out=f"_{side}", max_len=max_len
        ).drop("_text")
    columns = [F.col(key)]
    for side in ("chosen", "rejected"):
        padded = chat_columns(F.col(f"_{side}"), max_len)
        mask = A.padded_mask(F.col(f"_{side}"), max_len, V.ASSISTANT_OPEN, V.ASSISTANT_CLOSE)
        moved = A.shift(padded["input_ids"], mask)
        columns += [
            moved["x"].alias(f"x_{side}"),
            moved["y"].alias(f"y_{side}"),
            moved["m"].alias(f"mask_{side}"),
            F.slice(padded["attention_mask"], 1, max_len - 1).alias(f"attention_mask_{side}"),
        ]
    return out.select(*columns)


def stack_sides(samples: DataFrame, key: str = "pair_id") -> DataFrame:
    """Preference samples in long form: a row per side, as one batch holds them."""
    fields = ["x", "y", "mask", "attention_mask"]
    side = F.explode(F.array(F.lit("chosen"), F.lit("rejected"))).alias("side")
    chosen = F.col("side") == "chosen"  # fields that nobody reads are not made
    return samples.select("*", side).select(
        key, "side", *[F.when(chosen, F.col(f"{f}_chosen")).otherwise(F.col(f"{f}_rejected")).alias(f) for f in fields]
    )

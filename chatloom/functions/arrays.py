"""Array columns for token rows: framing, padding, masks and label spans.

Everything here is a per-row expression, so a plan built from these has no
shuffle; positions are explicit and never depend on row order.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

IGNORED = -100  # label value that carries no loss


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body
    reads it (lambda bodies are not searched for common subexpressions)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeat(value, times: Column) -> Column:
    value = value if isinstance(value, Column) else F.lit(value)
    return F.array_repeat(value, F.greatest(times, F.lit(0)).cast("int"))


def frame_ids(ids: Column, bos: int, eos: int, max_len: int) -> Column:
    """Cut to ``max_len - 2`` and put the start and end ids around."""
    return F.concat(F.array(F.lit(bos)), F.slice(ids, 1, max_len - 2), F.array(F.lit(eos)))


def pad_right(ids: Column, width, value) -> Column:
    width = width if isinstance(width, Column) else F.lit(width)
    return F.concat(ids, _repeat(value, width - F.size(ids)))


def pad_left(ids: Column, width, value) -> Column:
    width = width if isinstance(width, Column) else F.lit(width)
    return F.concat(_repeat(value, width - F.size(ids)), ids)


def keep_tail(ids: Column, n) -> Column:
    """The last ``n`` ids; ``n = 0`` switches the cut off."""
    if isinstance(n, int):
        return ids if n == 0 else F.slice(ids, F.greatest(F.size(ids) - n + 1, F.lit(1)), n)
    tail = F.slice(ids, F.greatest(F.size(ids) - n + 1, F.lit(1)), n)
    return F.when(n == 0, ids).otherwise(tail)


def pad_to_ignored(ids: Column, pad: int) -> Column:
    """Labels of a pretraining row: the ids, with padding ignored."""
    return F.transform(ids, lambda x: F.when(x == pad, F.lit(IGNORED)).otherwise(x))


def shift(ids: Column, mask: Column) -> Column:
    """Next-token form: inputs without the last, targets and mask without the first."""
    n = F.size(ids) - 1
    return F.struct(
        F.slice(ids, 1, F.greatest(n, F.lit(0))).alias("x"),
        F.slice(ids, 2, F.greatest(n, F.lit(0))).alias("y"),
        F.slice(mask, 2, F.greatest(n, F.lit(0))).alias("m"),
    )


def attention_mask(ids: Column, pad: int) -> Column:
    return F.transform(ids, lambda x: (x != pad).cast("tinyint"))


def mask_sum(mask: Column) -> Column:
    return F.aggregate(mask, F.lit(0), lambda a, x: a + x)


def completion_mask(ids: Column, eos: int) -> Column:
    """1 up to and including the first end id; all 1 when there is none."""
    stop = F.coalesce(F.nullif(F.array_position(ids, eos), F.lit(0)), F.size(ids).cast("bigint"))
    return F.transform(ids, lambda x, i: (i < stop).cast("tinyint"))


def agent_mask(mask: Column, ids: Column, eos: int) -> Column:
    """Loss positions of a packed trajectory.

    Targets only (the first position goes away); positions after the first end
    id that lies inside the mask are dropped.
    """
    targets = F.slice(ids, 2, F.greatest(F.size(ids) - 1, F.lit(0)))
    inside = F.slice(mask, 2, F.greatest(F.size(mask) - 1, F.lit(0)))
    ends = F.zip_with(targets, inside, lambda t, m: (t == eos) & (m == 1))
    stop = F.coalesce(F.nullif(F.array_position(ends, True), F.lit(0)), F.size(ends).cast("bigint"))
    return F.transform(inside, lambda m, i: F.when(i < stop, m).otherwise(F.lit(0)).cast("tinyint"))


def response_mask(ids: Column, prompt_len: Column, pad: int) -> Column:
    """Targets at or after ``prompt_len`` that are not padding."""
    targets = F.slice(ids, 2, F.greatest(F.size(ids) - 1, F.lit(0)))
    return F.transform(targets, lambda t, i: ((i >= prompt_len) & (t != pad)).cast("tinyint"))


def response_len(ids: Column, eos: int) -> Column:
    """Ids up to and including the first end id, else the full width."""
    return F.coalesce(F.nullif(F.array_position(ids, eos), F.lit(0)), F.size(ids).cast("bigint"))


def align_logps(logps: Column, n: Column) -> Column:
    """One log-prob per id: fill zeros on the left, or keep the last ``n``."""
    have = F.size(logps)
    tail = F.slice(logps, F.greatest(have - n + 1, F.lit(1)), n)
    return F.when(have < n, F.concat(_repeat(0.0, n - have), logps)).otherwise(tail)


def first_one(mask: Column) -> Column:
    """Zero-based index of the first 1, or the length when there is none."""
    return F.coalesce(
        F.nullif(F.array_position(mask, F.lit(1)) - 1, F.lit(-1).cast("bigint")),
        F.size(mask).cast("bigint"),
    )


def remap_special_ids(ids: Column, mapping: dict[int, int], vocab_size: int) -> Column:
    """Move known out-of-range ids to their saved place; leave all others."""
    if not mapping:
        return ids
    table = F.create_map(*[F.lit(v) for pair in sorted(mapping.items()) for v in pair])
    return F.transform(
        ids,
        lambda x: F.when(x >= vocab_size, F.coalesce(F.try_element_at(table, x), x)).otherwise(x),
    )


def remap_table(current: dict[str, int], saved: dict[str, int], vocab_size: int) -> dict[int, int]:
    """Out-of-range id to saved id, for the special tokens that have both."""
    return {
        i: saved[t]
        for t, i in current.items()
        if i >= vocab_size and saved.get(t, vocab_size) < vocab_size
    }


def append_once(ids: Column, token: int) -> Column:
    """Add ``token`` unless the row already ends with it."""
    ends = F.coalesce(F.try_element_at(ids, F.lit(-1)) == token, F.lit(False))
    return F.when(ends, ids).otherwise(F.concat(ids, F.array(F.lit(token))))


def _firsts(ids: Column, firsts: list[int]) -> Column:
    """Zero-based places of ids that begin a marker: one cheap pass over the row."""
    return F.filter(
        F.sequence(F.lit(0), F.greatest(F.size(ids) - 1, F.lit(0))),
        lambda i: F.coalesce(F.get(ids, i).isin(*firsts), F.lit(False)),
    )


def _marked(ids: Column, places: Column, marker: list[int]) -> Column:
    """Those of ``places`` where ``marker`` stands whole."""
    whole = F.array(*[F.lit(m) for m in marker])
    return F.filter(places, lambda i: F.slice(ids, i + 1, len(marker)) == whole)


def assistant_spans(ids: Column, bos_seq: list[int], eos_seq: list[int]) -> Column:
    """Spans ``(lo, hi, open)``, end exclusive, that carry loss.

    A span opens after ``bos_seq`` and runs through ``eos_seq``. Start markers
    inside an open span do not count; a span with no end marker runs to the end
    of the row and is ``open``. The fold visits start markers only, not every position.
    """
    n = F.size(ids)
    nothing = F.array().cast("array<struct<lo:int,hi:int,open:boolean>>")

    def spans(found):
        ends = found["ends"]

        def step(state, s):
            lo = s + len(bos_seq)
            close = F.get(F.filter(ends, lambda e: e >= lo), F.lit(0))
            hi = F.coalesce(close + len(eos_seq), n)
            span = F.struct(lo.alias("lo"), hi.alias("hi"), close.isNull().alias("open"))
            taken = F.struct(
                hi.alias("free"), F.concat(state["spans"], F.array(span)).alias("spans")
            )
            # after an open span nothing is free, not even the row's end
            last = F.get(state["spans"], F.size(state["spans"]) - 1)["open"]
            free = (s >= state["free"]) & ~F.coalesce(last, F.lit(False))
            return F.when(free, taken).otherwise(state)

        start = F.struct(F.lit(0).alias("free"), nothing.alias("spans"))
        return F.aggregate(found["starts"], start, step, lambda state: state["spans"])

    def markers(places):
        return F.struct(
            _marked(ids, places, bos_seq).alias("starts"), _marked(ids, places, eos_seq).alias("ends")
        )

    return let(let(_firsts(ids, [bos_seq[0], eos_seq[0]]), markers), spans)


def labels_from_spans(ids: Column, spans: Column) -> Column:
    """The ids inside the spans, the ignored value elsewhere (linear in the row)."""
    n = F.size(ids)
    before = F.transform(
        spans,
        lambda sp, k: F.concat(
            _repeat(
                IGNORED, sp["lo"] - F.when(k == 0, F.lit(0)).otherwise(F.get(spans, k - 1)["hi"])
            ),
            F.slice(ids, sp["lo"] + 1, sp["hi"] - sp["lo"]),
        ),
    )
    last = F.coalesce(F.try_element_at(spans, F.lit(-1))["hi"], F.lit(0))
    return F.concat(F.flatten(before), _repeat(IGNORED, n - last))


def assistant_labels(
    ids: Column, bos_seq: list[int], eos_seq: list[int], mask_padding: int | None = None
) -> Column:
    """Labels of a chat row. An unclosed span includes the padding after it;
    pass the pad id as ``mask_padding`` to ignore padding instead."""
    labels = let(
        assistant_spans(ids, bos_seq, eos_seq), lambda spans: labels_from_spans(ids, spans)
    )
    if mask_padding is not None:
        labels = pad_to_ignored(labels, mask_padding)
    return labels


def padded_labels(
    ids: Column, width: int, pad: int, bos_seq: list[int], eos_seq: list[int], mask_padding: bool = False
) -> Column:
    """Labels of a chat row of ``width`` from its unpadded ids. Spans are looked for in
    the ids alone; padding takes the label of the span that it follows, the ignored value
    if there is none or with ``mask_padding``."""

    def labels(spans):
        rest = F.lit(width) - F.size(ids)
        open_ = F.coalesce(F.try_element_at(spans, F.lit(-1))["open"], F.lit(False))
        filling = F.when(open_, F.lit(pad)).otherwise(F.lit(IGNORED))
        return F.concat(labels_from_spans(ids, spans), _repeat(filling, rest))

    out = let(assistant_spans(ids, bos_seq, eos_seq), labels)
    return pad_to_ignored(out, pad) if mask_padding else out


def padded_mask(ids: Column, width: int, bos_seq: list[int], eos_seq: list[int]) -> Column:
    """``label_mask`` of ``padded_labels``, laid out span by span: no place of a row is looked at."""
    off, on = (F.lit(v).cast("tinyint") for v in (0, 1))

    def mask(spans):
        parts = F.transform(
            spans,
            lambda sp, k: F.concat(
                _repeat(off, sp["lo"] - F.when(k == 0, F.lit(0)).otherwise(F.get(spans, k - 1)["hi"])),
                _repeat(on, sp["hi"] - sp["lo"]),
            ),
        )
        last = F.try_element_at(spans, F.lit(-1))
        filling = F.when(F.coalesce(last["open"], F.lit(False)), on).otherwise(off)
        return F.concat(
            F.flatten(parts),
            _repeat(off, F.size(ids) - F.coalesce(last["hi"], F.lit(0))),
            _repeat(filling, F.lit(width) - F.size(ids)),
        )

    return let(assistant_spans(ids, bos_seq, eos_seq), mask)


def ones(mask: Column) -> Column:
    """Ones of a mask of zeros and ones without nulls."""
    return F.size(F.array_remove(mask, F.lit(0).cast("tinyint")))


def label_mask(labels: Column) -> Column:
    return F.transform(labels, lambda x: (x != IGNORED).cast("tinyint"))

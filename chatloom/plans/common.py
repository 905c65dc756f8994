"""Registry, and small pieces shared by the queries and their SQL."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.functions.text import BLANKS
from chatloom.operators import vocab as V
from chatloom.sources import tables as D

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


# ---- result columns -------------------------------------------------------


def r6(x) -> Column:
    """Six digits, and no negative zero."""
    return F.round(x, 6) + F.lit(0.0)


def digest(ids) -> Column:
    ids = F.col(ids) if isinstance(ids, str) else ids
    return F.md5(F.array_join(ids.cast("array<string>"), " "))


def wsum(xs) -> Column:
    """Place-weighted sum: differs when values or their order differ."""
    xs = F.col(xs) if isinstance(xs, str) else xs
    weighted = F.transform(xs, lambda x, i: x * (i + 1))
    return r6(F.aggregate(weighted, F.lit(0.0), lambda a, x: a + x))


# ---- the same in SQL ------------------------------------------------------


def s_r6(x: str) -> str:
    return f"(round(CAST({x} AS DOUBLE), 6) + 0.0)"


def s_digest(x: str) -> str:
    return f"md5(array_to_string({x}, ' '))"


def s_wsum(x: str) -> str:
    weighted = f"list_transform({x}, lambda v, i: v * i)"
    return s_r6(f"coalesce(list_sum({weighted}), 0)")


def s_strip(x: str) -> str:
    return f"trim({x}, '{BLANKS}')"


def s_count(x: str, needle: str) -> str:
    return f"((strlen({x}) - strlen(replace({x}, '{needle}', ''))) // {len(needle)})"


def s_u(key: str, seed: str) -> str:
    return f"(('0x' || substr(md5('{seed}:' || {key}), 1, 8))::UBIGINT / 4294967296.0)"


def s_after_first(x: str, mark: str) -> str:
    return f"(CASE WHEN contains({x}, '{mark}') THEN substr({x}, strpos({x}, '{mark}') + {len(mark)}) ELSE {x} END)"


S_TURNS = f"""turns AS (SELECT conv_id, turn, role, text, {D.TOOLS} AS tools,
  {D.TOOL_CALLS} AS tool_calls, {D.REASONING} AS reasoning_content FROM conversations)"""


def s_frame(role: str = "role", text: str = "text") -> str:
    return f"('<|im_start|>' || {role} || chr(10) || {text} || '<|im_end|>' || chr(10))"


def s_vocab(source: str, size: int, key: str = "doc_id", text: str = "text") -> str:
    """CTEs ``vocab(token, id)`` over the texts of ``source``."""
    fixed = V.SPECIALS + V.RESERVED
    rows = ", ".join(f"('{t}', {i})" for i, t in enumerate(fixed))
    names = ", ".join(f"'{t}'" for t in fixed)
    return f"""fixed(token, id) AS (VALUES {rows}),
freq AS (SELECT token, count(*) AS n FROM (
    SELECT unnest(regexp_extract_all({text}, '{V.TOKEN}')) AS token FROM {source})
  WHERE token NOT IN ({names}) GROUP BY token),
vocab AS (SELECT token, CAST(id AS INTEGER) AS id, CAST(NULL AS BIGINT) AS n FROM fixed UNION ALL
  SELECT token, CAST({len(fixed)} - 1 + row_number() OVER (ORDER BY n DESC, token) AS INTEGER), n
  FROM freq QUALIFY row_number() OVER (ORDER BY n DESC, token) <= {size - len(fixed)})"""


def s_encode(source: str, out: str, key: str = "doc_id", text: str = "text", max_len=None) -> str:
    """CTE ``out(key, ids)``: ids of the texts of ``source`` under ``vocab``."""
    cut = "" if max_len is None else f"[1:{max_len}]"
    return f"""{out}_t AS (SELECT {key}, unnest(t) AS token, generate_subscripts(t, 1) AS pos
  FROM (SELECT {key}, regexp_extract_all({text}, '{V.TOKEN}'){cut} AS t FROM {source})),
{out}_i AS (SELECT {key}, list(coalesce(v.id, 1) ORDER BY pos) AS ids
  FROM {out}_t LEFT JOIN vocab v USING (token) GROUP BY {key}),
{out} AS (SELECT s.{key}, coalesce(i.ids, CAST([] AS INTEGER[])) AS ids FROM {source} s LEFT JOIN {out}_i i USING ({key}))"""


def s_pad(x: str, n, value) -> str:
    """Pad a list on the right to ``n``."""
    return f"list_concat({x}, list_transform(range(greatest({n} - len({x}), 0)), lambda k: {value}))"

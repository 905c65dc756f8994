"""Conversations of thousands of turns are one record, like any other."""

import os

import __spark_entry__ as entry
import oracle
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

SF = "/root/testdata/sf0.001"
NAMES = [
    n
    for n in entry.queries()
    if n[:3] in {f"c{k:02d}" for k in range(1, 16)} | {"s02", "s04", "s05", "s06", "t07", "t08", "t09", "t20", "t21"}
    and n != "c15_text_counts"
]


@pytest.fixture(scope="module")
def long_tables(tmp_path_factory):
    """The smallest tables, with conversations of 4,097 and 5,000 turns of near ids added."""
    folder = tmp_path_factory.mktemp("long")
    for name in os.listdir(SF):
        if name != "conversations.parquet":
            os.symlink(f"{SF}/{name}", folder / name)
    table = pq.read_table(f"{SF}/conversations.parquet")
    top = max(table["conv_id"].to_pylist())
    rows = [
        (top + k, t, "system" if t == 0 else "user" if t % 2 else "assistant", f"turn {t % 97} of {k}")
        for k, turns in ((1, 4097), (2, 5000))
        for t in range(turns)
    ]
    more = pa.Table.from_arrays([pa.array(c) for c in zip(*rows)], names=["conv_id", "turn", "role", "text"])
    pq.write_table(pa.concat_tables([table, more.cast(table.schema)]), folder / "conversations.parquet")
    return str(folder)


@pytest.mark.parametrize("name", NAMES)
def test_long_conversations_agree_with_sql(spark, long_tables, name):
    con = oracle.database(long_tables)
    problem, rows, _ = oracle.compare(
        spark, con, name, entry.queries()[name], entry.oracle_sql().get(name), long_tables
    )
    assert problem is None and rows

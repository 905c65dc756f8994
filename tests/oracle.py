"""Compare every registered query with its SQL counterpart on the same tables.

    python tests/oracle.py [folder] [name ...]
"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def database(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float) and v == 0:
        return 0.0
    if hasattr(v, "tzinfo") and v is not None and v.tzinfo is not None:
        return v.replace(tzinfo=None)
    return v


def _kind(name: str) -> str:
    name = name.lower()
    for kind, words in {
        "int": ["tinyint", "smallint", "bigint", "int", "hugeint"],
        "real": ["double", "float"],
        "text": ["string", "varchar"],
        "bool": ["boolean"],
        "time": ["timestamp"],
    }.items():
        if any(name.startswith(w) for w in words) or name == kind:
            return kind
    return name


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows) if all(
        None not in r for r in rows
    ) else sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name, query, sql, sf):
    """(problem or None, rows, seconds)."""
    start = time.time()
    df = query(spark, sf)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - start
    if sql is None:
        return None, len(got), took
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    kinds = {d[0]: str(d[1]) for d in rel.description}
    want = rel.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}", len(got), took
    for field, kind in df.dtypes:
        if _kind(kind) != _kind(kinds[field]):
            return f"{field}: {kind} against {kinds[field]}", len(got), took
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if a != b:
        only_a = [r for r in a if r not in set(b)][:3]
        only_b = [r for r in b if r not in set(a)][:3]
        return f"{len(a)} rows against {len(b)}; {only_a} / {only_b}"[:900], len(got), took
    return None, len(got), took


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    args = sys.argv[1:]
    sf = args[0] if args else "/root/testdata/sf0.001"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con, oracle = database(sf), entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if len(args) > 1 and not any(name.startswith(a) for a in args[1:]):
            continue
        try:
            problem, n, took = compare(spark, con, name, fn, oracle.get(name), sf)
        except Exception as e:  # report and go on
            problem, n, took = f"{type(e).__name__}: {str(e)[:700]}", 0, 0
        note = "" if name in oracle else "(rows only)"
        print(f"{'BAD ' if problem else 'ok  '}{name:32s} {n:8d} rows {took:6.2f}s {note} {problem or ''}", flush=True)
        bad += bool(problem)
    print("bad:", bad)


if __name__ == "__main__":
    main()

"""Run registered queries against their SQL oracles: python tests/compare.py <sf_dir> [name fragment ...]"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    return str(value)


def sorted_rows(columns: list[str], rows: list) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(canonical(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir: str, query) -> str:
    """Empty text when the results agree, else what differs."""
    df = query.run(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    if query.sql is None:
        return "" if df.columns else "no columns"
    cursor = con.execute(query.sql)
    columns = [c[0] for c in cursor.description]
    kinds = {c[0]: str(c[1]) for c in cursor.description}
    want = cursor.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    spark_kinds = dict(df.dtypes)
    loose = {"bigint": {"BIGINT"}, "int": {"INTEGER"}, "double": {"DOUBLE"}, "string": {"VARCHAR"}, "date": {"DATE"}, "boolean": {"BOOLEAN"}}
    odd = {c: (spark_kinds[c], kinds[c]) for c in columns if kinds[c] not in loose.get(spark_kinds[c], {kinds[c]})}
    a, b = sorted_rows(df.columns, got), sorted_rows(columns, want)
    if a != b:
        set_a, set_b = set(a), set(b)
        only_a, only_b = [r for r in a if r not in set_b][:3], [r for r in b if r not in set_a][:3]
        return f"rows {len(a)} vs {len(b)}; types {odd}\n  columns {sorted(columns)}\n  spark {only_a}\n  sql   {only_b}"
    if odd:
        return f"types {odd}"
    return ""


def main(argv: list[str]) -> int:
    from skyledger.plans import all_queries
    from skyledger.session import build_session, local_scratch

    sf_dir, names = argv[0], argv[1:]
    spark = build_session("compare", os.environ.get("MASTER", "local[8]"), spark_sql_shuffle_partitions="8", spark_driver_memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    local_scratch(spark)
    con = connect(sf_dir)
    bad = 0
    for name, q in all_queries().items():
        if names and not any(n in name for n in names):
            continue
        start = time.time()
        try:
            message = compare(spark, con, sf_dir, q)
        except Exception as error:  # noqa: BLE001
            message = f"{type(error).__name__}: {str(error)[:700]}"
        seconds = time.time() - start
        state = "ok " if not message else "BAD"
        bad += bool(message)
        print(f"{state} {name} {seconds:.1f}s {'' if q.sql else '(no sql)'} {message}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(min(main(sys.argv[1:]), 100))

"""Compare registered queries with their SQL oracle: names, types and values of all rows."""

from __future__ import annotations

import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _value(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, Decimal):
        return ("decimal", str(v))
    if isinstance(v, float):
        return ("float", repr(round(v, 9)))
    return v


def spark_rows(df):
    order = sorted(df.columns)
    return order, Counter(tuple(_value(r[c]) for c in order) for r in df.select(*order).collect())


def sql_rows(con, sql):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(
        tuple(_value(row[i]) for i in order) for row in result.fetchall()
    )


def differences(df, con, sql) -> str | None:
    """None when equal, else what differs."""
    left_names, left = spark_rows(df)
    right_names, right = sql_rows(con, sql)
    if left_names != right_names:
        return f"columns {left_names} / {right_names}"
    if left != right:
        only_left, only_right = left - right, right - left
        return (
            f"rows {left.total()} / {right.total()}, only spark {only_left.total()}: "
            f"{list(only_left)[:2]}, only sql {only_right.total()}: {list(only_right)[:2]}"
        )
    return None


def main(folder: str, wanted: list[str]) -> int:
    import __spark_entry__ as entry
    from cardwarden.session import local_session, scratch

    spark = local_session()
    con = connect(folder)
    oracle = entry.oracle_sql()
    bad = 0
    for name, build in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            with scratch(spark):
                df = build(spark, folder)
                if name in oracle:
                    found = differences(df, con, oracle[name])
                else:
                    found = f"no oracle, {df.count()} rows"
        except Exception as error:  # noqa: BLE001
            found = f"error {type(error).__name__}: {str(error)[:900]}"
        if found:
            bad += 1
            print("DIFF", name, round(time.time() - start, 1), found, flush=True)
        else:
            print("ok  ", name, round(time.time() - start, 1), flush=True)
    missing = set(oracle) - set(entry.queries())
    print("oracle without query:", missing, "not equal:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))

"""Compare registered queries with their SQL. As a script: python -m tests.compare [sf_dir] [name ...]"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES.split():
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def _sorted_rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(spark, con, function, sql: str, sf_dir: str) -> str | None:
    """None if the results agree, else what differs."""
    df = function(spark, sf_dir)
    got = _sorted_rows(df.columns, df.collect())
    con.execute(sql)
    names = [d[0] for d in con.description]
    want = _sorted_rows(names, con.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if got != want:
        extra, lacking = got - want, want - got
        return (
            f"{sorted(names)}: {sum(got.values())} rows against {sum(want.values())};"
            f" only ours {list(extra)[:3]}, only SQL {list(lacking)[:3]}"
        )
    return None if got else "no rows on either side"


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from tests.session import make_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    spark = make_session()
    con = oracle_connection(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            if name in oracle_sql():
                result = differences(spark, con, queries()[name], oracle_sql()[name], sf_dir)
            else:
                result = None if queries()[name](spark, sf_dir).count() else "no rows"
        except Exception as e:  # noqa: BLE001
            result = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += result is not None
        print(f"{'ok ' if result is None else 'BAD'} {time.time() - start:5.1f}s {name} {result or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")


if __name__ == "__main__":
    main()

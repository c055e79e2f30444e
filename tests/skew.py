"""A copy of the test tables in which single keys hold about a third of the rows.

As a script: python -m tests.skew <target folder>
"""

from __future__ import annotations

import sys

import duckdb

SOURCE = "/root/testdata/sf0.01"
HOT = {
    "lineitem": """
        select * exclude (rn) replace (
            case when rn % 3 = 0 then 7 else l_orderkey end as l_orderkey,
            case when rn % 3 = 1 then 4 else l_suppkey end as l_suppkey,
            case when rn % 3 = 2 then 6 else l_partkey end as l_partkey)
        from (select *, row_number() over () as rn from {t})
        union all select * exclude (i) from (select * from {t} limit 1), range(7000) as r(i)""",
    "part": """
        select * from {t}
        union all
        select 1000000 + i, 'red widget', 'Brand#' || (i % 400), 'KIND' || (i % 30), (i % 50)::int, 1.0
        from range(9000) as r(i)""",
    "events": "select * replace (case when event_id % 3 = 0 then 8 else user_id end as user_id) from {t}",
    "orders": "select * replace (case when o_orderkey % 3 = 0 then 5 else o_custkey end as o_custkey) from {t}",
}


def build(target: str) -> None:
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        sql = HOT.get(t, "select * from {t}").format(t=f"read_parquet('{SOURCE}/{t}.parquet')")
        con.execute(f"copy ({sql}) to '{target}/{t}.parquet' (format parquet)")


if __name__ == "__main__":
    build(sys.argv[1])

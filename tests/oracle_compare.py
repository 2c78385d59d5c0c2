"""Run registered queries next to their SQL: python tests/oracle_compare.py [folder] [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def kind(value) -> str:
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "bool"
    return type(value).__name__


def normal(rows):
    return sorted([tuple(r) for r in rows], key=lambda r: tuple((v is None, str(v)) for v in r))


def same(a, b, slack: bool = False) -> bool:
    """Equal values of equal kind; ``slack`` forgives one unit of the last rounded decimal (a tie)."""
    if isinstance(a, float) and isinstance(b, float):
        if slack and a != b and math.isfinite(a) and math.isfinite(b):
            decimals = max(len(repr(v).partition(".")[2]) for v in (a, b))
            return abs(a - b) <= 1.5 * 10.0**-decimals
        return a == b or (math.isnan(a) and math.isnan(b))
    return a == b and (a is None or kind(a) == kind(b))


def compare(spark, con, folder: str, run, sql: str, slack: bool = False) -> str | None:
    """None if equal, else what differs."""
    df = run(spark, folder)
    names = sorted(df.columns)
    got = normal(df.select(*names).collect())
    rel = con.sql(sql)
    if sorted(rel.columns) != names:
        return f"columns {names} vs {sorted(rel.columns)}"
    want = normal(con.sql(f"SELECT {', '.join(names)} FROM ({sql}) AS t").fetchall())
    if len(got) != len(want):
        return f"{len(got)} rows vs {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if not all(same(x, y, slack) for x, y in zip(g, w))]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, names {names}, first: {bad[0]}"
    return None if got else "no rows"


if __name__ == "__main__":
    import __spark_entry__ as entry
    from wattlane.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = local_session("compare", cpus=8)
    con = connect(folder)
    oracles = entry.oracle_sql()
    failed = 0
    for name, run in entry.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            if name in oracles:
                verdict = compare(spark, con, folder, run, oracles[name])
            else:
                n = run(spark, folder).count()
                verdict = None if n else "no rows"
        except Exception as error:  # noqa: BLE001 - a report over all queries
            verdict = f"{type(error).__name__}: {str(error)[:600]}"
        failed += verdict is not None
        mark = "sql " if name in oracles else "rows"
        print(f"{'ok  ' if verdict is None else 'FAIL'} {mark} {time.time() - start:6.2f}s {name} {verdict or ''}", flush=True)
    print("failed:", failed)

"""Compare registered queries with their SQL on the parquet tables (helper for tests and the command line)."""

from __future__ import annotations

import datetime as dt
import glob
import os
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb

SPARK_TO_SQL = {"tinyint": "TINYINT", "smallint": "SMALLINT", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
                "float": "FLOAT", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE"}


def oracle_connection(sf_dir: str):
    con = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def _plain(v):
    if isinstance(v, float):
        return repr(v + 0.0)
    if isinstance(v, Decimal):
        return repr(float(v))
    if isinstance(v, dt.datetime) and (v.hour, v.minute, v.second) == (0, 0, 0):
        v = v.date()
    return str(v)


def differences(df, con, sql: str) -> list[str]:
    """Empty when names, types and the multiset of rows agree."""
    cur = con.execute(sql)
    types = {d[0]: str(d[1]) for d in cur.description}
    rows = cur.fetchall()
    ours = dict(df.dtypes)
    out = []
    if sorted(ours) != sorted(types):
        return [f"columns {sorted(ours)} vs {sorted(types)}"]
    for c, t in ours.items():
        if SPARK_TO_SQL.get(t, t) != types[c]:
            out.append(f"type of {c}: {t} vs {types[c]}")
    names = sorted(ours)
    at = [list(types).index(c) for c in names]
    theirs = Counter(tuple(_plain(r[i]) for i in at) for r in rows)
    mine = Counter(tuple(_plain(r[c]) for c in names) for r in df.collect())
    if sum(theirs.values()) != sum(mine.values()):
        out.append(f"rows {sum(mine.values())} vs {sum(theirs.values())}")
    a, b = mine - theirs, theirs - mine
    if a or b:
        out.append(f"{sum(a.values())} rows differ, e.g. {sorted(a)[:2]} vs {sorted(b)[:2]} in {names}")
    return out


def main(argv: list[str]) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from tests.conftest import build_session
    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = build_session()
    con = oracle_connection(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    wanted = [q for q in queries if not argv or any(q.startswith(a) for a in argv)]
    bad = 0
    for name in wanted:
        t = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracles:
                d = differences(df, con, oracles[name])
                state = "ok" if not d else "DIFF " + "; ".join(d)
            else:
                state = f"rows {len(df.collect())}"
        except Exception as e:  # noqa: BLE001
            state = "ERROR " + str(e)[:700]
        bad += not state.startswith(("ok", "rows"))
        print(f"{name:32s} {time.time() - t:6.2f}s {state}", flush=True)
    print(f"{len(wanted)} queries, {bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))

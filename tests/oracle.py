"""Run registered queries against their oracle SQL: ``python tests/oracle.py [sf] [names...]``."""

from __future__ import annotations

import pathlib
import sys
import time

import duckdb

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        return round(v, 6)
    return v if isinstance(v, (int, str)) else str(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def _family(kind: str) -> str:
    kind = kind.lower()
    if kind in ("tinyint", "smallint", "int", "integer", "bigint"):
        return "int"
    return {"varchar": "string"}.get(kind, kind)


def compare(df, con, sql: str) -> tuple[bool, str]:
    got = df.collect()
    cur = con.execute(sql)
    want_cols = [c[0] for c in cur.description]
    duck_types = {c[0]: _family(str(c[1])) for c in cur.description}
    spark_types = {c: _family(t) for c, t in df.dtypes}
    if duck_types != spark_types:
        return False, f"types {spark_types} != {duck_types}"
    want = cur.fetchall()
    if sorted(df.columns) != sorted(want_cols):
        return False, f"columns {sorted(df.columns)} != {sorted(want_cols)}"
    a, b = _rows(df.columns, got), _rows(want_cols, want)
    if a == b:
        return True, f"{len(a)} rows"
    set_a, set_b = set(a), set(b)
    only_a = [r for r in a if r not in set_b][:3]
    only_b = [r for r in b if r not in set_a][:3]
    return False, f"{len(a)} vs {len(b)} rows\n   spark: {str(only_a)[:1500]}\n   duck:  {str(only_b)[:1500]}"


def main(argv: list[str]) -> int:
    from silsila.plans.catalog import ORACLES, QUERIES
    from silsila.plans.session import local_session

    sf = argv[0] if argv else "0.001"
    names = argv[1:] or list(QUERIES)
    spark = local_session(cores="8")
    sf_dir = f"/root/testdata/sf{sf}"
    con = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLES:
                ok, note = compare(df, con, ORACLES[name])
            else:
                ok, note = True, f"{df.count()} rows, no oracle"
        except Exception as e:  # report and go on
            ok, note = False, f"{type(e).__name__}: {str(e)[:1500]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:32s} {time.time() - start:6.1f}s {note}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)

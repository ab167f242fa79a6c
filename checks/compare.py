"""Run registered queries beside their oracle and compare the rows.

``python -m checks.compare [sf_dir] [name ...]``
"""

from __future__ import annotations

import sys
import time
from decimal import Decimal

import duckdb

from checks.registry import ORACLE, QUERIES
from locusframe.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def normal(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float, Decimal)):
        number = round(float(value), 6)
        return 0.0 if number == 0 else number
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(normal(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def kinds(columns, rows):
    """Python types per column, to spot an integer on one side only."""
    return {c: {type(r[i]).__name__ for r in rows if r[i] is not None} for i, c in enumerate(columns)}


def compare(spark, sf_dir: str, name: str, con) -> tuple[str, int, float, float]:
    started = time.time()
    df = QUERIES[name](spark, sf_dir)
    raw = [tuple(r) for r in df.collect()]
    cols, got = rows_of(df.columns, raw)
    spent = time.time() - started
    if name not in ORACLE:
        return "rows only", len(got), spent, 0.0
    started = time.time()
    cur = con.execute(ORACLE[name])
    onames, oraw = [c[0] for c in cur.description], cur.fetchall()
    ocols, want = rows_of(onames, oraw)
    oracle_spent = time.time() - started
    if cols != ocols:
        return f"COLUMNS {cols} / {ocols}", len(got), spent, oracle_spent
    if got != want:
        more = [g for g in got if g not in want][:2] if len(got) < 20000 else got[:1]
        less = [w for w in want if w not in got][:2] if len(want) < 20000 else want[:1]
        return f"DIFF {len(got)}/{len(want)} {more} / {less}", len(got), spent, oracle_spent
    ours, theirs = kinds(df.columns, raw), kinds(onames, oraw)
    odd = [f"{c}: {ours[c]} / {theirs[c]}" for c in cols if ours[c] != theirs[c]]
    if odd:
        return f"TYPES {odd}", len(got), spent, oracle_spent
    return "ok", len(got), spent, oracle_spent


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def main(args: list[str]) -> None:
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or list(QUERIES)
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        try:
            verdict, n, spent, other = compare(spark, sf_dir, name, con)
        except Exception as error:
            verdict, n, spent, other = f"ERROR {type(error).__name__}: {str(error)[:600]}", 0, 0, 0
        bad += verdict not in ("ok", "rows only")
        print(f"{name:32s} {n:8d} {spent:7.2f}s {other:7.2f}s  {verdict}", flush=True)
    print(f"{len(names)} queries, {bad} failing")


if __name__ == "__main__":
    main(sys.argv[1:])

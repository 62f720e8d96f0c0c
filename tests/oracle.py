"""Compares registered queries with their SQL in DuckDB: same rows, same column names."""

from __future__ import annotations

import math
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return value if value is None or isinstance(value, (str, bool)) else str(value)


def _sorted(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(str(tuple(_plain(r[i]) for i in order)) for r in rows)


def compare(spark, con, key: str, fn, sql: str, sf_dir: str) -> str | None:
    """None when equal, else a description of the first difference."""
    df = fn(spark, sf_dir)
    ours = [tuple(r) for r in df.collect()]
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = result.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows vs {len(theirs)}"
    if not ours:
        return "no rows"
    a, b = _sorted(ours, df.columns), _sorted(theirs, names)
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(wrong)} of {len(a)} rows differ, first: {wrong[0]}" if wrong else None


def main(argv: list[str]) -> int:
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as entry
    from tillcast.session import build_session

    sf_dir = argv[0]
    spark = build_session(
        "local[8]", spark__driver__memory="16g", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(sf_dir), 0
    oracle = entry.oracle_sql()
    for key, fn in entry.queries().items():
        if argv[1:] and not any(key.startswith(p) for p in argv[1:]):
            continue
        begun = time.time()
        try:
            if key in oracle:
                outcome = compare(spark, con, key, fn, oracle[key], sf_dir)
                outcome = "ok" if outcome is None else f"DIFF {outcome}"
            else:
                outcome = f"rows only: {fn(spark, sf_dir).count()}"
        except Exception as error:  # noqa: BLE001 - report and go on
            outcome = f"ERROR {type(error).__name__}: {str(error)[:1500]}"
        bad += outcome.startswith(("DIFF", "ERROR"))
        print(f"{time.time() - begun:6.1f}s {key}: {outcome}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))

"""Side-by-side check of registered queries against their oracle text in DuckDB."""

from __future__ import annotations

import math
import sys
import time

GIVEN = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(path: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in GIVEN:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}/{t}.parquet')")
    return con


def _exact(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ("", "null")
    if isinstance(v, (int, float)) and not isinstance(v, bool):
        return ("n", repr(float(v) + 0.0))
    return (type(v).__name__, str(v))


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ("", "null")
    if isinstance(v, bool):
        return ("b", str(v))
    if isinstance(v, float):
        return ("n", f"{v:.9g}" if v else "0")
    if isinstance(v, int):
        return ("n", f"{float(v):.9g}" if v else "0")
    return (type(v).__name__, str(v))


def compare(spark_rows, spark_cols, duck_rows, duck_cols) -> str | None:
    """None when equal, else the first difference."""
    if sorted(spark_cols) != sorted(duck_cols):
        return f"columns differ: {sorted(spark_cols)} against {sorted(duck_cols)}"
    if len(spark_rows) != len(duck_rows):
        return f"rows differ: {len(spark_rows)} against {len(duck_rows)}"
    order = sorted(spark_cols)
    exact = sorted(tuple(_exact(r[spark_cols.index(c)]) for c in order) for r in spark_rows) == sorted(
        tuple(_exact(r[duck_cols.index(c)]) for c in order) for r in duck_rows
    )
    if exact:
        return None
    si, di = [spark_cols.index(c) for c in order], [duck_cols.index(c) for c in order]
    a = sorted(tuple(_norm(r[i]) for i in si) for r in spark_rows)
    b = sorted(tuple(_norm(r[i]) for i in di) for r in duck_rows)
    for x, y in zip(a, b):
        if x != y:
            diff = [(c, p, q) for c, p, q in zip(order, x, y) if p != q]
            return f"values differ: {diff[:4]} in {x}"
    return "NEAR"


def check(spark, con, path: str, name: str, fn, sql: str | None, inspect=None) -> tuple[str | None, int, float]:
    started = time.time()
    df = fn(spark, path)
    if inspect:
        inspect(df)
    rows = [tuple(r) for r in df.collect()]
    took = time.time() - started
    if sql is None:
        return None, len(rows), took
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    kinds = {d[0]: str(d[1]) for d in cur.description}
    out = cur.fetchall()
    bad = {c: k for c, k in kinds.items() if not any(k.upper().startswith(p) for p in ("BIGINT", "DOUBLE", "VARCHAR", "NUMBER", "STRING", "INTEGER"))}
    problem = compare(rows, df.columns, out, cols)
    near = problem == "NEAR"
    problem = None if near else problem
    if problem is None and bad:
        problem = f"oracle types need a cast: {bad}"
    if near:
        print(f"     {name}: equal to nine digits, not bit for bit", flush=True)
    return problem, len(rows), took


def main(argv: list[str]) -> int:
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as entry
    from ledgerloom.session import build_session

    path = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = argv[1:]
    spark = build_session(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(path)
    failed = 0
    oracle = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        try:
            problem, n, took = check(spark, con, path, name, fn, oracle.get(name))
        except Exception as exc:
            problem, n, took = f"error: {str(exc)[:900]}", -1, 0.0
        failed += problem is not None
        mark = "FAIL" if problem else ("ok  " if name in oracle else "rows")
        print(f"{mark} {name} rows={n} {took:.1f}s {problem or ''}", flush=True)
    print("failed", failed)
    return failed


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))

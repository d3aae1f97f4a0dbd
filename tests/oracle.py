"""Run registered queries on Spark and their SQL on DuckDB, and compare the rows."""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


RELATIVE, ABSOLUTE = 1e-9, 1e-9


def _rows(frame: pd.DataFrame) -> list[tuple]:
    """Rows in an order that a last bit does not change: whole numbers and texts first, doubles rounded."""
    exact = [c for c in sorted(frame.columns) if not pd.api.types.is_float_dtype(frame[c])]
    real = [c for c in sorted(frame.columns) if c not in exact]
    told = frame[exact].astype(object).where(frame[exact].notna(), None)
    keys = [tuple("" if v is None else f"{float(v):.0f}" if isinstance(v, (bool, int, float)) else str(v) for v in row)
            for row in told.itertuples(index=False)]
    values = [tuple(float(v) for v in row) for row in frame[real].astype(float).itertuples(index=False)]
    return sorted(zip(keys, values), key=lambda r: (r[0], tuple("" if v != v else f"{v:.6e}" for v in r[1])))


def _close(a: tuple, b: tuple) -> bool:
    return a[0] == b[0] and all((x != x and y != y) or x == y or abs(x - y) <= max(ABSOLUTE, RELATIVE * max(abs(x), abs(y)))
                                for x, y in zip(a[1], b[1]))


def differences(spark_rows: pd.DataFrame, sql_rows: pd.DataFrame) -> str | None:
    if sorted(spark_rows.columns) != sorted(sql_rows.columns):
        return f"columns differ: {sorted(set(spark_rows.columns) ^ set(sql_rows.columns))}"
    if len(spark_rows) != len(sql_rows):
        return f"rows differ: {len(spark_rows)} vs {len(sql_rows)}"
    for c in spark_rows.columns:
        a, b = spark_rows[c], sql_rows[c]
        if pd.api.types.is_numeric_dtype(a) != pd.api.types.is_numeric_dtype(b) and not (a.isna().all() or b.isna().all()):
            return f"type of {c} differs: {a.dtype} vs {b.dtype}"
    for c in spark_rows.columns:  # a column of one engine may be whole where the other's has nulls
        if pd.api.types.is_float_dtype(spark_rows[c]) != pd.api.types.is_float_dtype(sql_rows[c]) and pd.api.types.is_numeric_dtype(spark_rows[c]):
            spark_rows, sql_rows = spark_rows.astype({c: float}), sql_rows.astype({c: float})
    left, right = _rows(spark_rows), _rows(sql_rows)
    bad = [(x, y) for x, y in zip(left, right) if not _close(x, y)]
    if bad:
        return f"{len(bad)} of {len(left)} rows differ, first:\n  {sorted(spark_rows.columns)}\n  {bad[0][0]}\n  {bad[0][1]}"
    return None


def check(spark, sf_dir: str, names=None) -> dict[str, str | None]:
    import __spark_entry__ as entry

    con, runs, texts, out = connect(sf_dir), entry.queries(), entry.oracle_sql(), {}
    for name in names or runs:
        started = time.time()
        try:
            got = runs[name](spark, sf_dir).toPandas()
            took = time.time() - started
            problem = differences(got, con.execute(texts[name]).df()) if name in texts else None
            note = "ok" if name in texts else f"rows only ({len(got)})"
        except Exception as error:  # noqa: BLE001 - a report, every failure is listed
            took, problem, note = time.time() - started, f"{type(error).__name__}: {str(error)[:1500]}", ""
        out[name] = problem
        print(f"{name:28s} {took:6.2f}s {'FAIL ' + problem if problem else note}", flush=True)
    return out


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from riskloom.session import build_session

    session = build_session("check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    results = check(session, sys.argv[1], sys.argv[2:])
    failed = [n for n, p in results.items() if p]
    print(f"{len(results) - len(failed)} of {len(results)} fine; failed: {failed}")

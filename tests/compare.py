"""Run a Spark query and its DuckDB oracle on the same parquet tables and
compare them: row count, column names, and the multiset of rows with floats
rounded. Used by the tests and by hand (``python -m tests.compare``)."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
from collections import Counter

import duckdb

from strata.plans.tables import TABLES


def duckdb_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _norm(value, digits: int):
    if value is None:
        return None
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return round(value, digits) + 0.0
    if isinstance(value, decimal.Decimal):
        return round(float(value), digits) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(_norm(v, digits) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, _norm(v, digits)) for k, v in value.items()))
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if hasattr(value, "asDict"):
        return tuple(_norm(v, digits) for v in value)
    return value


def rows_multiset(rows, columns, digits: int = 6) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_norm(r[i], digits) for i in order) for r in rows)


def compare(spark, name: str, sf_dir: str, digits: int = 6) -> dict:
    from strata.plans.oracles import oracle_sql
    from strata.plans.queries import queries

    import time
    t0 = time.time()
    df = queries()[name](spark, sf_dir)
    spark_rows = [tuple(r) for r in df.collect()]
    spark_sec = round(time.time() - t0, 2)
    spark_cols = df.columns
    out = {"query": name, "spark_rows": len(spark_rows), "sec": spark_sec}
    sql = oracle_sql().get(name)
    if sql is None:
        out["oracle"] = None
        return out
    con = duckdb_connection(sf_dir)
    rel = con.execute(sql)
    duck_cols = [d[0] for d in rel.description]
    duck_rows = rel.fetchall()
    out["oracle_rows"] = len(duck_rows)
    out["columns_match"] = sorted(spark_cols) == sorted(duck_cols)
    if not out["columns_match"]:
        out["spark_cols"], out["duck_cols"] = spark_cols, duck_cols
    a = rows_multiset(spark_rows, spark_cols, digits)
    b = rows_multiset(duck_rows, duck_cols, digits)
    out["values_match"] = a == b
    if a != b:
        out["only_spark"] = list((a - b).elements())[:3]
        out["only_oracle"] = list((b - a).elements())[:3]
    return out


def main(argv: list[str]) -> int:
    from strata.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = build_session()
    from strata.plans.queries import queries

    bad = 0
    for name in names or sorted(queries()):
        try:
            result = compare(spark, name, sf_dir)
        except Exception as exc:  # report and go on with the next query
            result = {"query": name, "error": repr(exc)[:500]}
        ok = "error" not in result and (
            ("oracle" in result and result["oracle"] is None)
            or bool(result.get("values_match") and result.get("columns_match")))
        bad += 0 if ok else 1
        print(("OK  " if ok else "BAD ") + str(result), flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))

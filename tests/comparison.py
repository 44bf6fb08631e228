"""Run a query in Spark and its SQL in DuckDB and compare the results."""

from __future__ import annotations

import math
import sys
import time
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if value is None or isinstance(value, (bool, str)):
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def _sorted(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(plain, key=lambda row: tuple(map(repr, row)))


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE"}


def differences(df, con, statement: str) -> list[str]:
    """Empty when names, types, row counts and all values agree."""
    cursor = con.execute(statement)
    duck_types = {d[0]: str(d[1]) for d in cursor.description}
    duck_names, duck_rows = _sorted(list(duck_types), cursor.fetchall())
    spark_names, spark_rows = _sorted(df.columns, df.collect())
    if duck_names != spark_names:
        return [f"columns {spark_names} against {duck_names}"]
    out = [
        f"type of {name}: {kind} against {duck_types[name]}"
        for name, kind in df.dtypes
        if KINDS.get(kind, kind) != duck_types[name]
    ]
    if len(duck_rows) != len(spark_rows):
        out.append(f"rows {len(spark_rows)} against {len(duck_rows)}")
    wrong = [(a, b) for a, b in zip(spark_rows, duck_rows) if a != b]
    if wrong:
        out.append(f"{len(wrong)} rows differ, first {wrong[0][0]} against {wrong[0][1]}")
    if not duck_rows:
        out.append("empty result")
    return out


def main(folder: str, wanted: list[str]) -> None:
    from stopflow.plans import catalog, oracle
    from stopflow.session import build_session

    spark = build_session("8", spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    for name in wanted or list(catalog.QUERIES):
        started = time.time()
        try:
            df = catalog.QUERIES[name](spark, folder)
            if name in oracle.QUERIES:
                found = differences(df, con, oracle.QUERIES[name])
                status = "ok" if not found else "; ".join(found)[:700]
            else:
                rows = df.collect()
                status = f"rows only: {len(rows)} {rows[:3]}"[:500]
        except Exception as error:  # noqa: BLE001 - a report goes on to the next query
            status = "FAILED " + str(error)[:900]
        print(f"{name:26s} {time.time() - started:6.1f}s {status}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])

"""Run registered queries against their SQL: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from barlab.session import build_session
from checks.registry import ORACLES, QUERIES

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    return "nan" if isinstance(v, float) and math.isnan(v) else v


def sorted_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def mismatch(spark, con, name: str, sf_dir: str) -> str | None:
    """None if the query and its SQL agree exactly, else what differs."""
    df = QUERIES[name](spark, sf_dir)
    got = sorted_rows(df.columns, df.collect())
    relation = con.sql(ORACLES[name])
    want = sorted_rows(relation.columns, relation.fetchall())
    if sorted(df.columns) != sorted(relation.columns):
        return f"columns {sorted(df.columns)} / {sorted(relation.columns)}"
    kinds = dict(zip(relation.columns, map(str, relation.types)))
    names = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN",
             "timestamp_ntz": "TIMESTAMP", "date": "DATE"}
    for c, t in df.dtypes:
        if names.get(t) != kinds[c]:
            return f"type of {c}: {t} / {kinds[c]}"
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} of {len(got)} rows differ, first {bad[0]}" if bad else None


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, con = build_session(), oracle_connection(sf_dir)
    for name in names:
        t = time.time()
        try:
            if name in ORACLES:
                found = mismatch(spark, con, name, sf_dir)
                text = "ok" if found is None else "DIFF " + found
            else:
                text = f"rows only: {len(QUERIES[name](spark, sf_dir).collect())}"
        except Exception as e:  # report and go on with the next query
            text = "ERROR " + str(e)[:700]
        print(f"{name:24s} {time.time() - t:6.1f}s {text}", flush=True)


if __name__ == "__main__":
    main()

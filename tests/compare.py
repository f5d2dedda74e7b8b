"""Compare a Spark result with DuckDB's answer to the SQL counterpart."""

from __future__ import annotations

import math

import duckdb

from assaymill.plans.bronze_views import SOURCE_TABLES, table_path


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in SOURCE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def _sort_key(row: tuple):
    return tuple((v is not None, str(type(v).__name__), v if v is not None else 0) for v in row)


def _plain(row) -> tuple:
    return tuple(
        "nan" if isinstance(v, float) and math.isnan(v) else v for v in row
    )


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty if names, types, row counts and exact values agree."""
    names = sorted(df.columns)
    spark_rows = sorted((_plain(r) for r in df.select(*names).collect()), key=_sort_key)
    cursor = con.execute(sql)
    duck_names = [d[0] for d in cursor.description]
    problems = []
    if sorted(duck_names) != names:
        return [f"columns {names} vs {sorted(duck_names)}"]
    order = [duck_names.index(n) for n in names]
    duck_rows = sorted(
        (_plain(tuple(r[i] for i in order)) for r in cursor.fetchall()), key=_sort_key
    )
    if len(spark_rows) != len(duck_rows):
        problems.append(f"{len(spark_rows)} rows vs {len(duck_rows)}")
    for a, b in zip(spark_rows, duck_rows):
        if a != b or [type(v) for v in a] != [type(v) for v in b]:
            problems.append(
                str([(n, u, v) for n, u, v in zip(names, a, b) if u != v or type(u) is not type(v)])
            )
            if len(problems) > 3:
                break
    return problems

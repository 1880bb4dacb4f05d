"""Run registered queries on Spark and their SQL on DuckDB and compare.

    python -m tests.compare [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time
from pathlib import Path

import duckdb

DATA = Path("/root/testdata")


def database(folder: Path) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(folder.glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    return str(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def kind(name: str) -> str:
    """Coarse type family, common to both engines."""
    name = name.lower()
    for family, words in {
        "int": ("bigint", "int", "integer", "smallint", "tinyint", "long", "short"),
        "float": ("double", "float"),
        "text": ("string", "varchar"),
        "bool": ("boolean",),
        "date": ("date",),
        "time": ("timestamp", "timestamp_ntz"),
    }.items():
        if name in words:
            return family
    return name


def compare(df, con, sql: str) -> str:
    """'' when equal, else the first difference."""
    mine = rows_of(df.columns, df.collect())
    relation = con.sql(sql)
    theirs = rows_of(list(relation.columns), relation.fetchall())
    spark_types = {c: kind(t) for c, t in df.dtypes}
    sql_types = {c: kind(str(t)) for c, t in zip(relation.columns, relation.types)}
    if spark_types != sql_types:
        both = sorted(set(spark_types.items()) ^ set(sql_types.items()))
        return f"schema: {both}"
    if len(mine) != len(theirs):
        return f"rows: {len(mine)} != {len(theirs)}"
    for a, b in zip(mine, theirs):
        if a != b:
            return f"values:\n  spark {a}\n  sql   {b}\n  cols  {sorted(df.columns)}"
    return "" if mine else "EMPTY"


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from foretell.sources.session import local_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    folder = DATA / f"sf{args.sf}"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = database(folder)
    bad = 0
    todo = queries()
    oracles = oracle_sql()
    for name in args.names or todo:
        start = time.time()
        try:
            if name in oracles:
                problem = compare(todo[name](spark, str(folder)), con, oracles[name])
            else:
                n = todo[name](spark, str(folder)).count()
                problem = f"rows only: {n}"
        except Exception as error:  # report and go on
            problem = f"ERROR {type(error).__name__}: {str(error)[:1500]}"
        bad += bool(problem) and not problem.startswith("rows only")
        print(f"{name:28s} {time.time() - start:6.2f}s  {problem or 'ok'}", flush=True)
    print(f"{len(args.names or todo)} queries, {bad} differ")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())

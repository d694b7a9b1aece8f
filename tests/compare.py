"""Run registered queries against their SQL: ``python -m tests.compare [sf dir] [query ...]``."""

from __future__ import annotations

import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations".split()
)


def connect(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _rows(table):
    names = sorted(table.column_names)
    columns = [table.column(name).to_pylist() for name in names]
    return sorted(zip(*columns), key=repr)


def _types(table):
    def simple(arrow_type):
        return str(arrow_type).replace("large_", "")

    return {field.name: simple(field.type) for field in table.schema}


def difference(spark_table, sql_table):
    """A description of the first difference, or None."""
    if _types(spark_table) != _types(sql_table):
        return f"schema: {_types(spark_table)} <> {_types(sql_table)}"
    ours, theirs = _rows(spark_table), _rows(sql_table)
    if len(ours) != len(theirs):
        only = [r for r in ours if r not in set(theirs)][:2], [r for r in theirs if r not in set(ours)][:2]
        return f"rows: {len(ours)} <> {len(theirs)}; e.g. {only}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"values: {a} <> {b}"
    return None


def main(sf_dir="/root/testdata/sf0.01", *names):
    import __spark_entry__ as entry
    from siteatlas.session import local_session

    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    bad = 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            table = query(spark, sf_dir).toArrow()
            took = time.time() - start
            problem = difference(table, connection.execute(entry.oracle_sql()[name]).to_arrow_table())
        except Exception as error:  # report and go on with the next query
            took, problem, table = time.time() - start, f"{type(error).__name__}: {str(error)[:1500]}", None
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {took:.1f}s {table.num_rows if table else '-'}", problem or "", flush=True)
    print("all equal" if not bad else f"{bad} differ")


if __name__ == "__main__":
    main(*sys.argv[1:])

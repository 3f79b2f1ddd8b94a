"""Run queries and their SQL side by side: ``python -m checks.compare <folder> [query ...]``."""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES
from checks.roles import BASE_TABLES

SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
                 "timestamp_ntz": "TIMESTAMP"}


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in BASE_TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def differences(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between a DataFrame and a statement: columns, types, then rows."""
    relation = connection.sql(sql)
    types = dict(zip(relation.columns, map(str, relation.types)))
    mine = {f: SPARK_TO_DUCK.get(t, t) for f, t in df.dtypes}
    found = []
    if set(types) != set(mine):
        return [f"columns: {sorted(set(types) ^ set(mine))}"]
    for column in sorted(mine):
        if mine[column] != types[column]:
            found.append(f"type of {column}: {mine[column]} / {types[column]}")
    order = sorted(mine)
    left = Counter(tuple(r) for r in df.select(*order).collect())
    right = Counter(connection.sql(
        f"SELECT {', '.join(order)} FROM ({sql})").fetchall())
    if left != right:
        found.append(f"rows: {sum(left.values())} / {sum(right.values())}, only here "
                     f"{list((left - right).items())[:2]}, only there "
                     f"{list((right - left).items())[:2]}")
    return found


def main(folder: str, names: list[str]) -> int:
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(folder)
    bad = 0
    for name in names or QUERIES:
        start = time.time()
        if name not in ORACLES:
            print(f"----  {name} has no SQL", flush=True)
            continue
        try:
            found = differences(QUERIES[name](spark, folder), connection, ORACLES[name])
        except Exception as error:  # report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:700]}"]
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok':5} {name} {time.time() - start:.1f}s", *found,
              sep="\n      " if found else " ", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)

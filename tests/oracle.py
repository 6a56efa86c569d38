"""Compare registered queries with their SQL counterpart in DuckDB."""

from __future__ import annotations

import datetime
import json
import math
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    return value


def bag(names, rows) -> Counter:
    places = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(json.dumps([plain(r[i]) for i in places], ensure_ascii=False) for r in rows)


def types(names, kinds) -> dict:
    return dict(zip(names, kinds))


SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def type_name(spark_type: str) -> str:
    if spark_type.startswith("array<"):
        return type_name(spark_type[6:-1]) + "[]"
    return SAME_TYPE.get(spark_type, spark_type)


def compare(df, con, sql: str) -> list[str]:
    """Differences, empty when schema, row count and values agree."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    expected = bag(names, cursor.fetchall())
    actual = bag(df.columns, df.collect())
    problems = []
    if sorted(names) != sorted(df.columns):
        problems.append(f"columns {sorted(df.columns)} != {sorted(names)}")
    else:
        for name, kind in df.dtypes:
            if type_name(kind) != kinds[name]:
                problems.append(f"type of {name}: {kind} != {kinds[name]}")
    if sum(actual.values()) != sum(expected.values()):
        problems.append(f"rows {sum(actual.values())} != {sum(expected.values())}")
    if actual != expected:
        only_spark = next(iter((actual - expected).keys()), None)
        only_sql = next(iter((expected - actual).keys()), None)
        problems.append(f"values differ, e.g. {str(only_spark)[:400]} vs {str(only_sql)[:400]}")
    return problems


if __name__ == "__main__":
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    import __spark_entry__ as contract
    from corpusflow import build_session

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:] or list(contract.queries())
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    for name in wanted:
        began = time.time()
        try:
            df = contract.queries()[name](spark, sf_dir)
            sql = contract.oracle_sql().get(name)
            found = compare(df, con, sql) if sql else [f"rows only: {df.count()}"]
        except Exception as error:
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        print(f"{name:26s} {time.time() - began:6.2f}s {'ok' if not found else found}", flush=True)

"""Run registered queries and their SQL on the same tables and compare all rows."""

from __future__ import annotations

import datetime
import glob
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def sql_connection(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def differences(df, con, sql: str) -> list[str]:
    """What differs: columns, types, rows. Empty when the results are equal."""
    names = sorted(df.columns)
    relation = con.sql(sql)
    if sorted(relation.columns) != names:
        return [f"columns {names} against {sorted(relation.columns)}"]
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    theirs = dict(zip(relation.columns, map(str, relation.types)))
    types = [
        f"{f.name}: {f.dataType.simpleString()} against {theirs[f.name]}"
        for f in df.schema.fields
        if kinds.get(f.dataType.simpleString()) != theirs[f.name]
    ]
    ours = Counter(tuple(row[n] for n in names) for row in df.collect())
    order = [relation.columns.index(n) for n in names]
    expected = Counter(tuple(row[i] for i in order) for row in relation.fetchall())
    if ours != expected:
        missing, extra = expected - ours, ours - expected
        types.append(
            f"rows {ours.total()} against {expected.total()}, missing {list(missing)[:2]}, extra {list(extra)[:2]}"
        )
    return types


if __name__ == "__main__":
    import __spark_entry__ as contract
    from scoreflow.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session(
        "compare", "local[8]", **{
            "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
            "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = sql_connection(sf_dir), 0
    for name, fn in contract.queries().items():
        if (wanted and name not in wanted) or name not in contract.oracle_sql():
            continue
        start = time.time()
        try:
            problems = differences(fn(spark, sf_dir), con, contract.oracle_sql()[name])
        except Exception as error:  # noqa: BLE001
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.2f}s {problems or ''}", flush=True)
    print(f"{bad} differ, {datetime.datetime.now():%H:%M:%S}")

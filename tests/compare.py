"""Run registered queries beside their SQL and compare rows, schema and values."""

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(data):
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return con


def _plain(v):
    if v is None:
        return "~"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


DUCK_TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "FLOAT": "float",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
    "DATE": "date",
}


def compare(spark, con, build, sql, data):
    """Empty list when equal, otherwise a list of differences."""
    df = build(spark, data)
    got = [tuple(r) for r in df.collect()]
    rel = con.sql(sql)
    want = rel.fetchall()
    problems = []
    if sorted(df.columns) != sorted(rel.columns):
        return [f"columns {sorted(df.columns)} != {sorted(rel.columns)}"]
    kinds = dict(zip(rel.columns, [DUCK_TYPES.get(str(t), str(t)) for t in rel.types]))
    for name, kind in df.dtypes:
        if kinds[name] != kind:
            problems.append(f"type {name}: {kind} != {kinds[name]}")
    a, b = rows_of(df.columns, got), rows_of(rel.columns, want)
    if len(a) != len(b):
        problems.append(f"rows {len(a)} != {len(b)}")
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        problems.append(f"{len(bad)} rows differ, first {bad[:2]}")
    return problems


if __name__ == "__main__":
    import __spark_entry__ as entry
    from serpscope.session import build_session

    data = sys.argv[1]
    names = sys.argv[2:]
    spark = build_session(
        "compare",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.host": "127.0.0.1",
            "spark.driver.bindAddress": "127.0.0.1",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(data)
    all_queries, sql = entry.queries(), entry.oracle_sql()
    failed = []
    for name in names or all_queries:
        start = time.time()
        try:
            if name in sql:
                problems = compare(spark, con, all_queries[name], sql[name], data)
            else:
                n = all_queries[name](spark, data).count()
                problems = [] if n else ["no rows"]
        except Exception as error:
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        mark = "ok" if not problems else "FAIL " + "; ".join(problems)[:900]
        print(f"{name:32s} {time.time() - start:6.2f}s {mark}", flush=True)
        if problems:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")

"""Compare registered queries with their SQL in DuckDB; ``python -m tests.oracle [folder] [names]``."""

from __future__ import annotations

import datetime
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
}


def connect(folder: str):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def differences(spark, db, function, sql: str, folder: str) -> list[str]:
    """What differs between the Spark result and the SQL result; empty if nothing does."""
    df = function(spark, folder)
    cursor = db.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    found = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} and {sorted(names)}"]
    for field in df.schema.fields:
        mine = KINDS.get(field.dataType.simpleString(), field.dataType.simpleString())
        theirs = kinds[field.name]
        if theirs.startswith("DECIMAL") or theirs == "HUGEINT" or mine != theirs:
            found.append(f"{field.name}: {mine} and {theirs}")
    order = sorted(names)
    left = sorted(tuple(plain(r[c]) for c in order) for r in df.collect())
    at = [names.index(c) for c in order]
    right = sorted(tuple(plain(r[i]) for i in at) for r in cursor.fetchall())
    if len(left) != len(right):
        found.append(f"{len(left)} and {len(right)} rows")
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if wrong:
        found.append(f"{len(wrong)} rows differ, such as {wrong[0]}")
    return found


def main(folder: str, chosen: list[str]) -> int:
    import __spark_entry__ as entry
    from cohortkit.session import build_session

    spark = build_session(
        "oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "10g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(folder)
    oracles, bad = entry.oracle_sql(), 0
    for name, function in entry.queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            if name in oracles:
                found = differences(spark, db, function, oracles[name], folder)
            else:
                found = [] if function(spark, folder).count() else ["no rows"]
        except Exception as error:  # report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok'} {name} {time.time() - start:.1f}s {'' if name in oracles else 'rows only'} {found or ''}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(min(1, main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001", sys.argv[2:])))

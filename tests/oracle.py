"""Compare registered queries with their SQL twins, value by value.

python tests/oracle.py [folder] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import tempfile
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
    "benchmark", "labels", "conversations",
)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, float):
        return value + 0.0  # -0.0 and 0.0 alike
    if isinstance(value, (list, tuple)):
        return tuple(map(_cell, value))
    if isinstance(value, dt.datetime):
        return ("ts", value.isoformat())
    return value


def differences(df, con, sql: str) -> list[str]:
    """What differs between a Spark result and the SQL twin; empty when all is equal."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    twin = [dict(zip(names, row)) for row in cursor.fetchall()]
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    order = sorted(names)
    ours = Counter(tuple(_cell(r[c]) for c in order) for r in df.collect())
    theirs = Counter(tuple(_cell(r[c]) for c in order) for r in twin)
    if ours == theirs:
        # An integer must not face a float: the driver hashes the values with their types.
        kinds = lambda rows: [{type(r[i]).__name__ for r in rows if r[i] is not None} for i in range(len(order))]
        a, b = kinds(ours), kinds(theirs)
        return [f"type of {c}: {x} against {y}" for c, x, y in zip(order, a, b) if x and y and x != y]
    only_ours, only_theirs = ours - theirs, theirs - ours
    lines = [f"rows {sum(ours.values())} against {sum(theirs.values())}, {sum(only_ours.values())} differ"]
    a, b = sorted(only_ours, key=repr)[:3], sorted(only_theirs, key=repr)[:3]
    for x, y in zip(a, b):
        lines.append(str({c: (p, q) for c, p, q in zip(order, x, y) if p != q}))
    return lines


def main() -> int:
    import __spark_entry__ as contract
    from ledgerloom.session import build_session, clear_scratch

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = build_session(
        "oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                 "spark.ui.showConsoleProgress": "false",
                                 "spark.driver.memory": "8g",
                                 "spark.checkpoint.dir": tempfile.mkdtemp(prefix="oracle-")}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    twins, bad = contract.oracle_sql(), 0
    for name, build in contract.queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            if name in twins:
                found = differences(build(spark, folder), con, twins[name])
                state = "equal" if not found else "DIFFERS"
            else:
                rows = build(spark, folder).count()
                found, state = [], f"{rows} rows, no twin"
        except Exception as error:  # report and go on to the next query
            found, state = [str(error)[:1500]], "FAILS"
        bad += bool(found)
        print(f"{name:32s} {state:20s} {time.time() - start:6.1f}s", flush=True)
        for line in found:
            print("    ", line[:600], flush=True)
    clear_scratch(spark)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main())

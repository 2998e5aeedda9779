"""Compare a query with its SQL on the same tables. As a script: ``python tests/oracle.py FOLDER [NAME …]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{os.path.join(folder, name)}.parquet'")
    return con


def plain(value):
    if hasattr(value, "asDict"):
        return tuple(value)
    if isinstance(value, list):
        return tuple(plain(v) for v in value)
    return value


def normal(names: list[str], rows: list) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    table = [tuple(plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(table, key=repr)


def differences(query, sql: str, spark, folder: str, con) -> list[str]:
    frame = query(spark, folder)
    ours = normal(frame.columns, frame.collect())
    result = con.execute(sql)
    theirs = normal([c[0] for c in result.description], result.fetchall())
    found = []
    if ours[0] != theirs[0]:
        found.append(f"columns {ours[0]} / {theirs[0]}")
    if len(ours[1]) != len(theirs[1]):
        found.append(f"rows {len(ours[1])} / {len(theirs[1])}")
    kinds = [(type(x).__name__, type(y).__name__) for r, s in zip(ours[1], theirs[1]) for x, y in zip(r, s)]
    odd = {k for k in kinds if k[0] != k[1] and "NoneType" not in k}
    if odd:
        found.append(f"types {odd}")
    for mine, other in zip(ours[1], theirs[1]):
        if mine != other:
            found.append(f"{repr(mine)[:400]}\n  / {repr(other)[:400]}")
            break
    return found


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from corpusloom.session import build_session

    folder, names = sys.argv[1], sys.argv[2:]
    session = build_session("local[8]", 8, **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    queries, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            if name in sqls:
                found = differences(queries[name], sqls[name], session, folder, connection)
            else:
                found = [] if queries[name](session, folder).count() else ["no rows"]
        except Exception as error:
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        bad += bool(found)
        print(f"{'BAD ' if found else 'ok  '} {name} {time.time() - start:.1f}s", *found, sep="\n  " if found else "", flush=True)
    print(f"{bad} bad")

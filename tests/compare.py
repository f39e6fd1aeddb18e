"""Run every registered query next to its SQL counterpart and compare all values.

    python tests/compare.py [sf folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def connect(sf_dir: str):
    db = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        db.execute(f"create view {path.stem} as select * from '{path}'")
    return db


def _value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(
        (tuple(_value(row[i]) for i in order) for row in rows), key=repr
    )


def spark_answer(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def sql_answer(db, sql):
    found = db.execute(sql)
    return canonical([d[0] for d in found.description], found.fetchall())


def difference(mine, other) -> str | None:
    if mine[0] != other[0]:
        return f"columns {mine[0]} against {other[0]}"
    if mine[1] == other[1]:
        return None
    only_mine = [r for r in mine[1] if r not in set(other[1])][:2]
    only_other = [r for r in other[1] if r not in set(mine[1])][:2]
    return (
        f"{len(mine[1])} rows against {len(other[1])}; only here {only_mine}; "
        f"only there {only_other}"
    )


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from rowgate.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session(
        master="local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "8",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(folder)
    sqls = oracle_sql()
    for name, run in queries().items():
        if wanted and name not in wanted:
            continue
        began = time.time()
        try:
            mine = spark_answer(run(spark, folder))
            took = f"{time.time() - began:.2f}s"
            if name not in sqls:
                print("ROWS ", name, took, len(mine[1]), flush=True)
                continue
            gap = difference(mine, sql_answer(db, sqls[name]))
            print("OK   " if gap is None else "DIFF ", name, took, gap or len(mine[1]), flush=True)
        except Exception as error:  # noqa: BLE001
            print("FAIL ", name, str(error)[:500], flush=True)

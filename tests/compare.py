"""Run registered queries beside their SQL and compare the rows.

    python tests/compare.py [folder] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


_FAMILY = {
    "bigint": "int", "int": "int", "integer": "int", "long": "int", "hugeint": "int",
    "double": "float", "string": "text", "varchar": "text",
    "timestamp_ntz": "timestamp", "timestamp": "timestamp",
}


def family(name: str) -> str:
    return _FAMILY.get(name.lower(), name.lower())


def compare(spark, con, folder: str, name: str, queries, oracles) -> tuple[bool, str]:
    df = queries[name](spark, folder)
    got = df.collect()
    if name not in oracles:
        return True, f"{len(got)} rows, no SQL"
    result = con.execute(oracles[name])
    columns = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(columns)}"
    con.execute(f"CREATE OR REPLACE TEMP VIEW result AS {oracles[name]}")
    theirs = {r[0]: family(r[1]) for r in con.execute("DESCRIBE result").fetchall()}
    ours = {f.name: family(f.dataType.simpleString()) for f in df.schema.fields}
    types = {c: (ours[c], theirs[c]) for c in ours if ours[c] != theirs[c]}
    a, b = rows_of(df.columns, got), rows_of(columns, expected)
    if a != b:
        only_a, only_b = sorted(set(a) - set(b))[:2], sorted(set(b) - set(a))[:2]
        return False, f"{len(a)} vs {len(b)} rows; ours {only_a} theirs {only_b}"
    return not types, f"{len(a)} rows" + (f", types {types}" if types else "")


def main() -> int:
    from wattlake.plans import load_queries
    from wattlake.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    queries, oracles = load_queries()
    names = sys.argv[2:] or list(queries)
    spark = local_session(8, **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    con = connect(folder)
    bad = 0
    for name in names:
        started = time.time()
        try:
            ok, note = compare(spark, con, folder, name, queries, oracles)
        except Exception as error:  # noqa: BLE001
            ok, note = False, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:34} {time.time() - started:6.2f}s  {note}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())

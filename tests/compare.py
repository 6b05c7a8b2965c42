"""Run registered queries on Spark and their oracle SQL on DuckDB and compare the rows.

Usage: python tests/compare.py <sf dir> [query ...]
"""

import collections
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder):
    con = duckdb.connect()
    con.execute("SET threads TO 8")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def norm(value):
    if value is None:
        return "NULL"
    if isinstance(value, float):
        return "NULL" if value != value else repr(round(value, 6) + 0.0)
    if isinstance(value, bool):
        return str(value)
    if hasattr(value, "item"):
        return norm(value.item())
    return str(value)


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return collections.Counter(tuple(norm(r[i]) for i in order) for r in records)


def spark_rows(df):
    return sorted(df.columns), rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    rel = con.sql(sql)
    columns = list(rel.columns)
    return sorted(columns), rows_of(columns, rel.fetchall()), [str(t) for t in rel.types]


def compare(spark, con, folder, name, query, sql):
    start = time.time()
    columns, got = spark_rows(query(spark, folder))
    took = time.time() - start
    if sql is None:
        return True, f"{name}: rows-only {sum(got.values())} rows {took:.1f}s"
    start = time.time()
    wanted_columns, wanted, types = duck_rows(con, sql)
    duck = time.time() - start
    odd = [t for t in types if "HUGEINT" in t or "[]" in t or "STRUCT" in t]
    same = columns == wanted_columns and got == wanted
    note = f"{name}: {'ok' if same else 'DIFF'} {sum(got.values())} rows spark {took:.1f}s duck {duck:.1f}s" + (f" types {odd}" if odd else "")
    if not same:
        note += f"\n  columns {columns} vs {wanted_columns}; rows {sum(got.values())} vs {sum(wanted.values())}"
        note += f"\n  only spark: {list((got - wanted).items())[:4]}\n  only duck:  {list((wanted - got).items())[:4]}"
    return same, note


def main():
    import __spark_entry__ as entry
    from lexframe.session import get_session

    folder, chosen = sys.argv[1], sys.argv[2:]
    spark = get_session("compare", cores=os.environ.get("COMPARE_CPUS", "8"), partitions=8)
    con = connect(folder)
    bad = 0
    for name, query in entry.queries().items():
        if chosen and name not in chosen:
            continue
        try:
            same, note = compare(spark, con, folder, name, query, entry.oracle_sql().get(name))
        except Exception as error:  # noqa: BLE001
            same, note = False, f"{name}: ERROR {str(error)[:1500]}"
        bad += not same
        print(note, flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()

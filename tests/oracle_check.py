"""Compare registered queries with their SQL in DuckDB.

``python tests/oracle_check.py [folder] [name ...]``
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


# Bit-equal doubles and equal integer widths instead of nine digits and families.
STRICT = os.environ.get("STRICT") == "1"


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def plain(value):
    if value is None:
        return None
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return (value if STRICT else float(f"{value:.9g}")) + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def kind(type_name: str) -> str:
    """Type families that must agree between the engines."""
    name = type_name.lower()
    if STRICT:
        return {"int": "integer", "varchar": "string", "timestamp_ntz": "timestamp"}.get(name, name)
    for family, words in {
        "int": ("bigint", "integer", "int"),
        "float": ("double", "float"),
        "time": ("timestamp",),
        "date": ("date",),
        "text": ("varchar", "string"),
        "other": ("hugeint", "decimal"),
    }.items():
        if name in words or (family in ("time", "other") and name.startswith(words)):
            return family
    return name


def compare(name, query, sql, spark, folder, con) -> str | None:
    """None when rows, names and types agree, else what differs."""
    df = query(spark, folder)
    columns = sorted(df.columns)
    ours = Counter(tuple(plain(v) for v in row) for row in df.select(*columns).collect())
    rel = con.sql(sql)
    if sorted(rel.columns) != columns:
        return f"columns {columns} vs {sorted(rel.columns)}"
    types = dict(zip(rel.columns, (str(t) for t in rel.types)))
    mine = dict(df.dtypes)
    odd = {c: (mine[c], types[c]) for c in columns if kind(mine[c]) != kind(types[c])}
    if odd:
        return f"types {odd}"
    listed = ", ".join(f'"{c}"' for c in columns)
    theirs = Counter(
        tuple(plain(v) for v in row) for row in con.execute(f"select {listed} from ({sql})").fetchall()
    )
    if ours != theirs:
        return (
            f"rows {sum(ours.values())} vs {sum(theirs.values())}; only ours {list((ours - theirs).items())[:3]}; "
            f"only theirs {list((theirs - ours).items())[:3]}; columns {columns}"
        )
    if not ours:
        return "both empty"
    return None


def main() -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from nightledger.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session("oracle-check", partitions=int(os.environ.get("PARTITIONS", "8")))
    spark.conf.set("spark.sql.session.timeZone", os.environ.get("SESSION_TZ", "UTC"))
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    sqls = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            if name in sqls:
                found = compare(name, query, sqls[name], spark, folder, con)
            else:
                found = None if query(spark, folder).count() else "empty"
        except Exception as error:
            found = f"{type(error).__name__}: {str(error)[:700]}"
        bad += found is not None
        print(f"{'ok  ' if found is None else 'FAIL'} {name} {time.time() - start:.1f}s {found or ''}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    raise SystemExit(main())

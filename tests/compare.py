"""Run every query and its SQL twin on the same tables and compare all values.

    python tests/compare.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def rows(records, names) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_value(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def compare(spark, con, query, sql, sf_dir) -> tuple[bool, str]:
    df = query(spark, sf_dir)
    mine, names = rows(df.collect(), df.columns), df.columns
    res = con.execute(sql)
    sql_names = [c[0] for c in res.description]
    theirs = rows(res.fetchall(), sql_names)
    if sorted(names) != sorted(sql_names):
        return False, f"columns {sorted(names)} vs {sorted(sql_names)}"
    if len(mine) != len(theirs):
        return False, f"{len(mine)} rows vs {len(theirs)}"
    for a, b in zip(mine, theirs):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return False, f"{a} vs {b}"
    return True, f"{len(mine)} rows"


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", os.environ.get("COMPARE_TZ", "UTC")).getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, failed = duck(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            ok, note = compare(spark, con, query, sqls[name], sf_dir)
        except Exception as e:  # report and go on with the next query
            ok, note = False, f"{type(e).__name__}: {str(e)[:600]}"
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:26s} {time.time() - start:6.2f}s  {note}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())

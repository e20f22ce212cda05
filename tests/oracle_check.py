"""Compare registered queries with their SQL: ``python tests/oracle_check.py [sf_dir] [query …]``."""

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def differences(spark, con, sf_dir, query, sql):
    """(rows only in Spark, rows only in SQL, number of rows)."""
    df = query(spark, sf_dir)
    columns = sorted(df.columns)
    mine = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns, (sorted(names), columns)
    order = [names.index(c) for c in columns]
    theirs = sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=repr)
    if mine == theirs:
        return [], [], len(mine)
    from collections import Counter
    a, b = Counter(mine), Counter(theirs)
    return list((a - b).elements()), list((b - a).elements()), len(mine)


def main(sf_dir="/root/testdata/sf0.01", *names):
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            extra, missing, n = differences(spark, con, sf_dir, query, sqls[name])
            ok = not extra and not missing
            print(f"{'ok ' if ok else 'BAD'} {name} rows={n} {time.time() - start:.1f}s", flush=True)
            if not ok:
                bad += 1
                print("   only spark", len(extra), extra[:3], "\n   only sql  ", len(missing), missing[:3], flush=True)
        except Exception as e:
            bad += 1
            print(f"ERR {name} {type(e).__name__} {str(e)[:600]}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main(*sys.argv[1:])

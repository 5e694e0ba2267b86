"""Run every registered query next to its SQL twin: python tests/check_oracle.py <sf_dir> [names...]"""

import math
import os
import sys
import tempfile
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else (int(v) if v == int(v) and abs(v) < 1e15 else round(v, 9))
    if isinstance(v, bool) or v is None:
        return v
    if hasattr(v, "as_integer_ratio"):
        return _plain(float(v))
    return v


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, sf_dir, query, sql):
    """None when both agree, else what differs."""
    df = query(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    a, b = canonical(df.columns, got), canonical(names, want)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ, first {bad[0]}"
    return None


def main():
    from pyspark.sql import SparkSession

    from cropmosaic.plans.catalog import QUERIES
    from cropmosaic.plans.oracle import ORACLE

    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="cropmosaic-oracle-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        if name not in ORACLE:
            print(f"ROWS {name} {QUERIES[name](spark, sf_dir).count()} {time.time() - start:.1f}s", flush=True)
            continue
        try:
            problem = compare(spark, con, sf_dir, QUERIES[name], ORACLE[name])
        except Exception as e:
            problem = f"{type(e).__name__} {str(e)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'BAD '} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed of {len(names)}")


if __name__ == "__main__":
    main()

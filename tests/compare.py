"""Run every query and its SQL twin at one scale and compare: `python tests/compare.py SF_DIR [name ...]`."""

import datetime
import decimal
import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def cell(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (int, float, decimal.Decimal)):
        f = float(v)
        return "nan" if math.isnan(f) else f
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([cell(r[i]) for i in order] for r in rows), key=lambda r: [(x is None, str(type(x)), x) if x is not None else (True, "", "") for x in r])


def difference(spark_df, con, sql) -> str | None:
    cur = con.execute(sql)
    sql_columns = [c[0] for c in cur.description]
    sql_types = [str(c[1]) for c in cur.description]
    want = cur.fetchall()
    if sorted(spark_df.columns) != sorted(sql_columns):
        return f"columns {sorted(spark_df.columns)} and {sorted(sql_columns)}"
    got = spark_df.collect()
    if len(got) != len(want):
        return f"{len(got)} rows and {len(want)} rows"
    a, b = rows_of(spark_df.columns, got), rows_of(sql_columns, want)
    for x, y in zip(a, b):
        if x != y:
            return f"{sorted(sql_columns)}: {x} and {y}"
    huge = [c for c, t in zip(sql_columns, sql_types) if "HUGEINT" in t or "DECIMAL" in t]
    if huge:
        return f"wide types in {huge}"
    return None


def main():
    sys.path.insert(0, ".")
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", "12g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir, names = sys.argv[1], sys.argv[2:]
    queries, oracles, con = entry.queries(), entry.oracle_sql(), connect(sf_dir)
    assert set(oracles) <= set(queries), set(oracles) - set(queries)
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            found = difference(df, con, oracles[name]) if name in oracles else f"no oracle, {df.count()} rows"
        except Exception as e:
            found = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.1f}s {found or ''}", flush=True)
    print(f"{bad} of {len(names or queries)} differ")


if __name__ == "__main__":
    main()

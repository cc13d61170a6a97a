"""Compare example jobs with their SQL: row count, column names, sorted values."""

import math
import os
import sys

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        return (2, repr(float(v) + 0.0))
    return (3, str(v))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(plain(r[i]) for i in order) for r in rows])


def compare(spark, con, sf_dir, query, sql):
    """None when equal, else a short account of the difference."""
    df = query(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    want = rows_of(names, res.fetchall())
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        g, w = bad[0]
        cols = sorted(names)
        diff = [(c, x[1][:80], y[1][:80]) for c, x, y in zip(cols, g, w) if x != y]
        return f"{len(bad)} of {len(got)} rows differ, first: {diff} in {[x[1][:40] for x in g]}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import time

    import __spark_entry__ as entry
    from guardlake.session import build_session

    sf = sys.argv[1]
    spark = build_session(
        "compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
                                  "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    if os.environ.get("ROWS_PER_CHUNK"):
        spark.conf.set("spark.guardlake.rowsPerChunk", os.environ["ROWS_PER_CHUNK"])
    con = connect(sf)
    queries, sqls = entry.queries(), entry.oracle_sql()
    for name in sys.argv[2:] or list(queries):
        start = time.time()
        if name not in sqls:
            n = queries[name](spark, sf).count()
            print(f"{name:32s} rows only {n} {time.time() - start:.2f}s", flush=True)
            continue
        try:
            diff = compare(spark, con, sf, queries[name], sqls[name])
        except Exception as e:  # noqa: BLE001
            diff = "ERROR " + str(e)[:900]
        print(f"{name:32s} {'ok' if diff is None else 'DIFF ' + diff} {time.time() - start:.2f}s", flush=True)

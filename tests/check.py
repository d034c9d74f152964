"""Run registered queries against DuckDB: ``python tests/check.py [sf] [name ...]``."""

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    return repr(v)


def _norm(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql):
    """(equal, message) of a Spark frame and a DuckDB query; types count: 1 and 1.0 differ."""
    cols, rows = _norm(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    want_cols, want = _norm([d[0] for d in cur.description], cur.fetchall())
    if cols != want_cols:
        return False, f"columns {cols} != {want_cols}"
    if rows == want:
        return True, f"{len(rows)} rows"
    a, b = set(rows) - set(want), set(want) - set(rows)
    return False, f"rows {len(rows)} vs {len(want)}; only spark {list(a)[:2]}; only sql {list(b)[:2]}"


def main():
    import __spark_entry__ as entry
    from rtmart.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                                      "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = duck(sf_dir), entry.oracle_sql()
    bad = []
    for name, fn in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            ok, message = compare(fn(spark, sf_dir), con, sql[name])
        except Exception as e:  # noqa: BLE001
            ok, message = False, f"{type(e).__name__}: {str(e)[:700]}"
        print(f"{'ok ' if ok else 'BAD'} {name:28s} {time.time() - start:6.2f}s {message}", flush=True)
        if not ok:
            bad.append(name)
    print("bad:", bad)


if __name__ == "__main__":
    main()

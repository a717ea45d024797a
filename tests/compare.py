"""Run queries() and oracle_sql() side by side: python tests/compare.py <sf dir> [query ...]"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        if isinstance(v, float):
            return "null" if math.isnan(v) else f"{v:.6g}"
        return "null" if v is None else str(v)

    return sorted(tuple(value(row[i]) for i in order) for row in rows)


def compare(spark_df, con, sql):
    result = con.execute(sql)
    want_columns = [c[0] for c in result.description]
    want = normal(result.fetchall(), want_columns)
    got = normal([tuple(r) for r in spark_df.collect()], spark_df.columns)
    if sorted(want_columns) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(want_columns)}"
    if len(want) != len(got):
        return f"rows {len(got)} != {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"value {str(g)[:700]}\n   != {str(w)[:700]}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as entry_module
    from bench import session
    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark, con = session(), duck(sf_dir)
    oracles, bad = entry_module.oracle_sql(), 0
    for name, fn in entry_module.queries().items():
        if wanted and name not in wanted:
            continue
        t = time.time()
        try:
            if name in oracles:
                problem = compare(fn(spark, sf_dir), con, oracles[name])
            else:
                problem = None if fn(spark, sf_dir).count() else "no rows"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - t:.2f}s {problem or ''}", flush=True)
    print("missing oracle:", sorted(set(entry_module.queries()) - set(oracles)), "orphans:", sorted(set(oracles) - set(entry_module.queries())))
    sys.exit(bad > 0)

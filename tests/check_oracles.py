"""Run queries next to their SQL and compare: python tests/check_oracles.py DIR [NAME ...]."""

import math
import sys
import time
import traceback
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from regfacts import queries as catalog  # noqa: E402
from regfacts.session import get_spark  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def tidy(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "~"
    if isinstance(value, float):
        return f"{value:.6g}" if value != int(value) else str(int(value))
    if hasattr(value, "isoformat"):
        return value.isoformat()[:19].replace("T00:00:00", "")
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(tidy(r[i]) for i in order) for r in rows)


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def check(spark, con, sf_dir, name):
    df = catalog.QUERIES[name](spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    if name not in catalog.ORACLES:
        return len(got), None
    result = con.execute(catalog.ORACLES[name])
    columns = [d[0] for d in result.description]
    want = rows_of(columns, result.fetchall())
    if sorted(columns) != sorted(df.columns):
        return len(got), f"columns {sorted(df.columns)} / {sorted(columns)}"
    if got != want:
        a, b = set(got) - set(want), set(want) - set(got)
        return len(got), f"rows {len(got)}/{len(want)} only here {list(a)[:2]} only there {list(b)[:2]}"
    return len(got), None


if __name__ == "__main__":
    sf = sys.argv[1]
    session = get_spark("local[8]", **{"spark.sql.shuffle.partitions": "8",
                                       "spark.driver.memory": "12g"})
    session.sparkContext.setLogLevel("ERROR")
    db = connect(sf)
    for q in sys.argv[2:] or list(catalog.QUERIES):
        start = time.time()
        try:
            n, problem = check(session, db, sf, q)
        except Exception:
            n, problem = 0, traceback.format_exc()[-900:]
        print(f"{'FAIL' if problem else 'ok'} {q} rows={n} {time.time() - start:.1f}s {problem or ''}",
              flush=True)

"""Compare registered queries with their SQL on the given tables.

    python tests/parity.py [sf] [query ...]
"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from navlake.plans.oracles import ORACLES  # noqa: E402
from navlake.plans.queries import QUERIES  # noqa: E402
from navlake.session import local_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(columns, rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(r[i] for i in order) for r in rows),
        key=lambda r: tuple((v is None, str(v)) for v in r),
    )


def differences(spark, con, name: str, sf_dir: str) -> str | None:
    """None when rows and column names agree, else a short description."""
    frame = QUERIES[name](spark, sf_dir)
    got = canonical(frame.columns, frame.collect())
    result = con.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    want = canonical(columns, result.fetchall())
    if sorted(frame.columns) != sorted(columns):
        return f"columns {sorted(frame.columns)} != {sorted(columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    if wrong:
        return f"{len(wrong)} of {len(got)} rows differ, first: {wrong[0]}"
    return None if got else "no rows"


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    directory = f"/root/testdata/sf{sf}"
    session = local_session("parity", "8")
    database = oracle_connection(directory)
    failed = 0
    for query_name in sys.argv[2:] or QUERIES:
        start = time.time()
        try:
            problem = differences(session, database, query_name, directory)
        except Exception as error:  # report and go on to the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'OK ' if problem is None else 'BAD'} {query_name} {time.time() - start:.1f}s"
              f"{'' if problem is None else ' ' + problem}", flush=True)
    print(f"{failed} failed")

"""Time one category's returns as a loop of point lookups, fund by fund, in DuckDB.

The comparison figure for the set-based job: one label lookup and two as-of lookups per
fund, each a statement of its own over the deduplicated history in Parquet files.
"""

import datetime as dt
import json
import os
import tempfile
import time

import duckdb

from navlake.plans.fixtures import AS_OF
from navlake.plans.oracles import MASTER, NAV_ZERO

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
LOOKUP = "SELECT max(nav_date), arg_max(nav, nav_date) FROM nav WHERE scheme_code = $1 AND nav_date <= $2"


def main() -> None:
    con = duckdb.connect()
    for name in ("lineitem", "part"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    folder = tempfile.mkdtemp(prefix="run-")
    con.execute(f"COPY (WITH {NAV_ZERO} SELECT *, year(nav_date) AS year FROM nav "
                f"ORDER BY scheme_code, nav_date) TO '{folder}/nav' "
                "(FORMAT parquet, PARTITION_BY (year))")
    con.execute(f"COPY (WITH {MASTER} SELECT * FROM master) TO '{folder}/master.parquet'")
    con.execute(f"CREATE VIEW nav AS SELECT * FROM read_parquet('{folder}/nav/*/*.parquet')")
    con.execute(f"CREATE VIEW master AS SELECT * FROM '{folder}/master.parquet'")

    today = dt.date.fromisoformat(AS_OF)
    start = today.replace(year=today.year - 1)
    began = time.perf_counter()
    codes = [r[0] for r in con.execute(
        "SELECT scheme_code FROM master WHERE upper(category) = 'ECONOMY' ORDER BY scheme_name"
    ).fetchall()]
    for code in codes:
        con.execute("SELECT * FROM master WHERE scheme_code = ?", [code]).fetchone()
        con.execute(LOOKUP, [code, start]).fetchone()
        con.execute(LOOKUP, [code, today]).fetchone()
    seconds = time.perf_counter() - began
    print(json.dumps({
        "metric": "one category, one period, fund-by-fund loop", "funds": len(codes),
        "value": round(seconds, 3), "unit": "sec", "sf": os.path.basename(SF_DIR.rstrip("/")),
    }))


if __name__ == "__main__":
    main()

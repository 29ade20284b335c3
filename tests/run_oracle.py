"""Run every registered query against its DuckDB oracle: ``python tests/run_oracle.py [sf_dir] [name ...]``."""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from compare import compare, duck  # noqa: E402


def main(argv: list[str]) -> int:
    sf = argv[0] if argv else "/root/testdata/sf0.01"
    only = set(argv[1:])
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf)
    qs, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t = time.time()
        try:
            df = fn(spark, sf)
            if name in oracle:
                ok, msg = compare(df, con, oracle[name])
            else:
                ok, msg = True, f"rows-only: {df.count()} rows"
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:300]}"
            traceback.print_exc(limit=3)
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {name:32s} {time.time() - t:6.1f}s  {msg}", flush=True)
    print(f"{len(qs) - bad}/{len(qs)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))

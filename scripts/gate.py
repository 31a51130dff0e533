"""Local correctness gate: run every registered query in Spark and its DuckDB
twin on the same Parquet, compare names / rows / values (like the driver).

    python scripts/gate.py [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from orderflow.plans.catalog import oracle_sql, spark_queries  # noqa: E402
from orderflow.plans.compare import compare, duckdb_con  # noqa: E402
from orderflow.session import local_session  # noqa: E402


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = argv[2:]
    spark = local_session()
    con = duckdb_con(sf_dir)
    qs, sqls = spark_queries(), oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and not any(o in name for o in only):
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in sqls:
                r = compare(df, con, sqls[name])
                ok = r["values_match"]
                msg = f"{r['spark_rows']} rows"
            else:
                n = df.count()
                ok, r, msg = True, {}, f"{n} rows (no oracle)"
        except Exception as e:  # report and continue
            ok, r, msg = False, {}, f"ERROR {type(e).__name__}: {str(e)[:300]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {name:32s} {msg} {time.time() - t0:.1f}s", flush=True)
        if not ok and r:
            print("   ", json.dumps({k: r.get(k) for k in ("spark_rows", "oracle_rows",
                                                          "spark_cols", "oracle_cols",
                                                          "only_spark", "only_oracle")},
                                    default=str)[:3000])
    print(f"{bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))

"""Dev tool: run every registered query against its DuckDB oracle (like the driver's correctness gate).

Usage: python tests/check_all.py [sf_dir] [key-prefix ...]
"""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import oracle  # noqa: E402

from commitlens.session import build_session  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = sys.argv[2:]
    import __spark_entry__ as E
    spark = build_session("local[8]")
    con = oracle.duck(sf)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for key, fn in qs.items():
        if prefixes and not any(key.startswith(p) for p in prefixes):
            continue
        t = time.time()
        try:
            df = fn(spark, sf)
            if key in sqls:
                ok, msg = oracle.compare(df, sqls[key], sf, con)
            else:
                ok, msg = True, f"{df.count()} rows (no oracle)"
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"{type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {key:40s} {time.time() - t:6.2f}s {msg}", flush=True)
    print(f"{bad} failing")


if __name__ == "__main__":
    main()

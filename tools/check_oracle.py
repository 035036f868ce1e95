"""Run registered queries next to their oracle SQL: python tools/check_oracle.py [sf_dir] [name ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from starledger.bindings.catalog import ORACLES, QUERIES  # noqa: E402
from starledger.bindings.compare import compare, oracle_connection  # noqa: E402
from starledger.session import build_session  # noqa: E402


def main(arguments: list[str]) -> int:
    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.01"
    names = arguments[1:] or list(QUERIES)
    settings = {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"}
    spark = build_session("check", "local[8]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(QUERIES[name](spark, sf_dir), connection, ORACLES.get(name))
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - start:6.2f}s {name}"
              + ("" if name in ORACLES else " (no oracle)") + (f"\n     {problem}" if problem else ""),
              flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    spark.stop()
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))

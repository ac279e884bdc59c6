"""Run every query against the oracle: python tests/run_oracle.py <sf dir> [names...]."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from finsieve.plans import catalog  # noqa: E402
from finsieve.session import local_session  # noqa: E402
from tests.oracle import connect, difference  # noqa: E402

if __name__ == "__main__":
    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark, con = local_session(8), connect(sf_dir)
    queries, sql = catalog.queries(), catalog.oracle_sql()
    bad = 0
    for name, run in queries.items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in sql:
                problem = difference(run(spark, sf_dir), con, sql[name])
            else:
                problem = None if run(spark, sf_dir).count() > 0 else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print("failures:", bad)

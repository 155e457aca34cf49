"""Run registered queries against their DuckDB oracles (local check tool).

usage: python check_oracles.py [sf_dir] [name ...]
"""

import sys
import time

sys.path.insert(0, __import__("os").path.dirname(__import__("os").path.abspath(__file__)))

from sitecall.plans.registry import load_all  # noqa: E402
from sitecall.session import local_session  # noqa: E402
from sitecall.testing import compare  # noqa: E402


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = local_session(8)
    reg = load_all()
    bad = 0
    for name, q in reg.items():
        if names and name not in names:
            continue
        t = time.time()
        try:
            df = q.run(spark, sf)
            if q.oracle:
                ok, msg = compare(df, q.oracle, sf)
            else:
                n = df.count()
                ok, msg = True, f"{n} rows (no oracle)"
        except Exception as exc:  # report and continue
            ok, msg = False, f"ERROR {type(exc).__name__}: {str(exc)[:400]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {name:28s} {q.survey_id:8s} {time.time() - t:6.1f}s {msg}", flush=True)
    print(f"{bad} failing")


if __name__ == "__main__":
    main(sys.argv)

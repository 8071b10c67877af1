"""Compare every registered query with its SQL: ``python tests/check_all.py [dir] [names...]``."""

import sys
import time
import traceback

sys.path[:0] = [__file__.rsplit("/", 2)[0], __file__.rsplit("/", 1)[0]]

import oracle  # noqa: E402

from shopgrain.plans.all_queries import ORACLE, QUERIES  # noqa: E402
from shopgrain.session import local_session  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, con = local_session(), oracle.connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLE:
                notes = oracle.differences(df, con, ORACLE[name])
                state = "ok" if not notes else "DIFF"
            else:
                notes, state = [], f"rows {len(df.collect())}"
        except Exception as e:  # noqa: BLE001
            notes, state = [str(e)[:900] or traceback.format_exc()[-900:]], "ERROR"
        bad += state in ("DIFF", "ERROR")
        print(f"{state:10} {name:28} {time.time() - start:6.2f}s", flush=True)
        for n in notes:
            print("    ", n[:1200], flush=True)
    print(f"{len(names)} queries, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)

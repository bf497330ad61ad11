"""python tests/check_all.py [sf_dir] [name ...]: every query against its SQL, with times."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry
from gridpulse.session import local_session
from tests.oracle import connect, differences

if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = local_session(), connect(sf_dir)
    sqls, failed = entry.oracle_sql(), []
    names = sys.argv[2:] or list(entry.queries())
    assert not set(sqls) - set(entry.queries()), set(sqls) - set(entry.queries())
    for name in names:
        start = time.time()
        try:
            df = entry.queries()[name](spark, sf_dir)
            if name in sqls:
                bad = differences(df, con, sqls[name])
                note = "ok" if not bad else f"DIFFERS {bad}"
            else:
                bad, note = [], f"rows {df.count()}"
        except Exception as e:
            bad, note = [str(e)], f"ERROR {str(e)[:1500]}"
        if bad:
            failed.append(name)
        print(f"{name:28s} {time.time() - start:6.2f}s {note}", flush=True)
    print("failed:", failed)

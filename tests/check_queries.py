"""Compare queries with their SQL: python tests/check_queries.py FOLDER [name ...]"""

import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from sparktab.queries import ORACLES, QUERIES  # noqa: E402
from sparktab.session import local_session  # noqa: E402
from tests.compare import connect, difference  # noqa: E402

if __name__ == "__main__":
    folder, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark, db = local_session(), connect(folder)
    for name in names:
        began = time.time()
        try:
            df = QUERIES[name](spark, folder)
            found = difference(df, db, ORACLES[name]) if name in ORACLES else f"no SQL, {len(df.collect())} rows"
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__}: {str(error)[:900]}"
            if "-v" in sys.argv:
                traceback.print_exc()
        print(f"{name:24} {time.time() - began:6.2f}s  {found or 'equal'}", flush=True)

"""Command line: compare every query with its SQL check. ``check_all.py [folder] [name ...]``"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as contract
from crawlsight.session import local_session
from tests.compare import connect, differences


def main(folder: str, names: list[str]) -> int:
    spark = local_session(8)
    db = connect(folder)
    checks = contract.oracle_sql()
    bad = 0
    for name, run in contract.queries().items():
        if names and not any(name.startswith(each) for each in names):
            continue
        start = time.time()
        try:
            frame = run(spark, folder)
            if name in checks:
                problems = differences(frame, db, checks[name])
                note = f"ok, {frame.count()} rows" if not problems else "; ".join(problems)
            else:
                note = f"ok, rows only: {frame.count()}"
        except Exception as error:  # noqa: BLE001 - report and go on
            note = f"{type(error).__name__}: {str(error)[:600]}"
        bad += not note.startswith("ok")
        print(f"{time.time() - start:6.2f}s  {name}: {note}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    args = sys.argv[1:]
    sys.exit(main(args[0] if args else "/root/testdata/sf0.01", args[1:]) > 0)

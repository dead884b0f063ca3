"""Run registered queries against their SQL: python tests/check_all.py SF_DIR [name ...]"""

import sys
import time
import traceback
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

import __spark_entry__ as entry  # noqa: E402
from compare import connect, differences  # noqa: E402

from claimflow.session import build_session  # noqa: E402


def main():
    sf, names = sys.argv[1], sys.argv[2:]
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(sf), entry.oracle_sql(), 0
    for name, function in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = function(spark, sf)
            problems = differences(df, con, sqls[name]) if name in sqls else [f"no SQL, {df.count()} rows"]
        except Exception as error:  # noqa: BLE001
            problems = [traceback.format_exc()[-1500:] if "-v" in sys.argv else f"{type(error).__name__}: {str(error)[:700]}"]
        bad += bool(problems)
        print(f"{'BAD' if problems else 'ok '} {name} {time.time() - start:.1f}s", *problems, sep="\n    " if problems else " ", flush=True)
    print("bad:", bad)
    spark.stop()


main()

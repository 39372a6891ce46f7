"""Run every registered query and compare it with its SQL twin.

    python tests/check_all.py [scale] [query ...]
"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from stpanel.operators.storage import release  # noqa: E402
from tests.compare import TESTDATA, connect, differences  # noqa: E402


def main(scale="0.01", *names):
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf = f"{TESTDATA}/sf{scale}"
    con, oracles = connect(sf), entry.oracle_sql()
    failed = 0
    for name, fn in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = fn(spark, sf)
            if name in oracles:
                found = differences(df, con, oracles[name])
            else:
                found = [] if df.count() else ["no rows"]
        except Exception as error:  # noqa: BLE001
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        release(spark)
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.2f}s", *found, flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main(*sys.argv[1:])

"""Run queries against DuckDB by hand: python tests/check_oracle.py <sf_dir> [name ...]"""

import sys
import time
import tempfile
import traceback
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parent.parent), str(Path(__file__).resolve().parent)]

import __spark_entry__ as entry  # noqa: E402
from oracle import connect, differences  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

folder, names = sys.argv[1], sys.argv[2:]
work = tempfile.mkdtemp(prefix="run-", dir="/tmp")
spark = (
    SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
    .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g").config("spark.checkpoint.dir", work)
    .config("spark.sql.warehouse.dir", f"{work}/warehouse").getOrCreate()
)
spark.sparkContext.setLogLevel("ERROR")
con, sql, bad = connect(folder), entry.oracle_sql(), 0
for name, run in entry.queries().items():
    if names and name not in names:
        continue
    started = time.time()
    try:
        df = run(spark, folder)
        found = differences(df, con, sql[name]) if name in sql else [] if df.count() else ["no rows"]
    except Exception as error:
        found = [f"{type(error).__name__}: {str(error)[:600]}"]
        if names:
            traceback.print_exc()
    bad += bool(found)
    print(f"{'FAIL' if found else 'ok  '} {name:28s} {time.time() - started:6.2f}s {'; '.join(found)}", flush=True)
print(f"{bad} failed")

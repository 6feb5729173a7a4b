"""Run registered queries beside their SQL: python tests/check.py SF_DIR [name part ...]"""

import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from compare import connect, differences  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402

if __name__ == "__main__":
    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    oracles = oracle_sql()
    for name, query in queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            if name in oracles:
                problems = differences(df, con, oracles[name])
                label = "ok" if not problems else "DIFF"
            else:
                problems, label = [], f"rows {df.count()}"
        except Exception as e:
            problems, label = [str(e)[:1500]], "ERROR"
            if len(wanted) == 1:
                traceback.print_exc()
        bad += bool(problems)
        print(f"{label:8} {time.time() - start:6.2f}s {name} {' // '.join(problems)}", flush=True)
    print("problems:", bad)

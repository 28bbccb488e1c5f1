"""Check registered queries against their SQL: check.py FOLDER [NAME ...]."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from tests.compare import difference, duck, duck_rows, spark_rows  # noqa: E402
from tillstream.session import build_session  # noqa: E402


def main(folder: str, names: list[str]) -> int:
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = duck(folder), oracle_sql(), 0
    for name, fn in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            rows = spark_rows(fn(spark, folder))
            verdict = difference(rows, duck_rows(con, sqls[name])) if name in sqls else "no SQL"
            n = len(rows[1])
        except Exception as error:  # report and go on with the next query
            verdict, n = f"failed: {str(error)[:600]}", -1
        bad += bool(verdict) and verdict != "no SQL"
        print(f"{name:32s} {time.time() - start:6.2f}s {n:8d} rows  {verdict or 'equal'}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))

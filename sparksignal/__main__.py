"""Command line: ``python -m sparksignal <command> ...``.

  run LANDING WAREHOUSE     the daily batch over landed files (plans.daily_run)
  query NAME SF_DIR [OUT]   one registered query over the driver tables; prints the
                            row count, or writes parquet to OUT

The master comes from ``SPARK_MASTER`` (default ``local[$BENCH_CPUS]``); on a
cluster also set ``spark.checkpoint.dir`` to shared storage.
"""

from __future__ import annotations

import sys

from sparksignal.session import get_spark


def main(argv: list[str]) -> int:
    if len(argv) < 2 or argv[0] not in {"run", "query"}:
        print(__doc__)
        return 2
    spark = get_spark("sparksignal-cli")
    try:
        if argv[0] == "run":
            from sparksignal.plans import daily_run

            for name, n in daily_run.run(spark, argv[1], argv[2]).items():
                print(f"{name}\t{n}")
        else:
            from sparksignal.catalog import QUERIES

            df = QUERIES[argv[1]](spark, argv[2])
            if len(argv) > 3:
                df.write.mode("overwrite").parquet(argv[3])
            else:
                print(df.count())
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))

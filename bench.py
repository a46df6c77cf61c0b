"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from fringeframe.plans import catalog  # noqa: E402
from fringeframe.session import build_session, clear_tables  # noqa: E402

HEADLINE = ["flagship", "flg7", "flg8", "flg13", "agg1", "jn3", "jn5", "jn16", "agg18", "agg19", "cal1", "flt16_exact", "jn6", "agg10", "agg15", "win1",
            "det3", "agg34", "str1_stream", "snk1"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": str(max(8, int(cpus) if cpus.isdigit() else 8)),
                                                        "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    queries["agg7"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # start the session
    times = {}
    for name in HEADLINE:
        t = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t, 3)
        clear_tables(spark)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", "")}))
    spark.stop()


if __name__ == "__main__":
    main()

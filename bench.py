"""Time the headline queries and print one line of JSON.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs in full, into a sink that discards the rows. One small query runs first, so
that starting the session counts for none of them.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from backframe.plans import QUERIES  # noqa: E402
from backframe.session import local_session  # noqa: E402

HEADLINE = [
    "rolling_ratio_100d",
    "rolling_batting_average",
    "rolling_ratio_exact_hours",
    "band_self_join",
    "rolling_global",
    "rolling_global_100d",
    "assemble_game_row",
    "rolling_pair_features",
    "streak_parity",
    "streak_entering",
    "ordered_split",
    "box_totals",
    "corr_pearson",
    "corr_ratio",
    "corr_cramers_v",
    "brute_cat_cat",
    "brute_con_con",
    "brute_cat_con",
    "brute_con_con_mor",
    "mean_of_response",
    "class_histogram",
    "class_kde",
    "box_summary",
    "logit_univariate",
    "knn_classify",
    "summary_stats",
    "contingency",
    "lowess_trend",
    "logreg_classify",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["scan_parquet"](spark, sf_dir).count()
    names = sys.argv[1:] or HEADLINE
    spent = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        spent[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(spent.values()), 3),
                "unit": "sec",
                "queries": spent,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

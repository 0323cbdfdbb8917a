"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR is the data folder, BENCH_CPUS the number of local task slots.
Every query is run to the end (all rows, all columns) into a no-op sink.
"""

from __future__ import annotations

import json
import os
import time

from gridloom.queries.catalog import all_queries
from gridloom.session import local_session
from gridloom.sources.scratch import clear_scratch

HEADLINE = (
    "io7_repeat_rows", "pf10_fill_by_type", "jn3_semi_join", "jn6_null_safe_join", "ag4_group_having",
    "ag7_target_rate", "ag11_describe", "ag14_quantiles", "wn1_rank_in_group", "wn3_top_by_limit",
    "wn4_row_index", "so2_latest_row", "rs5_finalize", "sc7_preprocess_text", "co5_clean_groups", "co8_mean_fill",
    "co12_series_features", "fe1_set_encoder", "fe5_target_encode", "fe9_scale", "fe11_tfidf", "ml2_time_split",
    "ml7_ridge", "ml9_logistic", "ml14_gradient_descent", "ml21_grid_search", "ml23_cross_validate", "me1_gini",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("gridloom-bench")
    registered = all_queries()
    spark.read.parquet(f"{folder}/lineitem.parquet").count()  # start-up is not a query's time
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        registered[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    clear_scratch(spark)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()

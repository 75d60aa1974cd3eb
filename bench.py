"""Times of the headline queries: one JSON line on standard output.

Each query runs twice into a sink that discards the rows; the second time counts. The raw log that some of them
read is written in the first one.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rollcall.session import build_session  # noqa: E402
from suite.registry import load  # noqa: E402

HEADLINE = (
    "jn1_member_regtype", "jn1_ten_minutes", "jn2_member_payment", "jn6_all_lookups", "jn10_wide_rows",
    "jn10_current_members", "flt1_json_object", "src2_member_records", "prj1_decode_member", "rte2_target_table",
    "snk8_latest_rows", "snk8_latest_values", "agg2_word_count", "prj6_words_on_space", "agg3_running_count",
    "agg4_windowed_count", "str4_tumbling", "str6_sliding", "str7_sessions", "str11_previous_login",
    "fn2_row_key", "fn3_safe_json_parse", "fn12_money_text", "jn9_cogroup", "ods_dimension_rows", "jn1_stream",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    checks = load()
    seconds = {}
    for name in HEADLINE:
        for _ in range(2):
            began = time.perf_counter()
            checks[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - began, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()

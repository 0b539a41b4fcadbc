"""Times the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS] and prints one JSON line."""

import json
import os
import time

from pyspark.sql import SparkSession

from allelix.plans import registry

HEADLINE = ("F6_overall_counters", "G1_source_priority_dedup", "F5_label_counters", "F7_rollup_counters", "F10_variant_index", "F14_grouped_best", "E5_interval_overlap", "N11_shared_architecture", "E12_catalog_union", "K1_validation")


def main() -> None:
    data, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    spark.read.parquet(f"{data}/lineitem.parquet").count()
    took = {}
    for name in HEADLINE:
        began = time.time()
        registry.queries()[name](spark, data).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "headline queries", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": data.rstrip("/").rpartition("sf")[2]}))
    spark.stop()


if __name__ == "__main__":
    main()

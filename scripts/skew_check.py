"""Hot-key check: one station holds a third of all observations.

The skewed inputs are derived by Spark from the test tables (every third
lineitem row is re-assigned to supplier 0; every third order to customer 1,
so one zone holds over a third of the air measurements). The flagship zone metrics run
on it with an event log in a fresh scratch folder; the script reports, for
every shuffle stage, the largest and the median records read by one reduce
task. With map-side partial aggregation the hot station adds about one row
per map task, so the largest reduce task stays near the median.

usage: python scripts/skew_check.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from zonecast.plans.catalog import FIXTURE  # noqa: E402
from zonecast.plans.dashboard import Dashboard, Params  # noqa: E402
from zonecast.session import build_session  # noqa: E402
from zonecast.sources import tables  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    events = tempfile.mkdtemp(prefix="zonecast-skew-events-")
    spark = build_session("local[8]", shuffle_partitions=16, conf={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": events,
        "spark.eventLog.compress": "false"})
    li = tables.table(spark, sf_dir, "lineitem")
    hot = li.withColumn("l_suppkey", F.when(F.col("l_orderkey") % 3 == 0, F.lit(0))
                        .otherwise(F.col("l_suppkey")))
    share, n_rows = hot.agg(F.avg((F.col("l_suppkey") == 0).cast("double")), F.count(F.lit(1))).first()
    dash = Dashboard(lambda: tables.zones(spark, sf_dir), lambda: tables.air_raw(spark, sf_dir),
                     None, Params(**FIXTURE), observations=lambda: tables.observations_from(hot),
                     station_names=lambda: tables.station_names(spark, sf_dir))
    spark.sparkContext.setJobGroup("skew", "zone metrics on skewed observations")
    dash.zone_weather().write.format("noop").mode("overwrite").save()

    # air side: every third measurement re-assigned to one owner, hence one zone
    orders = tables.table(spark, sf_dir, "orders")
    hot_orders = orders.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(1))
                                   .otherwise(F.col("o_custkey")))
    cust = tables.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    ok = F.col("o_orderkey")
    air_raw = hot_orders.join(cust, hot_orders.o_custkey == cust.c_custkey).select(
        F.when(ok % 101 == 0, F.lit("999")).otherwise(F.col("c_nationkey").cast("string")).alias("GEOJOIN_ID"),
        F.to_date("o_orderdate").cast("string").alias("DATE_MESURE_BRUTE"),
        F.col("o_orderpriority").alias("NOM_POLLUANT"),
        F.when(ok % 97 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string")).alias("VALEUR_BRUTE"))
    air_dash = Dashboard(lambda: tables.zones(spark, sf_dir), air_raw, None, Params(**FIXTURE))
    spark.sparkContext.setJobGroup("skew_air", "pollutant means on skewed measurements")
    air_dash.pollutant_means().write.format("noop").mode("overwrite").save()
    spark.stop()

    stage_tasks: dict[int, list[int]] = {}
    skew_jobs: dict[str, set] = {"skew": set(), "skew_air": set()}
    for path in glob.glob(os.path.join(events, "*", "*")) + glob.glob(os.path.join(events, "*")):
        if os.path.isdir(path):
            continue
        for line in open(path):
            e = json.loads(line)
            group = e.get("Properties", {}).get("spark.jobGroup.id") if e["Event"] == "SparkListenerJobStart" else None
            if group in skew_jobs:
                skew_jobs[group].update(e["Stage IDs"])
            if e["Event"] == "SparkListenerTaskEnd":
                m = e.get("Task Metrics") or {}
                read = m.get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
                stage_tasks.setdefault(e["Stage ID"], []).append(read)
    def report(stages):
        out = []
        for sid in sorted(s for s in stage_tasks if s in stages):
            reads = stage_tasks[sid]
            if sum(reads):
                out.append({"stage": sid, "tasks": len(reads), "max_records": max(reads),
                            "median_records": statistics.median(reads), "total_records": sum(reads)})
        return out
    print(json.dumps({"sf_dir": sf_dir, "observations": n_rows, "hot_station_share": round(share, 3),
                      "weather_shuffle_stages": report(skew_jobs["skew"]),
                      "air_shuffle_stages": report(skew_jobs["skew_air"])}))


if __name__ == "__main__":
    main()

"""Write the physical plan of every table build, as a large run would plan it.

Hub tables (person, stays_pmsi, prestations) are stored and read back, as in
``plans.steps.build_all``; broadcasting by size estimate is off, so every join
that is not explicitly size-checked shows its shuffle form.

Usage: python scripts/dump_plans.py [sf_dir] [out_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from carelake.plans.steps import STEPS, build_table, stored_hub  # noqa: E402
from carelake.sinks import scratch_path, write_table  # noqa: E402
from carelake.sources import Sources  # noqa: E402
from carelake.sources.readers import read_table  # noqa: E402
from carelake.testbed.standins import standin_sources  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    out = sys.argv[2] if len(sys.argv) > 2 else "docs/plans"
    spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.autoBroadcastJoinThreshold", "-1")
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.shuffle.partitions", "16").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    src = standin_sources(spark, sf)
    root = scratch_path(spark, "plans")
    for name in src.names():
        df = src.get(name)
        write_table(df, f"{root}/in/{name}", ["YEAR"] if "YEAR" in df.columns else None)
    stored = Sources.from_folder(spark, f"{root}/in", src.names())
    hubs = {}
    os.makedirs(out, exist_ok=True)
    for step in STEPS:
        df = build_table(step, stored, hubs)
        plan = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        plan = re.sub(r"file:[^ ,\]]*/plans-[0-9a-f]+/in/", "<final>/", plan)
        plan = re.sub(r"file:[^ ,\]]*/plans-[0-9a-f]+/out/", "<omop>/", plan)
        with open(f"{out}/{step}.txt", "w") as fh:
            fh.write(plan)
        if step in ("person", "stays_pmsi", "prestations"):
            write_table(df, f"{root}/out/{step}")
            hubs[step] = stored_hub(read_table(spark, f"{root}/out/{step}"), step, f"{root}/out")
        print(step, plan.count("Exchange"), "exchanges")
    spark.stop()


if __name__ == "__main__":
    main()

"""Physical-plan audit of the registered queries.

usage: python tools/plan_report.py [sf_dir] > PLANS.md

For every query: shuffles (Exchange), join strategies, windows, Python
operators, and any Cartesian product / nested-loop join, read from the
formatted plan Spark would run (before AQE's runtime re-planning).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from turnstile.session import local_session  # noqa: E402

MODEL_QUERIES = {"demand_model", "kmeans_elbow", "cv_scores", "cluster_compare", "staff_model", "feature_corr",
                 "complaint_model", "word_importance", "review_explanations", "pca2", "bisecting_clusters",
                 "density_clusters", "weather_regression", "model_roundtrip"}


def plan_string(spark, df) -> str:
    jvm = spark.sparkContext._jvm
    return jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def summarize(plan: str) -> dict:
    ops = re.findall(r"^\(\d+\) (\w+)", plan, flags=re.M)
    count = {o: ops.count(o) for o in set(ops)}
    joins = sorted({o for o in ops if o.endswith("Join") or o == "CartesianProduct"})
    pushed = len(re.findall(r"PushedFilters: \[[^\]]+\]", plan))
    return {
        "exchanges": count.get("Exchange", 0),
        "joins": ", ".join(f"{j} x{count[j]}" for j in joins) or "-",
        "windows": count.get("Window", 0),
        "python": sum(v for k, v in count.items() if "Python" in k or "Pandas" in k or "Arrow" in k),
        "pushed_filter_scans": pushed,
        "bad": any(j in ("CartesianProduct", "BroadcastNestedLoopJoin") for j in joins),
    }


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(app="turnstile-plans")
    from turnstile.plans import QUERIES as qs

    print(f"# Physical plans ({sf_dir})\n")
    print("Generated by `tools/plan_report.py`: the formatted plan of each query before AQE re-planning "
          "(AQE may still turn a shuffle join into a broadcast join at run time).  Model queries are "
          "MLlib jobs and are not listed.\n")
    print("| query | exchanges | joins | windows | python ops | scans with pushed filters |")
    print("| --- | --- | --- | --- | --- | --- |")
    bad = []
    for name in sorted(qs):
        if name in MODEL_QUERIES:
            continue
        s = summarize(plan_string(spark, qs[name](spark, sf_dir)))
        if s["bad"]:
            bad.append(name)
        print(f"| {name} | {s['exchanges']} | {s['joins']} | {s['windows']} | {s['python']} | "
              f"{s['pushed_filter_scans']} |")
    print(f"\nCartesian products / nested-loop joins: {', '.join(bad) if bad else 'none'}.")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)

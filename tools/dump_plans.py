"""Write the formatted physical plans of key queries to docs/PLANS.md.

usage: python tools/dump_plans.py [sf_dir]
Plans are taken after execution (final adaptive plans); a second section
shows the same queries with broadcasts disabled, as at 100 TB.
"""
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tabreg.plans import catalog, housing as H  # noqa: E402
from tabreg.session import get_session  # noqa: E402

KEYS = ["standard_scale", "row_index", "train_test_split", "regression_metrics_by_segment",
        "mlp_score_housing", "matmul"]


def plan_of(df):
    df.write.format("noop").mode("overwrite").save()
    sc = df.sparkSession.sparkContext
    return sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    catalog._register_all()
    catalog.ORACLE_ROUNDING = False
    spark = get_session("local[8]", shuffle_partitions=8)
    out = ["# Physical plans of key queries", "",
           f"Generated by `tools/dump_plans.py` on `{sf}` (local[8]).", ""]
    for title, setup in [("As run (size-checked broadcasts)", None), ("Broadcasts disabled (100 TB shape)", True)]:
        if setup:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
            H.BROADCAST_MAX_ROWS = 0
        out += [f"## {title}", ""]
        for k in ["housing_like"] + KEYS:
            df = H.housing_like(spark, sf) if k == "housing_like" else catalog.QUERIES[k](spark, sf)
            text = plan_of(df)
            head = text.split("\n\n(1)")[0]          # the operator tree only
            head = re.sub(r"#\d+L?", "", head)
            out += [f"### {k}", "", "```", head.strip(), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out))
    print(path)


if __name__ == "__main__":
    main()

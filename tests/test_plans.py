"""Plan checks: data-sized queries never funnel through one partition, and
scans read only the columns they need."""
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
DATA_SIZED = ["standard_scale", "preprocess", "minmax_scale", "row_index", "minibatch",
              "regression_metrics_by_segment", "mlp_score_housing", "linear_transform",
              "train_test_split", "epoch_shuffle", "transpose", "matmul"]


def plan(df):
    df.write.format("noop").mode("overwrite").save()          # final (adaptive) plan
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", DATA_SIZED)
def test_no_single_partition_exchange(spark, name):
    p = plan(E.queries()[name](spark, SF))
    assert "SinglePartition" not in p


def test_scaled_scan_reads_needed_columns_only(spark):
    df = E.queries()["standard_scale"](spark, SF)
    text = df._jdf.queryExecution().executedPlan().toString()
    for unused in ("l_shipdate", "l_returnflag", "p_name", "o_orderdate", "s_name", "c_name"):
        assert unused not in text

"""A sample of registered queries against their DuckDB SQL at sf0.001 (the
full set runs with tools/check_oracle.py)."""
import math
import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
SAMPLE = ["standard_scale", "fit_minmax", "dataset_statistics", "row_index", "random_val_split",
          "minibatch", "relu", "mae_backward", "regression_metrics_by_segment", "linear_transform",
          "matmul", "mlp_score_arrow", "mlp_gradient_small", "early_stopping_delta", "plateau_lr",
          "rename_positional", "minmax_constant"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["customer", "supplier", "part", "orders", "lineitem", "events", "embeddings", "nation"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t + '.parquet')}')")
    return c


def canon(pdf):
    cols = sorted(pdf.columns)
    rows = []
    for rec in pdf[cols].itertuples(index=False):
        rows.append(tuple("nan" if isinstance(v, float) and math.isnan(v) else
                          (round(v, 9) + 0.0 if isinstance(v, float) else v) for v in rec))
    return cols, sorted(rows, key=repr)


@pytest.mark.parametrize("name", SAMPLE)
def test_matches_duckdb(spark, con, name):
    got = canon(E.queries()[name](spark, SF).toPandas())
    want = canon(con.execute(E.oracle_sql()[name]).df())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]

import numpy as np
from pyspark.sql import functions as F

from tabreg.operators import scale as S
from tabreg.operators.model import MLP
from tabreg.streaming.score import read_parquet_stream, score_stream, write_stream


def test_stream_scoring_equals_batch(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.range(200).select((F.col("id") * 0.5).alias("a"), (F.col("id") % 7).cast("double").alias("b"),
                            F.col("id").alias("k")).repartition(4).write.parquet(src)
    batch = spark.read.parquet(src)
    fm = S.StandardScaler(["a", "b"]).fit(batch)
    net = MLP.create((2, 4, 1), seed=3)
    want = {r["k"]: r["pred"] for r in score_stream(batch, fm, net, ["a", "b"], keep=["k"]).collect()}
    stream = read_parquet_stream(spark, src, "a double, b double, k long")
    out = str(tmp_path / "out")
    q = write_stream(score_stream(stream, fm, net, ["a", "b"], keep=["k"]), out,
                     checkpoint=str(tmp_path / "ck"))
    q.awaitTermination(120)
    got = {r["k"]: r["pred"] for r in spark.read.parquet(out).collect()}
    assert got.keys() == want.keys()
    assert np.allclose([got[k] for k in sorted(got)], [want[k] for k in sorted(want)])

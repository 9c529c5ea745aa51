"""Scoring a stream with a fitted scaler and network.

Scaler transforms and network scoring are stateless per-row projections, so
the same operators apply unchanged to a streaming DataFrame: no state store,
no watermark. The sink's checkpoint goes under the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.model import MLP, mlp_score
from ..session import shared_path


def score_stream(stream: DataFrame, feature_model, model: MLP, features, *, keep=(),
                 out: str = "pred") -> DataFrame:
    """Scaled features -> network prediction, for batch or streaming input."""
    scaled = feature_model.transform(stream.select(*features, *keep))
    return mlp_score(scaled, model, list(features), keep=list(keep), out=out)


def read_parquet_stream(spark: SparkSession, path: str, schema: str, max_files: int = 64) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def write_stream(scored: DataFrame, path: str, *, checkpoint: str | None = None,
                 available_now: bool = True):
    """Append the predictions as Parquet; exactly-once through the sink's
    checkpoint (a path under ``spark.checkpoint.dir`` unless given)."""
    spark = scored.sparkSession
    ck = checkpoint or shared_path(spark, "stream-ckpt")
    w = scored.writeStream.format("parquet").option("path", path).option("checkpointLocation", ck) \
        .outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()

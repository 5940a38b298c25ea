"""Score new contest files as they land, with a model fitted in batch.

Every stage between the raw rows and the prediction is a per-row projection
(leakage drop, differential features with an explicit vocabulary, scaler,
assembler, logistic model), so the stream needs no state and no watermark;
exactly-once output comes from the file sink plus the query checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from duelframe.operators import features as fe
from duelframe.operators import model as mo
from duelframe.operators import quality as qa
from duelframe.session import checkpoint_dir


def scored_stream(raw_stream: DataFrame, vocab: fe.Vocabulary, model: mo.FittedModel) -> DataFrame:
    """Streaming DataFrame of (bout_id, target, prediction, score)."""
    feats, _ = fe.feature_matrix(qa.drop_leakage(raw_stream), vocab)  # no discovery job
    view = mo.training_view(feats.withColumn("split", F.lit("stream")), model.feature_cols)
    return model.score(view).drop("split")


def start_scoring(spark: SparkSession, source_dir: str, schema: T.StructType,
                  vocab: fe.Vocabulary, model: mo.FittedModel, sink_dir: str,
                  query_checkpoint: str | None = None, available_now: bool = False,
                  max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the scoring query: parquet files in ``source_dir`` -> parquet in ``sink_dir``."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    out = scored_stream(reader.parquet(source_dir), vocab, model)
    ckpt = query_checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/duelframe-streams/scoring"
    w = out.writeStream.format("parquet").option("checkpointLocation", ckpt).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start(sink_dir)

"""Stateless streaming scoring (B2).

The single-request scoring endpoint becomes a Structured Streaming query:
request rows arrive through ``readStream``, the fitted preprocessing +
classifier pipeline scores each micro-batch with the same expressions as
batch scoring (B1), and ``foreachBatch`` appends the results to a sink
table.  No state is kept, so a restarted query resumes from its checkpoint
without replaying scores twice into the table (each batch overwrites its own
``batch_id`` partition).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlens.operators.scoring import MODEL_VERSION, score_rows
from leadlens.session import checkpoint_dir


def scoring_stream(spark: SparkSession, model, source_dir: str, schema, sink_dir: str,
                   request_id: str = "stream", fmt: str = "parquet",
                   checkpoint: str | None = None, trigger_once: bool = True,
                   max_files_per_trigger: int | None = None, key_col: str | None = None):
    """Start a streaming scoring query over files landing in ``source_dir``.

    ``key_col`` names the request key column (ids ``pred_<key>``); without it
    ids are ``pred_<request_id>_<batch>_<n>``.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    requests = reader.load(source_dir)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        scored = score_rows(model, batch, request_id, MODEL_VERSION, key_col=key_col,
                            batch_id=batch_id).withColumn("batch_id", F.lit(batch_id))
        (scored.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(sink_dir))

    ckpt = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/streams/scoring-{request_id}"
    w = requests.writeStream.foreachBatch(write_batch).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if trigger_once else w.trigger(processingTime="5 seconds")
    return w.start()

"""stream_score: score snapshot files as they arrive (stateless).

readStream (declared schema) -> inference-mode contract -> fitted pipeline ->
foreachBatch sink. Each micro-batch is written to its own ``batch_id=N``
directory with overwrite, so a replayed epoch after a failure rewrites the
same output (idempotent); quarantined rows go to a sibling directory.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from closecast.operators import contracts as C
from closecast.operators.scoring import ModelBundle, batch_score
from closecast.schema import TARGET, snapshot_schema


def start_stream_score(spark: SparkSession, source_dir: str, bundle: ModelBundle, out_dir: str,
                       checkpoint_dir: str, scored_at: str | None = None, available_now: bool = True):
    stream = spark.readStream.schema(snapshot_schema()).parquet(source_dir)

    def sink(batch: DataFrame, epoch: int) -> None:
        raw = batch.drop(TARGET)
        good, bad = C.quarantine(raw, require_target=False)
        (batch_score(bundle, good, scored_at=scored_at).write.mode("overwrite")
         .parquet(os.path.join(out_dir, "scored", f"batch_id={epoch}")))
        bad.write.mode("overwrite").parquet(os.path.join(out_dir, "quarantine", f"batch_id={epoch}"))

    writer = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def read_scored(spark: SparkSession, out_dir: str) -> DataFrame:
    return spark.read.parquet(os.path.join(out_dir, "scored")).drop("batch_id")

"""Applying fitted state to a stream.

The reference has no streaming operators (no windows, watermarks or state);
what carries over is the fit-on-train / apply-to-all contract: the fitted
scaler table, literal encoder maps and Spark ML models are all stateless
per-row transforms, so the very same apply functions run unchanged on a
``readStream`` DataFrame.  Progress is checkpointed under the cluster's
shared ``spark.checkpoint.dir``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from lathe.operators.encode import ordinal_encode
from lathe.operators.scale import apply_scaler
from lathe.session import checkpoint_dir


def read_stream(spark: SparkSession, path: str, schema, max_files_per_trigger: int = 16) -> DataFrame:
    """Parquet files arriving in ``path`` (explicit schema, no inference)."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(path))


def score_stream(stream: DataFrame, scaler: DataFrame | dict | None = None,
                 ordinals: dict | None = None, model=None, assemble=None) -> DataFrame:
    """Fitted transforms on a stream: ordinal codes, population scaling,
    then an optional Spark ML model (``assemble`` builds its input vector)."""
    out = stream
    if ordinals:
        out = ordinal_encode(out, ordinals)
    if scaler is not None:
        if isinstance(scaler, DataFrame):  # collect the small fitted table once
            scaler = {r["feature"]: (r["mean"], r["std"]) for r in scaler.collect()}
        out = apply_scaler(out, scaler)
    if model is not None:
        out = model.transform(assemble(out) if assemble else out)
    return out


def start_sink(scored: DataFrame, path: str, name: str | None = None, fmt: str = "parquet",
               trigger_once: bool = False):
    """Append the scored rows to ``path``; exactly-once through the file
    sink's log and a checkpoint in the shared folder."""
    spark = scored.sparkSession
    ckpt = f"{checkpoint_dir(spark)}/lathe-stream/{name or uuid.uuid4().hex}"
    w = scored.writeStream.format(fmt).option("path", path).option("checkpointLocation", ckpt) \
        .outputMode("append")
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()

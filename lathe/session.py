"""Session helpers: building a session with sane defaults, the shared
checkpoint folder and durable staging of intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

_STAGED: list[str] = []


def get_spark(master: str | None = None, app: str = "lathe",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Return (or create) a session with AQE and skew-join handling on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the operator and points at shared storage
    (a missing setting is an error there); only a ``local[...]`` session
    without one gets a folder under the system temp folder, as in tests.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors "
                               "(stage tables and checkpoints must survive executor loss)")
        # single-machine sessions (tests) only; the setting itself is fixed once a session runs
        d = tempfile.mkdtemp(prefix="lathe-ckpt-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
        if not spark.conf.get("spark.checkpoint.dir", None):
            d = spark.sparkContext.getCheckpointDir()
    return d.rstrip("/")


def stage_table(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it
    back.  Cuts lineage and pins non-deterministic physical facts (range
    partition ids, in-partition positions) so every later read agrees, even
    if executors are lost and tasks re-run."""
    spark = df.sparkSession
    base = checkpoint_dir(spark)
    path = f"{base}/lathe-stage/{name}-{uuid.uuid4().hex}"
    _STAGED.append(path)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def clear_stages(spark: SparkSession) -> None:
    """Delete the stage tables written so far.  Call it once the results that
    read them have been written or collected."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while _STAGED:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_STAGED.pop())
        path.getFileSystem(conf).delete(path, True)


def num_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))

"""Session helpers.

Library code never creates its own session: every operator takes DataFrames.
`get_spark` is a convenience for tests, the bench and local runs; on a cluster
the caller's session (and its configuration) is used as is.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Defaults that matter for the operators in this package. They are only
# applied when the session is created here; an existing session keeps its own.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # pages can be large; keep Arrow batches for mapInPandas moderate
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.ui.enabled": "false",
    "spark.sql.parquet.compression.codec": "zstd",
}


def get_spark(
    app: str = "threadmill",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
) -> SparkSession:
    """Return a session configured for this package (local runs and tests)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    On a cluster this is whatever the deployment put in
    ``spark.checkpoint.dir`` (a shared file system); it is read, never
    invented. Only a local-mode session without the setting (tests, local
    runs) gets a scratch folder.
    """
    sc = spark.sparkContext
    path = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: point it at a shared folder (HDFS, object store)")
        path = tempfile.mkdtemp(prefix="threadmill-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path

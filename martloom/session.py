"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job of this package is planned for. AQE sizes the shuffles at run time,
# splits skewed join partitions, and turns a sort-merge join into a broadcast join only
# after it has measured the side to be sent.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
    # Recording the Python line of every expression costs two calls into the JVM each.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the package settings; ``conf`` keys use ``__`` for the dots."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for written intermediates.

    On a cluster it lies under the shared folder named in ``spark.checkpoint.dir``, so that
    every executor sees it and a lost executor loses nothing. Only where that setting is
    absent and the master is local (tests) is a local temporary folder used; a cluster
    without the setting is refused, as its executors would each write to a disk of their own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/martloom/{label}-{uuid.uuid4().hex}"
    master = spark.conf.get("spark.master", "local")
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on {master}")
    return tempfile.mkdtemp(prefix=f"martloom-{label}-")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    For a result that several branches of a plan read: it is computed once, its lineage ends in
    files that outlive any executor, and the planner sees its true size.
    """
    spark = df.sparkSession
    path = work_dir(spark, label)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)

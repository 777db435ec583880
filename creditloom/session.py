"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings every job of this package is written for.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app: str = "creditloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with :data:`DEFAULTS`; ``conf`` keys use ``__`` in place of dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``.

    Only where it is unset and the master is local a temporary one is made, as in tests:
    executors of a cluster could not read it.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can read")
        folder = tempfile.mkdtemp(prefix="creditloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def materialise(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage in the shared checkpoint folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(checkpoint_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt out evenly over all cores: a small file, or a shuffle that Spark made few partitions of, is little to read but may be much to compute."""
    return df.repartition(max(1, df.sparkSession.sparkContext.defaultParallelism))


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet below the shared folder and read again: cuts the lineage, survives lost executors."""
    path = f"{checkpoint_folder(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "dockline", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators are written for.

    AQE splits skewed join partitions and merges small shuffle partitions, so
    the shuffle width set here is only an upper bound for small inputs.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _own_folder(spark: SparkSession) -> str | None:
    """This application's folder in the one that all executors share, if that is set."""
    base = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/dockline/{spark.sparkContext.applicationId}" if base else None


def scratch_dir(spark: SparkSession, tag: str) -> str:
    """A new, unused path in the folder that all executors share.

    That is the folder of spark.checkpoint.dir, or the one set by
    SparkContext.setCheckpointDir; without either this raises.
    """
    own = _own_folder(spark)
    if not own:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{own}/{tag}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application; those of others that share the folder stay.

    For use between jobs: DataFrames that still read such a table fail afterwards.
    """
    own = _own_folder(spark)
    if own:
        path = spark._jvm.org.apache.hadoop.fs.Path(own)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back.

    Cuts the lineage of a table that several later steps read; lost executors
    then cost a re-read instead of a recomputation.
    """
    path = scratch_dir(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

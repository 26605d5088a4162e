"""Where intermediate tables live.

On a cluster that is the shared folder named by ``spark.checkpoint.dir``.  Only a
local session without that setting gets a temporary folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="vecspark-")
    return _local_dirs[context.applicationId]


def _own_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/vecspark/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing has used yet."""
    return f"{_own_dir(spark)}/{label}-{uuid.uuid4().hex}"


def clear_workspace(spark: SparkSession) -> None:
    """Delete what this application wrote to the shared folder, once its results are used."""
    delete_path(spark, _own_dir(spark))


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back, which cuts the lineage."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path):
    context = spark.sparkContext
    hadoop_path = context._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(context._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return bool(fs.exists(hadoop_path))


def delete_path(spark: SparkSession, path) -> None:
    """``path`` is a string or a Java URI."""
    fs, hadoop_path = _file_system(spark, path)
    fs.delete(hadoop_path, True)

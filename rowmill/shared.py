"""Folders every executor can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def in_one_process(spark: SparkSession) -> bool:
    """Whether driver and executors share one JVM and one machine."""
    master = spark.sparkContext.master
    return master.startswith("local") and not master.startswith("local-cluster")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; only local sessions without one (tests) get a temporary one."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not in_one_process(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor reaches")
        folder = tempfile.mkdtemp(prefix="rowmill-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def run_folder(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared folder, removed by Hadoop when the session's JVM ends."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def stored(df: DataFrame, label: str) -> DataFrame:
    """Compute ``df`` once into the shared folder as parquet, where it outlives lost executors until the session ends."""
    folder = run_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def settle(df: DataFrame) -> tuple[DataFrame, bool]:
    """Compute ``df`` once into the shared folder, for a side that several jobs or branches use.

    Where its measured size stays under the session's broadcast threshold it carries a broadcast hint, so that the
    large side of a join need not be shuffled; beyond it the join is left to Spark. The flag tells which.
    """
    settled = stored(df, "settled")
    width = sum((_width(field) for field in settled.schema), F.lit(0))
    size = settled.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0]
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return (F.broadcast(settled), True) if size <= limit else (settled, False)


def _width(field: T.StructField) -> Column:
    """Bytes of one value, counted generously."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)) + F.lit(16)
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return 2 * F.coalesce(F.octet_length(F.to_json(column)), F.lit(0)) + F.lit(32)
    return F.lit(16)

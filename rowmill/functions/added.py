"""Type inference that is added up: what was found in a file once is kept, so that new files alone are read."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.files import Files
from .ladders import cells_of, kind_of, merged_states, state_of

_FILE = "file string, changed timestamp, size long"
_FIELDS = f"{_FILE}, column_name string, low int, high int, seen int"


def infer_types_of_files(
    spark: SparkSession,
    path: str,
    state: str,
    ladder: str = "sqlite",
    loose: bool = False,
    format: str = "parquet",
    schema: T.StructType | str | None = None,
    **options: str,
) -> DataFrame:
    """One row ``(column_name, type)`` per column over all files in ``path``, of which only the new ones are read.

    What was found in each file is kept in the folder ``state``, one row per file and column: the lowest and highest rank
    on the ladder and which ones there are. States are merged on every call, so the types are those that
    :func:`infer_types` gives for all files together. A file is known while its size and modification time stay; files
    that are gone or have changed play no part any more. ``format``, ``schema`` and ``options`` are those of
    ``spark.read``; parquet and ORC columns are matched by name over all files. One call at a time may use a ``state``;
    a call that is broken off leaves the state as it was.
    """
    folder = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    listed = folder.select(F.col("_metadata.file_path").alias("file"), F.col("modificationTime").alias("changed"), F.col("length").alias("size"))
    key = ["file", "changed", "size"]
    known = _known(spark, state)
    fresh = listed.join(known, key, "left_anti")
    names = folder.select(F.col("_metadata.file_path").alias("file"), "path")  # the first with escaped characters
    paths = [row.path for row in names.join(fresh, "file").collect()]  # which their scan has to plan with anyway
    if paths:
        reader = spark.read.format(format).options(**({"mergeSchema": "true"} if format in ("parquet", "orc") else {}) | options)
        rows = (reader.schema(schema) if schema is not None else reader).load(paths)
        names = rows.columns
        cells = cells_of(rows, names, ladder, loose, F.col("_metadata.file_path").alias("file"))
        name = F.get(F.array(*[F.lit(name) for name in names]), F.col("column"))
        found = cells.groupBy("file", "column").agg(*state_of("rank")).select("file", name.alias("column_name"), "low", "high", "seen")
        # a row for every column of every file, so that files without rows are known too
        every = fresh.withColumn("column_name", F.explode(F.array(*[F.lit(name) for name in names])))
        every.join(found, ["file", "column_name"], "left").select(*key, "column_name", "low", "high", "seen").write.parquet(
            f"{state}/{uuid.uuid4().hex}"
        )
        known = _known(spark, state)
    return known.join(listed, key).groupBy("column_name").agg(*merged_states()).select("column_name", kind_of(ladder).alias("type"))


def _known(spark: SparkSession, state: str) -> DataFrame:
    if not Files(spark, state).exists(state):
        return spark.createDataFrame([], _FIELDS)
    return spark.read.schema(_FIELDS).option("recursiveFileLookup", "true").parquet(state)

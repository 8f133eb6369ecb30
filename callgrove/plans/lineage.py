"""Cutting lineage through reliable storage."""

from __future__ import annotations

import tempfile
import uuid
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate results, the one named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it gets a temporary folder.
    On a cluster such a folder would be lost with its machine, so that is an error.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current is not None:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="callgrove-")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


#: Folders of intermediate results by application.
_SCRATCH: dict[str, list[str]] = {}
_checkpoints: dict[str, list[str]] = {}


def scratch_folder(spark: SparkSession, name: str) -> str:
    """Path of a new folder for intermediate results, known to :func:`clear_scratch`."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Remove the folders and checkpoints that this session made; returns their number.

    Data frames that read from them are of no use afterwards: write the results first.
    """
    paths = _SCRATCH.pop(spark.sparkContext.applicationId, [])
    paths += [path for path in _checkpoints.pop(spark.sparkContext.applicationId, []) if path]
    return sum(remove_folder(spark, path) for path in paths)


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder of any file system; tells whether it was there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.delete(folder, True)


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` once, keep it in reliable storage and forget how it was made."""
    spark = df.sparkSession
    shared_dir(spark)
    stored = df.checkpoint(eager=True)
    file = stored._jdf.queryExecution().logical().rdd().getCheckpointFile()
    if file.isDefined():
        _checkpoints.setdefault(spark.sparkContext.applicationId, []).append(file.get())
    return stored


def cut_and_observe(df: DataFrame, **aggregates: Column) -> tuple[DataFrame, dict[str, Any]]:
    """Like :func:`cut`, with aggregates of the rows taken in the same job."""
    seen = Observation()
    named = [aggregate.alias(name) for name, aggregate in aggregates.items()]
    stored = cut(df.observe(seen, *named))
    return stored, seen.get

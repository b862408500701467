"""Cutting lineage through written tables in the cluster's shared folder.

A staged table survives the loss of any executor and is read back column-pruned.
The folder is the one the session names in ``spark.checkpoint.dir``. A local session
that names none gets one named here; a cluster session without it is refused.
Each application has its own folder there, removed when its JVM ends; loops drop
what they have replaced earlier, with ``drop`` or inside ``scratch``.
"""

from __future__ import annotations

import contextlib
import getpass
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_known: dict[str, str] = {}
_paths: list[list[str]] = []


def _fs(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def staging_root(spark: SparkSession) -> str:
    """This application's folder below the shared one."""
    app = spark.sparkContext.applicationId
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder before running on a cluster")
        root = os.path.join(tempfile.gettempdir(), f"tidewatch-{getpass.getuser()}")
    path = f"{root.rstrip('/')}/tidewatch-{app}"
    if _known.get(app) != path:
        fs, jvm_path = _fs(spark, path)
        fs.deleteOnExit(jvm_path)
        _known[app] = path
    return path


def staging_path(spark: SparkSession, tag: str, keep: bool = False) -> str:
    """A fresh path in the shared folder; ``keep`` lets it outlive the innermost ``scratch``."""
    path = f"{staging_root(spark)}/{tag}-{uuid.uuid4().hex}"
    level = len(_paths) - 1 - keep
    if level >= 0:
        _paths[level].append(path)
    return path


def stage(df: DataFrame, tag: str, keep: bool = False) -> DataFrame:
    """Write ``df`` and return it as a scan of the written table."""
    return stage_at(df, tag, keep)[0]


def stage_at(df: DataFrame, tag: str, keep: bool = False) -> tuple[DataFrame, str]:
    """``stage`` together with the path, for a later ``drop``."""
    path = staging_path(df.sparkSession, tag, keep)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def drop(spark: SparkSession, *paths: str) -> None:
    """Remove staged tables that nothing reads any more."""
    for path in paths:
        fs, jvm_path = _fs(spark, path)
        fs.delete(jvm_path, True)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is staged inside goes at the end, but for what is staged with ``keep``."""
    _paths.append([])
    try:
        yield
    finally:
        drop(spark, *_paths.pop())

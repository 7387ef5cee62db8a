"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


#: Shuffle files go when the write that made them has ended, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session. Where it is unset, as in tests, a folder of our own, but only if driver and
    executors are one process: on a cluster other machines would not see it."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.fullmatch(r"local(\[[^-]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="lacunar-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


#: What the innermost scope owns; None outside of any.
_owned: ContextVar[list[str] | None] = ContextVar("owned", default=None)


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/lacunar/{name}-{uuid.uuid4().hex}"
    owned = _owned.get()
    if owned is not None:
        owned.append(path)
    return path


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Owns all scratch paths that are made inside, and deletes them at its end, also when it fails. What is to outlive it must be
    written by then: a result that still reads scratch tables can't be read after it."""
    owned: list[str] = []
    token = _owned.set(owned)
    try:
        yield
    finally:
        _owned.reset(token)
        for path in owned:
            delete(spark, path)


@contextmanager
def _cleaned(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df once and read it back: lineage ends here and lost executors cost no recomputation."""
    spark = df.sparkSession
    path = new_path(spark, name)
    with _cleaned(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a scratch path through Hadoop's file system, wherever it lives."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def release(*tables: DataFrame) -> None:
    """Remove materialized tables once no later plan reads them."""
    for df in tables:
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if "/lacunar/" in path:
                delete(df.sparkSession, path)

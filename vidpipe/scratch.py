"""Intermediate tables in the folder that driver and executors share: they cut lineage and survive lost executors."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_OWN_DIRS: dict[str, str] = {}
_MADE: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``.

    Where that is unset, a temporary folder in local mode, as in tests; on a cluster, whose executors could not
    see it, an error.
    """
    given = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if given:
        return given
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN_DIRS:
        _OWN_DIRS[app] = "file://" + tempfile.mkdtemp(prefix="vidpipe-", dir="/tmp")
    return _OWN_DIRS[app]


def new_path(spark: SparkSession, what: str) -> str:
    """A path below the shared folder that nothing else uses."""
    path = f"{shared_dir(spark)}/vidpipe/{what}-{uuid.uuid4().hex}"
    _MADE.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


@contextmanager
def shredding(spark: SparkSession, depth: int) -> Iterator[None]:
    """Within it, variants are written with the fields of their first ``depth`` levels as columns of their own, those below as one value; 0: whole.

    Spark shreds 50 levels otherwise, which for entries in entries costs several times what parsing does, to write and to put together again.
    """
    given = {"spark.sql.variant.inferShreddingSchema": str(depth > 0).lower(), "spark.sql.variant.shredding.maxSchemaDepth": str(max(depth, 1))}
    before = {key: spark.conf.get(key) for key in given}
    try:
        for key, value in given.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def written(df: DataFrame, what: str) -> DataFrame:
    """``df`` written as Parquet below the shared folder and read again."""
    spark = df.sparkSession
    path = new_path(spark, what)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def made(spark: SparkSession) -> int:
    """How many paths this application has taken so far: a mark for ``release``."""
    return len(_MADE.get(spark.sparkContext.applicationId, []))


def release(spark: SparkSession, since: int, until: int) -> None:
    """Delete what was written between two marks; nothing may read it any more."""
    paths = _MADE.get(spark.sparkContext.applicationId, [])
    for k in range(since, min(until, len(paths))):
        if paths[k]:
            where = spark._jvm.org.apache.hadoop.fs.Path(paths[k])
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
            paths[k] = ""

"""Where intermediate tables are written, and how they are read back."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}

# Paths made inside each open staging block, innermost last.
_blocks: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session without the setting gets a folder of its own; on a cluster
    the setting is required, since a machine's own disk is lost with the machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="labelloom-")
    return _local_dirs[context.applicationId]


def _own_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/labelloom/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing else uses."""
    path = f"{_own_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _blocks:
        _blocks[-1].append(path)
    return path


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def remove_staged(spark: SparkSession) -> None:
    """Deletes what this application staged. Results not yet written read from there."""
    _delete(spark, _own_dir(spark))


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end what was staged inside: for jobs that write their result there."""
    made: list[str] = []
    _blocks.append(made)
    try:
        yield
    finally:
        _blocks.remove(made)
        for path in made:
            _delete(spark, path)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder once and read it back.

    Later steps start from the files, so a lost executor never makes Spark redo the
    work above, and rows keep the positions they were written with.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""CSV tables and Parquet snapshots."""

from __future__ import annotations

import re
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloom.functions.values import named
from labelloom.sources.claims import claimed


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A CSV table with header, quoted line breaks and doubled quotes.

    Without a schema the types are inferred, which reads the files once more. A file
    with line breaks in texts cannot be divided, so it is one task: keep large tables in
    Parquet, or in many CSV files.
    """
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def sink_csv(df: DataFrame, path: str, first: str | None = None, mode: str = "errorifexists") -> None:
    """Writes CSV files with header, the named column first. Null and '' both become empty.

    Texts are written as they are, white space at their ends included.
    """
    if first is not None:
        df = df.select(named(first), *[named(c) for c in df.columns if c != first])
    writer = df.write.mode(mode).option("header", True).option("escape", '"')
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.csv(path)


def write_snapshot(
    df: DataFrame,
    directory: str,
    prefix: str,
    day: date | None = None,
    partition_by: str | None = None,
) -> str:
    """Writes Parquet to <prefix>_<day>, or <prefix>_<day>_1, _2, ... if taken; returns the path.

    A path that exists is never written to: Spark refuses it before it starts a job. A writer
    claims a name before it writes, so writers that start together get one each.
    """
    base = f"{directory.rstrip('/')}/{prefix}_{(day or date.today()).isoformat()}"
    taken = 0
    while True:
        path = base if taken == 0 else f"{base}_{taken}"
        with claimed(df.sparkSession, directory, path.rsplit("/", 1)[1]) as mine:
            if mine and _written_new(df, path, partition_by):
                return path
        taken += 1


def _written_new(df: DataFrame, path: str, partition_by: str | None) -> bool:
    """Writes to a path that does not exist; whether it was so."""
    writer = df.write.mode("errorifexists")
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    try:
        writer.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_ALREADY_EXISTS":
            raise
        return False
    return True


def snapshot_times(spark: SparkSession, directory: str) -> DataFrame:
    """Snapshots of a directory with the time each was last written.

    Only the file listing is read: no content, since no column of it is used.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(directory)
        .select("path", "modificationTime")
    )
    # Listed paths start with a scheme that the given directory may lack.
    folder = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", directory).rstrip("/") + "/"
    start = F.locate(folder, F.col("path")) + len(folder)
    inner = F.substring(F.col("path"), start, F.length("path"))
    return (
        files.select(F.substring_index(inner, "/", 1).alias("snapshot"), "modificationTime")
        .groupBy("snapshot")
        .agg(F.max("modificationTime").alias("written_at"))
    )


def latest_snapshot(spark: SparkSession, directory: str, name: str | None = None) -> DataFrame:
    """The newest snapshot of a directory, or the named one; none is an error."""
    if name is None:
        newest = snapshot_times(spark, directory).agg(F.max(F.struct("written_at", "snapshot")))
        found = newest.first()[0]
        if found is None:
            raise FileNotFoundError(f"no snapshot in {directory!r}")
        name = found["snapshot"]
    return spark.read.parquet(f"{directory.rstrip('/')}/{name}")

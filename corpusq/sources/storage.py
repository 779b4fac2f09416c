"""Working tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_own_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``, or a folder of our own in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = tempfile.mkdtemp(prefix="corpusq-")
    return _own_dirs[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else writes to."""
    return f"{shared_dir(spark)}/corpusq/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts the lineage and survives the loss of executors, because the rows are in
    files and not in the memory or on the disks of the executors.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_bucketed(df: DataFrame, name: str, column: str, buckets: int) -> DataFrame:
    """As ``materialize``, with the rows in files by the hash of a column.

    A join or aggregation by that column over as many partitions then reads the rows where they
    lie and shuffles the other side only. The catalog knows the table just while it is opened.
    """
    spark, path = df.sparkSession, fresh_path(df.sparkSession, name)
    table = f"corpusq_{uuid.uuid4().hex}"
    df.write.mode("errorifexists").option("path", path).bucketBy(buckets, column).saveAsTable(table)
    opened = spark.table(table)
    opened.schema  # noqa: B018  resolved before its name goes
    spark.sql(f"DROP TABLE {table}")
    return opened


def write_bucketed(df: DataFrame, path: str, column: str, buckets: int, order: tuple[str, ...] = ()) -> None:
    """Write files by the hash of a column, sorted inside."""
    table = f"corpusq_{uuid.uuid4().hex}"
    writer = df.write.mode("overwrite").option("path", path).bucketBy(buckets, column)
    (writer.sortBy(*order) if order else writer).saveAsTable(table)
    df.sparkSession.sql(f"DROP TABLE {table}")


def read_bucketed(spark: SparkSession, path: str, schema: StructType, column: str, buckets: int) -> DataFrame:
    """Open such files in any session. The catalog knows the table only while it is opened."""
    table = f"corpusq_{uuid.uuid4().hex}"
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {table} ({schema.toDDL()}) USING parquet CLUSTERED BY ({column}) INTO {buckets} BUCKETS LOCATION '{place}'")
    opened = spark.table(table)
    opened.schema  # noqa: B018  resolved before its name goes
    spark.sql(f"DROP TABLE {table}")
    return opened


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or directory exists on the Hadoop file system of its path."""
    fs, target = _on_file_system(spark, path)
    return fs.exists(target)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and directories in a directory; none if it is not there."""
    fs, target = _on_file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def version_of(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """Size, number of files and time of change below a path."""
    fs, target = _on_file_system(spark, path)
    summary = fs.getContentSummary(target)
    return summary.getLength(), summary.getFileCount(), fs.getFileStatus(target).getModificationTime()


def delete_path(spark: SparkSession, path: str) -> bool:
    """Remove a table directory."""
    fs, target = _on_file_system(spark, path)
    return fs.delete(target, True)


def _on_file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target

"""Path checks shared by the scans."""

from __future__ import annotations

from pyspark.sql import SparkSession


def is_directory(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is a directory; a missing path is an error."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(where):
        raise ValueError(f"path does not exist: {path}")
    return system.getFileStatus(where).isDirectory()


def require_match(spark: SparkSession, path: str, glob: str) -> None:
    """Raise if the directory holds no file of that pattern itself."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{glob}")
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where)
    if found is None or len(found) == 0:
        raise ValueError(f"no {glob} files in {path}")

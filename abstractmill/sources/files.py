"""Files of a table, through the file system that Spark reads them with."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def exists(spark: SparkSession, path: str) -> bool:
    where, system = _located(spark, path)
    return system.exists(where)


def committed(spark: SparkSession, path: str) -> bool:
    """Whether a job that wrote this folder came to its end."""
    return exists(spark, f"{path}/_SUCCESS")


def folders(spark: SparkSession, path: str) -> list[str]:
    """Folders in a folder, by name; none where it does not exist."""
    where, system = _located(spark, path)
    if not system.exists(where):
        return []
    return sorted(x.getPath().toString() for x in system.listStatus(where) if x.isDirectory())


def total_bytes(spark: SparkSession, path: str) -> int:
    """Length of all files under a folder."""
    where, system = _located(spark, path)
    return system.getContentSummary(where).getLength()


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if there is one."""
    where, system = _located(spark, path)
    system.delete(where, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, which readers see whole or not at all."""
    where, system = _located(spark, path)
    draft, _ = _located(spark, f"{path}.draft")
    out = system.create(draft, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    system.delete(where, False)
    system.rename(draft, where)


def read_text(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    where, system = _located(spark, path)
    held = system.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(held, "UTF-8")
    finally:
        held.close()

"""Small files beside tables, through Hadoop's file systems: the same on a disk, HDFS or an object store."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where)


def names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, sorted; none if it does not exist."""
    fs, where = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.delete(where, True)


def rename(spark: SparkSession, old: str, new: str) -> None:
    """old takes the place of new."""
    fs, source = _at(spark, old)
    _, target = _at(spark, new)
    if fs.exists(target):
        fs.delete(target, True)
    if not fs.rename(source, target):
        raise OSError(f"{old} could not become {new}")


def read_text(spark: SparkSession, path: str) -> str | None:
    """None if there is no such file."""
    fs, where = _at(spark, path)
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Written beside its place and moved there, so a reader finds the old text or the new one."""
    fs, where = _at(spark, f"{path}.new")
    stream = fs.create(where, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    context = spark.sparkContext._jvm.org.apache.hadoop.fs.FileContext.getFileContext(where.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    overwrite = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(where, _at(spark, path)[1], overwrite)


def read_json(spark: SparkSession, path: str):
    text = read_text(spark, path)
    return None if text is None else json.loads(text)


def write_json(spark: SparkSession, doc: Mapping, path: str) -> None:
    write_text(spark, path, json.dumps(doc, indent=2, default=str))

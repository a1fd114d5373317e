"""Session settings, and shipping this package to the executors."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.parquet.compression.codec": "zstd",
}


def build(app: str = "registrum", master: str | None = None, **settings: str) -> SparkSession:
    """A session with SETTINGS; keyword names write a dot as two underscores."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in (SETTINGS | {k.replace("__", "."): v for k, v in settings.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the Python workers, once per application.

    Not needed where the package is installed on the executors, or passed by --py-files.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    target = os.path.join(tempfile.mkdtemp(prefix="registrum-ship-"), "registrum.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, f"{root.name}/{p.relative_to(root).as_posix()}")
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)


_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; a temporary folder only in local mode where it is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="registrum-")
    return _own[app]


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table of the shared folder: what several plans use is computed once, and read again after a loss."""
    where = f"{shared_folder(df.sparkSession)}/registrum-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(where)
    return df.sparkSession.read.schema(df.schema).parquet(where)

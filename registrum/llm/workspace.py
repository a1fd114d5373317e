"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship

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


class Workspace:
    """A folder of Parquet tables that cut lineage: a lost executor costs a reread, not a recomputation."""

    def __init__(self, spark: SparkSession, name: str):
        ship(spark)
        self.spark = spark
        self.path = f"{shared_folder(spark)}/registrum-{name}-{uuid.uuid4().hex}"

    def save(self, df: DataFrame, table: str) -> DataFrame:
        where = f"{self.path}/{table}"
        df.write.option("compression", "zstd").parquet(where)
        return self.spark.read.schema(df.schema).parquet(where)

    def drop(self, table: str) -> None:
        """Delete a table that no later plan reads."""
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{table}")
        where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def grouped(df: DataFrame, keys: list[str], work: Callable[[pa.Table], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Run work once on the rows of each key combination; groups must be small by construction.

    Rows meet by a shuffle and a sort, and stream: only one group is held at a time,
    without the per-group cost of applyInPandas.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        held: list[pa.RecordBatch] = []
        last: tuple | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            change = np.zeros(batch.num_rows, dtype=bool)
            for k in keys:
                c = batch.column(k).to_numpy(zero_copy_only=False)
                change[1:] |= c[1:] != c[:-1]
            cuts = np.flatnonzero(change).tolist()
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                this = tuple(batch.column(k)[a].as_py() for k in keys)
                if last is not None and this != last:
                    out = work(pa.Table.from_batches(held).combine_chunks())
                    if out is not None and out.num_rows:
                        yield out
                    held = []
                last = this
                held.append(batch.slice(a, b - a))
        if held:
            out = work(pa.Table.from_batches(held).combine_chunks())
            if out is not None and out.num_rows:
                yield out

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


#: a key is heavy with this part of all rows, and LEAST_HEAVY rows at least: so many heavy keys there can be
HEAVY_PARTS, LEAST_HEAVY = 4096, 1000


def join_counted(rows: DataFrame, counted: DataFrame, key: str | list[str], n: str, total: int) -> DataFrame:
    """rows joined to counted on key, with no task that holds all rows of a heavy key.

    counted has one row per key and, in column n, the number of rows with this key; total is
    the number of all rows.  The rows of a heavy key are dealt to several tasks by a hash of
    their columns, and the key's row of counted to each of these.  Heavy keys, HEAVY_PARTS at
    most, are broadcast.
    """
    least = max(LEAST_HEAVY, -(-total // HEAVY_PARTS))
    keys = [key] if isinstance(key, str) else key
    if total < least:
        return rows.join(counted, keys)
    parts = F.ceil(F.col(n) / least).cast("int")
    heavy = counted.where(F.col(n) > least).select(*keys, parts.alias("__parts"))
    dealt = rows.join(F.broadcast(heavy), keys, "left").withColumn("__deal", F.coalesce(F.pmod(F.xxhash64(*rows.columns), F.col("__parts")), F.lit(0)).cast("int")).drop("__parts")
    spread = counted.withColumn("__deal", F.explode(F.when(F.col(n) > least, F.sequence(F.lit(0), parts - 1)).otherwise(F.array(F.lit(0)))))
    return dealt.join(spread, [*keys, "__deal"]).drop("__deal")


def empty(df: DataFrame) -> bool:
    return not df.select(F.lit(1)).head(1)

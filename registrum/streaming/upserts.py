"""Latest-wins merge of a stream of upserts, an extension over the batch jobs.

Each micro-batch is merged with the current state by the operator of the batch job, and the
result is written under the batch's number before a pointer moves to it; a batch that is
replayed after a failure writes the same rows again.
"""

from __future__ import annotations

import json
import os
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators import merge


def state(spark: SparkSession, directory: str) -> DataFrame | None:
    """The current rows, or None before the first batch."""
    pointer = Path(directory, "CURRENT.json")
    if not pointer.exists():
        return None
    return spark.read.parquet(f"{directory}/{json.loads(pointer.read_text())['state']}")


def merged_stream(stream: DataFrame, directory: str, keys: Sequence[str], order: Sequence[str], checkpoint: str, **trigger) -> StreamingQuery:
    """Start the merge; trigger as for writeStream.trigger, by default all that is available."""
    Path(directory).mkdir(parents=True, exist_ok=True)

    def each(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        now = state(spark, directory)
        rows = batch if now is None else now.unionByName(batch)
        name = f"state-{number:08d}"
        if now is not None and json.loads(Path(directory, "CURRENT.json").read_text())["state"] == name:
            return  # the batch was finished before the failure
        merge.latest(rows, keys, order).write.mode("overwrite").parquet(f"{directory}/{name}")
        new = Path(directory, "CURRENT.new")
        new.write_text(json.dumps({"state": name}))
        os.replace(new, Path(directory, "CURRENT.json"))

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()

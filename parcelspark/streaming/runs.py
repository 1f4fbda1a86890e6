"""Batch functions run on a growing folder of tiles: each micro-batch is idempotent by fingerprint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def on_new_tiles(spark: SparkSession, folder: str, schema: T.StructType, work: Callable[[DataFrame, int], None], checkpoint: str, files_a_batch: int = 64) -> StreamingQuery:
    """Call `work(rows, batch)` for files as they appear, at most `files_a_batch` at once (back-pressure).
    A batch that was interrupted is run again: `work` must overwrite what it wrote. Ends when caught up."""
    tiles = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(folder)
    return tiles.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def replace_partitions(path: str, by: list[str]) -> Callable[[DataFrame, int], None]:
    """A `work` that replaces the partitions its rows belong to."""

    def work(rows: DataFrame, _: int) -> None:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)

    return work


def work_left(units: DataFrame, done: DataFrame, claims: DataFrame, now: float, patience: float = 900.0) -> DataFrame:
    """Units of a queue that are not done and not claimed by someone whose heartbeat is recent."""
    live = claims.where(F.col("heartbeat") > now - patience).select("unit")
    return units.join(done.select("unit"), "unit", "left_anti").join(live, "unit", "left_anti")


def taken_over(claims: DataFrame, worker: str, now: float, patience: float = 900.0, most: int = 1) -> DataFrame:
    """`claims` (unit, worker, heartbeat, tries) after `worker` has taken at most `most` units: those that nobody has
    claimed (null heartbeat) or whose heartbeat is older than `patience`, fewest tries first. A unit may thus run
    twice; its output must replace itself."""
    free = F.col("heartbeat").isNull() | (F.col("heartbeat") <= now - patience)
    taken = claims.where(free).orderBy("tries", "unit").limit(most).select("unit", F.lit(True).alias("_mine"))
    joined = claims.join(F.broadcast(taken), "unit", "left")
    mine = F.coalesce(F.col("_mine"), F.lit(False))
    return joined.select("unit", F.when(mine, F.lit(worker)).otherwise(F.col("worker")).alias("worker"), F.when(mine, F.lit(now)).otherwise(F.col("heartbeat")).alias("heartbeat"), (F.col("tries") + mine.cast("int")).alias("tries"))

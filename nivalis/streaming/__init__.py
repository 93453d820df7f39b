"""Files as they come: the incremental plan fed by a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from nivalis.plans.incremental import incremental_plan
from nivalis.sources.tables import latest_file, parse_file_metadata

FILES = T.StructType([T.StructField("file_name", T.StringType()), T.StructField("edit_ts", T.TimestampType())])


def file_stream(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    """Listings of input files (JSON lines) as they arrive, parsed."""
    rows = spark.readStream.schema(FILES).option("maxFilesPerTrigger", files_per_trigger).json(path)
    return parse_file_metadata(rows)


def plan_as_files_come(files: DataFrame, status: Callable[[], DataFrame], handle: Callable[[DataFrame, int], None], checkpoint: str, mode: int = 0) -> StreamingQuery:
    """Calls handle(plan, batch id) for each micro-batch: the incremental plan of the tile-days whose files have come.

    `status` gives what has been done until then. Of several files of a tile-day the latest counts; names that are
    no input file are passed over. A batch may be planned again after a failure, so handle should be idempotent.
    """

    def batch(df: DataFrame, batch_id: int) -> None:
        latest = latest_file(df.where("obs_date IS NOT NULL"))
        handle(incremental_plan(latest.select("tile", "obs_date"), latest, status(), mode), batch_id)

    return files.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

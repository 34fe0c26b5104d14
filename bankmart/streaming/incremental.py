"""Land new CSV drops into Bronze, exactly once, with Structured Streaming.

The daily batch lands whole extracts.  When extracts arrive as files in a
landing folder, the same Bronze append can run as a file stream with the
``availableNow`` trigger: each run picks up only files not seen before
(tracked in the checkpoint), stamps them and appends them, then stops.  A
lost executor or a failed run resumes from the checkpoint without
duplicating or skipping files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bankmart import schemas
from bankmart.config import RunConfig, DEFAULT
from bankmart.operators import bronze
from bankmart.sources.csv import CORRUPT


def land_available_now(spark: SparkSession, source: str, landing_dir: str, bronze_dir: str,
                       checkpoint_dir: str, cfg: RunConfig = DEFAULT) -> None:
    system, _, business_date = schemas.SOURCE_META[source]
    rows = T.StructType(schemas.SOURCES[source].fields + [T.StructField(CORRUPT, T.StringType())])
    stream = (spark.readStream.schema(rows).option("header", True).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT)
              .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
              .csv(landing_dir)
              .withColumn(bronze.INPUT, F.concat_ws(":", "_metadata.file_path",
                                                    F.col("_metadata.file_block_start").cast("string"))))
    stamped = bronze.stamp(stream, system, None, cfg)   # real file name from _metadata

    def append(batch: DataFrame, number: int) -> None:
        # every micro-batch is a batch of its own, so a later one replaces none
        bronze.append(batch, bronze_dir, f"{cfg.batch_id}-{number:06d}", business_date=business_date)

    q = (stamped.writeStream.foreachBatch(append)
         .option("checkpointLocation", checkpoint_dir)
         .trigger(availableNow=True).start())
    q.awaitTermination()

"""Incremental landing: new archives become raw records, every archive exactly once.

The stream carries paths only. Each micro-batch first decides by landing name what is new: an archive landed earlier under
another path is skipped. Only then are the new ones opened, once, by the tasks that cut their records. The file source
remembers which paths it has delivered, and a batch writes its own folder with overwrite, so a batch repeated after a
failure replaces itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from faultline.schemas import RAW_RECORD, empty
from faultline.sources.partition_index import landing_name
from faultline.sources.records import read_records
from faultline.sources.tables import read_if_present

_BINARY = "path string, modificationTime timestamp, length bigint, content binary"
# Paths of a batch that the driver hands to the scan; a larger inbox takes more batches.
BATCH_FILES = 1_000


def land_archives(
    spark: SparkSession, inbox: str, bronze: str, checkpoint: str, pattern: str = "*.zip", zipped: bool = True,
    batch_files: int = BATCH_FILES,
) -> StreamingQuery:
    """Land what is new in ``inbox`` and stop. Read the result with ``read_bronze``."""
    files = (
        spark.readStream.format("binaryFile")
        .schema(_BINARY)
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", batch_files)
        .load(inbox)
        .select("path")
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        named = batch.withColumn("landed_name", landing_name(F.col("path")))
        fresh = named.groupBy("landed_name").agg(F.min("path").alias("path"))
        landed = read_if_present(session, f"{bronze}/manifest")
        if landed is not None:
            before = landed.where(F.col("batch") != batch_id).select("landed_name")
            fresh = fresh.join(before, "landed_name", "left_anti")
        fresh = fresh.orderBy("path").collect()  # at most ``batch_files`` names
        paths = [r["path"] for r in fresh]
        files = session.read.format("binaryFile").load(paths) if paths else session.createDataFrame([], _BINARY)
        read_records(files, zipped=zipped).write.mode("overwrite").parquet(f"{bronze}/records/batch={batch_id}")
        manifest = session.createDataFrame([tuple(r) for r in fresh], "landed_name string, path string")
        manifest.write.mode("overwrite").parquet(f"{bronze}/manifest/batch={batch_id}")

    query = (
        files.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def read_bronze(spark: SparkSession, bronze: str) -> DataFrame:
    landed = read_if_present(spark, f"{bronze}/records")
    return empty(spark, RAW_RECORD) if landed is None else landed.select(*RAW_RECORD.names)

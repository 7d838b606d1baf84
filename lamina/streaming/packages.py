"""Packages as a stream: each new file is parsed and analyzed once, a document being the unit of state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lamina.plans import engine
from lamina.sources import package

FILES = "path string, modificationTime timestamp, length bigint, content binary"


def read_stream(spark: SparkSession, path: str) -> DataFrame:
    """(path, part, size, content): the parts of packages as they arrive under a folder."""
    files = spark.readStream.format("binaryFile").schema(FILES).option("pathGlobFilter", "*.{hwpx,zip}").load(path)
    return package.parts_of(files)


def write_sections(parts: DataFrame, out: str, checkpoint: str):
    """Start a query that appends nodes, tables and cells of each batch as Parquet, once per batch."""

    def save(batch: DataFrame, number: int) -> None:
        parsed = package.sections(batch).persist()
        for name, relation in (("nodes", package.nodes), ("tables", package.tables), ("cells", package.cells)):
            relation(parsed).write.mode("overwrite").parquet(f"{out}/{name}/batch={number}")
        parsed.unpersist()

    return parts.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def write_analysis(parts: DataFrame, out: str, checkpoint: str):
    """Start a query that analyzes the documents of each batch and writes all that ``engine.write`` does, once per batch.

    No relation spans documents, so batches need no state of each other; a batch that is repeated after a failure
    overwrites its own folder.
    """

    def save(batch: DataFrame, number: int) -> None:
        engine.write(engine.analyze(batch), f"{out}/batch={number}")

    return parts.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

"""What jobs need beside their plans: this package on the Python workers, and cut lineages."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per context; they need not have it installed."""
    context = spark.sparkContext
    if getattr(context, "_lamina_shipped", False):
        return
    package = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="lamina-"), "lamina.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(archive)
    context._lamina_shipped = True


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder, as ``spark.checkpoint.dir`` names it.

    Only on a local master, where driver and executors are one process (tests, a laptop), a temporary one is set
    if there is none; on a cluster such a folder would be one machine's own, so there it is an error.
    """
    context = spark.sparkContext
    found = context._jsc.sc().getCheckpointDir()
    if found.isDefined():
        return found.get()
    named = context.getConf().get("spark.checkpoint.dir")
    if not named and not (context.master.startswith("local") and "local-cluster" not in context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    context.setCheckpointDir(named or tempfile.mkdtemp(prefix="lamina-checkpoints-"))
    return context._jsc.sc().getCheckpointDir().get()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder's path below the session's checkpoint folder; it is made by whoever writes there."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the folder that the session names."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Bytes of a source's files, by the columns read, that one partition of ``spread`` takes about.
SPREAD_BYTES = 4_000_000


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """df dealt out by ``keys`` once, into as many partitions as its files' size asks for.

    What follows by these keys needs no other exchange, and the exchange is reused where df is read again. Their number
    grows with the input, so what a task holds does not; adaptive execution leaves it as it is.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-size // SPREAD_BYTES)), *keys)


#: Rows of a batch that ``by_group`` gives back.
BATCH_ROWS = 10_000


def by_group(df: DataFrame, key: str, order: list[str], run: Callable, schema: str | StructType) -> DataFrame:
    """What ``run(key, rows)`` lists as tuples for each group, its rows as dicts in order.

    Groups are gathered as arrays, many to an Arrow batch, and worked off one by one: a grouped pandas function costs
    milliseconds a group, however small, and its batches end with the group.
    """
    ship(df.sparkSession)
    names = [*order, *[c for c in df.columns if c != key and c not in order]]
    kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(kind)
    pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    def each(batches):
        found = []
        for batch in batches:
            keys, groups = batch.columns
            for k, group in zip(keys, groups):
                found += run(k.as_py(), group.as_py())
                if len(found) >= BATCH_ROWS:
                    yield pack(found)
                    found = []
        if found:
            yield pack(found)

    gathered = df.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*names))).alias("rows"))
    return gathered.mapInArrow(each, kind)

"""Session helpers: the shared folder for durable intermediates and measured broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A lookup side is broadcast only when its measured text size stays below this.
BROADCAST_BYTES = 64 * 1024 * 1024


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if configured:
        if current is None:
            context.setCheckpointDir(configured)
        return configured
    if current:
        return current
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="ledgerloom-")
    context.setCheckpointDir(folder)
    return folder


# Scratch folders of this process, in the order they were named.
_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_folder(spark).rstrip('/')}/ledgerloom-{label}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Removes the scratch folders named within, on whatever storage they are. For jobs that leave nothing lazy."""
    start = len(_SCRATCH)
    try:
        yield
    finally:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        configuration = spark.sparkContext._jsc.hadoopConfiguration()
        for path in _SCRATCH[start:]:
            folder = hadoop(path)
            folder.getFileSystem(configuration).delete(folder, True)
        del _SCRATCH[start:]


def durable(df: DataFrame) -> DataFrame:
    """Computes ``df`` once into the shared folder, so later plans neither recompute nor lose it."""
    path = scratch_path(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts_needed(rows: int, each: int = 50_000) -> int:
    return max(1, -(-rows // each))


def bounded_parts(df: DataFrame, rows: int, each: int = 50_000) -> DataFrame:
    """``df``, of at most ``rows`` rows, in no more partitions than ``each`` rows a partition need. For tables that are
    stored: one of few rows is not spread over a file per shuffle partition."""
    return df.coalesce(parts_needed(rows, each))


def lookup_side(df: DataFrame, limit: int = BROADCAST_BYTES, once: bool = True) -> DataFrame:
    """Prepares the lookup side of a join.

    The side is measured. Within ``limit`` bytes it carries a broadcast hint, so the large side is not
    shuffled; beyond it the join stays unhinted and Spark shuffles both sides, with adaptive skew-join
    splitting for hot keys. ``once`` stores the side first, for sides that are expensive to compute.
    """
    kept = durable(df) if once else df
    row = kept.agg(F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("size")).first()
    return F.broadcast(kept) if (row["size"] or 0) <= limit else kept


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A handful of control rows as literals, without starting Python workers."""
    cells = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields)]) for row in rows
    ]
    if cells:
        return spark.range(1).select(F.inline(F.array(*cells)))
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])

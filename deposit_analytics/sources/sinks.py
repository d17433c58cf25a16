"""File sinks. Each write runs its job once."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MODES = ("append", "overwrite", "ignore", "error")
BY_SNAPSHOT = ("snapshot",)

# The folder of the innermost scratch block, if there is one.
_SCRATCH: ContextVar[str | None] = ContextVar("scratch", default=None)


def counted(result: DataFrame, observation: Observation) -> DataFrame:
    """The same rows, counted while an action runs; no second job is needed.

    ``observation.get["rows"]`` holds the count after the action, and
    ``["snapshots"]`` the dates if there is such a column. Put this last,
    after any shuffle: tasks of an action's last stage count once even when
    they are repeated after losing an executor, tasks of earlier stages do not.
    """
    metrics = [F.count(F.lit(1)).alias("rows")]
    if BY_SNAPSHOT[0] in result.columns:
        # A handful of values: one for each date of the report.
        metrics.append(F.collect_set(*BY_SNAPSHOT).alias("snapshots"))
    return result.observe(observation, *metrics)


def _laid_out(
    result: DataFrame, partition_by: Sequence[str], observation: Observation | None = None
) -> DataFrame:
    """Rows of one output folder together, in tasks of about even size.

    Without this every task would write a file into every folder. The rebalance
    hint lets adaptive execution split a folder that is too large for one task
    and merge the small ones.
    """
    if partition_by:
        result = result.hint("rebalance", *[F.col(name) for name in partition_by])
    return result if observation is None else counted(result, observation)


def write_parquet(
    result: DataFrame,
    path: str,
    mode: str = "append",
    partition_by: Sequence[str] = BY_SNAPSHOT,
    observation: Observation | None = None,
) -> None:
    """Writes parquet files, one folder per snapshot.

    ``append`` adds the rows even if that snapshot is there already. The rows
    written are counted in ``observation`` if one is given.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    rows = _laid_out(result, partition_by, observation)
    writer = rows.write.mode(mode).option("partitionOverwriteMode", "static")
    writer.partitionBy(*partition_by).parquet(path)


def overwrite_snapshots(result: DataFrame, path: str, observation: Observation | None = None) -> None:
    """Replaces the snapshots that occur in ``result`` and leaves the others.

    A snapshot without rows in ``result`` is left as it is, also when an earlier
    run had rows for it; ``drop_snapshots`` removes such ones.
    """
    (
        _laid_out(result, BY_SNAPSHOT, observation)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*BY_SNAPSHOT)
        .parquet(path)
    )


def drop_snapshots(spark: SparkSession, path: str, snapshots: Iterable[str]) -> None:
    """Deletes the folders of these snapshots, if there are any, and nothing else."""
    for snapshot in snapshots:
        drop_folder(spark, f"{path.rstrip('/')}/{BY_SNAPSHOT[0]}={snapshot}")


def drop_folder(spark: SparkSession, path: str) -> None:
    """Deletes one folder with all it holds, if it exists."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if files.exists(folder):
        files.delete(folder, True)


def read_parquet_result(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Reads a stored result back under its own types.

    Without the schema, Spark would take the snapshot in the folder names for a
    number.
    """
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def append_csv(result: DataFrame, path: str, header: bool = False) -> None:
    """Adds the rows to a folder of CSV files, written by the tasks."""
    result.write.mode("append").option("header", header).option("encoding", "UTF-8").csv(path)


def read_csv_result(spark: SparkSession, path: str, schema: StructType, header: bool = False) -> DataFrame:
    """Reads a CSV folder back; empty fields are NULL."""
    return spark.read.schema(schema).option("header", header).option("encoding", "UTF-8").csv(path)


def preview(result: DataFrame, rows: int = 1) -> DataFrame:
    """A few rows to look at, in no particular order."""
    return result.limit(rows)


def work_folder(spark: SparkSession, label: str) -> str:
    """A new folder name in the shared folder of the cluster, or in the folder of a ``scratch`` block.

    The cluster names that folder in ``spark.checkpoint.dir``. A local session
    without the setting gets a temporary folder; a cluster session without it
    is an error, since executors do not share a machine's own folders.
    """
    base = _SCRATCH.get() or spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="run-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession, label: str = "scratch") -> Iterator[str]:
    """Folders named by ``work_folder`` inside the block go when it ends, also after an error.

    Frames are lazy: what must outlive the block has to be written, inside it, to a
    folder named before it. A block inside another one ends first.
    """
    folder = work_folder(spark, label)
    outer = _SCRATCH.set(folder)
    try:
        yield folder
    finally:
        _SCRATCH.reset(outer)
        drop_folder(spark, folder)

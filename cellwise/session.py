"""Session-level settings every operator shares: size budgets and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Largest block of centres (bytes of float64) that is collected and broadcast at
# once.  A larger set of centres is processed block after block, never truncated.
MAX_CENTER_BYTES = 128 * 1024 * 1024
# Arrow batches of rows with many values, and the setting that limits them.
_BATCH_BYTES = 8 * 1024 * 1024
_BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Workers import it to run the Arrow functions; shipping it means that neither
    an installation on the executors nor a certain working folder is needed.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="cellwise-package-")) / "cellwise.zip"
    with zipfile.ZipFile(archive, "w") as target:
        for source in sorted(package.rglob("*.py")):
            target.write(source, source.relative_to(package.parent))
    sc.addPyFile(str(archive))
    _shipped.add(sc.applicationId)


def center_budget(spark: SparkSession) -> int:
    """Broadcast budget in bytes; override with ``spark.cellwise.maxCenterBytes``."""
    return int(spark.conf.get("spark.cellwise.maxCenterBytes", str(MAX_CENTER_BYTES)))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, taking it from the session.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session
    without that setting (unit tests) falls back to a temporary folder: on a
    cluster such a folder would not survive the loss of its machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="cellwise-checkpoint-")
    sc.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the checkpoint folder and continue from that copy.

    Unlike an RDD checkpoint, the Parquet copy is read by column and its size is
    known to the optimizer.  It survives the loss of executors; like checkpoints,
    the copies stay until the folder is cleaned.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, most: int = _BATCH_BYTES) -> Iterator[None]:
    """Arrow batches of at most ``most`` bytes in the jobs that run inside, for rows of many values.

    A batch is held several times over, in the JVM and in its Python worker; Spark's own limit is 64 MB.
    """
    before = spark.conf.get(_BATCH_LIMIT, None)
    spark.conf.set(_BATCH_LIMIT, str(most))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_BATCH_LIMIT)
        else:
            spark.conf.set(_BATCH_LIMIT, before)


def local_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small result as a DataFrame, handed over as Arrow columns rather than pickled rows."""
    fields = StructType.fromDDL(schema).fields
    columns = {f.name: pa.array([row[i] for row in rows]) for i, f in enumerate(fields)}
    frame = spark.createDataFrame(pa.table(columns))
    return frame.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in fields])

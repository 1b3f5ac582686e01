"""Where jobs write what they read more than once: the shared folder of ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Set only where the session names no shared folder and runs on one machine.
_own: list[str] = []
#: Folder of each application's tables, below the shared one.
_FOLDER = "outpost-tables-"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: that of ``spark.checkpoint.dir``. Without one, a
    folder of this machine if all executors are on it (master ``local``), else an error."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _own:
        _own.append("file://" + tempfile.mkdtemp(prefix="outpost-"))
    return _own[0]


def tables_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/{_FOLDER}{spark.sparkContext.applicationId}"


def clear(spark: SparkSession) -> None:
    """Delete all that ``write_table`` wrote in this application. DataFrames that rest on it, such as results
    not yet written elsewhere, can't be read afterwards."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(tables_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def write_table(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts the lineage, so that a lost
    executor costs a reread and not a recomputation, and fixes the rows for later passes."""
    spark = df.sparkSession
    path = f"{tables_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of a batch that Spark hands to Python, at most.
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Have Spark hand rows to Python in small batches, as texts may be long: what a batch takes in a task, and
    in its JVM, is bounded by bytes and not by rows. A smaller setting of the session stays."""
    size = spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch()
    if size <= 0 or size > BATCH_BYTES:
        spark.conf.set(_BATCH, str(BATCH_BYTES))

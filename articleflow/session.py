"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that can be changed on a running session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A repeated key in a model response: the last one counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Whole pages travel in Arrow batches: bound a batch by bytes, not by rows only.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("articleflow")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="articleflow-"))
        # Don't record the Python line of every column expression: plans here have thousands of them.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def work_dir(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="articleflow-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    For a result with several readers: it is computed once, its real size is known to
    the planner, and it survives the loss of executors.
    """
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a folder in the store that ``path`` names; false if it is not there."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    return bool(place.getFileSystem(conf).delete(place, True))

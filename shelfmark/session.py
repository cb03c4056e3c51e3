"""Session helpers: where scratch tables go, and per-stage Arrow batch sizes."""

from __future__ import annotations

import gc
import tempfile
import uuid
import zipfile
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_local_scratch: dict[str, str] = {}
_shipped: set[str] = set()
_written: dict[str, list[str]] = {}


def get_spark(app_name: str = "shelfmark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; sizes are left to the cluster."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune_shuffle(spark: SparkSession, input_bytes: int, target_bytes: int = 128 << 20) -> int:
    """Set the number of shuffle partitions for jobs over this much data.

    Adaptive execution merges partitions that turn out small, and cannot split those that
    are too large for lack of partitions: so the number follows the input.
    """
    cores = spark.sparkContext.defaultParallelism
    partitions = max(cores, min(200_000, -(-input_bytes // target_bytes)))
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return partitions


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the one ``spark.checkpoint.dir`` names.

    A folder of our own is made only in local mode with the setting unset; on a
    cluster a machine-local folder would be lost to the other executors.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if named:
        if named.startswith("file:") and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir names a machine-local folder; all executors must share it")
        return named.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if sc.applicationId not in _local_scratch:
        _local_scratch[sc.applicationId] = tempfile.mkdtemp(prefix="shelfmark-")
    return _local_scratch[sc.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared scratch folder."""
    path = f"{scratch_dir(spark)}/shelfmark/{label}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def drop_scratch(spark: SparkSession) -> int:
    """Delete the intermediate tables of this application; the number of paths deleted.

    For the end of a job: DataFrames that read them can no longer be used.
    """
    sc = spark.sparkContext
    deleted = 0
    for path in _written.pop(sc.applicationId, []):
        target = sc._jvm.org.apache.hadoop.fs.Path(path)
        deleted += target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)
    return deleted


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to shared storage and read it back.

    Cuts the lineage (a lost executor re-reads files instead of recomputing models
    or non-deterministic columns) and keeps column pruning for the readers.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of jobs whose DataFrames are no longer in use. It does
    so when the driver collects garbage, which one with memory to spare puts off for long."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Spread a *scan* by its key when it has fewer splits than there are cores.

    A file with one row group is read by one task however many splits it has. Large
    tables have more splits than cores, so there this returns ``df`` as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, as ``--py-files`` would.

    Called by the operators that run Python in tasks; once per application.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    home = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="shelfmark-")) / "shelfmark.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(home.rglob("*.py")):
            out.write(source, source.relative_to(home.parent))
    sc.addPyFile(str(archive))
    _shipped.add(sc.applicationId)


@contextmanager
def setting(spark: SparkSession, name: str, value: str):
    """A session setting for the actions run inside the block, then as it was before."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def arrow_batch_rows(spark: SparkSession, rows: int):
    """Cap Arrow batches inside the block.

    Use around the stage that moves whole files; a cap left on for the session would
    also cut the batches of the embedding model.
    """
    return setting(spark, _ARROW_ROWS, str(rows))

"""Files as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfmark.session import setting

# Folders, or named files, are listed by tasks; by default each is a task of its own, up to 10,000.
_LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
LISTING_TASKS_PER_CORE = 4

# What a file counts for besides its bytes when files are dealt to tasks. Spark's 4 MB make a task of every
# few small files, and of what such tasks write files as small.
_OPEN_COST = "spark.sql.files.openCostInBytes"
SMALL_FILE_COST = 64 << 10

# The fixed schema of Spark's binaryFile source.
FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def scan_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """One row per file under ``path``, at any depth; zero-length files give no row.

    Filters on path, length and time reach the scan, and the bytes are read only when
    ``content`` is used.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    with listing_tasks(spark):
        return reader.load(path)


def read_files(spark: SparkSession, paths: list[str] | DataFrame) -> DataFrame:
    """One row per named file; no other file is touched.

    Of a table the column ``path`` counts. Its paths stay in the JVM: handed over one by one
    they take longer than the files.
    """
    reader = spark.read.format("binaryFile")
    with listing_tasks(spark):
        if isinstance(paths, list):
            return reader.load(paths)
        named = getattr(paths.select("path")._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING()).collect()
        return reader._df(reader._jreader.load(named))


def listing_tasks(spark: SparkSession):
    """Files are listed by some tasks per core inside the block, many folders each."""
    return setting(spark, _LISTING_TASKS, str(LISTING_TASKS_PER_CORE * spark.sparkContext.defaultParallelism))


def many_files(spark: SparkSession):
    """Scans of files run by few tasks inside the block, thousands of small files each."""
    return setting(spark, _OPEN_COST, str(SMALL_FILE_COST))


def stream_files(spark: SparkSession, path: str, glob: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    """New files under ``path`` as a stream, with the same columns."""
    reader = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("recursiveFileLookup", "true")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)

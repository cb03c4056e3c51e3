"""Triggered syncs: each run takes in what is new since the last one, then stops."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfmark.functions.common import as_list
from shelfmark.operators.changes import fingerprint
from shelfmark.plans.index import create_index, index_rows, upsert_index
from shelfmark.plans.ingest import ingest_files
from shelfmark.session import materialize
from shelfmark.sources.files import stream_files
from shelfmark.sources.keyed import create_companion, stored_with_keys, upsert_only


def latest_per_key(rows: DataFrame, key: list[str], version_col: str | None) -> DataFrame:
    """One row per key, that of the highest version; pre-aggregated before the shuffle.

    Without versions, and between equal ones, the choice is by a hash of the content: the
    same on every run.
    """
    rest = [c for c in rows.columns if c not in key]
    order = F.struct(*([] if version_col is None else [version_col]), fingerprint(rest or key).alias("_hash"))
    newest = rows.groupBy(*key).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return newest.select(*key, "_row.*").select(*rows.columns)


def version_table(spark: SparkSession, index: str, version_col: str) -> str:
    """Key, version and content hash of the last change taken in for each key, deletes included.

    Where an index has been filled without it, it begins with the versions that the index holds.
    """
    rows = index_rows(spark, index)
    shape = f"`{version_col}` {rows.schema[version_col].dataType.simpleString()}, change_hash string"
    return create_companion(spark, index, "versions", shape, rows.withColumn("change_hash", F.lit("")))


def not_outdated(rows: DataFrame, versions: str, key: list[str], version_col: str) -> DataFrame:
    """Those of ``rows``, one per key, that are not older than the version taken in before.

    The order is that of ``latest_per_key``, so that the outcome does not depend on how the
    changes were cut into batches, nor on the order of these.
    """
    order = F.struct(version_col, "change_hash")
    seen = stored_with_keys(rows, versions).select(*key, order.alias("_seen"))
    both = rows.join(seen, key, "left")
    return both.where(F.col("_seen").isNull() | (order >= F.col("_seen"))).drop("_seen")


def _run(stream: DataFrame, checkpoint: str, table: str, batch) -> int:
    """Run one triggered sync to its end; the number of batches that held data."""
    taken = []

    def step(rows: DataFrame, batch_id: int) -> None:
        if rows.isEmpty():
            return
        batch(rows)
        taken.append(batch_id)

    query = (
        stream.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    # Batches run in a session of their own; this one may remember the table's old files.
    spark = stream.sparkSession
    if spark.catalog.tableExists(table):
        spark.catalog.refreshTable(table)
    return len(taken)


def sync_stream(
    spark: SparkSession,
    source_dir: str,
    schema: StructType | str,
    index: str,
    checkpoint: str,
    key: str | list[str] = "id",
    vector_col: str = "embedding",
    dim: int = 1024,
    version_col: str | None = None,
    n_buckets: int | None = None,
    path: str | None = None,
    embedder_id: str | None = None,
    files_per_batch: int | None = None,
) -> int:
    """Bring new Parquet files of ``source_dir`` into the index; returns the batches run.

    Rows may carry ``_change``, as ``diff_snapshots`` makes it: those marked ``delete``
    take their key out of the index. ``files_per_batch`` cuts a backlog into batches.

    A batch that is repeated after a failure writes the same rows by key again, so the
    result is as if it had run once. With ``version_col`` the highest version of a key wins,
    in whatever order and batches the changes come: a late older row changes nothing, and
    does not bring back a key deleted since. Versions are kept in a narrow table beside the
    index (``drop_index`` drops both). Without it the last batch wins.
    The first batch creates the index: give ``n_buckets`` for the size it will grow to.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.parquet(source_dir)

    keys = as_list(key)

    def batch(rows: DataFrame) -> None:
        session = rows.sparkSession
        rows = materialize(latest_per_key(rows, keys, version_col), "change-rows")
        content = rows.drop("_change")
        create_index(content, index, keys, vector_col, dim, embedder_id, n_buckets, path)
        if version_col is not None:
            hashed = rows.withColumn("change_hash", fingerprint([c for c in rows.columns if c not in keys]))
            versions = version_table(session, index, version_col)
            rows = materialize(not_outdated(hashed, versions, keys, version_col), "newer-rows")
        marked = F.lit(False) if "_change" not in rows.columns else F.coalesce(F.col("_change") == "delete", F.lit(False))
        put = rows.where(~marked).select(*content.columns)
        upsert_index(put, index, embedder_id, gone=rows.where(marked))
        if version_col is not None:
            # Last: a batch interrupted before this is taken in again as a whole.
            upsert_only(rows.select(*keys, version_col, "change_hash"), versions)

    return _run(stream, checkpoint, index, batch)


def ingest_stream(
    spark: SparkSession,
    source_dir: str,
    table: str,
    embedder,
    checkpoint: str,
    extractor="auto",
    glob: str | None = None,
    files_per_batch: int | None = None,
    **options,
) -> int:
    """Bring new files of ``source_dir`` into the embedding table; returns the batches run.

    A stream of files takes each path once. Where files are updated in place or removed,
    ``ingest_changes`` follows them.
    """
    stream = stream_files(spark, source_dir, glob, files_per_batch)
    return _run(stream, checkpoint, table, lambda rows: ingest_files(rows, table, embedder, extractor, **options))

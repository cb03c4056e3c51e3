"""A searchable index over a source table, created once and then kept in step."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.common import as_list
from shelfmark.operators.changes import changed_keys, fingerprint
from shelfmark.operators.validate import validate_vectors
from shelfmark.session import materialize
from shelfmark.sources.tables import check_embedder
from shelfmark.sources.keyed import (
    apply_to_table,
    buckets_for,
    create_companion,
    create_keyed_table,
    refuse_duplicates,
    stored_with_keys,
    table_keys,
    table_property,
    upsert_only,
    upsert_rows,
    write_rows,
)


# Narrow tables kept beside an index: versions seen by a stream, texts that got no vector.
COMPANIONS = ("versions", "skipped")


def index_exists(spark: SparkSession, index: str) -> bool:
    return spark.catalog.tableExists(index)


def create_index(
    df: DataFrame,
    index: str,
    key: str | list[str] = "id",
    vector_col: str = "embedding",
    dim: int = 1024,
    embedder_id: str | None = None,
    n_buckets: int | None = None,
    path: str | None = None,
) -> bool:
    """Create an empty index with the columns of ``df``; False when it exists.

    The number of buckets follows the rows of ``df`` unless given.
    """
    if index_exists(df.sparkSession, index):
        return False
    drop_index(df.sparkSession, index)
    if n_buckets is None:
        n_buckets = buckets_for(df.count(), 4 * dim + 4_000)
    properties = {"vector_col": vector_col, "dim": str(dim)}
    if embedder_id is not None:
        properties["embedder_id"] = embedder_id
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return create_keyed_table(df.sparkSession, index, columns, as_list(key), n_buckets, path, properties)


def drop_index(spark: SparkSession, index: str) -> None:
    """Drop the index, if there is one, and the tables kept beside it."""
    for name in (index, *(f"{index}_{suffix}" for suffix in COMPANIONS)):
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def index_rows(spark: SparkSession, index: str) -> DataFrame:
    """The indexed rows, without the columns that maintenance uses."""
    return spark.table(index).drop("row_hash", "bucket")


def index_embedder(spark: SparkSession, index: str) -> str | None:
    return table_property(spark, index, "embedder_id")


def _valid(df: DataFrame, index: str) -> DataFrame:
    spark = df.sparkSession
    vector_col = table_property(spark, index, "vector_col")
    valid, _ = validate_vectors(df, int(table_property(spark, index, "dim")), vector_col)
    return valid


def create_or_sync_index(
    source: DataFrame,
    index: str,
    key: str | list[str] = "id",
    vector_col: str = "embedding",
    dim: int = 1024,
    embedder_id: str | None = None,
    n_buckets: int | None = None,
    path: str | None = None,
) -> dict[str, int]:
    """Create the index from ``source`` if absent, else apply what has changed since.

    Safe to run again: it then changes nothing. A sync reads only keys and hashes of the
    index and rewrites the touched buckets. Rows whose vector is not valid are not
    indexed (see ``validate_vectors`` for them). An interrupted run is repaired by the next.
    ``embedder_id`` must be the one the index was made with, and no key may come twice.
    """
    if not index_exists(source.sparkSession, index):
        # Before there is anything that reads as an index.
        refuse_duplicates(source, as_list(key))
    if create_index(source, index, key, vector_col, dim, embedder_id, n_buckets, path):
        write_rows(_valid(source, index), index)
        return {"insert": index_rows(source.sparkSession, index).count(), "update": 0, "delete": 0}
    check_embedder(source.sparkSession, index, embedder_id)
    return upsert_rows(_valid(source, index), index)


def create_or_sync_text_index(
    source: DataFrame,
    index: str,
    embedder,
    key: str = "id",
    text_col: str = "content",
    vector_col: str = "embedding",
    n_buckets: int | None = None,
    path: str | None = None,
) -> dict[str, int]:
    """As above for a source without vectors: the sync embeds the rows that changed, once.

    A text that gets no vector is not in the index; its hash is kept beside it, so that it is
    embedded again only when it changes.
    """
    spark = source.sparkSession
    source = source.withColumn("text_hash", fingerprint([c for c in source.columns if c != key]))
    shape = source.withColumn(vector_col, F.lit(None).cast("array<float>"))
    create_index(shape, index, key, vector_col, embedder.dim, embedder.embedder_id, n_buckets, path)
    check_embedder(spark, index, embedder.embedder_id)
    keys = table_keys(spark, index)
    skipped = create_companion(spark, index, "skipped", "text_hash string")
    known = [spark.table(t).select(*keys, "text_hash") for t in (index, skipped)]
    # Distinct: a run interrupted between the two tables leaves a key in both.
    found = changed_keys(known[0].unionByName(known[1]), source, keys, "text_hash").distinct()
    changes = materialize(found, "changes")
    fresh = source.join(changes.where(F.col("_change") != "delete").select(*keys), keys, "left_semi")
    embedded = materialize(embedder.transform(fresh, text_col, vector_col, key=key), "embedded")
    valid = _valid(embedded, index)
    # What is a change to the index follows from where the key is now, and has to be.
    indexed = stored_with_keys(changes, index).select(*keys, F.lit(True).alias("_old"))
    wanted = valid.select(*keys, F.lit(True).alias("_new"))
    kind = F.when(F.col("_old") & F.col("_new"), "update").when(F.col("_old"), "delete").when(F.col("_new"), "insert")
    placed = changes.select(*keys).join(indexed, keys, "left").join(wanted, keys, "left")
    placed = placed.select(*keys, kind.alias("_change")).where(F.col("_change").isNotNull())
    report = apply_to_table(materialize(placed, "changes"), valid, index)
    without = fresh.join(valid.select(*keys), keys, "left_anti").select(*keys, "text_hash")
    upsert_only(without, skipped, named=changes)
    return report


def upsert_index(
    rows: DataFrame, index: str, embedder_id: str | None = None, gone: DataFrame | None = None
) -> dict[str, int]:
    """Put rows into an index directly, without a source table; one row per key.

    A key whose new vector is not valid leaves the index: its former vector stands for it no
    more. Keys of ``gone`` that are not among the rows are deleted in the same step.
    """
    spark = rows.sparkSession
    check_embedder(spark, index, embedder_id)
    key = table_keys(spark, index)
    rows = materialize(rows, "rows")
    named = rows.select(*key)
    if gone is not None:
        named = named.unionByName(gone.select(*key))
    return upsert_only(_valid(rows, index), index, named)


def delete_from_index(keys: DataFrame, index: str) -> dict[str, int]:
    """Delete rows from an index by key; unknown keys are ignored."""
    spark = keys.sparkSession
    key = table_keys(spark, index)
    gone = stored_with_keys(keys, index).select(*key, F.lit("delete").alias("_change"))
    return apply_to_table(materialize(gone, "changes"), index_rows(spark, index), index)

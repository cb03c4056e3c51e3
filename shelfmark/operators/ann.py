"""Approximate search by inverted lists (Jegou et al. 2011)."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from shelfmark.functions.common import let
from shelfmark.functions.vectors import vector_fault
from shelfmark.operators.search import DEFAULT_K, METRICS, similarity_search
from shelfmark.operators.topk import BestRows, float_matrix
from shelfmark.session import scratch_path, ship_package

# Centroids that training holds on the driver and sends to the tasks.
MAX_CENTROID_BYTES = 256 << 20


@dataclass(frozen=True)
class AnnIndex:
    """Rows partitioned by ``list_id`` at ``path``, and the lists' centroids."""

    path: str
    metric: str
    dim: int
    n_lists: int
    key: str
    vector_col: str
    embedder_id: str | None = None

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/rows")

    def centroids(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/centroids")


def _direction(vector: Column) -> Column:
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))
    return let(norm, lambda n: F.transform(vector, lambda x: x.cast("double") / n))


def build_ann(
    index: DataFrame,
    dim: int,
    n_lists: int | None = None,
    metric: str = "cosine",
    key: str = "id",
    vector_col: str = "embedding",
    path: str | None = None,
    seed: int = 7,
    centroids: DataFrame | None = None,
    training_rows: int | None = None,
    embedder_id: str | None = None,
) -> AnnIndex:
    """Cluster the vectors and store every valid row under its nearest centroid.

    ``centroids(list_id, centroid)`` are taken as given; otherwise ``n_lists`` (by default
    the root of the number of rows) are trained on all rows, or on about ``training_rows``
    when the caller says so. Training keeps its centroids on the driver and refuses more
    than ``MAX_CENTROID_BYTES`` of them: name fewer lists then, or give centroids. A list
    that attracts far more rows than others is written by several tasks, and searched as
    several cells.
    """
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}, got {metric!r}")
    spark = index.sparkSession
    valid = index.where(vector_fault(F.col(vector_col), dim).isNull())
    path = path or scratch_path(spark, "ann")
    if centroids is None:
        centroids = _train(valid, dim, n_lists, metric, vector_col, seed, training_rows)
    centroids.select(F.col("list_id").cast("bigint"), F.col("centroid").cast("array<float>")).write.parquet(f"{path}/centroids")
    stored = spark.read.parquet(f"{path}/centroids")
    n_lists = stored.count()
    assigned = _assign(valid, stored, dim, n_lists, metric, vector_col)
    assigned.hint("rebalance", "list_id").write.partitionBy("list_id").parquet(f"{path}/rows")
    return AnnIndex(path, metric, dim, n_lists, key, vector_col, embedder_id)


def _train(valid: DataFrame, dim: int, n_lists: int | None, metric: str, vector_col: str, seed: int, training_rows: int | None) -> DataFrame:
    n_rows = valid.count()
    n_lists = n_lists or max(1, math.isqrt(n_rows))
    if n_lists * dim * 8 > MAX_CENTROID_BYTES:
        raise ValueError(f"{n_lists} centroids of {dim} numbers exceed {MAX_CENTROID_BYTES} bytes: name fewer lists or give centroids")
    vector = F.col(vector_col)
    features = array_to_vector(_direction(vector) if metric == "cosine" else vector.cast("array<double>"))
    training = valid.select(features.alias("_features"))
    if training_rows is not None and training_rows < n_rows:
        training = training.sample(fraction=training_rows / n_rows, seed=seed)
    # A random start: the other one ends in a single-threaded clustering on the driver.
    model = KMeans(k=n_lists, maxIter=10, seed=seed, featuresCol="_features", initMode="random").fit(training)
    centers = [(i, c.astype("float32").tolist()) for i, c in enumerate(model.clusterCenters())]
    return valid.sparkSession.createDataFrame(centers, "list_id bigint, centroid array<float>")


def _assign(valid: DataFrame, centroids: DataFrame, dim: int, n_lists: int, metric: str, vector_col: str) -> DataFrame:
    """``valid`` with ``list_id``, the nearest centroid by the rules of the search (ties by id).

    Centroids pass by in blocks of bounded size, and the better of two blocks is kept.
    """
    ship_package(valid.sparkSession)
    per_block = max(1, MAX_CENTROID_BYTES // (8 * dim))
    kind = StructType([StructField("list_id", LongType()), StructField("score", DoubleType())])
    best = None
    for block in range(max(1, -(-n_lists // per_block))):
        n_blocks = -(-n_lists // per_block)
        rows = centroids.where(F.pmod(F.xxhash64("list_id"), F.lit(n_blocks)) == block).orderBy("list_id").toArrow()
        if not rows.num_rows:
            continue
        ids, (found, matrix) = rows["list_id"].to_numpy(), float_matrix(rows["centroid"].combine_chunks(), dim)
        shared = valid.sparkSession.sparkContext.broadcast((ids[found], matrix))

        one = _nearest(shared, kind, dim, metric)(F.col(vector_col).cast("array<float>"))
        score = (lambda c: -c["score"]) if metric == "l2" else (lambda c: c["score"])
        if best is None:
            valid, best = valid.withColumn("_near", one), F.col("_near")
        else:
            valid = valid.withColumn("_next", one)
            better = (score(F.col("_next")) > score(best)) | ((score(F.col("_next")) == score(best)) & (F.col("_next.list_id") < best["list_id"]))
            valid = valid.withColumn("_near", F.when(better, F.col("_next")).otherwise(best)).drop("_next")
            best = F.col("_near")
    return valid.withColumn("list_id", F.col("_near.list_id")).drop("_near")


def _nearest(shared, kind: StructType, dim: int, metric: str):
    @F.arrow_udf(kind)
    def nearest(vectors: pa.Array) -> pa.Array:
        names, centers = shared.value
        _, asked = float_matrix(vectors, dim)
        hits = BestRows(asked, metric, 1)
        hits.add(names, centers)
        order = np.argsort(hits.query, kind="stable")
        return pa.StructArray.from_arrays([pa.array(hits.row_id[order]), pa.array(hits.score[order])], ["list_id", "score"])

    return nearest


def search_ann(
    ann: AnnIndex,
    queries: DataFrame,
    k: int = DEFAULT_K,
    nprobe: int = 8,
    where: Column | str | None = None,
    columns: tuple[str, ...] | list[str] = (),
    query_vector_col: str = "qv",
    **limits: int,
) -> DataFrame:
    """As ``similarity_search``, over the ``nprobe`` nearest lists of each query.

    With ``nprobe`` at the number of lists the result is exact.
    """
    spark = queries.sparkSession
    nearest = similarity_search(
        ann.centroids(spark),
        queries,
        k=min(nprobe, ann.n_lists),
        metric=ann.metric,
        key="list_id",
        vector_col="centroid",
        query_vector_col=query_vector_col,
        dim=ann.dim,
        **limits,
    )
    return similarity_search(
        ann.rows(spark),
        queries,
        k=k,
        metric=ann.metric,
        where=where,
        columns=columns,
        key=ann.key,
        vector_col=ann.vector_col,
        query_vector_col=query_vector_col,
        block_col="list_id",
        probes=nearest.select("query_id", F.col("id").alias("block")),
        dim=ann.dim,
        **limits,
    )

"""Approximate search over product-quantised inverted lists (Jegou et al. 2011).

Every row is kept twice: as it is, and as a code of ``n_sub`` bytes. The code names, for each of
``n_sub`` parts of the difference between a vector and the centroid of its list, the nearest of at
most 256 words. A search reads the codes of the probed lists alone: per question and list the
distance of a row is a sum of ``n_sub`` distances of words. The best
``shortlist`` rows of a question by these distances are scored exactly.

Vectors are compared on the unit sphere for ``cosine``, where the nearest is the most similar.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from shelfmark.operators.ann import AnnIndex, build_ann
from shelfmark.operators.search import DEFAULT_K, MAX_TASKS, similarity_search
from shelfmark.operators.topk import SCORE_DIGITS, float_matrix, pair_scores, slack_of
from shelfmark.session import materialize, ship_package

#: Words of a codebook: a code is one byte a part.
MAX_WORDS = 256
#: Rows and questions that meet in one task, a question for each list that it probes; more are cut.
CELL_ROWS, CELL_QUERIES = 1_000_000, 100_000
#: Pairs that one task scores exactly, and rows whose vectors it has for that.
CELL_PAIRS, CELL_VECTORS = 2_000_000, 150_000
#: Distances held at once within a task, and rows of a block of them.
_CELLS, _BLOCK_ROWS = 4_000_000, 16_384
#: Rows held for short lists within a task before they are cut to these.
_HELD = 2_000_000


@dataclass(frozen=True)
class PqIndex:
    """``ann`` has the rows and centroids; ``path`` the codes by list, and the codebooks."""

    ann: AnnIndex
    path: str
    n_sub: int

    def codes(self, spark: SparkSession) -> DataFrame:
        # The type of a folder's name is guessed, and a narrower one would hash to other partitions.
        return spark.read.parquet(f"{self.path}/codes").withColumn("list_id", F.col("list_id").cast("long"))

    def codebooks(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/codebooks")


def _points(vectors: np.ndarray, metric: str) -> np.ndarray:
    out = vectors.astype(np.float64)
    if metric == "cosine":
        length = np.sqrt(np.einsum("ij,ij->i", out, out))
        out /= np.where(length > 0, length, 1)[:, None]
    return out


def _parts(points: np.ndarray, n_sub: int) -> np.ndarray:
    """rows x parts x components; the last part is filled up with zeros."""
    width = -(-points.shape[1] // n_sub)
    filled = np.zeros((len(points), n_sub * width))
    filled[:, : points.shape[1]] = points
    return filled.reshape(len(points), n_sub, width)


def nearest_words(parts: np.ndarray, books: np.ndarray) -> np.ndarray:
    """rows x parts: number of the nearest word (the first of equals)."""
    out = np.empty(parts.shape[:2], np.uint8)
    step = max(1, _CELLS // (books.shape[1] * books.shape[2]))
    for a in range(0, len(parts), step):
        for s in range(parts.shape[1]):
            gap = parts[a : a + step, s, None, :] - books[s][None]
            out[a : a + step, s] = np.einsum("rwc,rwc->rw", gap, gap).argmin(1)
    return out


def _matrix(rows: pa.Table, column: str, dim: int) -> np.ndarray:
    values = rows[column].combine_chunks()
    return np.asarray(values.flatten().to_numpy(zero_copy_only=False), np.float32).reshape(-1, dim)


def _centroids(ann: AnnIndex, spark: SparkSession) -> tuple[np.ndarray, np.ndarray]:
    rows = ann.centroids(spark).orderBy("list_id").toArrow()
    return rows["list_id"].to_numpy(), _points(_matrix(rows, "centroid", ann.dim), ann.metric)


def _residuals(batch: pa.RecordBatch, vector_col: str, lists: np.ndarray, centers: np.ndarray, ann: AnnIndex) -> np.ndarray:
    _, vectors = float_matrix(batch.column(vector_col).cast(pa.list_(pa.float32())), ann.dim)
    own = np.searchsorted(lists, batch.column("list_id").to_numpy(zero_copy_only=False))
    return _points(vectors, ann.metric) - centers[own]


def train_codebooks(ann: AnnIndex, spark: SparkSession, n_sub: int, n_words: int = MAX_WORDS, rounds: int = 8, training_rows: int | None = None) -> np.ndarray:
    """parts x words x components, by rounds of k-means for all parts at once.

    Trained on all rows, or on about ``training_rows``, chosen by hash of the key, when the
    caller says so. A round is one pass; sums per word are added up before anything reaches the driver, which
    holds the codebooks alone: ``n_words`` times a vector.
    """
    ship_package(spark)
    rows = ann.rows(spark).select(ann.key, "list_id", ann.vector_col)
    n = rows.count()
    if training_rows is not None and training_rows < n:
        rows = rows.where(F.pmod(F.xxhash64(F.col(ann.key)), F.lit(1 << 20)) < F.lit(int(training_rows / n * (1 << 20)) + 1))
    lists, centers = _centroids(ann, spark)
    shared = spark.sparkContext.broadcast((lists, centers))
    start = rows.orderBy(F.xxhash64(ann.key), ann.key).limit(n_words).toArrow()  # at most 256 rows
    if not start.num_rows:
        return np.zeros((n_sub, 1, -(-ann.dim // n_sub)))
    first = _points(_matrix(start, ann.vector_col, ann.dim), ann.metric) - centers[np.searchsorted(lists, start["list_id"].to_numpy())]
    books = np.ascontiguousarray(_parts(first, n_sub).transpose(1, 0, 2))
    for _ in range(rounds):
        current = books

        def sums(batches, current=current):
            lists, centers = shared.value
            total, count = np.zeros(current.shape), np.zeros(current.shape[:2])
            for batch in batches:
                parts = _parts(_residuals(batch, ann.vector_col, lists, centers, ann), n_sub)
                words = nearest_words(parts, current)
                for s in range(n_sub):
                    np.add.at(total[s], words[:, s], parts[:, s])
                    np.add.at(count[s], words[:, s], 1)
            s, w = np.nonzero(count)
            held = np.concatenate([count[s, w][:, None], total[s, w]], 1)
            cell = np.arange(held.size) % held.shape[1] - 1
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(s, held.shape[1])), pa.array(np.repeat(w, held.shape[1])), pa.array(cell), pa.array(held.ravel())], ["s", "w", "j", "v"])

        found = rows.mapInArrow(sums, "s long, w long, j long, v double").groupBy("s", "w", "j").agg(F.sum("v").alias("v")).toArrow()
        grid = np.zeros((*books.shape[:2], books.shape[2] + 1))
        grid[found["s"].to_numpy(), found["w"].to_numpy(), found["j"].to_numpy() + 1] = found["v"].to_numpy()
        books = np.where(grid[..., :1] > 0, grid[..., 1:] / np.maximum(1, grid[..., :1]), books)
    return books


def _books(codebooks: DataFrame, n_sub: int) -> np.ndarray:
    rows = codebooks.orderBy("sub", "code").toArrow()
    n = rows.num_rows // n_sub
    words = np.array(rows["word"].to_pylist(), np.float64)
    if n * n_sub != rows.num_rows or not 1 <= n <= MAX_WORDS:
        raise ValueError(f"{rows.num_rows} words for {n_sub} parts: all parts need the same number, at most {MAX_WORDS}")
    return words.reshape(n_sub, n, -1)


def build_pq(index: DataFrame, dim: int, n_sub: int = 16, metric: str = "cosine", codebooks: DataFrame | None = None, training_rows: int | None = None, **lists) -> PqIndex:
    """An inverted-list index with codes of ``n_sub`` bytes a row.

    ``codebooks(sub, code, word)`` are taken as given, with codes from 0 on; otherwise they are
    trained, like the lists, on all rows, or on about ``training_rows`` when the caller says so.
    ``lists`` are options of ``build_ann``. Every valid row has a code.
    """
    if metric not in ("cosine", "l2"):
        raise ValueError(f"metric must be cosine or l2, got {metric!r}")
    if not 1 <= n_sub <= dim:
        raise ValueError(f"n_sub must be from 1 to {dim}, got {n_sub}")
    spark = index.sparkSession
    ann = build_ann(index, dim, metric=metric, training_rows=training_rows, **lists)
    path = f"{ann.path}/pq"
    books = train_codebooks(ann, spark, n_sub, training_rows=training_rows) if codebooks is None else _books(codebooks, n_sub)
    words = [(s, w, books[s, w].tolist()) for s in range(n_sub) for w in range(books.shape[1])]
    spark.createDataFrame(words, "sub int, code int, word array<double>").write.parquet(f"{path}/codebooks")
    shared = spark.sparkContext.broadcast((*_centroids(ann, spark), books))

    def encode(batches):
        lists, centers, books = shared.value
        for batch in batches:
            if batch.num_rows:
                codes = nearest_words(_parts(_residuals(batch, ann.vector_col, lists, centers, ann), n_sub), books)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([c.tobytes() for c in codes], pa.binary())], ["id", "list_id", "code"])

    rows = ann.rows(spark).select(F.col(ann.key).cast("long").alias("id"), F.col("list_id").cast("long"), ann.vector_col)
    rows.mapInArrow(encode, "id long, list_id long, code binary").write.partitionBy("list_id").parquet(f"{path}/codes")
    return PqIndex(ann, path, n_sub)


def search_pq(pq: PqIndex, queries: DataFrame, k: int = DEFAULT_K, nprobe: int = 8, shortlist: int = 200, columns: tuple[str, ...] | list[str] = (), query_vector_col: str = "qv", cell_rows: int = CELL_ROWS, cell_queries: int = CELL_QUERIES) -> DataFrame:
    """query_id, rank, id, score and ``columns`` of the ``k`` best rows for each question, found
    among the ``shortlist`` nearest by code in its ``nprobe`` nearest lists.

    Codes are compared at 6 decimals, then by id, so a result does not depend on how lists are
    cut. Questions without a usable vector have no row. With all lists probed and a shortlist
    of all rows the result is exact.

    A group of questions meets the codes of all lists in one task, of up to ``cell_rows`` rows, so that
    what leaves it is one short list per question. The rows of the short lists are scored where a group of
    questions meets the vectors of a part of the rows, each sent there once.
    """
    spark, ann = queries.sparkSession, pq.ann
    ship_package(spark)
    cores = spark.sparkContext.defaultParallelism
    near = similarity_search(ann.centroids(spark), queries, k=min(nprobe, ann.n_lists), metric=ann.metric, key="list_id", vector_col="centroid", query_vector_col=query_vector_col, dim=ann.dim)
    asked = queries.select(F.col("query_id").cast("long"), F.col(query_vector_col).cast("array<float>").alias("qv"))
    probed = near.groupBy("query_id").agg(F.collect_list(F.col("id").cast("long")).alias("lists"))
    probes = materialize(asked.join(probed, "query_id"), "probes")
    n_asked, n_probes = probes.agg(F.count("*"), F.sum(F.size("lists"))).first()
    n_codes = pq.codes(spark).count()
    n_parts = max(1, -(-n_codes // cell_rows))
    n_groups = max(-(-(n_probes or 0) // cell_queries), -(-2 * cores // n_parts))
    # Cells are dealt to tasks by number: codes are short, and their bytes say little about the time they take.
    n_tasks = min(MAX_TASKS, n_parts * n_groups)

    def cut(column: str, n: int):
        return F.pmod(F.xxhash64(column), F.lit(n)).cast("int")

    def each(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = probes.select(cut("query_id", n_groups).alias("grp"), each(n_parts).alias("part"), "query_id", "qv", "lists")
    right = pq.codes(spark).select(each(n_groups).alias("grp"), cut("id", n_parts).alias("part"), "list_id", "id", "code")
    shared = spark.sparkContext.broadcast((*_centroids(ann, spark), _books(pq.codebooks(spark), pq.n_sub)))
    cell, n_sub, metric, dim = ["grp", "part"], pq.n_sub, ann.metric, ann.dim

    def nearest(left: pa.Table, right: pa.Table) -> pa.Table:
        return _short_lists(left, right, *shared.value, n_sub, metric, shortlist)

    left, right = left.repartition(n_tasks, *cell), right.repartition(n_tasks, *cell)
    short = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(nearest, "query_id long, id long, list_id long, d double")
    if n_parts > 1:
        order = Window.partitionBy("query_id").orderBy("d", "id")
        short = short.withColumn("place", F.row_number().over(order)).where(F.col("place") <= shortlist)
    # Vectors go to each group of questions, so a group is as large as its pairs allow.
    n_blocks = max(1, -(-n_codes // CELL_VECTORS))
    n_sets = max(1, -(-n_asked * shortlist // (n_blocks * CELL_PAIRS)), -(-2 * cores // n_blocks))
    n_tasks = min(MAX_TASKS, n_blocks * n_sets)
    held = ann.rows(spark).select(F.col(ann.key).cast("long").alias("id"), F.col("list_id").cast("long"), F.col(ann.vector_col).cast("array<float>").alias("vector"), *columns)
    left = short.select(cut("query_id", n_sets).alias("grp"), cut("id", n_blocks).alias("part"), "query_id", "id", "list_id").repartition(n_tasks, *cell)
    # Questions stand among the rows, without a list.
    unlisted = [F.lit(None).cast(held.schema[c].dataType).alias(c) for c in ("list_id", *columns)]
    vectors = probes.select(cut("query_id", n_sets).alias("grp"), each(n_blocks).alias("part"), F.col("query_id").alias("id"), F.col("qv").alias("vector"), *unlisted)
    right = held.select(each(n_sets).alias("grp"), cut("id", n_blocks).alias("part"), *held.columns).unionByName(vectors).repartition(n_tasks, *cell)
    names = list(columns)
    kind = StructType([StructField("query_id", LongType()), StructField("id", LongType()), StructField("score", DoubleType()), *[held.schema[c] for c in names]])

    def exact(left: pa.Table, right: pa.Table) -> pa.Table:
        return _scored(left, right, names, dim, metric, k)

    scored = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(exact, kind)
    best = F.asc("score") if metric == "l2" else F.desc("score")
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(best, "id"))).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", "score", *columns)


def _first(order: np.ndarray, group: np.ndarray, most: int) -> np.ndarray:
    """Of ``order``, which sorts by ``group`` first, the first ``most`` of each group."""
    sorted_group = group[order]
    return order[np.arange(len(order)) - np.searchsorted(sorted_group, sorted_group) < most]


def _short_lists(left: pa.Table, right: pa.Table, lists: np.ndarray, centers: np.ndarray, books: np.ndarray, n_sub: int, metric: str, shortlist: int) -> pa.Table:
    """query_id, id, list_id and distance by code of the ``shortlist`` nearest rows of ``right`` for each
    question of ``left`` in the lists that it probes.

    A code stands for a vector, so distances are products of blocks in single precision first; whatever
    lies within their error of a question's bar is measured again part by part, in double precision.
    """
    out = pa.schema([("query_id", pa.int64()), ("id", pa.int64()), ("list_id", pa.int64()), ("d", pa.float64())])
    if not left.num_rows or not right.num_rows:
        return out.empty_table()
    vectors = _points(_matrix(left, "qv", centers.shape[1]), metric)
    asked, probed = left["query_id"].to_numpy(), left["lists"].combine_chunks()
    # A list that a question names twice counts twice.
    named = np.stack([np.repeat(np.arange(len(asked)), np.diff(probed.offsets.to_numpy())), probed.flatten().to_numpy()], 1)
    named, times = np.unique(named, axis=0, return_counts=True)
    at, ids = right["list_id"].to_numpy(), right["id"].to_numpy()
    codes = right["code"].combine_chunks().cast(pa.binary(n_sub))
    codes = np.frombuffer(codes.buffers()[1], np.uint8, n_sub * len(codes), n_sub * codes.offset).reshape(-1, n_sub)
    by_list = np.argsort(at, kind="stable")
    present, starts = np.unique(at[by_list], return_index=True)
    members = dict(zip(present.tolist(), np.split(by_list, starts[1:]), strict=True))
    part = np.arange(n_sub)

    def residuals(of: np.ndarray, name: int) -> np.ndarray:
        return _parts(vectors[of] - centers[np.searchsorted(lists, name)], n_sub)

    def decoded(of: np.ndarray) -> np.ndarray:
        return books[part, codes[of]]

    def products(gap: np.ndarray, words: np.ndarray):
        """What orders the rows of a question (more is nearer), what a distance is taken off for that, and its error."""
        one, two = gap.reshape(len(gap), -1), words.reshape(len(words), -1)
        long, size = np.einsum("ij,ij->i", one, one), np.einsum("ij,ij->i", two, two)
        kind, error = slack_of(one, two, np.sqrt(long), float(np.sqrt(size.max())))
        close = one.astype(kind) @ two.astype(kind).T
        close *= 2
        close -= size.astype(kind)[None, :]
        return close, long, error

    step = max(1, _CELLS // _BLOCK_ROWS)
    # The bar: the last place of the short list within the nearest list that has so many rows.
    bar, gap = np.full(len(asked), np.inf), np.full(len(asked), np.inf)
    nearest = np.full(len(asked), -1, np.int64)
    mine = {name: named[named[:, 1] == name, 0] for name in present.tolist()}
    for name, of in mine.items():
        if len(members[name]) >= shortlist:
            away = vectors[of] - centers[np.searchsorted(lists, name)]
            away = np.einsum("ij,ij->i", away, away)
            closer = away < gap[of]
            gap[of[closer]], nearest[of[closer]] = away[closer], name
    for name in present.tolist():
        of = np.flatnonzero(nearest == name)
        # Any rows of the list give a bar that holds; more of them give a lower one.
        words = decoded(members[name][: max(shortlist, _BLOCK_ROWS)])
        for a in range(0, len(of), step):
            some = of[a : a + step]
            close, long, error = products(residuals(some, name), words)
            last = close.shape[1] - shortlist
            bar[some] = long - np.partition(close, last, axis=1)[:, last] + error
    found, n_held, most = [], 0, max(_HELD, 2 * shortlist * len(asked))
    names, group = np.unique(asked, return_inverse=True)

    def squeezed() -> list[tuple[np.ndarray, ...]]:
        """What is held, cut to short lists; their last places are the new bar."""
        who, row, name, d = (np.concatenate(c) for c in zip(*found, strict=True))
        order = np.lexsort((ids[row], d, who))
        kept = _first(order, who, shortlist)
        ends = np.flatnonzero(np.diff(who[kept], append=-1))
        full = ends[np.diff(ends, prepend=-1) == shortlist]
        last = np.full(len(names), np.inf)
        last[who[kept[full]]] = d[kept[full]] + 10.0**-SCORE_DIGITS
        np.minimum(bar, last[group], out=bar)
        return [(who[kept], row[kept], name[kept], d[kept])]

    count = dict(zip(map(tuple, named.tolist()), times.tolist(), strict=True)) if (times > 1).any() else None
    for name, of in mine.items():
        for b in range(0, len(members[name]), _BLOCK_ROWS):
            rows = members[name][b : b + _BLOCK_ROWS]
            words = decoded(rows)
            for a in range(0, len(of), step):
                some = of[a : a + step]
                parts = residuals(some, name)
                close, long, error = products(parts, words)
                cut = long - bar[some] - error
                cut = np.where(np.isfinite(cut), cut, -np.inf).astype(close.dtype)
                q, r = np.divmod(np.flatnonzero(close >= np.nextafter(cut, close.dtype.type(-np.inf))[:, None]), close.shape[1])
                for c in range(0, len(q), _CELLS // max(1, vectors.shape[1])):
                    qc, rc = q[c : c + _CELLS // max(1, vectors.shape[1])], r[c : c + _CELLS // max(1, vectors.shape[1])]
                    far = parts[qc] - words[rc]
                    # Summed part after part, in the order of the parts.
                    d = np.round(np.ascontiguousarray(np.einsum("psc,psc->ps", far, far).T).sum(0), SCORE_DIGITS)
                    who, row = some[qc], rows[rc]
                    if count is not None:
                        again = np.array([count[w, name] for w in who.tolist()], np.int64)
                        who, row, d = (np.repeat(x, again) for x in (who, row, d))
                    found.append((group[who], row, np.full(len(who), name, np.int64), d))
                    n_held += len(who)
                if n_held > most:
                    found = squeezed()
                    n_held = len(found[0][0])
    if not found:
        return out.empty_table()
    ((who, row, name, d),) = squeezed()
    return pa.table([pa.array(x) for x in (names[who], ids[row], name, d)], schema=out)


def _matches(wanted: np.ndarray, given: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all pairs of equal values."""
    order = np.argsort(given, kind="stable")
    first, last = np.searchsorted(given[order], wanted), np.searchsorted(given[order], wanted, "right")
    n = last - first
    one = np.repeat(np.arange(len(wanted)), n)
    return one, order[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)]


def _scored(left: pa.Table, right: pa.Table, columns: list[str], dim: int, metric: str, k: int) -> pa.Table:
    """query_id, id, score and ``columns`` of the k best of the pairs in ``left``; ``right`` has the vectors
    of the rows, and without a list those of the questions."""
    head = pa.schema([("query_id", pa.int64()), ("id", pa.int64()), ("score", pa.float64())])
    empty = pa.schema([*head, *[right.schema.field(c) for c in columns]]).empty_table()
    listed = right["list_id"].is_valid()
    right, asked = right.filter(listed), right.filter(pc.invert(listed))
    if not left.num_rows or not right.num_rows or not asked.num_rows:
        return empty
    questions, vectors = float_matrix(asked["vector"].combine_chunks(), dim)
    usable, rows = float_matrix(right["vector"].combine_chunks(), dim)
    at, ids, names = (left[c].to_numpy() for c in ("query_id", "id", "list_id"))
    p, q = _matches(at, asked["id"].to_numpy()[questions])
    more, r = _matches(ids[p], right["id"].to_numpy()[usable])
    p, q = p[more], q[more]
    same = right["list_id"].to_numpy()[usable][r] == names[p]
    p, q, r = p[same], q[same], r[same]
    score, step = np.empty(len(p)), max(1, _CELLS // dim)
    for a in range(0, len(p), step):
        score[a : a + step] = pair_scores(vectors[q[a : a + step]], rows[r[a : a + step]], metric)
    order = np.lexsort((ids[p], score if metric == "l2" else -score, at[p]))
    kept = _first(order, at[p], k)
    payload = right.select(columns).take(pa.array(usable[r[kept]]))
    return pa.table([pa.array(at[p[kept]]), pa.array(ids[p[kept]]), pa.array(score[kept]), *payload.columns], schema=empty.schema)

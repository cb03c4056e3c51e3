"""Ranked lexical search: best-first over document intervals, bounded by range-maximum tables.

Documents are read once and leave the terms that the items ask for, with their counts. Rows are
then searched shard by shard, where a shard is a run of rows of bounded size in the order of
doc_id. A shard has, for every term, the list of its documents with their impacts (what the term
adds to a score), and over the lists a sparse table that names the largest impact of any range of
a list in two look-ups.

An item starts with one interval, the whole shard. The sum over its terms of the largest impact
within an interval bounds every score in it. The intervals with the highest bounds are taken
first, several at a time; each is split at the document that holds its largest impact, that
document is scored, and the two sides come back with bounds of their own. An interval ends when
its bound shows that it holds none of the best. Every document that could be among the best is
scored, and nothing is capped.

Items come in blocks of bounded size, one after the other, so there may be any number of them.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from shelfmark.llm.op10_fm_index import phrase_words
from shelfmark.llm.words import documents, per_batch, store
from shelfmark.session import ship_package

TOP = 20
#: Postings of a shard (one document may exceed it alone).
SHARD_POSTINGS = 1_000_000
#: Bytes of item texts that are searched at once.
BLOCK_BYTES = 4 << 20
#: Intervals split at once, and entries of the (intervals x terms) arrays for it.
WIDTH, CELLS = 64, 1 << 18


class Items:
    """Items of a block as term numbers with counts."""

    def __init__(self, rows: list[tuple]) -> None:
        self.ids = [item for item, _ in rows]
        self.terms: dict[bytes, int] = {}
        self.counts = []
        for _, text in rows:
            held = Counter(phrase_words(text))
            numbers = [self.terms.setdefault(t, len(self.terms)) for t in held]
            self.counts.append((np.array(numbers, np.int64), np.array(list(held.values()), np.int64)))


def term_counts(docs: DataFrame, items: Items) -> DataFrame:
    """doc_id, n (terms with repeats), terms and tfs (terms of the items and their counts) of
    every row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(items.terms)

    def count(batch):
        numbers = shared.value
        n, ends, terms, tfs = [], [0], [], []
        for text in batch.column("text").to_pylist():
            words = phrase_words(text)
            n.append(len(words))
            found = np.fromiter((x for x in map(numbers.get, words) if x is not None), np.int32)
            held, times = np.unique(found, return_counts=True)
            terms.append(held)
            tfs.append(times.astype(np.int32))
            ends.append(ends[-1] + len(held))
        ends = pa.array(ends, pa.int32())
        lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x))) for x in (terms, tfs)]
        return {"doc_id": batch.column("doc_id"), "n": n, "terms": lists[0], "tfs": lists[1]}

    return per_batch(docs.select(F.col("doc_id").cast("long"), "text"), count, "doc_id long, n long, terms array<int>, tfs array<int>")


class Corpus:
    """Weights of terms, and the length of the usual document."""

    def __init__(self, n_docs: int, length: int, frequencies: np.ndarray) -> None:
        self.n_docs, self.length = n_docs, length
        self.weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in frequencies.tolist()], np.int64)

    def impacts(self, terms: np.ndarray, tfs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """What each posting adds to a score, given the length of its document."""
        lengths = lengths.astype(np.int64)
        if len(lengths) and int(lengths.max()) * self.n_docs >= 1 << 58:
            share = np.array([25 * n * self.n_docs // self.length for n in lengths.tolist()], np.int64)
        else:
            share = 25 * lengths * self.n_docs // self.length
        tfs = tfs.astype(np.int64)
        return self.weights[terms] * (1_000_000_000 * tfs // (1000 * tfs + 12 * (75 + share)))


class Shard:
    """Posting lists of a run of documents, one after the other, under one sparse table."""

    def __init__(self, doc_ids: np.ndarray, docs: np.ndarray, terms: np.ndarray, impacts: np.ndarray) -> None:
        """``docs`` are places in ``doc_ids``, which ascends."""
        self.doc_ids, self.n = doc_ids, len(doc_ids)
        keys = terms.astype(np.int64) * self.n + docs
        order = np.argsort(keys, kind="stable")
        self.keys, self.impacts = keys[order], impacts[order]
        self.docs = docs[order]
        self.largest = self._sparse_table(np.diff(np.flatnonzero(np.concatenate([[True], np.diff(terms[order]) != 0, [True]]))))

    def _sparse_table(self, lengths: np.ndarray) -> np.ndarray:
        """Row j: place of the first largest impact among 2**j postings from each place on."""
        rows = int(lengths.max(initial=1)).bit_length()
        table = np.empty((rows, len(self.keys)), np.int32)
        table[0] = np.arange(len(self.keys))
        for j in range(1, rows):
            half, last = 1 << (j - 1), table[j - 1]
            left, right = last[:-half], last[half:]
            table[j, -half:] = last[-half:]
            table[j, :-half] = np.where(self.impacts[right] > self.impacts[left], right, left)
        return table

    def place_of_largest(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Place of the first largest impact of each range of one list; any place if empty."""
        some = begin < end
        begin = np.where(some, begin, 0)
        end = np.where(some, end, 1)
        row = np.frexp((end - begin).astype(np.float64))[1] - 1
        a, b = self.largest[row, begin], self.largest[row, end - (1 << row)]
        return np.where(self.impacts[b] > self.impacts[a], b, a)

    def search(self, terms: np.ndarray, times: np.ndarray, best: Best) -> int:
        """Put into ``best`` all documents that belong there; the number of documents scored."""
        base = terms * self.n
        some = np.searchsorted(self.keys, base) < np.searchsorted(self.keys, base + self.n)
        base, times = base[some], times[some]
        if not len(base):
            return 0
        width = max(1, min(WIDTH, CELLS // len(base)))
        low, high = np.zeros(1, np.int64), np.full(1, self.n)
        bound = self._bounds(*self._ranges(base, low, high), times)[0]
        scored = 0
        while True:
            floor, last = best.threshold()
            alive = (bound > floor) | ((bound == floor) & (self.doc_ids[low] < last))
            low, high, bound = low[alive], high[alive], bound[alive]
            if not len(low):
                return scored
            take = np.argpartition(-bound, width)[:width] if len(bound) > width else np.arange(len(bound))
            rest = np.ones(len(bound), bool)
            rest[take] = False
            begin, end = self._ranges(base, low[take], high[take])
            _, middle = self._bounds(begin, end, times)
            at = np.searchsorted(self.keys, base + middle[:, None])
            hit = (at < end) & (self.docs[np.minimum(at, len(self.docs) - 1)] == middle[:, None])
            score = np.where(hit, self.impacts[np.minimum(at, len(self.docs) - 1)], 0) @ times
            best.add(score, self.doc_ids[middle])
            scored += len(middle)
            low = np.concatenate([low[rest], low[take], middle + 1])
            high = np.concatenate([high[rest], middle, high[take]])
            sides = [self._bounds(begin, at, times)[0], self._bounds(at + hit, end, times)[0]]
            bound = np.concatenate([bound[rest], *sides])
            some = low < high
            low, high, bound = low[some], high[some], bound[some]

    def _ranges(self, base: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of the lists (intervals x terms) that lie within document intervals."""
        return np.searchsorted(self.keys, base + low[:, None]), np.searchsorted(self.keys, base + high[:, None])

    def _bounds(self, begin: np.ndarray, end: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each interval the bound of its scores, and the document with its largest impact."""
        at = self.place_of_largest(begin, end)
        most = np.where(begin < end, self.impacts[at], 0) * times
        return most.sum(1), self.docs[at[np.arange(len(at)), most.argmax(1)]].astype(np.int64)


class Best:
    """The ``k`` best documents of an item so far: highest score, then smallest id."""

    def __init__(self, k: int) -> None:
        self.k, self.scores, self.doc_ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def threshold(self) -> tuple[int, int]:
        """What the next one must beat: a score, or the same score with a smaller id."""
        if len(self.scores) < self.k:
            return 0, -(1 << 63)
        return int(self.scores[-1]), int(self.doc_ids[-1])

    def add(self, scores: np.ndarray, doc_ids: np.ndarray) -> None:
        some = scores > 0
        scores, doc_ids = np.concatenate([self.scores, scores[some]]), np.concatenate([self.doc_ids, doc_ids[some]])
        order = np.lexsort([doc_ids, -scores])[: self.k]
        self.scores, self.doc_ids = scores[order], doc_ids[order]


#: Stands for a null doc_id within a shard: after all others.
NULL_ID = (1 << 63) - 1


def _search(counted: DataFrame, items: Items, corpus: Corpus, top: int, kind: StructType) -> DataFrame:
    """The best documents of each partition for every item: item, doc_id, score."""
    spark = counted.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast((items, corpus))
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in kind])

    def search(batches):
        items, corpus = shared.value
        best = [Best(top) for _ in items.ids]
        held, size = [], 0

        def run():
            ids, lengths, ends, terms, tfs = (np.concatenate([h[i] for h in held]) for i in range(5))
            order = np.argsort(ids, kind="stable")
            place = np.empty(len(ids), np.int64)
            place[order] = np.arange(len(ids))
            owner = np.repeat(np.arange(len(ids)), ends)
            shard = Shard(ids[order], place[owner], terms, corpus.impacts(terms, tfs, lengths[owner]))
            for (numbers, times), found in zip(items.counts, best, strict=True):
                shard.search(numbers, times, found)

        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("doc_id").fill_null(NULL_ID).to_numpy(zero_copy_only=False)
            lengths = batch.column("n").to_numpy(zero_copy_only=False)
            terms, tfs = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("terms", "tfs"))
            sizes = batch.column("terms").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            offsets, first = np.concatenate([[0], np.cumsum(sizes)]), 0
            while first < len(ids):
                last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + SHARD_POSTINGS - size, "right")) - 1)
                a, b = offsets[first], offsets[last]
                held.append((ids[first:last], lengths[first:last], sizes[first:last], terms[a:b], tfs[a:b]))
                size, first = size + int(b - a), last
                if size >= SHARD_POSTINGS or first < len(ids):
                    run()
                    held, size = [], 0
        if held:
            run()
        for item, found in zip(items.ids, best, strict=True):
            if len(found.scores):
                ids = pa.array(found.doc_ids, pa.int64(), mask=found.doc_ids == NULL_ID)
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(ids), arrow.field(0).type), ids, pa.array(found.scores)], schema=arrow)

    return counted.mapInArrow(search, kind)


def search_documents(docs: DataFrame, items: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` rows of ``docs`` (doc_id, text) with the
    highest scores above 0 for every row of ``items`` (item_id, text); equal scores by doc_id.

    Null and empty texts have no term: such a document is never found and counts nowhere, and
    such an item finds nothing. Repeated documents are found each. Items that repeat both id
    and text are one; several texts under one id are ranked each on its own. A null doc_id
    comes after all others. Very long texts count in full. Empty tables give no row; columns
    other than these are not looked at.
    """
    spark = docs.sparkSession
    item_type = items.schema["item_id"].dataType
    wanted = items.select("item_id", "text").where("text IS NOT NULL").distinct()
    total = wanted.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n_blocks = max(1, -(-int(total) // block_bytes))
    parts = []
    for block in range(n_blocks):
        # A block is bounded by its bytes, up to the unevenness of a hash.
        chosen = wanted.where(F.pmod(F.xxhash64("text"), F.lit(n_blocks)) == block)
        rows = sorted((tuple(r) for r in chosen.collect()), key=repr)
        parts.append(_search_block(docs, rows, top))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select(F.col("item_id").cast(item_type).alias("item_id"), "rank", "doc_id", "score")


def _search_block(docs: DataFrame, rows: list[tuple], top: int) -> DataFrame:
    """``search_documents`` for the items of one block, stored: nothing of it stays behind."""
    spark = docs.sparkSession
    items = Items([(i, text) for i, (_, text) in enumerate(rows)])
    counted = store(term_counts(docs, items), "term-counts")
    n_docs, length = counted.where("n > 0").agg(F.count("*"), F.sum("n")).first()
    frequencies = np.zeros(len(items.terms), np.int64)
    for r in counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # at most the block's terms
        frequencies[r.t] = r["count"]
    kind = StructType([StructField("item", IntegerType()), StructField("doc_id", LongType()), StructField("score", LongType())])
    found = _search(counted.where(F.size("terms") > 0), items, Corpus(n_docs, length or 0, frequencies), top, kind)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    ids = pa.table({"item": pa.array(range(len(rows)), pa.int32()), "item_id": pa.array([None if i is None else str(i) for i, _ in rows], pa.string())})
    named = spark.createDataFrame(ids) if len(rows) else spark.createDataFrame([], "item int, item_id string")
    return store(ranked.join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score"), "found")


def op13_rmq_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


#: All scores of all documents that hold a term, then the best of each item.
SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), postings AS (
  SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL
), lengths AS (
  SELECT doc_id, sum(tf)::BIGINT AS n FROM postings GROUP BY doc_id
), totals AS (
  SELECT count(*) AS n_docs, sum(n)::BIGINT AS total FROM lengths
), lists AS (
  SELECT term, count(*) AS df FROM postings GROUP BY term
), asked AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), scored AS (
  SELECT item_id, doc_id, sum(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)::DOUBLE))::BIGINT
    * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // total))))::BIGINT AS score
  FROM asked JOIN postings USING (term) JOIN lists USING (term) JOIN lengths USING (doc_id), totals
  GROUP BY item_id, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY rank <= 20
"""

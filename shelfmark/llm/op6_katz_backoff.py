"""Language-model scoring: a Katz backoff model of word pairs over the whole corpus.

Tokens are the lower-cased words of a text and one end. A pair seen in training has its
Good-Turing discounted relative frequency; any other has the history's backoff weight times
the word's own probability, which again is discounted or, for a word never seen, what
discounting has left over. Weights are normalised exactly: for every history the probabilities
of all words and the unknown word add up to 1.

    P(w | h) = d(c(hw)) c(hw) / T(h)  if c(hw) > 0,   a(h) P(w)  otherwise
    a(h) = (1 - sum of the former over w) / (1 - sum of P(w) over the same w)
    P(w) = d(c(w)) c(w) / N           if c(w) > 0,    P(unknown)  otherwise

T(h) is the history's count, or one more where no pair of it is discounted. Nothing grows on
the driver: documents are tokenised into batches of bounded size, and each batch asks for the
counts of its distinct words and pairs. Sorted 64-bit keys, packed, go to buckets by key range;
a bucket adds up all batches, keeps its part of the model table, and answers in the order asked.
A word or pair is one entry of a batch however often it occurs, so frequent ones are no burden.
Words are known by 64-bit hashes (two of ten million share one with odds of 3 in a million).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.words import LOWER_AZ, arrow_schema, documents, mix, segment_sums, store
from shelfmark.session import scratch_path, ship_package

#: Tokens of a batch at most (a longer text is a batch of its own).
BATCH_TOKENS = 2_000_000
#: Tokens of the corpus per bucket of keys.
BUCKET_TOKENS = 1_000_000
#: Counts up to this one are discounted.
GOOD_TURING_MAX = 5

_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Keys of the end of a text and of its beginning, which is a history only. No word holds
#: the white space that they are named by.
END, BEGIN = (np.uint64(xxhash.xxh3_64_intdigest(x)) for x in (b"\n", b"\r"))

BATCHES = "batch long, doc_ids array<long>, lengths array<int>, learn array<boolean>, tokens binary, words binary"
PACKETS = "bucket int, batch long, keys binary, n int, counts binary"
SUMS = "bucket int, batch long, keys binary, n int, counts binary, mass binary, lower binary"
REPLIES = "batch long, bucket int, n int, payload binary, owned binary"


# ------------------------------------------------------------------ packing


def pack(values: np.ndarray) -> bytes:
    """Values by byte planes, compressed: planes of small numbers vanish."""
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.dtype.itemsize)
    return zstandard.ZstdCompressor(level=1).compress(raw.T.tobytes())


def unpack(raw: bytes, kind, n: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    return np.ascontiguousarray(planes.reshape(-1, n).T).view(kind).ravel() if n else np.zeros(0, kind)


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as differences."""
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(raw: bytes, n: int) -> np.ndarray:
    return np.cumsum(unpack(raw, np.uint64, n), dtype=np.uint64)


def bucket_edges(keys: np.ndarray, n_buckets: int) -> np.ndarray:
    """Where each bucket's slice of the sorted keys begins, and the end."""
    bounds = np.array([(b << 64) // n_buckets for b in range(1, n_buckets)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, bounds), [len(keys)]])


# ------------------------------------------------------------------ the model


def discounts(n_with: np.ndarray) -> np.ndarray:
    """Good-Turing factors of the counts 0 to GOOD_TURING_MAX (0 is not used), from the number
    of n-grams with each count, n_with[c].

    Where copies make those numbers so uneven that a factor leaves (0, 1), they are smoothed
    by a line through their logarithms first; where that does not help either, or a number is
    missing, half a count is taken off each.
    """
    k = GOOD_TURING_MAX
    counts = np.arange(1, k + 1)
    n = n_with[: k + 2].astype(np.float64)
    if (n[1:] > 0).all():
        slope, level = np.polyfit(np.log(np.arange(1, k + 2)), np.log(n[1:]), 1)
        line = np.exp(level) * np.arange(1, k + 2) ** slope
        for m in (n[1:], line):
            tail = (k + 1) * m[k] / m[0]
            factors = ((counts + 1) * m[1:] / (counts * m[:-1]) - tail) / (1 - tail) if tail < 1 else np.zeros(k)
            if ((factors > 0) & (factors < 1)).all():
                return np.concatenate([[1.0], factors])
    return np.concatenate([[1.0], 1 - 0.5 / counts])


class Model:
    """What all tasks share: totals, and discounts of words and pairs."""

    def __init__(self, tokens: int, vocabulary: int, word_counts: np.ndarray, pair_counts: np.ndarray) -> None:
        self.tokens, self.vocabulary = tokens, vocabulary
        self.of_words, self.of_pairs = discounts(word_counts), discounts(pair_counts)
        few = np.arange(GOOD_TURING_MAX + 1)
        kept = tokens - float((word_counts[: GOOD_TURING_MAX + 1] * few * (1 - self.of_words)).sum())
        self.unknown = max(1 - kept / tokens, 1 / (tokens + 1)) if tokens else 1.0
        self.scale = (1 - self.unknown) / kept if tokens else 0.0

    @staticmethod
    def _discounted(counts: np.ndarray, factors: np.ndarray) -> np.ndarray:
        return counts * factors[np.where(counts <= GOOD_TURING_MAX, counts, 0)]

    def pair_mass(self, counts: np.ndarray) -> np.ndarray:
        return self._discounted(counts, self.of_pairs)

    def word(self, counts: np.ndarray) -> np.ndarray:
        """P(w) by count; the unknown word's where it is 0."""
        return np.where(counts > 0, self._discounted(counts, self.of_words) * self.scale, self.unknown)


def history_weight(counts: np.ndarray, mass: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(T(h), a(h)) from the history's count, the discounted counts of its pairs, and the sum
    of P(w) over them. A history that was never seen leaves everything to the word."""
    total = counts + (mass >= counts - 1e-9)
    return total, np.where(counts > 0, (1 - mass / total) / np.maximum(1e-300, 1 - lower), 1.0)


# ------------------------------------------------------------------ batches


def tokenised(docs: DataFrame, learn) -> DataFrame:
    """Rows of BATCHES: local token ids by falling frequency, and the key of each."""
    ship_package(docs.sparkSession)
    schema = arrow_schema(BATCHES)
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.coalesce(learn, F.lit(True)).alias("learn"))

    def cut(batches):
        part, number = TaskContext.get().partitionId(), 0
        ids, texts, learns, held = [], [], [], 0

        def row():
            seen: dict[bytes, int] = {}
            flat = np.concatenate([np.fromiter((seen.setdefault(w, len(seen)) for w in t), np.int64, len(t)) for t in texts])
            counts = np.bincount(flat, minlength=len(seen))
            order = np.argsort(-counts, kind="stable")
            rank = np.empty(len(order), np.uint32)
            rank[order] = np.arange(len(order), dtype=np.uint32)
            keys = np.fromiter(map(xxhash.xxh3_64_intdigest, seen), np.uint64, len(seen))[order]
            values = ((part << 32) + number, ids, [len(t) for t in texts], learns, pack(rank[flat]), keys.tobytes())
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema, strict=True)], schema=schema)

        for batch in batches:
            for doc_id, text, known in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER_AZ).split()
                words.append(b"\n")
                if held and held + len(words) > BATCH_TOKENS:
                    yield row()
                    number, ids, texts, learns, held = number + 1, [], [], [], 0
                ids.append(doc_id)
                texts.append(words)
                learns.append(known)
                held += len(words)
        if held:
            yield row()

    return rows.mapInArrow(cut, BATCHES)


class Batch:
    """Arrays of one row of BATCHES. ``word_keys`` and ``pair_keys`` are sorted and distinct;
    ``word_at`` and ``pair_at`` say which of them each token is. Beginnings are the history of
    first tokens and come last in ``history_keys``, after the words."""

    def __init__(self, table: pa.Table) -> None:
        row = table.to_pylist()[0]
        self.number, self.doc_ids = row["batch"], row["doc_ids"]
        self.lengths = np.array(row["lengths"], np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)])
        self.learn = np.repeat(np.array(row["learn"], bool), self.lengths)
        keys = np.frombuffer(row["words"], np.uint64)
        order = np.argsort(keys)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.word_keys = keys[order]
        self.word_at = place[unpack(row["tokens"], np.uint32, int(self.offsets[-1]))]
        n = len(keys)
        self.history_at = np.concatenate([[n], self.word_at[:-1]])
        self.history_at[self.offsets[:-1]] = n
        both = self.history_at * np.int64(n) + self.word_at
        pairs, at = np.unique(both, return_inverse=True)
        history, word = pairs // n, pairs % n
        hashed = mix(np.append(self.word_keys, BEGIN)[history] * _ODD + self.word_keys[word])
        order = np.argsort(hashed)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.pair_keys, self.pair_at = hashed[order], place[at]
        self.pair_history, self.pair_word = history[order], word[order]

    def history_keys(self) -> tuple[np.ndarray, np.ndarray]:
        """(sorted keys of the words and the beginning, index of each in word order)."""
        keys = np.append(self.word_keys, BEGIN)
        order = np.argsort(keys)
        return keys[order], order


def _one_by_one(batches, make, schema):
    for batch in batches:
        for i in range(batch.num_rows):
            rows = make(Batch(pa.Table.from_batches([batch.slice(i, 1)])))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)


#: Buckets of words are numbered from 0, those of pairs from here.
PAIRS = 1 << 24


def count_requests(batches: DataFrame, n_buckets: int) -> DataFrame:
    """Each batch's distinct words and pairs with their counts in training texts."""
    schema = arrow_schema(PACKETS)

    def ask(b: Batch):
        rows = []
        for first, keys, at in ((0, b.word_keys, b.word_at), (PAIRS, b.pair_keys, b.pair_at)):
            counts = np.bincount(at[b.learn], minlength=len(keys)).astype(np.uint32)
            edges = bucket_edges(keys, n_buckets).tolist()
            rows += [(first + i, b.number, pack_keys(keys[x:y]), y - x, pack(counts[x:y])) for i, (x, y) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if x < y]
        return rows

    return batches.mapInArrow(lambda it: _one_by_one(it, ask, schema), PACKETS)


def _merged(table: pa.Table):
    """(numbers of the batches, ends of their entries, distinct keys, index of each entry)."""
    table = table.sort_by("batch")
    sizes = table.column("n").to_pylist()
    keys = np.concatenate([unpack_keys(k.as_py(), n) for k, n in zip(table.column("keys"), sizes, strict=True)])
    distinct, at = np.unique(keys, return_inverse=True)
    return table, sizes, np.concatenate([[0], np.cumsum(sizes)]).tolist(), distinct, at


def _column(table: pa.Table, name: str, kind, sizes) -> np.ndarray:
    return np.concatenate([unpack(v.as_py(), kind, n) for v, n in zip(table.column(name), sizes, strict=True)])


def answer_counts(requests: DataFrame) -> DataFrame:
    """Per bucket: one row of the model table (batch null: keys and counts of what training
    holds) and a reply to each batch. ``owned`` marks the entries for which a batch is the
    first that saw the key in training, so that every pair is summed up once."""
    schema = arrow_schema("batch long, bucket int, n int, payload binary, owned binary, keys binary, few array<long>, total long")

    def answer(table: pa.Table) -> pa.Table:
        table, sizes, ends, distinct, at = _merged(table)
        counts = _column(table, "counts", np.uint32, sizes).astype(np.int64)
        total = np.bincount(at, counts, len(distinct)).astype(np.int64)
        learned = np.flatnonzero(counts)
        owned = np.zeros(len(at), bool)
        owned[learned[np.unique(at[learned], return_index=True)[1]]] = True
        bucket, reply = table.column("bucket")[0].as_py(), total[at].astype(np.uint32)
        known = total > 0
        few = np.bincount(np.minimum(total[known], GOOD_TURING_MAX + 2), minlength=GOOD_TURING_MAX + 3)
        rows = [(None, bucket, int(known.sum()), pack(total[known].astype(np.uint32)), None, pack_keys(distinct[known]), few.tolist(), int(total.sum()))]
        for batch, a, b in zip(table.column("batch").to_pylist(), ends[:-1], ends[1:], strict=True):
            rows.append((batch, bucket, b - a, pack(reply[a:b]), np.packbits(owned[a:b]).tobytes(), None, None, None))
        return pa.table([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

    return requests.groupBy("bucket").applyInArrow(answer, "batch long, bucket int, n int, payload binary, owned binary, keys binary, few array<long>, total long")


def _replied(table: pa.Table, pairs: bool, kind) -> tuple[np.ndarray, np.ndarray]:
    """A batch's answers in the order of its keys."""
    rows = [r for r in table.sort_by("bucket").to_pylist() if (r["bucket"] >= PAIRS) == pairs]
    values = [unpack(r["payload"], kind, r["n"]) for r in rows]
    owned = [np.unpackbits(np.frombuffer(r["owned"], np.uint8), count=r["n"]).astype(bool) for r in rows if r["owned"] is not None]
    return np.concatenate([np.zeros(0, kind), *values]), np.concatenate([np.zeros(0, bool), *owned])


def sum_requests(batches: DataFrame, replies: DataFrame, model: Model, n_texts: int, n_buckets: int) -> DataFrame:
    """For every history of a batch: its count, and over the pairs that the batch owns the
    discounted counts and the sum of P(w)."""
    schema = arrow_schema(SUMS)

    def ask(left: pa.Table, right: pa.Table) -> pa.Table:
        b = Batch(left)
        words = _replied(right, False, np.uint32)[0].astype(np.int64)
        pairs, owned = _replied(right, True, np.uint32)
        size = len(b.word_keys) + 1
        mass = np.bincount(b.pair_history[owned], model.pair_mass(pairs[owned].astype(np.int64)), size)
        lower = np.bincount(b.pair_history[owned], model.word(words[b.pair_word[owned]]), size)
        keys, order = b.history_keys()
        counts = np.append(words, n_texts)[order].astype(np.uint32)
        edges = bucket_edges(keys, n_buckets).tolist()
        rows = [(i, b.number, pack_keys(keys[x:y]), y - x, pack(counts[x:y]), pack(mass[order[x:y]]), pack(lower[order[x:y]])) for i, (x, y) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if x < y]
        return pa.table([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)

    return batches.groupBy("batch").cogroup(replies.groupBy("batch")).applyInArrow(ask, SUMS)


def answer_weights(requests: DataFrame) -> DataFrame:
    """Backoff weights to each batch; negative where T(h) is one more than the count."""
    schema = arrow_schema(REPLIES)

    def answer(table: pa.Table) -> pa.Table:
        table, sizes, ends, distinct, at = _merged(table)
        counts = np.zeros(len(distinct), np.int64)
        counts[at] = _column(table, "counts", np.uint32, sizes)
        mass, lower = (np.bincount(at, _column(table, name, np.float64, sizes), len(distinct)) for name in ("mass", "lower"))
        total, weight = history_weight(counts, mass, lower)
        reply, bucket = np.where(total > counts, -weight, weight)[at], table.column("bucket")[0].as_py()
        rows = [(batch, bucket, y - x, pack(reply[x:y]), None) for batch, x, y in zip(table.column("batch").to_pylist(), ends[:-1], ends[1:], strict=True)]
        return pa.table([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

    return requests.groupBy("bucket").applyInArrow(answer, REPLIES)


def score_batches(batches: DataFrame, replies: DataFrame, model: Model, n_texts: int) -> DataFrame:
    """The recursion for every token, added up per text. Replies with weights have a negative
    bucket number."""
    schema = "doc_id long, learn boolean, n_tokens long, n_known long, base_score double, score double"
    arrow = arrow_schema(schema)

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        b = Batch(left)
        weights = right.filter(pa.compute.less(right.column("bucket"), 0))
        right = right.filter(pa.compute.greater_equal(right.column("bucket"), 0))
        words = _replied(right, False, np.uint32)[0].astype(np.int64)
        pairs = _replied(right, True, np.uint32)[0].astype(np.int64)
        rows = sorted(weights.to_pylist(), key=lambda r: -r["bucket"])
        signed = np.zeros(len(words) + 1)
        signed[b.history_keys()[1]] = np.concatenate([unpack(r["payload"], np.float64, r["n"]) for r in rows])
        total = np.append(words, n_texts) + np.signbit(signed)
        word = model.word(words)
        seen = model.pair_mass(pairs) / np.maximum(1, total[b.pair_history])
        pair = np.log10(np.where(pairs > 0, seen, np.abs(signed)[b.pair_history] * word[b.pair_word]))
        base = np.log10((words + 1) / (model.tokens + model.vocabulary + 1))
        learn = b.learn[b.offsets[:-1]]
        columns = (b.doc_ids, learn, b.lengths, segment_sums(words[b.word_at] > 0, b.offsets), segment_sums(base[b.word_at], b.offsets), segment_sums(pair[b.pair_at], b.offsets))
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return batches.groupBy("batch").cogroup(replies.groupBy("batch")).applyInArrow(score, schema)


def katz_scores(docs: DataFrame, learn) -> DataFrame:
    """doc_id, learn, n_tokens, n_known, train_tokens, base_score, score for every row of
    ``docs`` (doc_id, text); ``learn`` is the condition of the rows that the model is made of.

    Null text counts as empty and has one token, its end. Repeated rows count as often as
    they occur. Without any training row every word is the unknown one, with probability 1.
    """
    spark = docs.sparkSession
    # Bucketed by batch, so that the two later passes read batches in place and only the
    # small answers are shuffled.
    name = "katz_batches_" + scratch_path(spark, "katz").rpartition("-")[2]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tokenised(docs, learn).write.bucketBy(parts, "batch").option("compression", "zstd").option("path", scratch_path(spark, "katz-batches")).saveAsTable(name)
    batches = spark.table(name)
    size, n_texts = batches.agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)), F.sum(F.size(F.filter("learn", lambda x: x)))).first()
    n_buckets = max(1, -(-(size or 0) // BUCKET_TOKENS))
    answers = store(answer_counts(count_requests(batches, n_buckets)), "katz-counts")
    table = answers.where("batch IS NULL")
    level = (F.col("bucket") >= PAIRS).cast("int").alias("level")
    few = np.zeros((2, GOOD_TURING_MAX + 3), np.int64)
    tokens = 0
    for r in table.select(level, F.posexplode("few"), "total").groupBy("level", "pos").agg(F.sum("col").alias("n"), F.sum("total").alias("total")).collect():
        few[r.level, r.pos] = r.n
        tokens = r.total if r.level == 0 else tokens
    model = Model(tokens, int(few[0].sum()), few[0], few[1])
    counts = answers.where("batch IS NOT NULL").select("batch", "bucket", "n", "payload", "owned")
    weights = store(answer_weights(sum_requests(batches, counts, model, n_texts or 0, n_buckets)), "katz-weights")
    marked = weights.withColumn("bucket", -1 - F.col("bucket"))
    scored = score_batches(batches, counts.drop("owned").unionByName(marked.drop("owned")).withColumn("owned", F.lit(None).cast("binary")), model, n_texts or 0)
    return scored.withColumn("train_tokens", F.lit(tokens).cast("long"))


def op6_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2
    scored = katz_scores(documents(spark, sf_dir), learn)
    return scored.select("doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")

"""Token-id files: canonical length-limited Huffman coding by global counts.

A file set under ``path`` has three Parquet tables: ``code`` (id, bits: the canonical code
follows from it), ``blocks`` (one folder per file; blocks of whole documents) and ``manifest``
(ids before and in each file). A block row holds its documents' ids and lengths, the coded bits
(16-bit units, most significant bit first) and the distance in bits between checkpoints, one per
``CHECKPOINT`` ids; a block is decoded on its own, all stretches between checkpoints in step, by
a table over the next ``MAX_BITS`` bits. Files follow each other in ascending doc_id order, as
do blocks in a file and documents in a block.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.bpe import encoder, tokenizer_path
from shelfmark.llm.words import arrow_schema, documents, per_batch, store
from shelfmark.session import scratch_path, ship_package

MAX_BITS = 16
#: Ids from one checkpoint to the next.
CHECKPOINT = 64
#: Ids from which on a block is closed; it always holds whole documents.
BLOCK_IDS = 1 << 17

RAW = "file_no int, block_no int, start long, doc_ids array<long>, lengths array<long>, ids binary"
BLOCKS = "file_no int, block_no int, start long, doc_ids array<long>, lengths array<long>, checkpoints binary, bits binary"


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths up to ``max_bits`` by package-merge; 0 where the count is 0."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.int64)
    if len(used) > 1 << max_bits:
        raise ValueError("more ids than codes")
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.float64)
    merged, is_leaf = weights, [np.ones(len(weights), bool)]
    for _ in range(max_bits - 1):
        n = len(merged) // 2
        packages = merged[: 2 * n].reshape(n, 2).sum(1)
        both = np.concatenate([weights, packages])
        rank = np.argsort(both, kind="stable")
        merged = both[rank]
        is_leaf.append(rank < len(weights))
    take, depth = 2 * len(order) - 2, np.zeros(len(order) + 1, np.int64)
    for level in reversed(is_leaf):
        leaves = int(level[:take].sum())  # the lightest ones: leaves come in ascending order
        depth[0] += 1
        depth[leaves] -= 1
        take = 2 * (take - leaves)
    lengths[order] = np.cumsum(depth)[:-1]
    return lengths


class Code:
    """Canonical code of given lengths: codes ascend with (length, id)."""

    def __init__(self, lengths: np.ndarray) -> None:
        self.lengths = lengths
        order = np.lexsort((np.arange(len(lengths)), lengths))
        order = order[lengths[order] > 0]
        spans = np.left_shift(1, MAX_BITS - lengths[order])  # share of the table of each code
        begins = np.concatenate([[0], np.cumsum(spans)[:-1]]) if len(order) else np.zeros(0, np.int64)
        self.codes = np.zeros(len(lengths), np.int64)
        self.codes[order] = begins >> (MAX_BITS - lengths[order])
        self.symbols, self.widths = np.zeros(1 << MAX_BITS, np.uint32), np.ones(1 << MAX_BITS, np.int64)
        self.symbols[: spans.sum()] = np.repeat(order, spans)
        self.widths[: spans.sum()] = np.repeat(lengths[order], spans)

    def encode(self, ids: np.ndarray) -> tuple[bytes, bytes]:
        """(checkpoint distances as unsigned 16-bit, coded 16-bit units)."""
        bits = self.lengths[ids]
        ends = np.cumsum(bits)
        begins = ends - bits
        at = begins[::CHECKPOINT]
        total = int(ends[-1]) if len(ids) else 0
        spread = self.codes[ids] << (32 - (begins & 15) - bits)
        unit, n_units = begins >> 4, (total + 15) // 16 + 1
        # Codes of a unit share no bit, so that their sum is their union.
        units = np.bincount(unit, spread >> 16, n_units) + np.bincount(unit + 1, spread & 0xFFFF, n_units + 1)[:n_units]
        return np.diff(at).astype("<u2").tobytes(), units[: (total + 15) // 16].astype(">u2").tobytes()

    def decode(self, checkpoints: bytes, bits: bytes, n: int) -> np.ndarray:
        if not n:
            return np.zeros(0, np.uint32)
        units = np.concatenate([np.frombuffer(bits, ">u2").astype(np.int64), np.zeros(2, np.int64)])
        window = (units[:-1] << 16) | units[1:]
        at = np.concatenate([[0], np.cumsum(np.frombuffer(checkpoints, "<u2").astype(np.int64))])
        last = len(window) - 1
        out = np.zeros((CHECKPOINT, len(at)), np.uint32)
        for step in range(min(CHECKPOINT, n)):
            peek = (window[np.minimum(at >> 4, last)] >> (16 - (at & 15))) & 0xFFFF
            out[step] = self.symbols[peek]
            at += self.widths[peek]
        return out.T.ravel()[:n]


def _ids_type(size: int) -> str:
    return "<u2" if size <= 65536 else "<u4"


def tokenized_blocks(docs: DataFrame, path: str, end_id: int, vocabulary: int, spaced: bool = True) -> DataFrame:
    """Blocks of raw ids in ascending doc_id order; null ids come first, null texts are
    empty, and rows with the same id follow each other by text."""
    ship_package(docs.sparkSession)
    schema = arrow_schema(RAW)
    kind, end = _ids_type(vocabulary), np.array([end_id], "<u4").tobytes()
    ordered = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def cut(batches):
        file_no, block_no, start = TaskContext.get().partitionId(), 0, 0
        doc_ids, lengths, parts, held = [], [], [], 0

        def block():
            raw = np.frombuffer(b"".join(parts), "<u4").astype(kind).tobytes()
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((file_no, block_no, start, doc_ids, lengths, raw), schema, strict=True)], schema=schema)

        for batch in batches:
            coded = encoder(path, spaced).encode(batch.column("text").to_pylist())
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), coded, strict=True):
                doc_ids.append(doc_id)
                lengths.append(len(raw) // 4 + 1)
                parts += (raw, end)
                held += lengths[-1]
                if held >= BLOCK_IDS:
                    yield block()
                    block_no, start = block_no + 1, start + held
                    doc_ids, lengths, parts, held = [], [], [], 0
        if doc_ids:
            yield block()

    return ordered.mapInArrow(cut, RAW)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int, vocabulary: int, spaced: bool = True) -> None:
    """Encode ``docs`` (doc_id, text) and write the file set. ``vocabulary`` bounds the ids."""
    spark = docs.sparkSession
    raw = store(tokenized_blocks(docs, tokenizer, end_id, vocabulary, spaced), "token-blocks")
    kind = _ids_type(vocabulary)

    def count(batches):
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            for ids in batch.column("ids"):
                total += np.bincount(np.frombuffer(ids.as_buffer(), kind), minlength=vocabulary)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])

    counts = np.zeros(vocabulary, np.int64)
    for row in raw.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        counts[row.id] = row.n  # bounded by the vocabulary
    lengths = code_lengths(counts)
    used = np.flatnonzero(lengths)
    spark.createDataFrame(list(zip(used.tolist(), lengths[used].tolist(), strict=True)), "id int, bits int").coalesce(1).write.parquet(f"{path}/code")
    code = Code(lengths)

    def encode(batch):
        coded = [code.encode(np.frombuffer(ids.as_buffer(), kind)) for ids in batch.column("ids")]
        return {name: batch.column(name) for name in ("file_no", "block_no", "start", "doc_ids", "lengths")} | {
            "checkpoints": [c for c, _ in coded],
            "bits": [b for _, b in coded],
        }

    blocks = per_batch(raw, encode, BLOCKS).sortWithinPartitions("file_no", "block_no")
    blocks.write.option("compression", "zstd").partitionBy("file_no").parquet(f"{path}/blocks")
    # One row per file, and files hold whole partitions: small, and needed in one order.
    files = raw.groupBy("file_no").agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n_ids")).orderBy("file_no").collect()
    before, rows = 0, []
    for f in files:
        rows.append((f.file_no, before, f.n_ids))
        before += f.n_ids
    spark.createDataFrame(rows, "file_no int, base long, n_ids long").coalesce(1).write.parquet(f"{path}/manifest")


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Decode a file set: doc_id, start, n_tokens, ids_crc32, with the ids if asked for."""
    ship_package(spark)
    table = spark.read.parquet(f"{path}/code").collect()  # bounded by the vocabulary
    lengths = np.zeros(max((r.id for r in table), default=0) + 1, np.int64)
    for r in table:
        lengths[r.id] = r.bits
    code = Code(lengths)
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    # One row per file, and a file is a partition of the writing job.
    manifest = F.broadcast(spark.read.parquet(f"{path}/manifest").select("file_no", "base"))
    rows = blocks.join(manifest, "file_no").select((F.col("start") + F.col("base")).alias("start"), "doc_ids", "lengths", "checkpoints", "bits")

    def decode(batch):
        out: dict[str, list] = {k: [] for k in ("doc_id", "start", "n_tokens", "ids_crc32", "ids")}
        for start, doc_ids, sizes, marks, bits in zip(*(batch.column(i) for i in range(5)), strict=True):
            sizes = sizes.values.to_numpy()
            ends = np.cumsum(sizes)
            raw = code.decode(marks.as_buffer(), bits.as_buffer(), int(ends[-1])).astype("<u4")
            begins = (ends - sizes).tolist()
            out["doc_id"] += doc_ids.as_py()
            out["start"] += [start.as_py() + b for b in begins]
            out["n_tokens"] += sizes.tolist()
            parts = [raw[b:e] for b, e in zip(begins, ends.tolist(), strict=True)]
            out["ids_crc32"] += [zlib.crc32(p) for p in parts]
            if with_ids:
                out["ids"] += [p.astype(np.int32) for p in parts]
        return out

    return per_batch(rows, decode, "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else ""))


def op7_huffman_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    write_token_files(documents(spark, sf_dir), path, tokenizer_path("byte_bpe_50k.json"), end_id=2, vocabulary=50257)
    return read_token_files(spark, path)

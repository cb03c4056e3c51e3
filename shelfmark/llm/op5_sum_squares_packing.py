"""Packing of token sequences by the sum-of-squares rule.

A document goes to the open sequence whose choice makes the sum, over all residual gaps, of the
squared number of open sequences with that gap smallest; ties go to the smallest gap, and a
sequence is begun only where none has room. Documents come in descending length. Pieces are
dealt into groups of some thousands by hash; a group is packed in one task over narrow rows
(ids stay behind). Sequences that a group leaves open are taken apart and packed again among
those of other groups until one group is left, so that grouping costs no more than a few
unfilled sequences in all.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.bpe import encoder, tokenizer_path
from shelfmark.llm.words import documents, per_batch, store
from shelfmark.session import ship_package

CAPACITY = 4096
#: Pieces that one task packs.
GROUP = 4096
#: Share of a sequence's capacity from which on it counts as full.
FULL = 0.995

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = PIECES + ", sequence_id long, offset long, filled long"


def token_pieces(docs: DataFrame, path: str, end_id: int = 1, capacity: int = CAPACITY, spaced: bool = False, with_ids: bool = False) -> DataFrame:
    """Each document's ids and ``end_id``, cut every ``capacity`` ids; one row per piece.

    Null text counts as empty: one piece that holds the end id. Repeated rows give their
    pieces twice. ``with_ids`` adds the ids themselves as ``array<int>``.
    """
    end = np.array([end_id], "<u4").tobytes()

    def cut(batch):
        out: dict[str, list] = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
        texts = [t or "" for t in batch.column("text").to_pylist()]
        for doc_id, raw in zip(batch.column("doc_id").to_pylist(), encoder(path, spaced).encode(texts), strict=True):
            raw += end
            for n, at in enumerate(range(0, len(raw), 4 * capacity)):
                part = raw[at : at + 4 * capacity]
                for key, value in zip(out, (doc_id, n, at // 4, len(part) // 4, zlib.crc32(part)), strict=False):
                    out[key].append(value)
                if with_ids:
                    out["ids"].append(np.frombuffer(part, "<u4").astype(np.int32))
        return out

    return per_batch(docs.select(F.col("doc_id").cast("long"), "text"), cut, PIECES + (", ids array<int>" if with_ids else ""))


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sequence, offset) of each length, in the given order, and what each sequence holds."""
    counts = np.zeros(capacity + 1, np.int64)  # open sequences by residual gap
    open_at: dict[int, list[int]] = {}
    where, offset, filled = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), []
    for i, size in enumerate(lengths.tolist()):
        chosen = -1
        if size < capacity:
            gaps = counts[size:capacity]
            if gaps.any():
                # Twice the change of the sum, without what is equal for all; a sequence
                # that is filled leaves the sum and saves one more.
                change = 2 * (counts[: capacity - size] - gaps)
                change[0] -= 1
                change[gaps == 0] = np.iinfo(np.int64).max
                gap = size + int(change.argmin())
                chosen = open_at[gap].pop()
                counts[gap] -= 1
        if chosen < 0:
            chosen, gap = len(filled), capacity
            filled.append(0)
        where[i], offset[i] = chosen, filled[chosen]
        filled[chosen] += size
        if gap > size:
            counts[gap - size] += 1
            open_at.setdefault(gap - size, []).append(chosen)
    return where, offset, np.array(filled, np.int64)


def _pack_groups(pieces: DataFrame, n_groups: int, turn: int, capacity: int) -> DataFrame:
    ship_package(pieces.sparkSession)

    def pack(table: pa.Table) -> pa.Table:
        group = table.column("pack_group")[0].as_py()
        table = table.select(["doc_id", "piece", "start", "length", "ids_crc32"])
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        where, offset, filled = sum_of_squares(table.column("length").to_numpy(), capacity)
        table = table.append_column("sequence_id", pa.array(where + (group << 24) + (turn << 56)))
        return table.append_column("offset", pa.array(offset)).append_column("filled", pa.array(filled[where]))

    # Equal rows are told apart by a number that need not be the same on a second run: it
    # only deals them to groups.
    key = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.lit(turn)), F.lit(n_groups))
    return pieces.withColumn("pack_group", key).groupBy("pack_group").applyInArrow(pack, PLACED)


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP, full: float = FULL) -> DataFrame:
    """Place the rows of ``token_pieces``: adds ``sequence_id`` and ``offset``.

    Sequences never exceed the capacity and have no gap. Longer pieces than the capacity
    are refused. An empty table gives no row.
    """
    rest, done, turn = store(pieces, "pieces"), [], 0
    if rest.where(F.col("length") > capacity).limit(1).count():
        raise ValueError(f"a piece is longer than {capacity}")
    left = rest.count()
    while True:
        n_groups = max(1, -(-left // group))
        placed = store(_pack_groups(rest, n_groups, turn, capacity), "packed")
        still_open = placed.where(F.col("filled") < full * capacity)
        before, left = left, still_open.count()
        # The last group keeps what it has; so does a turn that would gain nothing.
        if n_groups == 1 or left > 0.9 * before or left == 0:
            done.append(placed)
            break
        done.append(placed.where(F.col("filled") >= full * capacity))
        rest, turn = still_open.select("doc_id", "piece", "start", "length", "ids_crc32"), turn + 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.drop("filled")


def packed_sequences(pieces_with_ids: DataFrame, placed: DataFrame) -> DataFrame:
    """The sequences themselves: sequence_id, ids. Equal pieces are interchangeable."""
    keys = ["doc_id", "piece", "ids_crc32"]
    texts = pieces_with_ids.select(*keys, "ids").dropDuplicates(keys)
    on = [placed[k].eqNullSafe(texts[k]) for k in keys]
    rows = placed.join(texts, on[0] & on[1] & on[2]).select("sequence_id", F.struct("offset", "ids").alias("part"))
    ordered = F.sort_array(F.collect_list("part"))  # at most `capacity` ids
    return rows.groupBy("sequence_id").agg(F.flatten(F.transform(ordered, lambda p: p["ids"])).alias("ids"))


def pack_documents(docs: DataFrame) -> DataFrame:
    return pack_pieces(token_pieces(docs, tokenizer_path("word_bpe_49k.json")))


def op5_sum_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))

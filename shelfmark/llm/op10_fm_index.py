"""Benchmark decontamination: an FM-index over every shard of the training text.

A shard is a bounded run of documents of one task. Its words are written in the alphabet of
the test phrases: a word that no phrase holds is a separator, and stretches between separators
that are shorter than the phrases cannot hold one and are left out. Over this text stand a
suffix array (kept only at every ``SAMPLE``-th position), its Burrows-Wheeler transform in a
wavelet matrix, and the usual counts. All phrases are searched backwards together, their
occurrences located by walking to the next sampled position, and spans of words merged.

Phrases come in blocks of bounded size; documents pass by each block in turn and carry their
spans along, so the benchmark may be of any size and no row is ever shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.words import documents, per_batch, segment_ids

WINDOW = 10
#: Words of a shard at most (a longer document is a shard of its own).
SHARD_WORDS = 2_000_000
#: Bytes of phrases that go to the tasks at once.
BLOCK_BYTES = 8 << 20
#: Text positions from one sampled suffix to the next.
SAMPLE = 8

#: Fixed: words are runs of letters and digits of ASCII and of anything outside ASCII; A-Z
#: becomes a-z and every other ASCII character a space.
_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

END, SEPARATOR = 0, 1


def phrase_words(text: str | None, lower: bool = True) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_BYTES).split()


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Positions of the suffixes in order, by prefix doubling; ends with a unique END."""
    _, rank = np.unique(text, return_inverse=True)
    rank, n, step = rank.astype(np.int64), len(text), 1
    while True:
        key = rank * np.int64(n + 1)
        key[: n - step] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        fresh = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        rank[order] = fresh
        if fresh[-1] == n - 1 or step >= n:
            return order
        step *= 2


class WaveletMatrix:
    """Ranks of symbols in a sequence, by one bit vector per bit of the symbols."""

    def __init__(self, sequence: np.ndarray, n_symbols: int) -> None:
        self.levels = []
        for bit in reversed(range(max(1, int(n_symbols - 1).bit_length()))):
            bits = (sequence >> bit) & 1
            ones = np.concatenate([[0], np.cumsum(bits)])
            self.levels.append((bit, bits, ones, len(bits) - int(ones[-1])))
            sequence = np.concatenate([sequence[bits == 0], sequence[bits == 1]])

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each position."""
        begin = np.zeros_like(at)
        for bit, _, ones, zeros in self.levels:
            one = (symbols >> bit) & 1 == 1
            at = np.where(one, zeros + ones[at], at - ones[at])
            begin = np.where(one, zeros + ones[begin], begin - ones[begin])
        return at - begin

    def symbol_and_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each position and how often it stands before."""
        symbols, begin = np.zeros_like(at), np.zeros_like(at)
        for bit, bits, ones, zeros in self.levels:
            one = bits[at] == 1
            symbols |= one.astype(symbols.dtype) << bit
            at = np.where(one, zeros + ones[at], at - ones[at])
            begin = np.where(one, zeros + ones[begin], begin - ones[begin])
        return symbols, at - begin


class FmIndex:
    """Backward search and location in a text of symbols from 1 on."""

    def __init__(self, text: np.ndarray, n_symbols: int) -> None:
        text = np.append(text, END)
        order = suffix_array(text)
        self.matrix = WaveletMatrix(text[order - 1], n_symbols)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n_symbols))])
        kept = order % SAMPLE == 0
        self.sampled = np.where(kept, np.cumsum(kept) - 1, -1)
        self.samples = order[kept]
        self.size = len(text)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of the suffixes that begin with each phrase (phrases x words)."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.size)
        for column in reversed(range(phrases.shape[1])):
            symbols = phrases[:, column]
            low = self.before[symbols] + self.matrix.rank(symbols, low)
            high = self.before[symbols] + self.matrix.rank(symbols, high)
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows."""
        out, steps = np.full(len(rows), -1), 0
        waiting, at = np.arange(len(rows)), rows.copy()
        while len(waiting):
            found = self.sampled[at] >= 0
            out[waiting[found]] = self.samples[self.sampled[at[found]]] + steps
            waiting, at = waiting[~found], at[~found]
            symbols, rank = self.matrix.symbol_and_rank(at)
            at, steps = self.before[symbols] + rank, steps + 1
        return out


@dataclass
class Phrases:
    """Distinct windows of one length: words x symbols, and the items that hold each."""

    length: int
    symbols: dict[bytes, int] = field(default_factory=dict)
    windows: dict[tuple[int, ...], int] = field(default_factory=dict)
    holders: list[set[str]] = field(default_factory=list)

    def add(self, words: list[bytes], item: str) -> None:
        window = tuple(self.symbols.setdefault(w, len(self.symbols) + 2) for w in words)
        at = self.windows.setdefault(window, len(self.windows))
        if at == len(self.holders):
            self.holders.append(set())
        self.holders[at].add(item)

    def search(self, words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """(flat word positions, window numbers) of all occurrences in a shard."""
        get = self.symbols.get
        parts = []
        for doc in words:
            parts.append(np.fromiter(map(get, doc, _ones(len(doc))), np.int64, len(doc)))
            parts.append(np.ones(1, np.int64))  # no window runs on into the next document
        flat = np.concatenate(parts)
        edge = np.flatnonzero(flat == SEPARATOR)
        begins = np.concatenate([[0], edge[:-1] + 1])
        long = edge - begins >= self.length
        begins, ends = begins[long], edge[long] + 1  # each stretch with the separator after it
        if not len(begins):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        sizes = ends - begins
        origin = np.repeat(begins - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
        index = FmIndex(flat[origin], len(self.symbols) + 2)
        low, high = index.search(np.array(list(self.windows), np.int64))
        found = high - low
        rows = np.repeat(low - np.concatenate([[0], np.cumsum(found)[:-1]]), found) + np.arange(found.sum())
        at = origin[index.locate(rows)]
        doc = segment_ids(np.concatenate([[0], np.cumsum([len(d) + 1 for d in words])]))[at]
        return at - doc, np.repeat(np.arange(len(found)), found)


def _ones(n: int):
    from itertools import repeat

    return repeat(SEPARATOR, n)


def read_phrases(items: list[tuple[str, str | None]], window: int) -> list[Phrases]:
    """Windows of ``window`` words of each item; a shorter item is one window."""
    by_length: dict[int, Phrases] = {}
    for item, text in items:
        words = phrase_words(text)
        size = min(window, len(words))
        for at in range(len(words) - size + 1 if size else 0):
            by_length.setdefault(size, Phrases(size)).add(words[at : at + size], item)
    return list(by_length.values())


def _shards(words: list[list[bytes]]):
    """Bounds of runs of documents with at most SHARD_WORDS words."""
    first, held = 0, 0
    for i, doc in enumerate(words):
        if held and held + len(doc) > SHARD_WORDS:
            yield first, i
            first, held = i, 0
        held += len(doc)
    if words:
        yield first, len(words)


def find_benchmark(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, spans (start, end of each merged run of hit words, flat), items (ids
    found, sorted as strings) and text for every row of ``docs`` (doc_id, text).

    Null and empty texts, of documents and items, have no word. A null item id is written
    ``null``; repeated items count once. An empty benchmark hits nothing.
    """
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), "text").where("text IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("text") + F.octet_length("item"))).first()[0] or 0
    n_blocks = max(1, -(-int(total) // block_bytes))
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.lit(0).cast("long").alias("n_words"), F.array().cast("array<int>").alias("spans"), F.array().cast("array<string>").alias("items"))
    for block in range(n_blocks):
        # A block is bounded by its bytes, up to the unevenness of a hash.
        chosen = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks)) == block)
        rows = _search_block(rows, read_phrases([tuple(r) for r in chosen.collect()], window))
    return rows


def _search_block(rows: DataFrame, phrases: list[Phrases]) -> DataFrame:
    def search(batch):
        words = [phrase_words(t) for t in batch.column("text").to_pylist()]
        spans, items = batch.column("spans").to_pylist(), batch.column("items").to_pylist()
        for a, b in _shards(words):
            offsets = np.concatenate([[0], np.cumsum([len(d) for d in words[a:b]])])
            doc_of = segment_ids(offsets)
            change = np.zeros(offsets[-1] + 1, np.int64)
            touched = [i for i in range(a, b) if spans[i]]
            for i in touched:
                change[np.array(spans[i][::2]) + offsets[i - a]] += 1
                change[np.array(spans[i][1::2]) + offsets[i - a]] -= 1
            for group in phrases:
                at, number = group.search(words[a:b])
                np.add.at(change, at, 1)
                np.add.at(change, at + group.length, -1)
                doc = doc_of[at]
                for d, n in np.unique(np.stack([doc, number], 1), axis=0).tolist() if len(at) else []:
                    items[a + d] = items[a + d] + list(group.holders[n])
            hit = np.concatenate([[0], np.cumsum(change[:-1]) > 0, [0]]).astype(np.int8)
            # Runs end at the end of their document even where the next one begins hit.
            edges = np.diff(hit)
            starts, ends = edges[:-1] > 0, edges[1:] < 0
            inner = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < offsets[-1])]
            across = inner[(hit[inner] == 1) & (hit[inner + 1] == 1)]
            starts[across], ends[across - 1] = True, True
            first, last = np.flatnonzero(starts), np.flatnonzero(ends) + 1
            owner = doc_of[first] if len(first) else first
            for d in np.unique(owner).tolist():
                mine = owner == d
                spans[a + d] = (np.stack([first[mine], last[mine]], 1) - offsets[d]).ravel().tolist()
        return {
            "doc_id": batch.column("doc_id"),
            "text": batch.column("text"),
            "n_words": [len(d) for d in words],
            "spans": spans,
            "items": [sorted(set(x)) for x in items],
        }

    return per_batch(rows, search, "doc_id long, text string, n_words long, spans array<int>, items array<string>")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The digest of ``find_benchmark``: how much of each document is benchmark text."""
    found = find_benchmark(docs, benchmark)
    n_hit = F.aggregate(F.transform("spans", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)), F.lit(0).cast("long"), lambda a, x: a + x)
    listed = F.sha2(F.array_join("items", ","), 256)
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), listed.alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def op10_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))

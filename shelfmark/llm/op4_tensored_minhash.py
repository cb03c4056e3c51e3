"""Near-duplicate detection: MinHash with tensored banding, candidates verified exactly.

A table key joins one of ``SIDE`` small collections of minhashes with one of ``SIDE`` others:
2 * SIDE collections give SIDE ** 2 tables, so the minhashes needed are about the square root
of those of independent tables. With 8 collections of 2 minhashes on either side, 32 minhashes
make 64 tables of 4 rows each. Two documents of similarity 0.8 miss each other in all tables
with probability 2 * 0.36 ** 8 = 0.0006, and less the more similar they are.

Documents with equal sets are one representative. Representatives that share a table key, at
whatever remove, form a candidate cluster; the sets of a cluster meet once (in blocks of bounded
size where it is large, every pair of blocks), and a search that follows true links finds its
components. Links are decided on the full sets. No list of pairs is ever written, so a group of
thousands of copies costs as many rows as it has members.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.components import components
from shelfmark.llm.words import arrow_schema, documents, mix, per_batch, split_words, store, window_hashes, word_arrays
from shelfmark.session import ship_package

#: Collections on either side, and minhashes in each.
SIDE, ROWS = 8, 2
#: Shingles that one block of a cluster may hold (one document may exceed it alone).
BLOCK_SHINGLES = 2_000_000

_ODD = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Shingling:
    """``words`` consecutive words; lower-cased in A-Z; ``split`` cuts a text into words."""

    words: int = 4
    percent: int = 80
    split: object = split_words

    def sets(self, texts: list[str | None]) -> list[np.ndarray]:
        """Sorted distinct 64-bit shingle hashes of each text. A text of fewer words is one
        shingle, a text without words has none."""
        ids, offsets, hashes = word_arrays(texts, True, self.split)
        words = hashes[ids] if len(ids) else np.zeros(0, np.uint64)
        windows = window_hashes(words, self.words)
        out = []
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            if b - a >= self.words:
                out.append(np.unique(windows[a : b - self.words + 1]))
            else:
                out.append(window_hashes(words[a:b], b - a) if b > a else np.zeros(0, np.uint64))
        return out

    def linked(self, common, size_a, size_b):
        return 100 * common >= self.percent * (size_a + size_b - common)


def table_keys(sets: list[np.ndarray]) -> np.ndarray:
    """sets x SIDE ** 2 keys; the sets must not be empty."""
    if not sets:
        return np.zeros((0, SIDE * SIDE), np.int64)
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    seeds = mix(np.arange(1, 2 * SIDE * ROWS * 2 + 1, dtype=np.uint64) * _ODD)
    minima = [np.minimum.reduceat(flat * (seeds[2 * i] | np.uint64(1)) + seeds[2 * i + 1], starts) for i in range(2 * SIDE * ROWS)]
    parts = []
    for c in range(2 * SIDE):
        part = np.full(len(sets), c + 1, np.uint64)
        for r in range(ROWS):
            part = mix(part * _ODD + minima[c * ROWS + r])
        parts.append(part)
    keys = [mix(parts[i] * _ODD + parts[SIDE + j]) for i in range(SIDE) for j in range(SIDE)]
    return np.stack(keys, 1).view(np.int64)


def local_links(nodes: np.ndarray, sets: list[np.ndarray], shingling: Shingling) -> list[tuple[int, int]]:
    """(member, root) for the components of a block of documents with distinct sets.

    Breadth first: an expanded document counts its common shingles with all documents not
    reached yet, through lists of who holds a shingle. Reached ones leave the lists when
    half are gone, so a dense group costs little more than its size.
    """
    sizes = np.array([len(s) for s in sets])
    if len(sets) == 2:
        common = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return [(int(nodes[1]), int(nodes[0]))] if shingling.linked(common, sizes[0], sizes[1]) else []
    out, waiting = [], np.ones(len(sets), bool)

    def lists(members):
        owner = np.repeat(members, sizes[members])
        held = np.concatenate([sets[i] for i in members]) if len(members) else np.zeros(0, np.uint64)
        order = np.argsort(held, kind="stable")
        return held[order], owner[order], len(members)

    held, owner, listed = lists(np.arange(len(sets)))
    for root in range(len(sets)):
        if not waiting[root]:
            continue
        waiting[root] = False
        frontier = [root]
        while frontier:
            u = frontier.pop()
            left = int(waiting.sum())
            if not left:
                break
            if 2 * left < listed:
                held, owner, listed = lists(np.flatnonzero(waiting))
            first, last = np.searchsorted(held, sets[u], "left"), np.searchsorted(held, sets[u], "right")
            spans = last - first
            at = np.repeat(first - np.concatenate([[0], np.cumsum(spans)[:-1]]), spans) + np.arange(spans.sum())
            common = np.bincount(owner[at], minlength=len(sets))
            near = np.flatnonzero(waiting & (common > 0) & shingling.linked(common, sizes, sizes[u]))
            waiting[near] = False
            out += [(int(nodes[i]), int(nodes[root])) for i in near]
            frontier += near.tolist()
    return out


def _verified_links(members: DataFrame, shingling: Shingling) -> DataFrame:
    """Links of rows (cluster, doc_id, text, n_shingles, n_blocks), a spanning forest."""
    ship_package(members.sparkSession)

    def pack(batch):
        sets = shingling.sets(batch.column("text").to_pylist())
        return {"cluster": batch.column("cluster"), "doc_id": batch.column("doc_id"), "n_blocks": batch.column("n_blocks"), "held": [s.tobytes() for s in sets]}

    packed = per_batch(members.select("cluster", "doc_id", "n_blocks", "text"), pack, "cluster long, doc_id long, n_blocks int, held binary")
    block = F.pmod(F.xxhash64("doc_id"), F.col("n_blocks")).cast("int")
    # Each block meets every other block of its cluster once, and clusters of one block
    # (nearly all) are not copied at all.
    meets = F.transform(F.sequence(F.lit(0), F.col("n_blocks") - 1), lambda o: F.struct(F.least(o, F.col("block")).alias("lo"), F.greatest(o, F.col("block")).alias("hi")))
    dealt = packed.withColumn("block", block).select("cluster", "doc_id", "held", F.explode(meets).alias("pair")).select("cluster", "pair.lo", "pair.hi", "doc_id", "held")
    dealt = dealt.repartition("cluster", "lo", "hi").sortWithinPartitions("cluster", "lo", "hi", "doc_id")
    schema = arrow_schema("a long, b long")

    def search(batches):
        current, nodes, sets = None, [], []
        for batch in batches:
            keys = zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)
            links = []
            for key, node, held in zip(keys, batch.column("doc_id").to_pylist(), batch.column("held"), strict=True):
                if key != current:
                    links += local_links(np.array(nodes), sets, shingling) if len(nodes) > 1 else []
                    current, nodes, sets = key, [], []
                nodes.append(node)
                sets.append(np.frombuffer(held.as_py(), np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], schema=schema)
        links = local_links(np.array(nodes), sets, shingling) if len(nodes) > 1 else []
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], schema=schema)

    return dealt.mapInArrow(search, "a long, b long")


def near_duplicates(docs: DataFrame, shingling: Shingling = Shingling()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text).

    Null and empty texts have no shingle and are linked with nothing. Rows with the same
    doc_id share its component; a row with a null id is alone and kept. Columns other than
    doc_id and text are not looked at.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def sketch(batch):
        sets = shingling.sets(batch.column("text").to_pylist())
        full = [i for i, s in enumerate(sets) if len(s)]
        keys: list = [None] * len(sets)
        for i, row in zip(full, table_keys([sets[i] for i in full]), strict=True):
            keys[i] = row
        prints = [(int(np.bitwise_xor.reduce(s).view(np.int64)), int(np.add.reduce(mix(s)).view(np.int64))) if len(s) else (None, None) for s in sets]
        return {"doc_id": batch.column("doc_id"), "n_shingles": [len(s) for s in sets], "f1": [p[0] for p in prints], "f2": [p[1] for p in prints], "keys": keys}

    sketches = store(per_batch(docs, sketch, "doc_id long, n_shingles long, f1 long, f2 long, keys array<long>"), "sketches")
    some = sketches.where("n_shingles > 0 AND doc_id IS NOT NULL")
    copies = store(some.groupBy("f1", "f2", "n_shingles").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")), "copies")
    same = some.join(copies.where("n > 1"), ["f1", "f2", "n_shingles"]).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))

    reps = some.join(copies.select(F.col("rep").alias("doc_id"), "f1", "f2", "n_shingles"), ["doc_id", "f1", "f2", "n_shingles"], "left_semi")
    entries = reps.select("doc_id", F.explode("keys").alias("key"))
    shared = entries.groupBy("key").agg(F.min("doc_id").alias("pivot"), F.max("doc_id").alias("other")).where("pivot < other").select("key", "pivot")
    candidates = components(entries.join(shared, "key").select(F.col("doc_id").alias("a"), F.col("pivot").alias("b")))
    clusters = store(candidates.select(F.col("node").alias("doc_id"), F.col("component").alias("cluster")), "clusters")
    sizes = clusters.join(reps.groupBy("doc_id").agg(F.max("n_shingles").alias("n_shingles")), "doc_id").groupBy("cluster").agg(F.sum("n_shingles").alias("total"))
    blocks = sizes.select("cluster", F.ceil(F.col("total") / BLOCK_SHINGLES).cast("int").alias("n_blocks"))
    # A doc_id with several texts is represented by each: all of them are shown, and links
    # of any text are links of the id.
    members = docs.join(clusters.join(blocks, "cluster"), "doc_id")
    links = _verified_links(members, shingling)
    found = components(links.unionByName(same))
    rows = sketches.select("doc_id", "n_shingles").join(found.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return rows.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def op4_tensored_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))

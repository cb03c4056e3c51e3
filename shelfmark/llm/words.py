"""Words of a batch of texts as integer arrays, for operators that work in numpy inside tasks."""

from __future__ import annotations


import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from shelfmark.session import free_shuffles, scratch_path, ship_package  # noqa: F401

#: Fixed mapping: A-Z to a-z, all other bytes as they are.
LOWER_AZ = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)


class WordIds(dict):
    """Dense ids of words in order of first sight; ``hashes`` has 64 bits of each."""

    def __init__(self) -> None:
        super().__init__()
        self.hashes: list[int] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = new = len(self)
        self.hashes.append(xxhash.xxh3_64_intdigest(word))
        return new


def split_words(text: str | None, lower: bool) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+``: bytes.split() splits at just these six characters."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return (raw.translate(LOWER_AZ) if lower else raw).split()


def word_arrays(texts: list[str | None], lower: bool, split=split_words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids of all words, offsets of the texts in them, 64-bit hash of each id)."""
    ids, offsets, parts = WordIds(), np.zeros(len(texts) + 1, np.int64), []
    for i, text in enumerate(texts):
        words = split(text, lower)
        parts.append(np.fromiter(map(ids.__getitem__, words), np.int32, len(words)))
        offsets[i + 1] = offsets[i] + len(words)
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    return flat, offsets, np.array(ids.hashes, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """64-bit hash of each window of ``width`` consecutive entries."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = mix(words[:n] + _ODD)
    for i in range(1, width):
        out = mix(out * _ODD + words[i : i + n])
    return out


def segment_ids(offsets: np.ndarray) -> np.ndarray:
    """For each element the number of the segment that it lies in."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def segment_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of each segment; empty segments give 0."""
    total = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def portions(texts: list[str], characters: int = 1_000_000):
    """Slices of ``texts`` of at most so many characters, or of one longer text. Arrays over
    characters and words stay small whatever the size of an Arrow batch."""
    first, held = 0, 0
    for i, text in enumerate(texts):
        if i > first and held + len(text) > characters:
            yield texts[first:i]
            first, held = i, 0
        held += len(text)
    if texts:
        yield texts[first:]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def per_batch(df: DataFrame, function, schema: str) -> DataFrame:
    """``function(RecordBatch) -> dict of columns``, Arrow batch by Arrow batch."""
    ship_package(df.sparkSession)
    arrow = arrow_schema(schema)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                out = function(batch)
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def store(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared scratch folder, compressed with zstd, and read back."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def without_ids(docs: DataFrame, ids: DataFrame, most: int = 1_000_000) -> DataFrame:
    """``docs`` less the rows whose doc_id is in ``ids`` (a stored table with that column).

    Up to ``most`` ids are broadcast, so that texts stay where they are; more are joined by a
    shuffle. A null id is never taken out.
    """
    ids = ids.select("doc_id").where("doc_id IS NOT NULL").distinct()
    few = ids.limit(most + 1).count() <= most
    return docs.join(F.broadcast(ids) if few else ids, "doc_id", "left_anti").select(docs.columns)

"""Text to vectors: a native feature-hashing embedder, or a user's model."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.common import unnest
from shelfmark.functions.text import term_counts, term_sign, term_slot, terms
from shelfmark.functions.vectors import unit_vector
from shelfmark.operators.corpus import CorpusStats, fit_corpus
from shelfmark.operators.lookup import HOT_KEYS, NARROW_ROWS, keyed_lookup
from shelfmark.session import materialize, ship_package

# Largest vocabulary that is broadcast: its rows and bytes are known from the fit.
BROADCAST_TERMS = 2_000_000
BROADCAST_BYTES = 64 << 20

MAX_SHARED = 8
_shared: dict = {}

# The default vector length, and the most texts sent in one request.
DEFAULT_DIM = 1024
REQUEST_TEXTS = 150


@dataclass(frozen=True)
class HashEmbedder:
    """Feature hashing (Weinberger et al. 2009) with optional idf weights.

    A term adds ``sign * (1 + ln tf) * idf`` to its slot, or ``sign * tf`` without
    ``stats``; the vector is scaled to length one. It captures shared words, not
    meaning. Terms unseen in the corpus are dropped; a text with no term left
    has a NULL vector.
    """

    dim: int = DEFAULT_DIM
    stats: CorpusStats | None = None

    @classmethod
    def fit(cls, df: DataFrame, text_col: str = "content", dim: int = DEFAULT_DIM) -> HashEmbedder:
        return cls(dim, fit_corpus(df, text_col))

    @property
    def embedder_id(self) -> str:
        if self.stats is None:
            return f"hash-{self.dim}"
        return f"hash-{self.dim}-{self.stats.n_docs}-{self.stats.fingerprint}"

    def transform(
        self,
        df: DataFrame,
        text_col: str = "content",
        out: str = "embedding",
        key: str | list[str] | None = None,
        broadcast_terms: int = BROADCAST_TERMS,
        hot_keys: int = HOT_KEYS,
        broadcast_facts: int = NARROW_ROWS,
    ) -> DataFrame:
        """``df`` with the vector column ``out``.

        A vocabulary within the broadcast bounds is looked up inside the scan stage,
        without a shuffle. Of a larger one the most frequent terms within the bounds are; only
        the others, few in a text, are joined by term, hot terms apart, and their weights
        come back by a number given to each row. The input is stored for that, so it is
        computed once. ``key`` is not needed for either way.
        """
        if self.stats is None:
            return df.withColumn(out, unit_vector(_plain_entries(F.col(text_col), self.dim), self.dim))
        if self.stats.n_terms <= broadcast_terms and self.stats.term_bytes <= BROADCAST_BYTES:
            return self._transform_in_place(df, text_col, out)
        numbered = materialize(df.withColumn("_row_no", F.monotonically_increasing_id()), "numbered")
        least_df = self._least_broadcast_df(df.sparkSession, broadcast_terms)
        if least_df is None:
            return self._transform_by_join(numbered, text_col, out, ["_row_no"], hot_keys, broadcast_facts).drop("_row_no")
        return self._transform_rare_by_join(numbered, text_col, out, least_df, hot_keys, broadcast_facts).drop("_row_no")

    def _least_broadcast_df(self, spark, broadcast_terms: int) -> int | None:
        """The document frequency from which on all terms fit the broadcast bounds together."""
        sizes = self.stats.terms(spark).groupBy("df").agg(F.count("*").alias("n"), F.sum(F.octet_length("term")).alias("b"))
        # One row per distinct frequency: their number grows with the root of the postings at most.
        table = sizes.orderBy(F.desc("df")).toArrow()
        n, b = np.cumsum(table["n"].to_numpy()), np.cumsum(table["b"].to_numpy())
        fits = int(np.count_nonzero((n <= broadcast_terms) & (b <= BROADCAST_BYTES)))
        return int(table["df"][fits - 1].as_py()) if fits else None

    def _transform_in_place(self, df: DataFrame, text_col: str, out: str) -> DataFrame:
        spark, dim = df.sparkSession, self.dim
        ship_package(spark)
        shared = _shared_terms(spark, self.stats, dim)

        @F.arrow_udf("array<float>")
        def embed(found: pa.Array) -> pa.Array:
            known, slots, weights = shared.value
            return _embed_batch(found, known, slots, weights, dim)

        return df.withColumn(out, embed(terms(F.col(text_col))))

    def _transform_rare_by_join(self, numbered, text_col, out, least_df, hot_keys, broadcast_facts) -> DataFrame:
        spark, dim = numbered.sparkSession, self.dim
        ship_package(spark)
        shared = _shared_terms(spark, self.stats, dim, least_df)

        @F.arrow_udf("array<string>")
        def others(found: pa.Array) -> pa.Array:
            return _terms_outside(found, shared.value[0])

        @F.arrow_udf("array<float>")
        def embed(found: pa.Array, rare: pa.Array) -> pa.Array:
            known, slots, weights = shared.value
            return _embed_batch(found, known, slots, weights, dim, rare)

        listed = numbered.select("_row_no", F.explode_outer(others(terms(F.col(text_col)))).alias("term"))
        postings = materialize(listed.where(F.col("term").isNotNull()), "postings")
        counts = postings.groupBy("term").agg(F.count("*").alias("n"))
        signed = self.stats.signed_terms(spark, dim).where(F.col("df") < least_df).select("term", "slot", "weight")
        weighted = keyed_lookup(postings, signed, "term", counts, hot_keys, broadcast_facts)
        # One group is one text, so what is collected is bounded by that text.
        rare = weighted.groupBy("_row_no").agg(F.collect_list(F.struct("term", "slot", "weight")).alias("_rare"))
        joined = numbered.join(rare, "_row_no", "left")
        return joined.withColumn(out, embed(terms(F.col(text_col)), F.col("_rare"))).drop("_rare")

    def _transform_by_join(self, df, text_col, out, key, hot_keys, broadcast_facts) -> DataFrame:
        spark = df.sparkSession
        entries = df.select(*key, term_counts(F.col(text_col)).alias("_e"))
        # Stored: counting, and both branches of the lookup, read it.
        postings = materialize(unnest(entries, key, "_e"), "postings")
        counts = postings.groupBy("term").agg(F.count("*").alias("n"))
        signed = self.stats.signed_terms(spark, self.dim).select("term", "slot", "weight")
        weighted = keyed_lookup(postings, signed, "term", counts, hot_keys, broadcast_facts)
        value = (1 + F.log(F.col("tf"))) * F.col("weight")
        # One group is one text, so what is collected is bounded by that text.
        vectors = weighted.groupBy(*key).agg(
            F.collect_list(F.struct("slot", value.alias("v"))).alias("_e")
        )
        vectors = vectors.select(*key, unit_vector(F.col("_e"), self.dim).alias(out))
        return df.join(vectors, key, "left")


def _shared_terms(spark, stats: CorpusStats, dim: int, least_df: int = 0):
    """The broadcast vocabulary, or its terms from ``least_df`` on, kept for the next use of the same embedder."""
    name = (spark.sparkContext.applicationId, stats.path, stats.fingerprint, dim, least_df)
    if name not in _shared:
        table = stats.signed_terms(spark, dim).where(F.col("df") >= least_df).select("term", "slot", "weight").toArrow()
        _shared[name] = spark.sparkContext.broadcast(
            (table["term"].combine_chunks(), table["slot"].to_numpy(), table["weight"].to_numpy())
        )
        while len(_shared) > MAX_SHARED:
            _shared.pop(next(iter(_shared)))
    return _shared[name]


def _plain_entries(text, dim: int):
    return F.transform(
        term_counts(text),
        lambda e: F.struct(
            term_slot(e["term"], dim).alias("slot"),
            (term_sign(e["term"]) * e["tf"]).alias("v"),
        ),
    )


def _rows_of(lists: pa.Array) -> np.ndarray:
    """For each value of an array of lists, the position of its list."""
    return np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))


def _terms_outside(found: pa.Array, known: pa.Array) -> pa.Array:
    """Of each list of terms, the distinct ones that are not among ``known``."""
    words = found.flatten()
    outside = pc.invert(pc.is_in(words, value_set=known)).to_numpy(zero_copy_only=False)
    rows, words = _rows_of(found)[outside], words.filter(pa.array(outside)).dictionary_encode()
    pairs = np.unique(rows * max(len(words.dictionary), 1) + words.indices.to_numpy(zero_copy_only=False))
    rows, codes = np.divmod(pairs, max(len(words.dictionary), 1))
    offsets = np.searchsorted(rows, np.arange(len(found) + 1))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), words.dictionary.take(pa.array(codes)))


def _embed_batch(found: pa.Array, known: pa.Array, slots, weights, dim: int, rare: pa.Array | None = None) -> pa.Array:
    """Vectors for a batch of term lists, by one hash lookup over the whole batch.

    ``rare`` has for each list the terms outside ``known`` with their slots and weights.
    """
    n = len(found)
    rows, words = _rows_of(found), found.flatten()
    codes = pc.fill_null(pc.index_in(words, value_set=known), -1).to_numpy(zero_copy_only=False)
    more = pa.array([]) if rare is None else rare.flatten()
    if len(more):
        term = more.field("term").dictionary_encode()
        # A term has one slot and weight, whichever list it comes from: its first place will do.
        _, first = np.unique(term.indices.to_numpy(zero_copy_only=False), return_index=True)
        other = pc.fill_null(pc.index_in(words, value_set=term.dictionary), -1).to_numpy(zero_copy_only=False)
        codes = np.where(codes < 0, np.where(other < 0, -1, other + len(known)), codes)
        slots = np.concatenate([slots, more.field("slot").to_numpy(zero_copy_only=False)[first]])
        weights = np.concatenate([weights, more.field("weight").to_numpy(zero_copy_only=False)[first]])
    n_terms = max(len(slots), 1)
    rows, codes = rows[codes >= 0], codes[codes >= 0].astype(np.int64)
    pairs, tf = np.unique(rows * n_terms + codes, return_counts=True)
    rows, codes = np.divmod(pairs, n_terms)
    values = (1 + np.log(tf)) * weights[codes]
    cells = np.bincount(rows * dim + slots[codes], weights=values, minlength=n * dim).reshape(n, dim)
    norms = np.sqrt(np.einsum("ij,ij->i", cells, cells))
    filled = norms > 0
    unit = (cells[filled] / norms[filled, None]).astype(np.float32)
    offsets = np.concatenate([[0], np.cumsum(np.where(filled, dim, 0))]).astype(np.int32)
    return pa.ListArray.from_arrays(
        pa.array(offsets), pa.array(unit.ravel()), mask=pa.array(~filled)
    ) if n else pa.array([], pa.list_(pa.float32()))


@dataclass(frozen=True)
class ModelEmbedder:
    """A user's model behind ``predict_batch_udf``.

    ``make_predict`` runs once per task and returns a function from an array of texts
    to an array of vectors; it gets at most ``batch_size`` texts at a time. A failed
    request fails the job, or with ``on_error="null"`` leaves its rows without a vector.
    """

    name: str
    make_predict: Callable[[], Callable[[np.ndarray], np.ndarray]]
    dim: int
    batch_size: int = REQUEST_TEXTS
    on_error: str = "fail"

    @property
    def embedder_id(self) -> str:
        return f"{self.name}-{self.dim}"

    def transform(
        self, df: DataFrame, text_col: str = "content", out: str = "embedding", key=None
    ) -> DataFrame:
        if self.on_error not in ("fail", "null"):
            raise ValueError(f"unknown error policy {self.on_error!r}")
        ship_package(df.sparkSession)
        make, dim, guarded = self.make_predict, self.dim, self.on_error == "null"

        def make_guarded():
            predict = make()

            def run(texts: np.ndarray) -> np.ndarray:
                try:
                    return np.asarray(predict(texts), dtype=np.float32)
                except Exception:
                    if not guarded:
                        raise
                    return np.full((len(texts), dim), np.nan, dtype=np.float32)

            return run

        embed = predict_batch_udf(
            make_guarded, return_type=T.ArrayType(T.FloatType()), batch_size=self.batch_size
        )
        vector = embed(F.coalesce(F.col(text_col), F.lit("")))
        df = df.withColumn(out, F.when(F.col(text_col).isNotNull(), vector))
        if not guarded:
            return df
        return df.withColumn(out, F.when(~F.isnan(F.get(out, F.lit(0))), F.col(out)))


def check_same_embedder(table_id: str | None, query_id: str | None) -> None:
    """Vectors of two embedders cannot be compared."""
    if table_id != query_id:
        raise ValueError(f"vectors were made by {table_id!r}, the question by {query_id!r}")

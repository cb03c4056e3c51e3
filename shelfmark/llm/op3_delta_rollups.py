"""Token counts as delta-maintained rollups.

A batch of changes inserts, revises and deletes documents. It is turned into signed counts, old
ones taken back and new ones added, which update additive totals by source, language and
tokenizer version. A batch is written aside first and then committed by one small file named
after it: only committed batches count, so that a batch may be applied again after a crash, or
by mistake, without any effect on the totals.

Under ``root``: ``states/<attempt>`` (per document what is counted now), ``deltas/<attempt>``
(signed totals) and ``commits/<batch id>`` (which attempt stands for the batch, and its number).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.bpe import encoder, tokenizer_path
from shelfmark.llm.words import documents, per_batch
from shelfmark.session import scratch_path

STATE = "doc_id long, source string, lang string, counts map<string,long>, live boolean, batch_no long"
DELTA = "source string, lang string, tokenizer string, n_docs long, n_tokens long"
COMMIT = "batch_id string, batch_no long, attempt string"

#: Adds a column of that name, the number of tokens of ``text`` (null: none), to a table.
Counter = Callable[[DataFrame, str], DataFrame]


def pattern_counter(pattern: str) -> Counter:
    """Counts the matches of a regular expression."""
    return lambda df, name: df.withColumn(name, F.coalesce(F.regexp_count("text", F.lit(pattern)), F.lit(0)).cast("long"))


def bpe_counter(path: str, spaced: bool) -> Counter:
    """Counts the ids that a vocabulary file gives, without special tokens."""

    def count(df: DataFrame, name: str) -> DataFrame:
        fields = [f for f in df.schema.fields]
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + f", `{name}` long"

        def run(batch):
            raw = encoder(path, spaced).encode([t or "" for t in batch.column("text").to_pylist()])
            return {f.name: batch.column(f.name) for f in fields} | {name: [len(r) // 4 for r in raw]}

        return per_batch(df, run, schema)

    return count


class TokenRollup:
    """Totals under ``root``, kept by the given tokenizers (name with version -> counter)."""

    def __init__(self, spark: SparkSession, root: str, tokenizers: dict[str, Counter]) -> None:
        self.spark, self.root, self.tokenizers = spark, root.rstrip("/"), tokenizers

    def _exists(self, path: str) -> bool:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{path}")
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(target)

    def commits(self) -> list:
        """Committed batches by number; one small row each."""
        if not self._exists("commits"):
            return []
        return self.spark.read.schema(COMMIT).option("recursiveFileLookup", "true").parquet(f"{self.root}/commits").orderBy("batch_no").collect()

    def _read(self, kind: str, schema: str) -> DataFrame:
        paths = [f"{self.root}/{kind}/{c.attempt}" for c in self.commits()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def apply(self, batch_id: str, changes: DataFrame) -> bool:
        """Apply a batch of rows (op, doc_id, source, lang, text, and optionally seq); False
        if it is committed already.

        op is insert, revise or delete; other and null ones are left out, as are null ids. An
        insert of a document that is there, or a revision of one that is not, sets it all
        the same; a delete of one that is not there does nothing. Of several changes of one
        document in a batch the one with the greatest seq holds, ties by op and text.
        """
        done = self.commits()
        if any(c.batch_id == batch_id for c in done):
            return False
        number, attempt = len(done), f"{len(done):08d}-{uuid.uuid4().hex}"
        seq = F.col("seq").cast("long") if "seq" in changes.columns else F.lit(0).cast("long")
        rows = changes.where("op IN ('insert', 'revise', 'delete') AND doc_id IS NOT NULL")
        rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "op", "source", "lang", "text", seq.alias("seq"))
        for i, counter in enumerate(self.tokenizers.values()):
            rows = counter(rows, f"count_{i}")
        counts = F.create_map(*[x for i, name in enumerate(self.tokenizers) for x in (F.lit(name), F.col(f"count_{i}"))])
        # The digest stands for the text from here on, so that no text is shuffled.
        rows = rows.select("doc_id", F.struct("seq", "op", F.xxhash64("text").alias("digest"), "source", "lang").alias("key"), counts.alias("counts"))
        chosen = rows.groupBy("doc_id").agg(F.max_by("counts", "key").alias("counts"), F.max("key").alias("key"))
        news = chosen.select("doc_id", "key.source", "key.lang", "counts", (F.col("key.op") != "delete").alias("live"), F.lit(number).cast("long").alias("batch_no"))
        # Written first, and read from there on, so that no text is counted twice.
        path = f"{self.root}/states/{attempt}"
        news.write.parquet(path)
        written = self.spark.read.schema(STATE).parquet(path)
        touched = self._read("states", STATE).join(written.select("doc_id"), "doc_id", "left_semi")
        last = touched.groupBy("doc_id").agg(F.max_by(F.struct("source", "lang", "counts", "live"), "batch_no").alias("s"))
        old = last.select("doc_id", "s.*").where("live")
        signed = old.withColumn("sign", F.lit(-1)).unionByName(written.where("live").drop("batch_no").withColumn("sign", F.lit(1)))
        cells = signed.select("source", "lang", "sign", F.explode("counts").alias("tokenizer", "n"))
        deltas = cells.groupBy("source", "lang", "tokenizer").agg(F.sum("sign").cast("long").alias("n_docs"), F.sum(F.col("sign") * F.col("n")).alias("n_tokens"))
        deltas.write.parquet(f"{self.root}/deltas/{attempt}")
        # Fails if another writer has committed the batch meanwhile.
        self.spark.createDataFrame([(batch_id, number, attempt)], COMMIT).coalesce(1).write.mode("errorifexists").parquet(f"{self.root}/commits/{uuid.uuid5(uuid.NAMESPACE_OID, batch_id)}")
        return True

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, n_docs, n_tokens over all committed batches; groups that
        have no document left are not shown."""
        sums = self._read("deltas", DELTA).groupBy("source", "lang", "tokenizer")
        return sums.agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).where("n_docs <> 0 OR n_tokens <> 0")


#: Words, and words apart from other signs.
WORDS_V1, WORDS_V2 = "[^\\x20\\x09-\\x0D]+", "[0-9A-Za-z\\x{80}-\\x{10FFFF}]+|[!-/:-@\\[-`{-~]"


def _changes(docs: DataFrame, batch: int) -> DataFrame:
    """Batch 0 inserts three quarters of the documents; batch 1 inserts the others, revises
    every tenth and deletes every tenth."""
    rows = docs.select("doc_id", "source", "lang", "text")
    if batch == 0:
        return rows.where("doc_id % 4 <> 3").withColumn("op", F.lit("insert"))
    op = F.when(F.col("doc_id") % 10 == 1, "revise").when(F.col("doc_id") % 10 == 2, "delete").when(F.col("doc_id") % 4 == 3, "insert")
    revised = F.when(F.col("doc_id") % 10 == 1, F.concat("text", F.lit(" Revised, once more."))).otherwise(F.col("text"))
    return rows.withColumn("op", op).where("op IS NOT NULL").withColumn("text", revised)


def _rollup(spark: SparkSession, sf_dir: str, tokenizers: dict[str, Counter]) -> DataFrame:
    docs = documents(spark, sf_dir)
    rollup = TokenRollup(spark, scratch_path(spark, "rollup"), tokenizers)
    for batch in (0, 1, 1):  # the second is sent twice
        rollup.apply(f"batch-{batch}", _changes(docs, batch))
    return rollup.totals()


def op3_delta_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rollup(spark, sf_dir, {"words.1": pattern_counter(WORDS_V1), "byte_bpe_50k.1": bpe_counter(tokenizer_path("byte_bpe_50k.json"), True)})


def word_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with counters that SQL has too."""
    return _rollup(spark, sf_dir, {"words.1": pattern_counter(WORDS_V1), "words.2": pattern_counter(WORDS_V2)})


SQL = r"""
WITH live AS (
  SELECT source, lang, CASE WHEN doc_id % 10 = 1 THEN text || ' Revised, once more.' ELSE text END AS text
  FROM documents WHERE doc_id IS NOT NULL AND doc_id % 10 <> 2
), counted AS (
  SELECT source, lang, 'words.1' AS tokenizer, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS n FROM live
  UNION ALL
  SELECT source, lang, 'words.2', coalesce(len(regexp_extract_all(text, '[0-9A-Za-z\x{80}-\x{10FFFF}]+|[!-/:-@\[-`{-~]')), 0) FROM live
)
SELECT source, lang, tokenizer, count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_tokens FROM counted GROUP BY source, lang, tokenizer
"""

"""Streaming vocabulary: ids assigned as text arrives.

A file stream of documents feeds ``foreachBatch``. The vocabulary is a log: batch
b appends its new words (``words/batch=b``), the occurrences of its words
(``counts/batch=b``) and, last, one manifest row (``manifest/batch=b``: the next
free id). A batch counts when its manifest is complete. It reads the tokens of the
log but writes only its own words, so a batch costs what it brings. After every
``compact_every`` batches the log up to there is also written as one table
(``base/batch=b``, complete when its own manifest is), from which readers start.

A replayed batch sees the same log before it and overwrites its own folders, so
the result is exactly-once, also after a crash between the folders. When each
micro-batch holds later documents than the one before, the vocabulary equals
``build_vocab`` over all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import SPECIAL_TOKENS
from ..operators.tokens import count_tokens
from ..operators.vocab import VOCAB_SCHEMA, first_places, new_words, special_tokens

WORDS = "token string, id bigint, first_doc bigint, first_pos bigint"
COUNTS = "token string, n bigint"
FIRSTS = "token string, n bigint, first_doc bigint, first_pos bigint"  # what counts/batch=b holds
MANIFEST = "next_id bigint, new_words bigint"
COMPACT_EVERY = 16


def _batches(spark: SparkSession, vocab_dir: str, kind: str) -> list[int]:
    """Batch ids whose folder of this kind is complete: a listing of names."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{vocab_dir}/{kind}")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{vocab_dir}/{kind}/batch=*/_SUCCESS"))
    out = [int(st.getPath().getParent().getName().split("=", 1)[1]) for st in found]
    return sorted(out)


class VocabLog:
    """The log as it stands before a batch (None: at its end)."""

    def __init__(self, spark: SparkSession, vocab_dir: str, before: int | None = None):
        self.spark, self.dir = spark, vocab_dir
        self.done = [b for b in _batches(spark, vocab_dir, "manifest") if before is None or b < before]
        whole = [b for b in _batches(spark, vocab_dir, "base") if b in self.done]
        self.base = whole[-1] if whole else None
        self.after = [b for b in self.done if self.base is None or b > self.base]

    def _deltas(self, kind: str, schema: str) -> DataFrame:
        paths = [f"{self.dir}/{kind}/batch={b}" for b in self.after]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _base(self) -> DataFrame:
        if self.base is None:
            return special_tokens(self.spark)
        return self.spark.read.schema(VOCAB_SCHEMA).parquet(f"{self.dir}/base/batch={self.base}")

    def next_id(self) -> int:
        if not self.done:
            return len(SPECIAL_TOKENS)
        return self.spark.read.schema(MANIFEST).parquet(f"{self.dir}/manifest/batch={self.done[-1]}").first()["next_id"]

    def tokens(self) -> DataFrame:
        return self._base().select("token").unionByName(self._deltas("words", WORDS).select("token"))

    def vocab(self) -> DataFrame:
        """The whole vocabulary in one aggregate by word: its row, and at most one
        count per batch. A word without a row (of no complete batch) is none."""
        none = F.lit(None).cast("bigint")
        rows = self._base().unionByName(self._deltas("words", WORDS).withColumn("n", F.lit(0).cast("bigint")))
        more = self._deltas("counts", COUNTS).select("token", none.alias("id"), "n", none.alias("first_doc"), none.alias("first_pos"))
        whole = rows.unionByName(more).groupBy("token").agg(
            F.max("id").alias("id"), F.sum("n").alias("n"), F.max("first_doc").alias("first_doc"), F.max("first_pos").alias("first_pos")
        )
        return whole.where("id IS NOT NULL")


def latest_vocab(spark: SparkSession, vocab_dir: str, before: int | None = None) -> DataFrame | None:
    """The vocabulary of the complete batches (optionally of those before one)."""
    log = VocabLog(spark, vocab_dir, before)
    return log.vocab() if log.done else None


def vocab_batch_writer(vocab_dir: str, key: str = "doc_id", text: str = "text", compact_every: int = COMPACT_EVERY):
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        log = VocabLog(spark, vocab_dir, before=batch_id)
        first = log.next_id()
        at = lambda kind: f"{vocab_dir}/{kind}/batch={batch_id}"
        # A batch is often one file: its texts are spread, so that not one task cuts them all.
        texts = batch.select(key, text).repartition(max(spark.sparkContext.defaultParallelism, 1))
        first_places(count_tokens(texts, key, text), key).write.mode("overwrite").parquet(at("counts"))
        firsts = spark.read.schema(FIRSTS).parquet(at("counts"))
        new_words(log.tokens(), first, firsts).write.mode("overwrite").parquet(at("words"))
        new = spark.read.schema(WORDS).parquet(at("words")).count()
        row = spark.range(0, 1, 1, 1).select(F.lit(first + new).cast("bigint").alias("next_id"), F.lit(new).cast("bigint").alias("new_words"))
        row.write.mode("overwrite").parquet(at("manifest"))
        if (batch_id + 1) % compact_every == 0:
            VocabLog(spark, vocab_dir, before=batch_id + 1).vocab().write.mode("overwrite").parquet(at("base"))

    return on_batch


def stream_vocab(
    spark: SparkSession,
    source_dir: str,
    vocab_dir: str,
    checkpoint_dir: str,
    schema: str = "doc_id bigint, text string",
    files_per_batch: int = 1,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Run the stream over what is in ``source_dir`` (availableNow) and
    return the vocabulary after it."""
    stream = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("recursiveFileLookup", "true")
        .parquet(source_dir)
    )
    q = (
        stream.writeStream.foreachBatch(vocab_batch_writer(vocab_dir, key, text))
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    out = latest_vocab(spark, vocab_dir)
    return spark.createDataFrame([], VOCAB_SCHEMA) if out is None else out


def write_in_order(docs: DataFrame, out_dir: str, chunks: int, key: str = "doc_id") -> list[str]:
    """Land a table as at most ``chunks`` files in key order, dated so that a
    file stream picks them up oldest first (tests, replays)."""
    # One write deals all rows to their parts; null keys are the first.
    parts = docs.repartitionByRange(chunks, key).sortWithinPartitions(key)
    parts.withColumn("part", F.spark_partition_id()).write.mode("overwrite").partitionBy("part").parquet(out_dir)
    paths = _dated_in_order(docs.sparkSession, out_dir)
    if not paths:
        # An empty table is one empty file, so that a stream over it has a batch.
        paths = [f"{out_dir}/part=0"]
        docs.coalesce(1).write.mode("overwrite").parquet(paths[0])
    return paths


def _dated_in_order(spark: SparkSession, out_dir: str) -> list[str]:
    """The folders part=0, 1, ... below out_dir, their files dated in that order,
    since a file stream takes the oldest first."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(out_dir)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    folders = [st.getPath() for st in fs.listStatus(path) if st.getPath().getName().startswith("part=")]
    folders.sort(key=lambda p: int(p.getName().split("=", 1)[1]))
    files = [st for p in folders for st in fs.listStatus(p) if st.getPath().getName().endswith(".parquet")]
    last = max((st.getModificationTime() for st in files), default=0)
    for i, st in enumerate(files):
        # Seconds apart and none in the future: some file systems keep no less.
        fs.setTimes(st.getPath(), last - 1000 * (len(files) - i), -1)
    return [p.toString() for p in folders]

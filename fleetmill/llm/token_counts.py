"""Token counts by a two-tier lookup on the map side.

The lengths of frequent words are broadcast as one hash table; a word that it
lacks is encoded once a worker and then found in the worker's cache. No word is
shuffled but for the table: each task counts the words of all its texts, and
sends those that it saw most. The table only saves work and never changes a
count; it holds ``table_words`` words at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import sliced, table
from .encoding import tokenizer_path, word_encoder

#: Words in the table, words that a task sends, and words that it counts at once.
TABLE_WORDS = 50_000
TASK_WORDS = 20_000
COUNTED_WORDS = 300_000


def frequent_words(docs: DataFrame, text: Column, words: int = TABLE_WORDS) -> list[str]:
    """The most frequent words of all texts, ASCII letters lower-cased, by what each task sees most; words of more than 32 bytes are left out."""

    def count(batches):
        from collections import Counter

        import pyarrow as pa

        seen: Counter = Counter()
        for batch in sliced(batches):
            for t in batch.column(0).to_pylist():
                seen.update(t.encode().lower().split())
                if len(seen) > COUNTED_WORDS:  # what is rare so far starts anew
                    seen = Counter(dict(seen.most_common(TASK_WORDS)))
        most = [(w.decode(), n) for w, n in seen.most_common(TASK_WORDS) if n > 1 and len(w) <= 32]
        if most:
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in most]), pa.array([n for _, n in most], pa.int64())], ["w", "n"])

    sent = docs.select(text.alias("t")).where("t is not null").mapInArrow(count, "w string, n bigint")
    counted = sent.groupBy("w").agg(F.sum("n").alias("n"))
    return [r.w for r in counted.orderBy(F.desc("n"), "w").limit(words).collect()]


def token_counts(docs: DataFrame, path: str, text: str = "text", limit: int = 2048) -> DataFrame:
    """docs, without the text, with n_bytes, n_tokens and over_limit; columns of these names are replaced.

    Null and empty texts have no bytes and no tokens; texts of any length are
    read whole. Rows are neither merged nor dropped, so repeated ones count
    alike; no column but ``text`` is looked at; an empty table gives no rows.
    """
    spark = docs.sparkSession
    encoder = word_encoder(path, "lengths")
    tier = {w.encode(): len(encoder.word_ids(w)) for w in frequent_words(docs, F.col(text))}
    lengths = spark.sparkContext.broadcast(tier)
    kept = [c for c in docs.columns if c not in ("n_bytes", "n_tokens", "over_limit")]
    others = [c for c in kept if c != text]

    def count(batches):
        import pyarrow as pa

        encoder = word_encoder(path, "lengths")
        encoder.keep(lengths.value)
        for batch in sliced(batches):
            texts = ["" if t is None else t for t in batch.column("__text").to_pylist()]
            n = encoder.encode_batch(texts, make=len, join=sum)
            columns = [batch.column(c) for c in others]
            size = [len(t.encode()) for t in texts]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(size, pa.int64()), pa.array(n, pa.int64())], [*others, "n_bytes", "n_tokens"])

    schema = docs.select(*others).withColumns({"n_bytes": F.lit(0).cast("bigint"), "n_tokens": F.lit(0).cast("bigint")}).schema
    counted = docs.select(*others, F.col(text).alias("__text")).mapInArrow(count, schema)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op3_token_counts(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts(docs, tokenizer_path("word_bpe_49k.json"))

"""Token counts through a cache of content digests."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..store import scratch_path, written
from .tokens import tidy

SCHEMA = "content_digest binary, tokenizer_digest string, n_tokens long"
_loaded: dict[str, object] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def tokenizer_digest(path: str) -> str:
    """Digest of the library, its version and the vocabulary file: counts of another version are other counts."""
    import sentencepiece

    with open(path, "rb") as f:
        return hashlib.sha256(f"sentencepiece {sentencepiece.__version__}\n".encode() + f.read()).hexdigest()


def normalised(text: Column) -> Column:
    """What counts depend on: the text as it is, null as empty. More would make texts equal whose counts differ."""
    return F.coalesce(text.cast("string"), F.lit(""))


def count_batches(batches: Iterator[pa.RecordBatch], path: str | None, version: str) -> Iterator[pa.RecordBatch]:
    import sentencepiece

    path = path or default_tokenizer()
    if path not in _loaded:
        _loaded[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    model = _loaded[path]
    for batch in batches:
        for first in range(0, batch.num_rows, 64):  # ids of so many texts at a time
            texts = batch.column(1).slice(first, 64).to_pylist()
            counts = [len(ids) for ids in model.encode(texts, num_threads=1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, 64), pa.array([version] * len(texts)), pa.array(np.array(counts, np.int64))], ["content_digest", "tokenizer_digest", "n_tokens"]
            )


def count_tokens(docs: DataFrame, limit: int = 4096, cache: str | None = None, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for each row of ``docs`` (doc_id, text).

    ``cache`` is a folder that holds counts by content and tokenizer digest, made where it is absent; runs look digests up
    in it, encode those it lacks and add their counts. Without it the cache is a new folder of this run. Each distinct text
    that the cache lacks is encoded once, whole; copies meet before the shuffle. Null texts count as empty, which have
    no tokens; repeated rows and null ids keep a row each; an empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    version = tokenizer_digest(tokenizer or default_tokenizer())
    folder = cache or scratch_path(spark, "token-cache")
    text = normalised(F.col("text"))
    digest = F.unhex(F.sha2(text.cast("binary"), 256))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest.alias("content_digest"), text.alias("content"))
    spark.createDataFrame([], SCHEMA).write.mode("append").parquet(folder)

    def stored() -> DataFrame:
        return spark.read.schema(SCHEMA).parquet(folder).where(F.col("tokenizer_digest") == version)

    distinct = keyed.select("content_digest", "content").dropDuplicates(["content_digest"])
    missing = distinct.join(stored().select("content_digest"), "content_digest", "left_anti")
    missing.mapInArrow(tidy(lambda batches: count_batches(batches, tokenizer, version)), SCHEMA).write.mode("append").parquet(folder)
    # Runs side by side may store a count twice. A table of single counts can be joined with a text that is copied very often:
    # its rows are then dealt over several tasks, which behind an aggregate they would not be.
    counts = written(stored().groupBy("content_digest").agg(F.max("n_tokens").alias("n_tokens")), "token-counts")
    sizes = docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest.alias("content_digest"), F.octet_length(text).cast("long").alias("n_bytes"))
    return sizes.join(counts, "content_digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))

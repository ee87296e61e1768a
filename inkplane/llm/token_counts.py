"""Token counts through a digest cache: only texts the cache doesn't know are encoded, each once.

The cache is a table (text_digest, tokenizer_digest, n_tokens). A text's digest is SHA-256 over its
normalised content: null becomes the empty text, and nothing else is changed, since the tokenizer
itself sees every other difference. The tokenizer's digest is SHA-256 over its file, so another
version never meets old counts. Counts of a run's misses are appended to the cache; a file of it is of one
version, so files of others are passed over by their statistics. A cache that is there but can't be read is an
error.

Texts move between executors by (doc_id, digest), never by digest alone, so that copies of one text
don't meet in one task; rows with equal id and text stand side by side there, and are encoded once.

Defined cases: null and empty texts have no tokens; repeated rows are each counted; rows without doc_id too;
an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import Scratch, arrow_batches, text_or_empty

_LOADED: dict[str, object] = {}


def _counter(path: str):
    """A function texts -> token counts; one tokenizer for each worker process."""
    if path not in _LOADED:
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            _LOADED[path] = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
        else:
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()
            _LOADED[path] = lambda texts: [len(x.ids) for x in model.encode_batch(texts, add_special_tokens=False)]
    return _LOADED[path]


def file_digest(path: str) -> str:
    return hashlib.sha256(Path(path).read_bytes()).hexdigest()


CACHE = "text_digest binary, n_tokens long, tokenizer_digest string"


def _read_cache(spark, path: str, version: str) -> DataFrame:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):  # the first run: nothing is stored yet
        return spark.createDataFrame([], CACHE).drop("tokenizer_digest")
    stored = spark.read.schema(CACHE).parquet(path)
    return stored.where(F.col("tokenizer_digest") == version).select("text_digest", "n_tokens").dropDuplicates(["text_digest"])


def count_tokens(docs: DataFrame, tokenizer: str, cache: str | None = None, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row of docs.

    tokenizer: its file (.model or .json). cache: the cache table's path, on a store all executors
    reach; a run without one begins a new cache in the shared folder.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    scratch, version = Scratch(spark, "token-counts"), file_digest(tokenizer)
    cache = cache or scratch.path("cache")
    texts = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    texts = texts.withColumn("text_digest", F.unhex(F.sha2("text", 256)))
    keys = scratch.save(texts.select("doc_id", "text_digest", F.octet_length("text").cast("long").alias("n_bytes")), "keys")
    known = _read_cache(spark, cache, version)
    misses = keys.groupBy("text_digest").agg(F.min("doc_id").alias("doc_id")).join(known, "text_digest", "left_anti")
    t, m = texts.alias("t"), misses.alias("m")
    to_encode = t.join(m, F.col("t.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("t.text_digest") == F.col("m.text_digest")), "left_semi")

    def run(batches):
        count, last = _counter(tokenizer), None
        for b in batches:
            digests = b.column(0).to_pylist()
            some = list({d: k for k, d in enumerate(digests) if d != last}.values())
            last = digests[-1] if digests else last
            if some:
                b = b.take(pa.array(some))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(count(b.column(1).to_pylist()), pa.int64())], ["text_digest", "n_tokens"])

    new = to_encode.select("text_digest", "text").mapInArrow(run, "text_digest binary, n_tokens long")
    new = new.groupBy("text_digest").agg(F.min("n_tokens").alias("n_tokens"))  # repeated rows
    new.withColumn("tokenizer_digest", F.lit(version)).write.mode("append").parquet(cache)
    counts = scratch.save(_read_cache(spark, cache, version), "counts")  # as a table, so that the join with a hot text can be split
    out = scratch.save(keys.join(counts, "text_digest", "left").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")), "result")
    scratch.drop("keys", "counts")
    return out

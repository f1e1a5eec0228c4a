"""Token counts through a digest cache.

A text's digest and the tokenizer's digest name a count.  Counts that the
cache holds are joined; of the rest each distinct text is encoded once, and
its count appended to the cache.  Texts that repeat are folded before the
shuffle, so a group of copies of any size costs one row per task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martflow.llm.frames import digest, text_bytes, written
from martflow.session import scratch_path

MODEL_BYTES = 64 << 20       # a tokenizer's file, sent to the executors
CACHE = "content binary, tokenizer string, n_tokens long"
ENCODE_BYTES = 1 << 20       # texts handed to the library at once


class Tokenizer:
    """A tokenizer file (.model: sentencepiece; .json: tokenizers), read on
    the driver; its version digests the file, the library and its release."""

    def __init__(self, path: str):
        self.kind = Path(path).suffix
        self.model = Path(path).read_bytes()
        if len(self.model) > MODEL_BYTES:
            raise ValueError(f"{path} is larger than {MODEL_BYTES} bytes")
        if self.kind == ".model":
            import sentencepiece as library
        elif self.kind == ".json":
            import tokenizers as library
        else:
            raise ValueError(f"no tokenizer library for {path}")
        told = f"{library.__name__}|{library.__version__}|ordinary text|".encode()
        self.version = hashlib.sha256(told + self.model).hexdigest()


def counter(kind: str, model: bytes) -> Callable[[list[str]], list[int]]:
    """Counts of a list of whole texts, without added tokens."""
    if kind == ".model":
        import sentencepiece
        library = sentencepiece.SentencePieceProcessor(model_proto=model)
        return lambda texts: [len(x) for x in library.encode(texts, num_threads=1)]
    import tokenizers
    library = tokenizers.Tokenizer.from_str(model.decode())
    library.no_truncation()
    library.no_padding()
    return lambda texts: [len(x.ids) for x in library.encode_batch(texts, add_special_tokens=False)]


def _encoded(texts: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """(content, tokenizer, n_tokens) of (content, text)."""
    kind, version = tokenizer.kind, tokenizer.version
    sent = texts.sparkSession.sparkContext.broadcast(tokenizer.model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(kind, sent.value)
        for b in batches:
            counts: list[int] = []
            some: list[str] = []
            size = 0
            for t in b.column(1):
                some.append(t.as_py())
                size += len(some[-1])
                if size >= ENCODE_BYTES:
                    counts += count(some)
                    some, size = [], 0
            counts += count(some) if some else []
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([version] * len(counts), pa.string()), pa.array(counts, pa.int64())],
                                             names=["content", "tokenizer", "n_tokens"])

    return texts.mapInArrow(run, CACHE)


def read_cache(spark: SparkSession, path: str, version: str) -> DataFrame | None:
    """(content, n_tokens) stored for a tokenizer; None if there is no cache.
    Runs that appended the same text at the same time count once."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return None
    stored = spark.read.schema(CACHE).parquet(path).where(F.col("tokenizer") == version)
    return stored.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def normalised(text: Column) -> Column:
    """What is encoded: null as the empty text, all else as it is, since any
    other change could change the count."""
    return F.coalesce(text, F.lit(""))


def fill_cache(docs: DataFrame, tokenizer: Tokenizer, path: str, text_col: str = "text") -> None:
    """Encode the distinct texts that the cache at ``path`` lacks and append them."""
    spark = docs.sparkSession
    text = normalised(F.col(text_col))
    # the partial aggregation folds copies before the shuffle
    distinct = docs.select(digest(text).alias("content"), text.alias("text")).dropDuplicates(["content"])
    stored = read_cache(spark, path, tokenizer.version)
    misses = distinct if stored is None else distinct.join(stored, "content", "left_anti")
    _encoded(misses, tokenizer).write.mode("append").parquet(path)


def token_counts(docs: DataFrame, tokenizer: Tokenizer, cache: str | None = None, id_col: str = "doc_id",
                 text_col: str = "text", limit: int = 4096) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit.

    ``cache`` is the folder of the stored counts (default: a new one in the
    shared folder).  Null texts are empty ones; repeated rows come back
    repeated; other columns aren't read; an empty table gives an empty result.
    """
    cache = cache or scratch_path(docs.sparkSession, "token-cache")
    fill_cache(docs, tokenizer, cache, text_col)
    text = normalised(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("doc_id"), text_bytes(text).alias("n_bytes"), digest(text).alias("content"))
    # written, so that the join's sides are plain shuffles and a large group of copies can be split
    stored = written(read_cache(docs.sparkSession, cache, tokenizer.version), "token-counts")
    return rows.join(stored, "content").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))

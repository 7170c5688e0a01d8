"""Token counts through a cache of content digests."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import small
from rivulet.util import stage

_PIECE_BYTES = 1 << 20
_CACHED = "digest binary, n_tokens long"


def content(text: Column) -> Column:
    """The content that is counted: the text as it is, of a null text the empty one."""
    return F.coalesce(text, F.lit(""))


def content_digest(text: Column) -> Column:
    return F.unhex(F.sha2(content(text).cast("binary"), 256))


def tokenizer_version(definition: str) -> str:
    """A digest of the tokenizer's definition and of the library that runs it."""
    import tokenizers

    return hashlib.sha256(f"{tokenizers.__version__}\n{definition}".encode()).hexdigest()


def read_cache(spark, path: str, version: str) -> DataFrame:
    """(digest, n_tokens) stored for one tokenizer version; a digest may be stored twice."""
    try:
        return spark.read.schema(_CACHED).parquet(f"{path}/tokenizer={version}")
    except AnalysisException:
        return spark.createDataFrame([], _CACHED)


def encode(texts: DataFrame, definition: str) -> DataFrame:
    """(digest, n_tokens) of rows of (digest, text)."""
    shared = texts.sparkSession.sparkContext.broadcast(definition)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(shared.value)
        tokenizer.no_truncation()
        tokenizer.no_padding()

        def sizes(part: list[str]) -> list[int]:
            found = tokenizer.encode_batch_fast(part, add_special_tokens=False)
            return [len(x.ids) for x in found]

        for batch in batches:
            counts, part, held = [], [], 0
            for text in batch.column("text"):
                part.append(text.as_py() or "")
                held += len(part[-1])
                if held > _PIECE_BYTES:
                    counts += sizes(part)
                    part, held = [], 0
            counts += sizes(part)
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array(counts, pa.int64())],
                names=["digest", "n_tokens"],
            )

    return texts.select("digest", "text").mapInArrow(count, _CACHED)


def count_tokens(
    docs: DataFrame, cache: str, definition: str, limit: int = 512
) -> DataFrame:
    """Tokens of every whole text; each distinct content is encoded once per tokenizer.

    `docs` needs `doc_id` and `text`; other columns are not looked at. `cache` is a folder
    that all executors reach; it holds a table per tokenizer version. Contents whose digest
    is stored there are not encoded; of the others, one row each is encoded and appended.
    Only digests are shuffled, unless there are too many distinct misses to broadcast: then
    texts are laid out by digest once. `definition` is the tokenizer's JSON.

    Returns a row per row: doc_id, n_bytes (UTF-8), n_tokens, over_limit. No begin, end or
    other special tokens are added, nothing is truncated or padded. A null text counts as
    the empty one (0 bytes, 0 tokens); rows without doc_id or repeated rows are rows like
    any others; an empty table gives an empty result. A run that fails may leave counts in
    the cache, which stay right; a digest stored twice has the same count both times.
    """
    spark = docs.sparkSession
    version = tokenizer_version(definition)
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        content(F.col("text")).alias("text"),
        content_digest(F.col("text")).alias("digest"),
    )
    seen = stage(
        keyed.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes")),
        "digests",
    )
    stored = read_cache(spark, cache, version)
    misses = stage(
        seen.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
        .join(stored, "digest", "left_anti"),
        "misses",
    )
    one = keyed.alias("d").join(
        small(misses).alias("m"),
        (F.col("d.digest") == F.col("m.digest"))
        & F.col("d.doc_id").eqNullSafe(F.col("m.doc_id")),
        "left_semi",
    )
    encode(one, definition).dropDuplicates(["digest"]).write.mode("append").parquet(
        f"{cache}/tokenizer={version}"
    )
    counts = read_cache(spark, cache, version).groupBy("digest").agg(
        F.max("n_tokens").alias("n_tokens")
    )
    return seen.join(counts, "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )

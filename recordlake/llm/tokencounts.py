"""Token counts by a cache of digests.

The cache is a parquet folder of (tokenizer, digest, n_tokens): the digest of a tokenizer's file, the
digest of a content, and the content's count. Contents are normalised by taking null as the empty text
and nothing else, as any other change could change the count. A run

1. digests all contents (no text is shuffled),
2. joins the distinct digests to the cache of this tokenizer,
3. encodes each distinct miss once and appends its count, and
4. joins all rows to the cache.

For step 3 one row stands for each missing digest. All other rows (copies and known contents) are marked
in a bitmap of fixed size. Rows it doesn't mark are encoded where they are read; only rows that it
marks, few more than the copies, are shuffled with their text to be sure.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from recordlake.llm.frames import bitmap_filter, map_arrow, settle

CACHE = "tokenizer string, digest string, n_tokens int"


@lru_cache(maxsize=2)
def _load(path: str):
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()
    return lambda texts: [len(x.ids) for x in model.encode_batch(texts, add_special_tokens=False)]


def tokenizer_digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def read_cache(spark, cache: str) -> DataFrame:
    """The cache, empty if there is none yet."""
    try:
        return spark.read.schema(CACHE).parquet(cache)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CACHE)


def _encode(rows: DataFrame, path: str, version: str) -> DataFrame:
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for lo in range(0, batch.num_rows, 128):
            part = batch.slice(lo, 128)
            n = _load(path)(part.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([version] * len(n)), part.column(0), pa.array(np.array(n, dtype=np.int32))],
                                             ["tokenizer", "digest", "n_tokens"])
    return map_arrow(rows.select("digest", "text"), run, CACHE)


def count_tokens(docs: DataFrame, path: str, cache: str, id: str = "doc_id", text: str = "text", limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of each row; new counts are appended to ``cache``.

    ``path`` is a .model file for sentencepiece or a .json file for tokenizers; no begin, end or added
    special tokens. Null and empty texts have 0 bytes and what the library gives for ''. Rows with null
    or repeated ids are counted like any other; other columns are not looked at.
    """
    spark = docs.sparkSession
    version = tokenizer_digest(path)
    own = docs.select(F.col(f"`{id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    named = own.withColumn("digest", F.sha2("text", 256)).withColumn("row", F.xxhash64("doc_id", "digest"))
    keyed = settle(named.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "digest", "row"), "digests")

    known = read_cache(spark, cache).where(F.col("tokenizer") == version).select("digest").distinct()
    first = keyed.groupBy("digest").agg(F.min("row").alias("row"))
    first = settle(first.join(known, "digest", "left_anti"), "first")
    others = keyed.join(first, ["digest", "row"], "left_anti").select("row")
    alone = bitmap_filter(named, "row", others, "row", keep=False)
    unsure = bitmap_filter(named, "row", others, "row").join(first, ["digest", "row"], "left_semi")
    misses = _encode(alone, path, version).unionByName(_encode(unsure.dropDuplicates(["digest"]), path, version))
    # rows that repeat both id and content pass the bitmap together
    settle(misses.groupBy("tokenizer", "digest").agg(F.min("n_tokens").alias("n_tokens")), "misses").write.mode("append").parquet(cache)

    counts = read_cache(spark, cache).where(F.col("tokenizer") == version).groupBy("digest").agg(F.min("n_tokens").alias("n"))
    return keyed.join(counts, "digest").select("doc_id", "n_bytes", F.col("n").cast("long").alias("n_tokens"),
                                               (F.col("n") > limit).alias("over_limit"))

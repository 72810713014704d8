"""The training-text pipeline: STAGES applied in turn to ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last return the
columns of ``documents``; the last returns each kept document's token ids. Texts are filtered where they are read:
no stage shuffles the texts of all documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlake.llm import bpe, toxicity
from recordlake.llm.decontaminate import drop_contaminated
from recordlake.llm.frames import bitmap_filter, settle, table
from recordlake.llm.lines import drop_boilerplate
from recordlake.llm.setsketch import near_duplicates

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go (op 8); the network is fitted to ``labels``, without the held-out ones."""
    net = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs.select(*COLUMNS), net, to="toxic_score").where(F.col("toxic_score") < toxicity.THRESHOLD).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of each source go (op 3); every document stays, n_chars follows the new text.

    Exact copies count as one page: they are for the next stage, which keeps one of them with its text.
    """
    return drop_boilerplate(docs, copies_once=True).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def _with_nodes(docs: DataFrame) -> DataFrame:
    """``docs`` with ``node``: the id, but another number for further texts of an id that repeats with different texts."""
    texts = F.xxhash64("text")
    clashing = settle(docs.where("doc_id is not null").groupBy("doc_id").agg(F.min(texts).alias("first"), F.max(texts).alias("last"))
                      .where("first <> last"), "clashing")
    if clashing.isEmpty():
        return docs.withColumn("node", F.col("doc_id"))
    # high numbers, so that of near-duplicates an id of its own stays first
    other = F.xxhash64("doc_id", "text").bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    alone = bitmap_filter(docs, "doc_id", clashing, "doc_id", keep=False).withColumn("node", F.col("doc_id"))
    unsure = bitmap_filter(docs, "doc_id", clashing, "doc_id").join(clashing.select("doc_id", "first"), "doc_id", "left")
    some = unsure.withColumn("node", F.when(F.col("first") != texts, other).otherwise(F.col("doc_id"))).drop("first")
    return settle(alone.unionByName(some), "nodes")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays (op 2).

    Groups are formed at a similarity of 0.8. Documents without words are in no group, and stay; so do
    rows with a null id. Of rows that repeat id and text the least stays; different texts of an id are documents of their own.
    """
    docs = _with_nodes(docs.select(*COLUMNS))
    marks = settle(near_duplicates(docs, id="node", percent=80).select(F.col("doc_id").alias("node"), "kept"), "marks").where("node is not null")
    gone = marks.where("not kept").select("node").distinct()
    repeated = marks.groupBy("node").count().where("count > 1").select("node")
    # only rows that share a bit with a removed or repeated id are shuffled
    looked_at = gone.unionByName(repeated)
    alone = bitmap_filter(docs, "node", looked_at, "node", keep=False).select(*COLUMNS)
    unsure = bitmap_filter(docs, "node", looked_at, "node")
    some = (unsure.where("node is not null").join(gone, "node", "left_anti")
            .groupBy("node").agg(F.min(F.struct(*COLUMNS)).alias("row")).select("row.*"))
    return alone.unionByName(some).unionByName(unsure.where("node is null").select(*COLUMNS))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain an item of ``benchmark`` go (op 6)."""
    return drop_contaminated(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and ids (little-endian unsigned 32-bit integers) of each document (op 4)."""
    rows = bpe.encode(docs.select("doc_id", "lang", "source", "text"), TOKENIZER)
    return rows.select("doc_id", "lang", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontaminate),
    ("bpe", encode),
]

#: A trained network decides the first stage, which SQL can't express; the tests compare each stage to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` through all stages; each result is written to the shared folder and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)

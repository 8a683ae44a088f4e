"""From raw documents to packed training sequences, one written stage after the other."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillbook.llm import langid, packing, substring
from tillbook.llm.common import load, merged, save
from tillbook.llm.near_dup import near_duplicates
from tillbook.llm.registry import ship

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def in_a_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language was found; texts that are null or have no letter go.

    Where no document says its language none can be found, and texts with a letter stay too.
    """
    ship(spark)
    learn_from = F.coalesce(langid.crc32(F.col("doc_id")) % 4 != 2, F.lit(False))
    found = langid.identify(docs, learn_from, carry=["text", "lang", "source", "n_chars"])
    return found.filter((F.col("lang_pred") != langid.UNKNOWN) | F.col("text").rlike(r"\p{L}")).select(COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies stays; rows without an id stay.

    Of rows that share both id and text the smallest stays. Rows that share an id but not the text are judged
    each by its own text: what is decided is joined by id and a hash of the text.
    """
    ship(spark)
    tag = F.xxhash64("text")
    found = near_duplicates(docs, tag=tag).groupBy("doc_id", "tag").agg(F.count("*").alias("rows"), F.bool_or("kept").alias("kept"))
    decided = save(found.filter("doc_id IS NOT NULL AND (rows > 1 OR NOT kept)"), "decided")
    tagged = docs.withColumn("tag", tag)
    left = merged(tagged.join(decided, ["doc_id", "tag"], "left_anti").select(COLUMNS))
    twice = decided.filter("kept").select("doc_id", "tag")
    if twice.isEmpty():
        return left
    one = tagged.join(twice, ["doc_id", "tag"]).groupBy("doc_id", "tag").agg(F.min(F.struct(*COLUMNS)).alias("row"))
    return left.unionByName(one.select("row.*"))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 20 words and more stay where they are first; documents with nothing left go.

    A document without such a passage keeps its text as it is.
    """
    ship(spark)
    found = substring.strip_repeats(docs, carry=["text", "lang", "source", "n_chars"])
    left = found.filter((F.col("n_removed") == 0) | (F.col("kept") != ""))
    text = F.when(F.col("n_removed") == 0, F.col("text")).otherwise(F.col("kept"))
    n_chars = F.when(F.col("n_removed") == 0, F.col("n_chars")).otherwise(F.char_length("kept").cast("long"))
    return merged(left.select("doc_id", text.alias("text"), "lang", "source", n_chars.alias("n_chars")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens: where each piece of each document lies."""
    ship(spark)
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(packing.pieces(docs, path, public_tokenizers.PATTERN))


STAGES = [
    ("language_id", in_a_language),
    ("near_dedup", one_of_each_group),
    ("substring_dedup", without_repeats),
    ("packing", packed),
]

# Language identification and near-duplicates by signatures have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the table documents, each written and read again."""
    ship(spark, sf_dir)
    docs = load(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = save(docs, name)
    return docs

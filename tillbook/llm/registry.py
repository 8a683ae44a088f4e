"""The registered queries of this subpackage and the SQL that gives the same rows."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

import tillbook
from tillbook.llm import ann, bpe, chat, html, langid, lm, merkle, negatives, packing, repeats, substring, topk
from tillbook.llm.common import load
from tillbook.llm.near_dup import near_duplicates
from tillbook.session import size_shuffles

_SHIPPED: set[str] = set()

# Operators write what they reuse to the shared folder; the shuffles behind it are of no more use then.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# A task holds several batches of whole texts at once: columns as read, rows on their way to Python and back.
_BATCHES = {"spark.sql.parquet.columnarReaderBatchSize": "1024", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


def ship(spark: SparkSession, sf_dir: str | None = None) -> SparkSession:
    """Give the Python workers this package, once per application; they may not see the driver's folders.
    Shuffles start with as many partitions as the tables in ``sf_dir`` ask for; batches are small."""
    spark.conf.set(_CLEANUP, "true")
    for key, value in _BATCHES.items():
        spark.conf.set(key, value)
    if sf_dir:
        size_shuffles(spark, sf_dir)
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        root = Path(tillbook.__file__).parent
        target = os.path.join(tempfile.mkdtemp(prefix="tillbook-"), "tillbook.zip")
        with zipfile.ZipFile(target, "w") as packed:
            for path in sorted(root.rglob("*.py")):
                packed.write(path, path.relative_to(root.parent))
        context.addPyFile(target)
        _SHIPPED.add(context.applicationId)
    return spark


def op1_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(load(ship(spark, sf_dir), sf_dir, "documents"))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = load(ship(spark, sf_dir), sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "\\### Assistant: </turn> ok"
    extra = spark.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(k).cast("long").alias("turn"), F.lit(role).alias("role"), F.lit(tricky).alias("text"))
        for k, role in enumerate(("user", "assistant"))
    ])).alias("x")).select("x.*")
    return chat.digest(chat.formatted(said.unionByName(extra)))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predictions(load(ship(spark, sf_dir), sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digests(load(ship(spark, sf_dir), sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(packing.pieces(load(ship(spark, sf_dir), sf_dir, "documents"), path, public_tokenizers.PATTERN))


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(load(ship(spark, sf_dir), sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(load(ship(spark, sf_dir), sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scores(load(ship(spark, sf_dir), sf_dir, "documents"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(load(ship(spark, sf_dir), sf_dir, "pages"))


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_products(load(ship(spark, sf_dir), sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digests(load(ship(spark, sf_dir), sf_dir, "documents"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.digests(load(ship(spark, sf_dir), sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mined(load(ship(spark, sf_dir), sf_dir, "embeddings"))


_QUERIES: list[Callable[[SparkSession, str], DataFrame]] = [
    op1_near_dup, op2_chat_format, op3_language_id, op4_substring_dedup, op5_packing, op6_ann, op7_bpe,
    op8_lm_score, op9_html_text, op10_topk, op11_suffix_dedup, op12_merkle, op13_hard_negatives,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_chat_format": chat.ORACLE, "op4_substring_dedup": substring.ORACLE, "op10_topk": topk.ORACLE,
        "op11_suffix_dedup": repeats.ORACLE, "op12_merkle": merkle.ORACLE, "op13_hard_negatives": negatives.ORACLE,
    }

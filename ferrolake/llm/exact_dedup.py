"""Exact deduplication by deterministic block naming (operator 9, DataFrame functions only).

Texts are cut into fixed-size blocks. The distinct blocks are sorted into dense integer names, then adjacent
names are paired and the distinct pairs are named in the same way, level by level, until each text has one
integer. Two texts get the same (level, name) if and only if they are identical after normalisation.

Blocks travel once: they are grouped under a 128-bit digest that keeps the smallest and the largest content
seen. If those differ for any digest, two contents share it, and the digests are taken anew with another
seed; so a name never stands for two contents, whatever the digest function.

Skew: equal blocks and pairs are combined in the map tasks before they are shuffled; names come back by
equi-joins, whose hot keys adaptive execution splits. No task ever holds the copies of one text.

Defined results: null text counts as empty; empty texts are equal to each other; only A-Z are lower-cased.
Of equal texts the row with the largest doc_id stays (null ids are smallest); of repeated rows with that
doc_id exactly one stays. An empty table gives an empty result. Other columns are ignored or passed through.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_key, ranked, stored

#: Code points in a block. Most web pages fit in one, so few levels follow.
BLOCK_CHARS = 4096


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def _blocks(text: Column, size: int) -> Column:
    return F.when(F.length(text) <= size, F.array(text)).otherwise(
        F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0)))


def _digest(block: Column, seed: int) -> list[Column]:
    return [F.xxhash64(F.lit(2 * seed), block), F.xxhash64(F.lit(2 * seed + 1), block)]


def _named(spark: SparkSession, df: DataFrame, by: list[str], level: int) -> DataFrame:
    """Distinct values of ``by`` with dense integer names in sort order."""
    return ranked(spark, df.select(*by).distinct(), by, "name", f"block-names-{level}")


def identities(spark: SparkSession, docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per input row: row_id, doc_id, text_sha256, and the identity (level, name) of its text."""
    norm = docs.select("doc_id", normalised(F.col("text")).alias("text"))
    seed = 0
    while True:
        h1, h2 = _digest(F.col("block"), seed)
        content = (norm.select(F.explode(_blocks(F.col("text"), block_chars)).alias("block"))
                   .groupBy(h1.alias("h1"), h2.alias("h2"))
                   .agg((F.min("block") != F.max("block")).alias("collided")))
        digests = stored(spark, content, "block-digests")
        if digests.where("collided").isEmpty():
            break
        seed += 1
    rows = stored(spark, norm.select(
        F.monotonically_increasing_id().alias("row_id"), "doc_id", F.sha2("text", 256).alias("text_sha256"),
        F.transform(_blocks(F.col("text"), block_chars),
                    lambda b: F.struct(*(h.alias(n) for h, n in zip(_digest(b, seed), ("h1", "h2"))))).alias("blocks"),
    ), "block-rows")

    names = _named(spark, digests, ["h1", "h2"], 0)
    now = stored(spark, rows.select("row_id", F.size("blocks").alias("n"), F.posexplode("blocks").alias("pos", "b"))
                 .select("row_id", "n", "pos", F.col("b.h1").alias("h1"), F.col("b.h2").alias("h2"))
                 .join(names, ["h1", "h2"]).select("row_id", "n", "pos", "name"), "block-level-0")
    ended = now.where("n = 1").select("row_id", F.lit(0).alias("level"), "name")
    level, longest = 0, now.agg(F.max("n")).first()[0] or 1
    now = now.where("n > 1")
    while longest > 1:
        level, longest = level + 1, (longest + 1) // 2
        pairs = stored(spark, now.groupBy("row_id", F.expr("n div 2 + n % 2").alias("n"), F.expr("pos div 2").alias("pos"))
                       .agg(F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("left"),
                            F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("right")),
                       f"block-pairs-{level}")
        now = stored(spark, pairs.join(_named(spark, pairs, ["left", "right"], level), ["left", "right"])
                     .select("row_id", "n", "pos", "name"), f"block-level-{level}")
        ended = ended.unionByName(now.where("n = 1").select("row_id", F.lit(level).alias("level"), "name"))
        now = now.where("n > 1")
    return rows.select("row_id", "doc_id", "text_sha256").join(ended, "row_id")


def exact_groups(spark: SparkSession, docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256 and row_id."""
    named = stored(spark, identities(spark, docs, block_chars), "identities")
    groups = named.groupBy("level", "name").agg(F.count("*").alias("group_size"),
                                                F.max(F.struct("doc_id", "row_id")).alias("keep"))
    return named.join(groups, ["level", "name"]).select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col("row_id") == F.col("keep.row_id")).alias("kept"), "text_sha256", "row_id")


def exact_dedup(spark: SparkSession, docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` that stay, all columns. Repeated (doc_id, text) rows count as one."""
    kept = exact_groups(spark, docs, block_chars).where("kept").select(
        id_key("doc_id").alias("__id"), F.col("text_sha256").alias("__sha"))
    rows = docs.select(id_key("doc_id").alias("__id"), F.sha2(normalised(F.col("text")), 256).alias("__sha"),
                       F.struct(*(docs[c] for c in docs.columns)).alias("__row"))
    one = rows.join(kept, ["__id", "__sha"], "left_semi").dropDuplicates(["__id", "__sha"])
    return one.select("__row.*")

"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree (operator 10).

Every document is hashed into a block of its source; blocks hold about 256 documents, or the square root of
the source's documents where that is more. A source whose target is r
times its size is drawn floor(r) whole times; the rest is drawn from its blocks in a keyed permutation: whole
blocks while they fit, then, inside the block where the target falls, documents in hash order, each that still
fits. What is left goes on to the next blocks that hold a document small enough, until none does; then the
smallest document left is added if that is nearer. Each (epoch, block) is one draw, so a source has an exact quota of
draws. The quotas of all sources are split between the two halves of the output shards by a multivariate
hypergeometric draw, and so on down to single shards; shards then own disjoint ranges of each source's
permuted draws, and a shard's rows are shuffled by a keyed hash.

Scale: one task sees a block's documents, or a row per block of a source (about sqrt(documents) each), and
the tree holds one row per node and source. Sums over documents are combined before the shuffle. All random
choices are keyed hashes or generators seeded by the node, so reruns and retried tasks agree.

Defined results: size counts runs of characters other than space and \\t-\\r; null text has size 0; null
source is a source of its own, last; sources of size 0 have target 0; repeated rows of one doc_id are taken
together; an empty table gives an empty result. Extra columns pass through ``mixed`` untouched.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ranked, stored

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (1.0, 2.0, 3.0)
#: A target never exceeds so many times the source's size.
MOST_REPEATS = 3
#: Words in an output shard; the number of shards follows the input.
SHARD_WORDS = 4_000_000
#: A block holds so many documents, or the square root of its source's documents where that is more.
BLOCK_DOCS = 256
SEED = 17
#: So many blocks of a source are filled document by document in one task.
FILL_BLOCKS = 4
_NODE = "lo long, hi long, sid long, quota long"


def _key(seed: int):
    return F.xxhash64(F.lit(seed), "doc_id")


def _with_source(df: DataFrame) -> DataFrame:
    """Two never-null columns that stand for the source, null last in their order."""
    return df.withColumns({"no_source": F.col("source").isNull(), "source_key": F.coalesce("source", F.lit(""))})


def sizes(docs: DataFrame, seed: int = SEED) -> DataFrame:
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    return _with_source(docs.select("doc_id", "source", words.alias("size"), _key(seed).alias("key")))


def targets(spark: SparkSession, sized: DataFrame, weights: tuple = WEIGHTS, most: float = MOST_REPEATS) -> DataFrame:
    """One row per source: sid, no_source, source_key, source_size, n_docs, target.

    The sources' weights share all words; where that exceeds ``most`` times a source's size, the target stops
    there and the excess goes to the others by weight. Each round is one aggregation and sends two sums.
    """
    totals = sized.groupBy("no_source", "source_key").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    by = ranked(spark, totals, ["no_source", "source_key"], "sid", "mix-sources")
    w = F.array(*(F.lit(float(x)) for x in weights))
    by = by.withColumns({"weight": F.get(w, (F.col("sid") % len(weights)).cast("int")),
                         "most": F.col("source_size") * float(most)})
    total = float(by.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    while total:
        capped = F.col("most") <= F.lit(level) * F.col("weight")
        fixed, free = by.agg(F.sum(F.when(capped, F.col("most")).otherwise(0.0)),
                             F.sum(F.when(~capped, F.col("weight")).otherwise(0.0))).first()
        now = (total - fixed) / free if free else level
        if now <= level:
            break
        level = now
    return by.withColumn("target", F.least(F.col("most"), F.lit(level) * F.col("weight"))).drop("weight", "most")


def _split(seed: int):
    def split(key: tuple, node: pd.DataFrame) -> pd.DataFrame:
        """A node's quotas, parted between the shards lo..mid and mid..hi."""
        lo, hi = key
        if hi - lo == 1:
            return node
        mid = (lo + hi) // 2
        node = node.sort_values("sid")
        quota = node["quota"].to_numpy(dtype=np.int64)
        rng = np.random.default_rng([seed, lo, hi])
        share = int(quota.sum()) * (mid - lo) / (hi - lo)
        take = math.floor(share) + int(rng.random() < share - math.floor(share))
        left = np.zeros_like(quota)
        rest, need = int(quota.sum()), take
        for i, q in enumerate(quota):  # marginal by marginal: any number of draws
            rest -= int(q)
            left[i] = rng.hypergeometric(int(q), rest, need) if need and q else 0
            need -= int(left[i])
        return pd.DataFrame({"lo": [lo, mid] * len(quota), "hi": [mid, hi] * len(quota),
                             "sid": np.repeat(node["sid"].to_numpy(), 2),
                             "quota": np.column_stack([left, quota - left]).ravel()})

    return split


def _fill(some: pd.DataFrame) -> pd.DataFrame:
    """The documents of a few blocks (each about sqrt of a source's) that fit into ``need`` one after the other."""
    some = some.sort_values(["pos", "key"])
    left, taken = float(some["need"].iloc[0]), []
    for at, size in enumerate(some["size"]):
        if size <= left:
            left -= size
            taken.append(at)
    return some.iloc[taken][["sid", "block", "key", "size"]]


def _filled(spark: SparkSession, placed: DataFrame, blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(whole blocks, documents of others) that the last pass over each source takes.

    Each round leaps over whole blocks while they fit and fills the next few document by document. Only blocks
    with a document that may fit are looked at, and the rest shrinks, so a few rounds do.
    """
    state = blocks.groupBy("sid").agg(F.max("rest").alias("need")).withColumn("after", F.lit(0).cast("long"))
    whole = stored(spark, blocks.where("words = 0 and epochs = 0").select("sid", "block"), "mix-whole")
    parts = stored(spark, placed.select("sid", "block", "key", "size").limit(0), "mix-parts")
    order = Window.partitionBy("sid").orderBy("pos")
    sized = placed.select("sid", "block", "key", "size")
    while True:
        open_ = blocks.join(state, "sid").where("pos >= after and least <= need")
        open_ = open_.withColumn("until", F.sum("words").over(order)).withColumn("fits", F.col("until") <= F.col("need"))
        open_ = open_.withColumns({"nth": F.row_number().over(Window.partitionBy("sid", "fits").orderBy("pos")),
                                   "leapt": F.max(F.when(F.col("fits"), F.col("until")).otherwise(0)).over(Window.partitionBy("sid"))})
        now = stored(spark, open_.where(F.col("fits") | (F.col("nth") <= FILL_BLOCKS)).select(
            "sid", "block", "pos", "fits", (F.col("need") - F.col("leapt")).alias("need")), "mix-open")
        if now.isEmpty():
            break
        inside = (sized.join(now.where("not fits").select("sid", "block", "pos", "need"), ["sid", "block"])
                  .groupBy("sid", "block", "pos", "need", "key").agg(F.sum("size").alias("size")))
        more = stored(spark, inside.groupBy("sid").applyInPandas(_fill, "sid long, block long, key long, size long"), "mix-filled")
        whole, parts = whole.unionByName(now.where("fits").select("sid", "block")), parts.unionByName(more)
        seen = now.groupBy("sid").agg(F.min("need").alias("now"), (F.max("pos") + 1).alias("next"))
        used = more.groupBy("sid").agg(F.sum("size").alias("used"))
        state = stored(spark, state.join(seen, "sid", "left").join(used, "sid", "left").select(
            "sid", (F.coalesce("now", "need") - F.coalesce("used", F.lit(0))).alias("need"), F.coalesce("next", "after").alias("after")), "mix-need")
    # No document left fits: one more if that is nearer.
    near = state.where("need > 0").select("sid", "need")
    spare = (sized.join(near, "sid").join(whole, ["sid", "block"], "left_anti")
             .groupBy("sid", "need", "block", "key").agg(F.sum("size").alias("size")).where("size > 0 and size - need < need")
             .join(parts, ["sid", "block", "key"], "left_anti").groupBy("sid").agg(F.min(F.struct("size", "key", "block")).alias("d")))
    parts = parts.unionByName(spare.select("sid", "d.block", "d.key", "d.size"))
    return whole, stored(spark, parts.drop("size"), "mix-taken")


def mix_plan(spark: SparkSession, docs: DataFrame, weights: tuple = WEIGHTS, most: int = MOST_REPEATS,
             shard_words: int = SHARD_WORDS, seed: int = SEED) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, draws, parts). Documents: doc_id, size, sid, block, key, source_size, target and more.
    Draws: sid, block, shard, epoch, partial. A partial draw takes only the documents whose keys are in parts."""
    sized = stored(spark, sizes(docs, seed), "mix-sizes")
    sources = stored(spark, targets(spark, sized, weights, most), "mix-targets")
    n_blocks = F.ceil(F.col("n_docs") / F.greatest(F.lit(float(BLOCK_DOCS)), F.sqrt("n_docs"))).cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + 1e-12)).otherwise(0)
    sources = sources.withColumns({"n_blocks": n_blocks, "epochs": epochs.cast("long")})
    sources = sources.withColumn("rest", F.greatest(F.lit(0.0), F.col("target") - F.col("epochs") * F.col("source_size")))
    placed = sized.join(sources, ["no_source", "source_key"]).withColumn("block", F.pmod(F.xxhash64("key"), "n_blocks"))

    order = Window.partitionBy("sid").orderBy(F.xxhash64(F.lit(seed), "block"), "block")
    least = F.min(F.when(F.col("size") > 0, F.col("size")))
    blocks = placed.groupBy("sid", "block", "n_blocks", "epochs", "rest").agg(F.sum("size").alias("words"), least.alias("least"))
    blocks = blocks.withColumns({"pos": F.row_number().over(order).cast("long") - 1,
                                 "held": F.count("*").over(Window.partitionBy("sid"))})
    blocks = stored(spark, blocks, "mix-blocks")
    whole, parts = _filled(spark, placed, blocks)

    drawn = (blocks.join(whole.withColumn("whole", F.lit(1).cast("long")), ["sid", "block"], "left")
             .join(parts.select("sid", "block").distinct().withColumn("partly", F.lit(True)), ["sid", "block"], "left"))
    drawn = drawn.withColumns({"whole": F.coalesce("whole", F.lit(0).cast("long")), "partly": F.coalesce("partly", F.lit(False))})
    drawn = drawn.withColumn("n_draws", F.col("epochs") + F.col("whole") + F.col("partly").cast("long"))
    drawn = stored(spark, drawn.select("sid", "block", "pos", "held", "epochs", "n_draws", "partly"), "mix-drawn")

    # The tree: exact quotas of draws, from all shards down to each one.
    words = sources.agg(F.sum("source_size")).first()[0] or 0
    shards = max(1, math.ceil(words / shard_words))
    nodes = drawn.groupBy("sid").agg(F.sum("n_draws").alias("quota")).select(
        F.lit(0).cast("long").alias("lo"), F.lit(shards).cast("long").alias("hi"), "sid", "quota")
    for _ in range(math.ceil(math.log2(shards)) if shards > 1 else 0):
        nodes = nodes.groupBy("lo", "hi").applyInPandas(_split(seed), _NODE)
    upper = F.sum("quota").over(Window.partitionBy("sid").orderBy("lo"))
    owned = nodes.withColumn("until", upper).where("quota > 0").select(
        "sid", F.col("lo").alias("shard"), F.explode(F.expr("sequence(until - quota, until - 1)")).alias("draw"))
    draws = drawn.where("n_draws > 0").select("*", F.explode(F.expr("sequence(0L, n_draws - 1)")).alias("epoch"))
    draws = draws.withColumn("draw", F.col("epoch") * F.col("held") + F.col("pos"))
    # The last pass draws its blocks in permuted order, but a block whose part is empty leaves a gap: close it.
    draws = draws.withColumn("draw", F.row_number().over(Window.partitionBy("sid").orderBy("draw")).cast("long") - 1)
    draws = draws.join(owned, ["sid", "draw"]).select(
        "sid", "block", "shard", "epoch", (F.col("partly") & (F.col("epoch") == F.col("n_draws") - 1)).alias("partial"))
    return placed, stored(spark, draws, "mix-draws"), parts


def mix_report(spark: SparkSession, docs: DataFrame, **params) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, taken (words, repeats counted)."""
    placed, draws, parts = mix_plan(spark, docs, **params)
    times = draws.where("not partial").groupBy("sid", "block").agg(F.count("*").alias("times"))
    out = (placed.join(times, ["sid", "block"], "left")
           .join(parts.withColumn("once", F.lit(1)), ["sid", "block", "key"], "left"))
    taken = F.col("size") * (F.coalesce("times", F.lit(0)) + F.coalesce("once", F.lit(0)))
    return out.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def mixed(spark: SparkSession, docs: DataFrame, seed: int = SEED, **params) -> DataFrame:
    """The mix itself: every drawn row with all columns of ``docs``, repeats included, plus shard and order_key."""
    placed, draws, parts = mix_plan(spark, docs, seed=seed, **params)
    sources = placed.select("no_source", "source_key", "sid", "n_blocks").distinct()
    rows = _with_source(docs.select("source", _key(seed).alias("key"), F.struct(*(docs[c] for c in docs.columns)).alias("row")))
    rows = rows.join(sources, ["no_source", "source_key"]).withColumn("block", F.pmod(F.xxhash64("key"), "n_blocks"))
    taken = (rows.join(draws, ["sid", "block"])
             .join(parts.withColumn("once", F.lit(True)), ["sid", "block", "key"], "left").where("not partial or once"))
    return taken.select("row.*", F.col("shard").alias("__shard"),
                        F.xxhash64(F.lit(seed), "shard", "key", "epoch").alias("__order"))


def write_shards(spark: SparkSession, docs: DataFrame, path: str, **params) -> None:
    """One folder per shard, its rows in shuffled order. Rows of a shard are split over tasks by order key."""
    out = mixed(spark, docs, **params)
    (out.repartitionByRange("__shard", "__order").sortWithinPartitions("__shard", "__order")
     .withColumnRenamed("__shard", "shard").drop("__order").write.partitionBy("shard").parquet(path))

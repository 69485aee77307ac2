"""Merkle manifest of a dataset with nested-interval labels (operator 12).

Every document is a leaf, hashed over its fields; the leaves of a source, in the order of doc_id, form a tree in
which runs of 16 consecutive nodes become one node, level by level; the sources' subroots form one more such tree
up to the root. A node is labelled with the interval ``[lo, hi)`` of the leaf ranks it covers. Nodes of level ``l``
fall into buckets ``lo div 16^l``, so an ancestor is attached by an equi-join on (tree, bucket) whose intervals
contain one another, and a node's siblings are its parent's interval without its own: those that end before it
and those that begin after it. Paths are handed down from the root, a level at a time, so the joins touch
N/16 + N/256 + ... rows before the one over the leaves, and a hot source is split like any other rows.

Defined results: a null field is hashed as ``-``, an empty text as ``0:``; a node's hash is that of its children's hex digests, one after the other. Rows with the same doc_id are leaves of
their own, ordered by their hash; a null doc_id comes first and is never tampered with. The null source is a source.
An empty table gives no rows (and no root). Other columns of the input, whatever their names, are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ranked, stored

FAN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ABOVE = "array<struct<left:string,right:string>>"


def _framed(value: Column) -> Column:
    """A value with its length in front, so that no two lists of values give the same bytes; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(**instead: Column) -> Column:
    """The leaf of a row; ``instead`` replaces fields by other columns."""
    return F.sha2(F.concat(*[_framed(instead.get(f, F.col(f))) for f in FIELDS]), 256)


def _inputs(nodes: Column) -> Column:
    """Digests are concatenated as they are: they are all of one length, so nothing has to part them."""
    return F.array_join(F.transform(nodes, lambda k: k["hash"]), "")


def leaves_of(spark: SparkSession, docs: DataFrame, candidate: Column | None) -> tuple[DataFrame, DataFrame]:
    """Leaves (tree, n, lo, hi, hash, doc_id, candidate) and the number of each source's tree.

    Texts are read once; what is sorted, ranked and joined afterwards are hashes.
    """
    hashed = stored(spark, docs.select("doc_id", "source", leaf_hash().alias("hash"),
                                       (F.lit(None).cast("string") if candidate is None else candidate).alias("candidate")), "merkle-leaf")
    placed = ranked(spark, hashed, ["source", "doc_id", "hash"], "rank", "merkle-ranked")
    # One row per source, whatever a source holds: counted before it is shuffled.
    spans = placed.groupBy("source").agg(F.min("rank").alias("base"), F.count("*").alias("n"))
    spans = ranked(spark, spans, ["base"], "tree", "merkle-source")
    found = placed["source"].eqNullSafe(spans["source"])
    return placed.join(spans, found).select("tree", "n", (F.col("rank") - F.col("base")).alias("lo"),
                                            (F.col("rank") - F.col("base") + 1).alias("hi"), "hash", "doc_id", "candidate"), spans


def _bucket(width: int) -> Column:
    return F.floor(F.col("lo") / F.lit(width)) if width < 2**52 else F.lit(0)


def levels_of(spark: SparkSession, leaves: DataFrame) -> list[DataFrame]:
    """Nodes (tree, n, lo, hi, hash, kids) of every level; a tree of n leaves ends at the first level with 16^l >= n."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    levels, width = [leaves], 1
    while width < most:
        several, width = levels[-1].where(F.col("n") > width), width * FAN
        runs = several.groupBy("tree", "n", _bucket(width).alias("bucket")).agg(
            F.sort_array(F.collect_list(F.struct("lo", "hi", "hash"))).alias("kids"))  # at most 16
        levels.append(stored(spark, runs.select("tree", "n", F.col("kids")[0]["lo"].alias("lo"), F.element_at("kids", -1)["hi"].alias("hi"),
                                                F.sha2(_inputs(F.col("kids")), 256).alias("hash"), "kids"), "merkle-level"))
    return levels


def roots_of(levels: list[DataFrame]) -> DataFrame:
    """The one node that remains of every tree: (tree, hash)."""
    tops = [nodes.where(F.col("n") <= F.lit(FAN**at)).select("tree", "hash") for at, nodes in enumerate(levels)]
    out = tops[0]
    for t in tops[1:]:
        out = out.unionByName(t)
    return out


def paths_of(spark: SparkSession, levels: list[DataFrame], seeds: DataFrame) -> DataFrame:
    """The leaves with ``above``: per level up to the root, what is hashed before and after the node itself.

    ``seeds`` (tree, above, ...) holds what lies above each tree's root; its further columns are handed down too.
    """
    extra = [c for c in seeds.columns if c not in ("tree", "above")]
    parents = None
    for at in reversed(range(len(levels))):
        nodes, width = levels[at], FAN**at
        paths = nodes.where(F.col("n") <= F.lit(width)).join(seeds, "tree")
        if parents is not None:
            over = parents.select(F.col("tree").alias("_tree"), _bucket(width * FAN).alias("_bucket"), F.col("lo").alias("_lo"),
                                  F.col("hi").alias("_hi"), F.col("kids").alias("_kids"), F.col("above").alias("_above"), *extra)
            held = ((F.col("tree") == F.col("_tree")) & (_bucket(width * FAN) == F.col("_bucket"))
                    & (F.col("_lo") <= F.col("lo")) & (F.col("hi") <= F.col("_hi")))
            inner = nodes.where(F.col("n") > F.lit(width)).join(over, held)
            step = F.struct(_inputs(F.filter("_kids", lambda k: k["hi"] <= F.col("lo"))).alias("left"),
                            _inputs(F.filter("_kids", lambda k: k["lo"] >= F.col("hi"))).alias("right"))
            inner = inner.withColumn("above", F.concat(F.array(step), F.col("_above"))).select(*nodes.columns, "above", *extra)
            paths = inner.unionByName(paths.select(*inner.columns))
        if at:
            parents = stored(spark, paths, "merkle-path")
    return paths


def folded(leaf: Column, above: Column) -> Column:
    """The root that follows from a leaf and its siblings."""
    return F.aggregate(above, leaf, lambda h, x: F.sha2(F.concat(x["left"], h, x["right"]), 256))


def manifest(spark: SparkSession, docs: DataFrame, candidate: Column | None = None) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, above (its siblings, from the leaf up), candidate.

    ``candidate`` is a leaf to be checked against the manifest, worked out from the same row (see ``leaf_hash``).
    """
    leaves, _ = leaves_of(spark, docs, candidate)
    levels = levels_of(spark, leaves)
    subroots = stored(spark, roots_of(levels), "merkle-subroot")
    n_trees = subroots.count()
    top = levels_of(spark, subroots.select(F.lit(0).cast("long").alias("tree"), F.lit(n_trees).cast("long").alias("n"), F.col("tree").alias("lo"),
                                           (F.col("tree") + 1).alias("hi"), "hash"))
    seed = roots_of(top).select("tree", F.lit(None).cast(_ABOVE).alias("above"), F.col("hash").alias("root"))
    seed = F.broadcast(seed.withColumn("above", F.array().cast(_ABOVE)))  # one row
    seeds = paths_of(spark, top, seed).select(F.col("lo").alias("tree"), "above", F.col("hash").alias("subroot"), "root")
    out = paths_of(spark, levels, stored(spark, seeds, "merkle-seed"))
    return out.select("doc_id", F.col("hash").alias("leaf"), "subroot", "root", "above", "candidate")


def tampered(every: int = 5) -> Column:
    """The contract's tampering: where ``every`` divides crc32 of the decimal doc_id, the text's A-Z are lower-cased."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0
    return F.when(hit, leaf_hash(text=F.translate(F.col("text"), UPPER, LOWER)))


def merkle_report(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: its digests, and whether a leaf made from the possibly tampered text leads to the root."""
    m = manifest(spark, docs, tampered())
    proof = F.sha2(F.array_join(F.transform("above", lambda x: F.concat(x["left"], x["right"])), ""), 256)
    m = m.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"),
                 folded(F.coalesce("candidate", "leaf"), F.col("above")).alias("folded_root"))
    return m.withColumn("verified", F.col("folded_root") == F.col("root"))

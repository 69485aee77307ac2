"""Near-duplicate detection with BagMinHash bands and verified multiset overlap (operator 3).

A text's words are its lower-cased runs without white space; its multiset holds every run of five words
(all words, if they are fewer). Two texts are linked if their multisets' weighted Jaccard similarity
(sum of smaller counts / sum of larger counts) is 0.8 or more; a class is a connected component of links.

1. Texts with equal words form one text class, so exact copies are worked on once.
2. Every text class gets a BagMinHash signature of 96 slots, cut into 24 bands of 4: a pair at 0.8 shares a
   bucket with a probability of 0.999997, at 0.9 of 1 - 10^-11.
3. Buckets that hold the same text classes as another one are dropped; each of the others is resolved exactly,
   without writing out its pairs. A bucket of at most ``BUCKET_TEXTS`` texts and ``BUCKET_CHARS`` characters is
   resolved in one place: pairs in order of their estimated similarity, skipping those that are in one
   component already and those that share an earlier bucket, so it yields a spanning forest of its verified
   links. The first bands go first; later ones only see buckets that still hold several components.
4. Larger buckets are resolved with pivots, in rounds of joins: each picks a few pivots, its smallest components
   first; pivots are compared with all others in the bucket that are not in their component yet, then they leave
   it. So every pair of a bucket is verified or already connected, and a group of near copies costs about
   one comparison per member instead of one per pair. Pivots per round grow fourfold, so rounds are few.
5. A comparison first estimates the similarity from the whole signatures (below 0.55 it can't be 0.8: six
   standard deviations), then counts the overlap of the texts exactly.
6. Components are merged by distributed hooking and pointer jumping; only row counts reach the driver.

No bucket is cut or sampled. Skew: bucket minima and counts are combined before they are shuffled; members meet
pivots in equi-joins that adaptive execution splits; a task holds at most one bucket of bounded size. Each
step's state is stored in the shared folder.

Defined results: null text counts as empty; texts without words are equal to each other; a null doc_id is
smallest; class_id is the smallest doc_id of the class and ``kept`` marks one of its rows with that doc_id;
an empty table gives an empty result. Columns other than doc_id and text are ignored or passed through.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bagminhash import mix, signatures
from .common import id_key, ranked, stored

WORDS = 5
SIMILAR = 0.8
BANDS, ROWS = 24, 4
SLOTS = BANDS * ROWS
#: Estimates below this are not verified.
ESTIMATE = 0.55
#: The largest bucket that is resolved in one place.
BUCKET_TEXTS, BUCKET_CHARS = 4096, 8_000_000
#: Bands that are resolved before the others.
FIRST_BANDS = 4
_BATCH_WORDS = 200_000
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)
_MARK = "id long, hash long, key1 long, key2 long, chars long, signature array<int>"


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def shingle_multisets(docs: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(elements, weights, owners) of the documents' hashed shingles, equal ones counted together."""
    lens = np.fromiter(map(len, docs), np.int64, len(docs))
    names = {w: xxhash.xxh3_64_intdigest(w) for w in set().union(*docs)}
    flat = np.fromiter(map(names.__getitem__, chain.from_iterable(docs)), np.uint64, int(lens.sum()))
    begin = np.cumsum(lens) - lens
    n = np.where(lens >= WORDS, lens - WORDS + 1, np.minimum(lens, 1))
    owners = np.repeat(np.arange(len(docs)), n)
    at = begin[owners] + np.arange(len(owners)) - np.repeat(np.cumsum(n) - n, n)
    end = (begin + lens)[owners]
    got = np.zeros(len(owners), np.uint64)
    for j in range(WORDS):
        there = at + j < end
        got[there] += (flat[at[there] + j] + np.uint64(j + 1)) * _FACTORS[j]
    # 44 bits of the shingle's hash below the owner's number: one plain sort brings equal ones together.
    got = np.sort((mix(got) >> np.uint64(20)) | (owners.astype(np.uint64) << np.uint64(44)))
    where = np.flatnonzero(np.concatenate([[True], got[1:] != got[:-1]])) if len(got) else np.zeros(0, np.int64)
    return mix(got[where] & np.uint64(2**44 - 1)), np.diff(np.append(where, len(got))), (got[where] >> np.uint64(44)).astype(np.int64)


def _marked(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for p in parts:
        at, texts = 0, p["text"].tolist()
        while at < len(texts):
            some, total = [], 0
            while at + len(some) < len(texts) and total < _BATCH_WORDS:
                some.append(words_of(texts[at + len(some)]))
                total += len(some[-1])
            slots = signatures(*shingle_multisets(some), len(some), SLOTS)
            keys = [xxhash.xxh3_128_intdigest(" ".join(w)) for w in some]
            rows = p.iloc[at:at + len(some)]
            yield pd.DataFrame({
                "id": rows["id"].to_numpy(), "hash": rows["hash"].to_numpy(),
                "key1": np.array([k >> 64 for k in keys], np.uint64).astype(np.int64),
                "key2": np.array([k & (2**64 - 1) for k in keys], np.uint64).astype(np.int64),
                "chars": [len(t) for t in texts[at:at + len(some)]],
                "signature": [s if w else None for s, w in zip((slots >> np.uint64(32)).astype(np.uint32).view(np.int32), some)],
            })
            at += len(some)


def multiset(text: str) -> Counter:
    words = words_of(text)
    return Counter(zip(*(words[i:] for i in range(WORDS)))) if len(words) >= WORDS else Counter([tuple(words)] if words else [])


def similarity(x: Counter, y: Counter) -> float:
    """Weighted Jaccard similarity of two multisets."""
    both = sum((x & y).values())
    return both / max(1, x.total() + y.total() - both)


def overlap(a: str, b: str) -> float:
    return similarity(multiset(a), multiset(b))


@F.pandas_udf(T.DoubleType())
def _overlap(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    of = lru_cache(maxsize=64)(multiset)  # a pivot comes again and again
    for a, b in parts:
        yield pd.Series([similarity(of(x), of(y)) for x, y in zip(a, b)], dtype="float64")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(id_key("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("hash", F.xxhash64("text"))


def _merged(spark: SparkSession, labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (c, label) after links (a, b) between labels: the smallest label of a component stays."""
    edges = stored(spark, links, "near-edges")
    while not edges.isEmpty():
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = stored(spark, both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
                       .select("node", F.least("node", "near").alias("up")), "near-hooks")
        while True:  # pointer jumping, two hops at a time: trees become stars
            above = hooks.select(F.col("node").alias("up"), F.col("up").alias("top"))
            once = hooks.join(above, "up").select("node", F.col("top").alias("up"))
            twice = once.join(above, "up").select("node", F.col("top").alias("up"), (F.col("top") != F.col("up")).alias("moved"))
            jumped = stored(spark, twice, "near-jumps")
            hooks = jumped.select("node", "up")
            if jumped.where("moved").isEmpty():
                break
        to = hooks.select(F.col("node").alias("label"), "up")
        labels = stored(spark, labels.join(to, "label", "left").select("c", F.coalesce("up", "label").alias("label")), "near-labels")
        one, two = hooks.select(F.col("node").alias("a"), F.col("up").alias("x")), hooks.select(F.col("node").alias("b"), F.col("up").alias("y"))
        edges = stored(spark, edges.join(one, "a").join(two, "b").where("x != y")
                       .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "near-edges")
    return labels


def _alike(a: str, b: str) -> Column:
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e))
    return same / F.lit(SLOTS)


def text_classes(spark: SparkSession, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows: id, hash, key1, key2; classes: c, key1, key2, first_id, first_hash, chars, signature)."""
    marks = stored(spark, _texts(docs).select("id", "hash", "text").mapInPandas(_marked, _MARK), "near-marks")
    groups = marks.groupBy("key1", "key2").agg(F.min(F.struct("id", "hash")).alias("first"), F.max("chars").alias("chars"), F.min("signature").alias("signature"))
    keys = ranked(spark, groups.select("key1", "key2", F.col("first.id").alias("first_id"), F.col("first.hash").alias("first_hash"), "chars", "signature"),
                  ["key1", "key2"], "c", "near-classes")
    return marks.select("id", "hash", "key1", "key2"), stored(spark, keys, "near-numbered")


def _buckets(spark: SparkSession, classes: DataFrame, labels: DataFrame, low: int, high: int) -> DataFrame:
    """(band, value, c, label, n, total): the rows of the buckets of bands low to high - 1 that hold two components
    or more, one of equal buckets."""
    bands = F.transform(F.sequence(F.lit(low), F.lit(high - 1)), lambda i: F.struct(
        i.alias("band"), F.xxhash64(F.slice("signature", i * ROWS + 1, ROWS)).alias("value")))
    rows = (classes.where("signature is not null").join(labels, "c").select("c", "label", "chars", F.explode(bands).alias("at"))
            .select("c", "label", "chars", "at.band", "at.value"))
    shared = (rows.groupBy("band", "value").agg(F.count("*").alias("n"), F.sum("chars").alias("total"),
                                                F.min("label").alias("least"), F.max("label").alias("most"),
                                                F.bit_xor(F.xxhash64("c")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "c")).alias("y"))
              .where("least != most").groupBy("n", "total", "x", "y").agg(F.min(F.struct("band", "value")).alias("at")))
    one = stored(spark, shared.select("at.band", "at.value", "n", "total"), "near-buckets")
    return stored(spark, rows.select("c", "label", "band", "value").join(one, ["band", "value"]), "near-members")


def spanning_links(found: np.ndarray, labels: np.ndarray, texts: list[str], band: int, similar: float) -> list[tuple[int, int]]:
    """A spanning forest of the links between components among the texts of one bucket: likely pairs first. Pairs
    that share an earlier band's bucket are left to that one."""
    n = len(texts)
    pairs = []
    for i in range(n - 1):
        same = found[i + 1:] == found[i]
        like = same.sum(axis=1)
        here = np.flatnonzero((like >= ESTIMATE * SLOTS) & (labels[i + 1:] != labels[i]))
        if len(here) and band:
            here = here[~same[here, :band * ROWS].reshape(len(here), band, ROWS).all(axis=2).any(axis=1)]
        if len(here):
            pairs.append(np.stack([like[here], np.full(len(here), i), i + 1 + here]).astype(np.int32))
    if not pairs:
        return []
    like, one, two = np.concatenate(pairs, axis=1)
    labels, sets, links = labels.copy(), {}, []
    for level in range(SLOTS, 0, -1):
        for i, j in zip(one[like == level].tolist(), two[like == level].tolist()):
            if labels[i] == labels[j]:
                continue
            for k in (i, j):
                if k not in sets:
                    sets[k] = multiset(texts[k])
            if similarity(sets[i], sets[j]) >= similar:
                labels[labels == labels[j]] = labels[i]
                links.append((i, j))
    return links


def _resolved(similar: float):
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Buckets arrive as runs of rows, which may go over from one batch to the next."""
        kept: list[pd.DataFrame] = []

        def links_of(rows: pd.DataFrame) -> Iterator[tuple[int, int]]:
            c, labels, texts, bands = rows["c"].to_numpy(), rows["label"].to_numpy(), rows["text"].tolist(), rows["band"].to_numpy()
            found = np.stack(rows["signature"].to_numpy())
            cut = np.flatnonzero(np.concatenate([[True], (np.diff(rows["value"].to_numpy()) != 0) | (np.diff(bands) != 0), [True]]))
            for lo, hi in zip(cut[:-1], cut[1:]):
                for i, j in spanning_links(found[lo:hi], labels[lo:hi], texts[lo:hi], int(bands[lo]), similar):
                    yield int(min(c[lo + i], c[lo + j])), int(max(c[lo + i], c[lo + j]))

        for p in parts:
            if not len(p):
                continue
            p = pd.concat([*kept, p], ignore_index=True)
            last = (p["value"] == p["value"].iloc[-1]) & (p["band"] == p["band"].iloc[-1])
            kept = [p[last]]
            if not last.all():
                yield pd.DataFrame(links_of(p[~last].reset_index(drop=True)), columns=["a", "b"], dtype="int64")
        if kept:
            yield pd.DataFrame(links_of(kept[0].reset_index(drop=True)), columns=["a", "b"], dtype="int64")

    return run


def _between_labels(labels: DataFrame, links: DataFrame) -> DataFrame:
    named = links.join(labels.select(F.col("c").alias("a"), F.col("label").alias("x")), "a").join(
        labels.select(F.col("c").alias("b"), F.col("label").alias("y")), "b")
    return named.where("x != y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def component_labels(spark: SparkSession, docs: DataFrame, classes: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """(c, label): the component of every text class."""
    labels = classes.select("c", F.col("c").alias("label"))
    for low, high in ((0, FIRST_BANDS), (FIRST_BANDS, BANDS)):
        members = _buckets(spark, classes, labels, low, high)
        firsts = classes.join(members.select("c").distinct(), "c", "left_semi").select(
            "c", F.col("first_id").alias("id"), F.col("first_hash").alias("hash"), "signature")
        texts = _texts(docs).join(firsts, ["id", "hash"]).select("c", "signature", "text")
        texts = stored(spark, texts.dropDuplicates(["c"]), "near-texts")  # repeated rows come once
        fits = (F.col("n") <= BUCKET_TEXTS) & (F.col("total") <= BUCKET_CHARS)
        small = (members.where(fits).select("band", "value", "c", "label").join(texts, "c")
                 .repartition("band", "value").sortWithinPartitions("band", "value"))
        links = stored(spark, small.mapInPandas(_resolved(similar), "a long, b long").distinct(), "near-links")
        labels = _merged(spark, labels, _between_labels(labels, links))
        over = members.where(~fits).select("band", "value", "c")
        if not over.isEmpty():
            labels = _pivoted(spark, texts, over, labels, similar)
    return labels


def _pivoted(spark: SparkSession, texts: DataFrame, members: DataFrame, labels: DataFrame, similar: float) -> DataFrame:
    """``labels`` after all links within buckets of any size."""
    sigs, texts = texts.select("c", "signature"), texts.select("c", "text")
    tested: DataFrame | None = None
    pivots_each = 1
    while True:
        now = stored(spark, members.join(labels, "c"), "near-now")
        of_label = now.groupBy("band", "value", "label").agg(F.count("*").alias("n"), F.min(F.struct(F.xxhash64("c"), "c")).alias("m"))
        of_label = of_label.select("band", "value", "label", "n", F.col("m.c").alias("pivot"))
        picks = of_label.select("*", F.explode(F.sequence(F.lit(1), F.lit(pivots_each))).alias("draw"))
        picked = (picks.groupBy("band", "value", "draw")
                  .agg(F.min(F.struct("n", F.xxhash64("draw", "label"), "pivot", "label")).alias("p"),
                       F.min("label").alias("low"), F.max("label").alias("high"))
                  .where("low != high").select("band", "value", F.col("p.pivot").alias("pivot"), F.col("p.label").alias("own")).distinct())
        picked = stored(spark, picked, "near-pivots")
        if picked.isEmpty():
            return labels
        met = now.join(picked, ["band", "value"]).where("label != own")
        pairs = met.select(F.least("c", "pivot").alias("a"), F.greatest("c", "pivot").alias("b")).distinct()
        pairs = stored(spark, pairs.join(tested, ["a", "b"], "left_anti") if tested else pairs, "near-pairs")
        tested = tested.unionByName(pairs) if tested else pairs
        likely = (pairs.join(sigs.select(F.col("c").alias("a"), F.col("signature").alias("sa")), "a")
                  .join(sigs.select(F.col("c").alias("b"), F.col("signature").alias("sb")), "b")
                  .where(_alike("sa", "sb") >= ESTIMATE).select("a", "b"))
        likely = stored(spark, likely, "near-likely")
        sure = (likely.join(texts.select(F.col("c").alias("a"), F.col("text").alias("ta")), "a")
                .join(texts.select(F.col("c").alias("b"), F.col("text").alias("tb")), "b")
                .select("a", "b", _overlap("ta", "tb").alias("s")).where(F.col("s") >= similar).select("a", "b"))
        labels = _merged(spark, labels, _between_labels(labels, sure.distinct()))
        active = picked.select("band", "value").distinct()
        members = now.select("band", "value", "c").join(active, ["band", "value"], "left_semi").join(
            picked.select("band", "value", F.col("pivot").alias("c")), ["band", "value", "c"], "left_anti")
        members = stored(spark, members, "near-members")
        pivots_each = min(4 * pivots_each, 1024)


def near_groups(spark: SparkSession, docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """One row per input row: doc_id, class_id, class_size, text_class_id (equal words), kept; and id, hash."""
    rows, classes = text_classes(spark, docs)
    labels = component_labels(spark, docs, classes, similar)
    named = stored(spark, rows.join(classes.join(labels, "c").select("key1", "key2", "label", "first_id"), ["key1", "key2"])
                   .select(F.monotonically_increasing_id().alias("row"), "id", "hash", "label", "first_id"), "near-named")
    groups = stored(spark, named.groupBy("label").agg(F.min(F.struct("id", "row")).alias("keep"), F.count("*").alias("class_size")), "near-groups")
    real = lambda c: F.when(F.col(c) != -(2**63), F.col(c))
    return named.join(groups, "label").select(
        real("id").alias("doc_id"), real("keep.id").alias("class_id"), "class_size", real("first_id").alias("text_class_id"),
        (F.col("row") == F.col("keep.row")).alias("kept"), "id", "hash")


def near_dedup(spark: SparkSession, docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """The rows of ``docs`` that stay, one per class, all columns. Repeated (doc_id, text) rows count as one."""
    kept = near_groups(spark, docs, similar).where("kept").select(F.col("id").alias("__id"), F.col("hash").alias("__hash"))
    rows = docs.select(id_key("doc_id").alias("__id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("__hash"),
                       F.struct(*(docs[c] for c in docs.columns)).alias("__row"))
    return rows.join(kept, ["__id", "__hash"], "left_semi").dropDuplicates(["__id", "__hash"]).select("__row.*")

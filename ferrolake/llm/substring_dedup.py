"""Removal of repeated byte strings by a distributed difference-cover algorithm (operator 2).

Every byte covered by a string of ``LENGTH`` bytes that also starts anywhere else (another document or the
same one) is removed. Suffixes need to be compared to that depth only, so naming ends after two levels:

1. Sample: suffixes at the places of a perfect difference cover modulo 307 (18 residues: for any two places
   there is a shift below 307 that brings both into the sample). Each is named by its next 94 bytes. Any
   repeated string of 400 bytes holds such a pair of equal names, so only sampled suffixes with a neighbour of
   equal name in the sorted order go on.
2. Recursion on ties only: a tied suffix is named again by the 247 bytes from its place on, and by the 247 bytes
   up to the end of its first name. A repeated string of 400 bytes around it contains one of the two in full,
   so suffixes that are tied in neither go no further.
3. Merge of the remaining suffixes: all starts within 306 bytes before a suffix that is still tied are named by
   their next 400 bytes; those with an equal neighbour are the repeated strings.

Names are fingerprints of the named bytes: 64 bits where they only propose, 96 bits where they decide. They
are range-partitioned by their leading bits, sorted, and adjacent ones compared, on packed numpy arrays.
A name that occurs several times among those a task holds is settled there and sent on once, so a passage that fills a
third of the corpus sends few names to its partition. The names of step 3 are compared in three turns, a third of their range at a time. Texts are shuffled once, where
equal texts become one row (all their bytes are covered); those with ties only are stored. No suffix array of
the whole corpus is ever in one place.

Defined results: null text counts as empty; texts are UTF-8 bytes; matches never cross documents; repeated rows
(equal id and text too) are documents of their own, so they match each other; documents shorter than 400 bytes
lose nothing; an empty table gives an empty result. Columns other than doc_id and text are not read. Work and
memory per document are linear in its length, in segments of 1 MB.
"""

from __future__ import annotations


from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bagminhash import mix
from .common import id_key, stored

LENGTH = 400
FIELD = 17
PERIOD = FIELD * FIELD + FIELD + 1  # 307
PREFIX = LENGTH - PERIOD + 1  # 94
MIDDLE = (LENGTH + PREFIX + 1) // 2  # 247
#: Names that one task sorts at a time.
BUCKET_NAMES = 1_500_000
#: Names that a task holds before it packs them.
HELD_NAMES = 2_000_000
#: Parts in which the names of all starts near ties are compared: they are the bulk of the shuffle.
TURNS = 3
_SEGMENT = 1 << 20
_PACKED = "bucket int, keys binary, counts binary, places binary, names binary"
_FOUND = "key long, places array<int>"
Places = Callable[[int, np.ndarray | None], np.ndarray]


@lru_cache(maxsize=1)
def difference_cover() -> np.ndarray:
    """Singer's difference set: exponents, modulo 307, of the powers of a generator of GF(17^3) that lie in a plane."""
    q = FIELD
    for c in np.ndindex(q, q, q):  # x^3 = c0 x^2 + c1 x + c2
        a, found, seen = (0, 1, 0), [], 1
        while a != (0, 0, 1) and seen < q**3:
            if a[0] == 0:
                found.append(seen % PERIOD)
            a = ((a[1] + a[0] * c[0]) % q, (a[2] + a[0] * c[1]) % q, (a[0] * c[2]) % q)
            seen += 1
        residues = {0, *found}
        if seen == q**3 - 1 and len(residues) == q + 1:
            return np.array(sorted(residues))
    raise AssertionError("no generator")


def sampled(n: int) -> np.ndarray:
    """Places of the cover whose prefix lies within n bytes, for texts that can hold a match."""
    if n < LENGTH:
        return np.zeros(0, np.int64)
    at = (np.arange(0, n, PERIOD)[:, None] + difference_cover()).ravel()
    return at[at <= n - PREFIX]


_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_BASES = (0x5851F42D4C957F2D, 0x2545F4914F6CDD1D)


@lru_cache(maxsize=4)
def _powers(which: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random words for byte values, powers of the base and of its inverse modulo 2^64."""
    base = _BASES[which]
    inverse = pow(base, -1, 2**64)
    n = _SEGMENT + LENGTH
    out = []
    for b in (base, inverse):
        p = np.full(n, b, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return mix((np.arange(256, dtype=np.uint64) + np.uint64(256 * which + 1)) * _GOLDEN), *out


def names(data: np.ndarray, places: np.ndarray, length: int, which: int) -> np.ndarray:
    """64-bit names of data[p : p + length] at sorted places."""
    words, powers, inverses = _powers(which)
    out = np.empty(len(places), np.uint64)
    for begin in range(0, len(data), _SEGMENT):
        lo, hi = np.searchsorted(places, (begin, begin + _SEGMENT))
        if lo == hi:
            continue
        part = data[begin:begin + _SEGMENT + length]
        sums = np.concatenate([[np.uint64(0)], np.cumsum(words[part] * powers[:len(part)])])
        at = places[lo:hi] - begin
        out[lo:hi] = mix((sums[at + length] - sums[at]) * inverses[at])
    return out


def _packed(places_of: Places, length: int, wide: bool, buckets: int, turn: int, turns: int) -> Callable:
    """Names of the chosen places of (key, data, places) rows, those of this turn's range, packed by range of names."""
    def rows(keys: list[int], at: list[np.ndarray], one: list[np.ndarray], two: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        owner = np.repeat(np.arange(len(at), dtype=np.int32), [len(x) for x in at])
        places, own_keys = np.concatenate(at).astype(np.uint32), np.array(keys, np.int64)
        got = [np.concatenate(x) for x in ((one, two) if wide else (one,))]
        tied, send = _neighbours(got)
        yield _rows(own_keys, owner[send], places[send], [x[send] for x in got], buckets)
        if tied.any():  # settled here; they ride along to a partition of their own keys
            yield _rows(own_keys, owner[tied], places[tied], None, buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, at, one, two, held = [], [], [], [], 0
            for key, raw, given in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
                data = np.frombuffer(raw.as_buffer(), np.uint8)
                places = places_of(len(data), given.values.to_numpy() if given.is_valid else None)
                if not len(places):
                    continue
                name = names(data, places, length, 0)
                if turns > 1:
                    mine = (name >> np.uint64(32)) * np.uint64(turns) >> np.uint64(32) == turn
                    places, name = places[mine], name[mine]
                keys.append(key)
                at.append(places)
                one.append(name)
                if wide:
                    two.append((names(data, places, length, 1) >> np.uint64(32)).astype(np.uint32))
                held += len(places)
                if held >= HELD_NAMES:
                    yield from rows(keys, at, one, two)
                    keys, at, one, two, held = [], [], [], [], 0
            if held:
                yield from rows(keys, at, one, two)

    return run


def _neighbours(got: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(names that occur again, one of each name), both as masks."""
    order = np.argsort(got[0]) if len(got) == 1 else np.lexsort(got[::-1])
    same = np.ones(max(0, len(order) - 1), dtype=bool)
    for x in got:
        x = x[order]
        same &= x[1:] == x[:-1]
    tied, first = np.zeros(len(order), dtype=bool), np.ones(len(order), dtype=bool)
    tied[order[1:][same]] = True
    tied[order[:-1][same]] = True
    first[order[1:][same]] = False
    return tied, first


def _rows(keys: np.ndarray, owner: np.ndarray, places: np.ndarray, got: list[np.ndarray] | None, buckets: int) -> pa.RecordBatch:
    n = np.uint64(buckets)
    if got is None:
        bucket = (mix(keys.astype(np.int64).view(np.uint64))[owner] % n).astype(np.int32)
    else:
        bucket = ((got[0] >> np.uint64(32)) * n >> np.uint64(32)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    owner, places, bucket = owner[order], places[order], bucket[order]
    got = None if got is None else [x[order] for x in got]
    cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
    out: list[list] = [[], [], [], [], []]
    for lo, hi in zip(cut[:-1], cut[1:]):
        begin = np.flatnonzero(np.concatenate([[True], owner[lo + 1:hi] != owner[lo:hi - 1]]))
        for column, value in zip(out, (
                int(bucket[lo]), keys[owner[lo:hi][begin]].astype(np.int64).tobytes(), np.diff(np.append(begin, hi - lo)).astype(np.uint32).tobytes(),
                places[lo:hi].tobytes(), None if got is None else b"".join(x[lo:hi].tobytes() for x in got))):
            column.append(value)
    return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), *(pa.array(c, pa.binary()) for c in out[1:])],
                                      names=["bucket", "keys", "counts", "places", "names"])


def _compared(wide: bool) -> Callable:
    """Sorts the names of one range and keeps the places whose name has an equal neighbour."""
    def run(group: pa.Table) -> pa.Table:
        key, place, got, known_key, known_place = [], [], [], [], []
        for keys, counts, places, name in zip(*(group.column(c) for c in ("keys", "counts", "places", "names"))):
            k = np.repeat(np.frombuffer(keys.as_buffer(), np.int64), np.frombuffer(counts.as_buffer(), np.uint32))
            p = np.frombuffer(places.as_buffer(), np.uint32)
            if name.is_valid:
                key.append(k)
                place.append(p)
                raw = name.as_buffer()
                got.append([np.frombuffer(raw, np.uint64, len(p)), *([np.frombuffer(raw, np.uint32, len(p), 8 * len(p))] if wide else [])])
            else:
                known_key.append(k)
                known_place.append(p)
        if key:
            tied, _ = _neighbours([np.concatenate(x) for x in zip(*got)])
            known_key.append(np.concatenate(key)[tied])
            known_place.append(np.concatenate(place)[tied])
        k, p = np.concatenate(known_key), np.concatenate(known_place).astype(np.int32)
        order = np.lexsort((p, k))
        k, p = k[order], p[order]
        new = np.concatenate([[True], (k[1:] != k[:-1]) | (p[1:] != p[:-1])]) if len(k) else np.zeros(0, bool)
        k, p = k[new], p[new]
        begin = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
        return pa.table({"key": pa.array(k[begin], pa.int64()),
                         "places": pa.ListArray.from_arrays(pa.array(np.append(begin, len(k)).astype(np.int32)), pa.array(p, pa.int32()))})

    return run


def repeated(spark: SparkSession, rows: DataFrame, places_of: Places, length: int, wide: bool, buckets: int, name: str,
             turns: int = 1) -> DataFrame:
    """(key, places): the places, of those chosen in (key, data, places) rows, whose next ``length`` bytes occur at
    another chosen place. Ranges of names are compared in ``turns``, so that only a part is on disk at a time."""
    found = None
    for turn in range(turns):
        packed = rows.select("key", "data", "places").mapInArrow(_packed(places_of, length, wide, buckets, turn, turns), _PACKED)
        part = stored(spark, packed.groupBy("bucket").applyInArrow(_compared(wide), _FOUND), name + "-found")
        found = part if found is None else found.unionByName(part)
    return stored(spark, found.groupBy("key").agg(
        F.array_sort(F.flatten(F.collect_list("places"))).alias("places")), name)  # at most the places of one text


def _from_cover(n: int, ties: np.ndarray | None) -> np.ndarray:
    return sampled(n)


def _onward(n: int, ties: np.ndarray) -> np.ndarray:
    return ties[ties <= n - MIDDLE].astype(np.int64)


def _backward(n: int, ties: np.ndarray) -> np.ndarray:
    return ties[ties >= MIDDLE - PREFIX].astype(np.int64) - (MIDDLE - PREFIX)


def _before(n: int, ties: np.ndarray) -> np.ndarray:
    """All starts within 306 bytes before a tie."""
    last = n - LENGTH + 1
    if last <= 0:
        return np.zeros(0, np.int64)
    edge = np.bincount(np.maximum(ties - PERIOD + 1, 0).clip(0, last), minlength=last + 1) - np.bincount((ties + 1).clip(0, last), minlength=last + 1)
    return np.flatnonzero(np.cumsum(edge[:last]) > 0)


def covered(starts: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs (begin, end) covered by strings of ``length`` bytes at sorted starts."""
    if not len(starts):
        return starts, starts
    cut = np.flatnonzero(np.diff(starts) > length) + 1
    return starts[np.concatenate([[0], cut])], starts[np.concatenate([cut - 1, [len(starts) - 1]])] + length


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        spans, kept = [], []
        for raw, copies, starts in zip(b.column(2), b.column(3), b.column(4)):
            data = raw.as_buffer().to_pybytes()
            begin, end = covered(np.array(starts.as_py() or [], np.int64))
            if copies.as_py() > 1:
                begin, end = [0], [len(data)]
            spans.append([{"start": int(s), "end": int(e)} for s, e in zip(begin, end)])
            kept.append(b"".join(data[s:e] for s, e in zip([0, *end], [*begin, len(data)])))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())],
            names=["key", "more", "spans", "kept"])


def _texts(docs: DataFrame) -> DataFrame:
    """doc_id, data and a 128-bit key (key, more) of the data."""
    return (docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("data"))
            .withColumns({"key": F.xxhash64("data"), "more": F.xxhash64(F.lit(1), "data")}))


def _moved(by: int) -> Column:
    return F.transform("places", lambda x: x + by)


def repeats(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(key, more, spans, kept): one row per distinct text that loses bytes, with its removed runs and remaining bytes."""
    texts = _texts(docs).where(F.octet_length("data") >= LENGTH)
    total = texts.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    buckets = max(16, -(-total * (FIELD + 1) // (PERIOD * BUCKET_NAMES)))
    ties = repeated(spark, texts.withColumn("places", F.lit(None).cast("array<int>")), _from_cover, PREFIX, False, buckets, "repeat-ties")
    distinct = texts.groupBy("key", "more").agg(F.count("*").alias("copies"), F.min("data").alias("data"))
    tied = stored(spark, distinct.join(ties, "key").select("key", "more", "copies", "data", "places"), "repeat-texts")
    near = [repeated(spark, tied, chosen, MIDDLE, False, buckets, name).select("key", _moved(by).alias(name))
            for chosen, by, name in ((_onward, 0, "onward"), (_backward, MIDDLE - PREFIX, "backward"))]
    none = F.array().cast("array<int>")
    still = tied.join(near[0], "key", "left").join(near[1], "key", "left").withColumn(
        "places", F.when(F.col("copies") > 1, F.col("places")).otherwise(F.array_union(F.coalesce("onward", none), F.coalesce("backward", none))))
    starts = repeated(spark, still.where(F.size("places") > 0), _before, LENGTH, True, TURNS * buckets, "repeat-starts", TURNS)
    merged = tied.join(starts.withColumnRenamed("places", "starts"), "key", "left").where("copies > 1 or size(starts) > 0")
    return merged.select("key", "more", "data", "copies", "starts").mapInArrow(
        _removed, "key long, more long, spans array<struct<start:long,end:long>>, kept binary")


def repeat_report(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    length = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    cut = stored(spark, repeats(spark, docs).select("key", "more", length.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                                                    F.sha2("kept", 256).alias("kept_sha256")), "repeat-report")
    rows = _texts(docs).select("doc_id", "key", "more", F.octet_length("data").cast("long").alias("n_bytes"), F.sha2("data", 256).alias("whole"))
    zero = F.lit(0).cast("long")
    return rows.join(cut, ["key", "more"], "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"))

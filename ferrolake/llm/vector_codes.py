"""Vector codes by dual-tree Lloyd iterations (operator 13).

A vector's components become integers, ``floor(256 * x)``, and the vector is cut into 16 equal parts; each part
position has a codebook of 64 entries. An iteration assigns every part to its nearest entry and moves the entries
to the floored means. Both sides are held in trees of boxes, split at the median of the widest side: one over
the parts of a batch, one over the entries. Pairs of nodes are followed down both trees at once. With the least and
the greatest distance between two boxes, an entry node goes as soon as another is nearer to all parts of the
node. A part node that has one entry left is assigned whole, by sums and counts kept at its nodes. Only leaves that keep
several entries work out distances, in integers, so ties go to the lower index exactly.

Tasks send one row per codebook cell (sums and counts); the driver holds the codebooks only (64 x dimension).

Defined results: rows whose vector is null, or holds a null, NaN or infinite component, are dropped. The dimension is
that of the smallest vec_id whose vector has a positive multiple of 16 components; vectors of another length
cannot be cut alike and are dropped too. With fewer than 64 vectors the codebooks are shorter. A null vec_id is never
among the smallest; of equal vec_ids the smaller vector counts as smaller. Components above 4,096 take the same steps
in Python integers; a sum of squares that no long holds becomes null. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored

PARTS, ENTRIES, ROUNDS = 16, 64, 2
BATCH, LEAF, PAIRS = 2048, 16, 1 << 14   # parts per tree, parts per leaf, leaf pairs worked out at once
SMALL = 1 << 20                          # up to here squares fit a long with room for the entry's index
LIMB = 40                                # larger sums travel in digits of so many bits
_CODES = "vec_id long, label string, code string, error long"


class Boxes:
    """Balanced trees over points (positions, n, d), all positions at once, stored level by level."""

    def __init__(self, points: np.ndarray, counts: np.ndarray, leaf: int):
        p, n, d = points.shape
        self.depth = max(0, int(np.ceil(np.log2(max(1, n / leaf)))))
        width = -(-n // (1 << self.depth)) << self.depth
        at = np.minimum(np.arange(width), n - 1)   # the last point fills up, without weight
        pts, self.at = points[:, at], np.broadcast_to(at, (p, width)).copy()
        weight = counts[:, at] * (np.arange(width) < n)
        for level in range(self.depth):
            shape = (p, 1 << level, width >> level)
            cut = pts.reshape(*shape, d)
            side = np.argmax(cut.max(2) - cut.min(2), axis=-1)
            key = np.take_along_axis(cut, side[:, :, None, None], 3)[..., 0]
            order = np.argsort(key, axis=2, kind="stable")
            pts = np.take_along_axis(cut, order[..., None], 2).reshape(p, width, d)
            self.at = np.take_along_axis(self.at.reshape(shape), order, 2).reshape(p, width)
            weight = np.take_along_axis(weight.reshape(shape), order, 2).reshape(p, width)
        cells = (p, 1 << self.depth, width >> self.depth)
        self.leaves, self.weights, self.rows = pts.reshape(*cells, d), weight.reshape(cells), self.at.reshape(cells)
        self.low, self.high = [self.leaves.min(2)], [self.leaves.max(2)]
        self.sums, self.counts = [(self.leaves * self.weights[..., None]).sum(2)], [self.weights.sum(2)]
        for _ in range(self.depth):   # from the leaves up
            self.low.insert(0, np.minimum(self.low[0][:, ::2], self.low[0][:, 1::2]))
            self.high.insert(0, np.maximum(self.high[0][:, ::2], self.high[0][:, 1::2]))
            self.sums.insert(0, self.sums[0][:, ::2] + self.sums[0][:, 1::2])
            self.counts.insert(0, self.counts[0][:, ::2] + self.counts[0][:, 1::2])


def _distinct(book: np.ndarray) -> np.ndarray:
    """1 for entries that differ from all before them: of equal ones the first wins every tie."""
    out = np.zeros(book.shape[:2], np.int64)
    for p, entries in enumerate(book):
        first: dict = {}
        for e, entry in enumerate(map(tuple, entries.tolist())):
            first.setdefault(entry, e)
        out[p, list(first.values())] = 1
    return out


class Assignment:
    """What a batch of parts (positions, n, d) adds to a codebook (positions, entries, d)."""

    def __init__(self, points: np.ndarray, book: np.ndarray, codes: bool = False):
        self.book, self.k = book, book.shape[1]
        self.sums = np.zeros(book.shape, book.dtype)
        self.counts = np.zeros(book.shape[:2], np.int64)
        self.codes = np.zeros(points.shape[:2], np.int64) if codes else None
        self.worked = 0   # integer distances that the bounds did not spare
        parts = Boxes(points, np.ones(points.shape[:2], np.int64), LEAF)
        self._descend(parts, Boxes(book, _distinct(book), 1))

    def _descend(self, parts: Boxes, entries: Boxes) -> None:
        p = np.arange(len(self.book))
        a = b = np.zeros_like(p)
        i = j = 0   # levels of the two trees; pairs (p, a, b) are kept in the order of (p, a)
        while len(p):
            lo, hi, elo, ehi = parts.low[i][p, a], parts.high[i][p, a], entries.low[j][p, b], entries.high[j][p, b]
            least = (np.maximum(np.maximum(lo - ehi, elo - hi), 0) ** 2).sum(-1)
            most = (np.maximum(hi - elo, ehi - lo) ** 2).sum(-1)
            start = np.flatnonzero(np.r_[True, (p[1:] != p[:-1]) | (a[1:] != a[:-1])])
            size = np.diff(np.r_[start, len(p)])
            alive = least <= np.repeat(np.minimum.reduceat(most, start), size)
            left = np.add.reduceat(alive.astype(np.int64), start)
            several = np.repeat(left, size)[alive] > 1
            p, a, b = p[alive], a[alive], b[alive]
            if j == entries.depth:   # entries are single: one left decides for the whole node
                self._whole(parts, entries, i, p[~several], a[~several], b[~several])
                p, a, b = p[several], a[several], b[several]
                if i == parts.depth:
                    return self._leaves(parts, entries, p, a, b)
            if i < parts.depth:
                i, p, a, b = i + 1, np.repeat(p, 2), np.stack([2 * a, 2 * a + 1], 1).ravel(), np.repeat(b, 2)
            if j < entries.depth:
                j, p, a, b = j + 1, np.repeat(p, 2), np.repeat(a, 2), np.stack([2 * b, 2 * b + 1], 1).ravel()
                there = entries.counts[j][p, b] > 0
                p, a, b = p[there], a[there], b[there]
            order = np.lexsort((b, a, p))
            p, a, b = p[order], a[order], b[order]

    def _whole(self, parts: Boxes, entries: Boxes, level: int, p, a, b) -> None:
        e = entries.rows[p, b, 0]
        np.add.at(self.sums, (p, e), parts.sums[level][p, a])
        np.add.at(self.counts, (p, e), parts.counts[level][p, a])
        if self.codes is not None and len(p):
            rows = parts.at.reshape(len(self.book), 1 << level, -1)[p, a]
            self.codes[p[:, None], rows] = e[:, None]

    def _leaves(self, parts: Boxes, entries: Boxes, p, a, b) -> None:
        start = np.flatnonzero(np.r_[True, (p[1:] != p[:-1]) | (a[1:] != a[:-1])]) if len(p) else np.empty(0, np.int64)
        while len(start):   # whole nodes only, about PAIRS pairs a turn
            ends = np.r_[start[1:], len(p)]
            n = max(1, int(np.searchsorted(ends, start[0] + PAIRS, "right")))
            cut = slice(start[0], ends[n - 1])
            q, c, e = p[cut], a[cut], entries.rows[p[cut], b[cut], 0]
            gap = parts.leaves[q, c] - self.book[q, e][:, None]
            self.worked += gap.shape[0] * gap.shape[1]
            best = np.minimum.reduceat((gap ** 2).sum(-1) * self.k + e[:, None], start[:n] - start[0], axis=0) % self.k
            best = best.astype(np.int64)
            q, c = p[start[:n]], a[start[:n]]
            weight = parts.weights[q, c]
            np.add.at(self.sums, (q[:, None], best), parts.leaves[q, c] * weight[..., None])
            np.add.at(self.counts, (q[:, None], best), weight)
            if self.codes is not None:
                self.codes[q[:, None], parts.rows[q, c]] = best
            start = start[n:]


def integers(flat: np.ndarray) -> np.ndarray:
    """``floor(256 * x)``, exactly: as longs where squares fit, else as Python integers."""
    if (np.abs(flat) < SMALL / 256).all():
        return np.floor(flat * 256).astype(np.int64)
    # Doubles from 2^53 on are whole, and their product might not be a double.
    return np.array([int(x) * 256 if abs(x) >= 2.0**53 else int(np.floor(x * 256)) for x in flat.tolist()], dtype=object)


def _parts(flat: np.ndarray, dim: int) -> np.ndarray:
    return integers(flat).reshape(-1, PARTS, dim // PARTS).transpose(1, 0, 2)


def _batches(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for whole in batches:
        for at in range(0, whole.num_rows, BATCH):
            b = whole.slice(at, BATCH)
            yield b, _parts(b.column("v").flatten().to_numpy(zero_copy_only=False), dim)


def _alike(points: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in longs, or both in Python integers."""
    if points.dtype == book.dtype:
        return points, book
    return points.astype(object), book.astype(object)


def _digits(cells: np.ndarray, value: np.ndarray) -> Iterator[tuple[int, int, int]]:
    for cell, v in zip(cells.tolist(), value.tolist()):
        sign, v, limb = (-1 if v < 0 else 1), abs(v), 0
        while v:
            yield cell, limb, sign * (v & ((1 << LIMB) - 1))
            v, limb = v >> LIMB, limb + 1


def _added(vectors: DataFrame, book: np.ndarray, dim: int) -> dict[int, int]:
    """Sums and counts of every codebook cell over all vectors: one row per cell and task is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(book.shape, object), np.zeros(book.shape[:2], object)
        for _, points in _batches(batches, dim):
            got = Assignment(*_alike(points, book))
            sums, counts = sums + got.sums, counts + got.counts
        flat = np.concatenate([sums, counts[..., None]], axis=2).ravel()
        there = np.flatnonzero(flat != 0)
        rows = list(_digits(there, flat[there]))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else ([], [], []), (pa.int32(), pa.int32(), pa.int64()))],
                                         names=["cell", "limb", "total"])

    out: dict[int, int] = {}
    rows = vectors.select("v").mapInArrow(run, "cell int, limb int, total long").groupBy("cell", "limb").agg(F.sum("total").alias("total"))
    for r in rows.collect():   # at most 16 x 64 x (dimension / 16 + 1) cells
        out[r.cell] = out.get(r.cell, 0) + (r.total << (LIMB * r.limb))
    return out


def _exact(values: list) -> np.ndarray:
    out = np.array(values, dtype=object)
    return out.astype(np.int64) if all(abs(v) < SMALL for v in out.ravel().tolist()) else out


def _moved(book: np.ndarray, cells: dict[int, int]) -> np.ndarray:
    """Every used entry at the floored mean of its parts."""
    p, k, d = book.shape
    new = book.astype(object)
    for i in range(p):
        for e in range(k):
            at = (i * k + e) * (d + 1)
            if n := cells.get(at + d, 0):
                new[i, e] = [cells.get(at + x, 0) // n for x in range(d)]
    return _exact(new.tolist())


def kept_vectors(embeddings: DataFrame) -> tuple[DataFrame, int | None]:
    """Rows (vec_id, label, v) that can be coded, and their dimension (None if there is none)."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = embeddings.select("vec_id", F.col("label").cast("string").alias("label"), v.alias("v")).where(v.isNotNull() & finite)
    cut = rows.where((F.size("v") > 0) & (F.size("v") % PARTS == 0))
    first = cut.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(1).collect()
    return (rows, None) if not first else (cut.where(F.size("v") == len(first[0].v)), len(first[0].v))


def fit(vectors: DataFrame, dim: int, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (16, entries, dimension / 16) after Lloyd rounds over all vectors."""
    seeds = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()   # a top-k
    book = _exact(_parts(np.array([x for r in seeds for x in r.v]), dim).tolist())
    for _ in range(rounds):
        book = _moved(book, _added(vectors, book, dim))
    return book


def encode(vectors: DataFrame, book: np.ndarray, dim: int) -> DataFrame:
    """vec_id, label, code, error of every vector under given codebooks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, points in _batches(batches, dim):
            points, entries = _alike(points, book)
            codes = Assignment(points, entries, codes=True).codes
            gap = points - entries[np.arange(PARTS)[:, None], codes]
            error = [int(e) if e < 2**63 else None for e in (gap ** 2).sum(-1).sum(0).tolist()]
            code = [r.tobytes().hex() for r in codes.T.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), pa.array(code, pa.string()), pa.array(error, pa.int64())],
                                             names=["vec_id", "label", "code", "error"])

    return vectors.select("vec_id", "label", "v").mapInArrow(run, _CODES)


def code_report(spark: SparkSession, embeddings: DataFrame) -> DataFrame:
    """One row per coded vector, with the error of all vectors of its label and a digest of the codebooks."""
    rows, dim = kept_vectors(embeddings)
    if dim is None:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    book = fit(rows, dim)
    digest = hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()
    coded = stored(spark, encode(rows, book, dim), "vector-codes")
    per_label = coded.groupBy("label").agg(F.try_sum("error").alias("label_error"))
    return (coded.alias("c").join(per_label.alias("l"), F.col("c.label").eqNullSafe(F.col("l.label")))
            .select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")))

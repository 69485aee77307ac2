"""Dual-tree Lloyd against the same iterations in plain Python."""

import hashlib
import math
import random
from collections import Counter
from fractions import Fraction

import numpy as np

SCHEMA = "vec_id long, embedding array<double>, label int, v int, code string, error string, at int"


def brute(rows, dim, entries=64, rounds=2):
    kept = [(i, [math.floor(256 * Fraction(x)) for x in v], lab) for i, v, lab in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    d = dim // 16
    cut = [[v[p * d:(p + 1) * d] for p in range(16)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(16)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), n) for n, e in enumerate(book))

    for _ in range(rounds):
        for p in range(16):
            groups = {}
            for c in cut:
                groups.setdefault(nearest(c[p], books[p])[1], []).append(c[p])
            for e, g in groups.items():
                books[p][e] = [sum(x) // len(g) for x in zip(*g)]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    got = [[nearest(c[p], books[p]) for p in range(16)] for c in cut]
    errors = [sum(g[0] for g in r) for r in got]
    fits = [e if e < 2**63 else None for e in errors]
    per = {}
    for (_, _, lab), e in zip(kept, fits):
        per[lab] = e if per.get(lab) is None else per[lab] + (e or 0)
    return Counter((i, "".join(f"{g[1]:02x}" for g in r), e, per[lab], sha) for (i, _, lab), r, e in zip(kept, got, fits))


def check(spark, rows, dim):
    from ferrolake.llm.vector_codes import code_report
    docs = spark.createDataFrame([(*r, 1, "c", "e", 2) for r in rows], SCHEMA).repartition(3)
    got = code_report(spark, docs)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert Counter(tuple(r) for r in got.collect()) == brute(rows, dim)


def vectors(n, dim, seed, groups=7):
    rng = random.Random(seed)
    middle = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(groups)]
    return [[m + rng.gauss(0, 0.05) for m in rng.choice(middle)] for _ in range(n)]


def test_against_brute_force_with_edges(spark):
    vs = vectors(150, 32, 1)
    rows = [(i, v, None if i % 7 == 0 else i % 3) for i, v in enumerate(vs)]
    rows += [(200, None, 1), (201, [None] * 32, 1), (202, vs[0][:-1] + [math.nan], 1), (203, vs[0][:-1] + [math.inf], 1),
             (204, vs[0][:16], 1), (205, [], 1), (None, vs[3], 2), (None, vs[4], None), (5, vs[9], 1), (5, vs[9], 1),
             (6, vs[6], 1), (-4, [0.0] * 32, 0), (-4, [-0.001] * 32, 0)] + [(300 + i, vs[1], 9) for i in range(90)]
    check(spark, rows, 32)


def test_few_large_and_no_vectors(spark):
    from ferrolake.llm.vector_codes import code_report
    check(spark, [(i, v, 1) for i, v in enumerate(vectors(5, 16, 2))], 16)
    big = [(i, [x * 10.0 ** (i % 9 * 3) for x in v], i % 2) for i, v in enumerate(vectors(80, 16, 3))]
    check(spark, big, 16)   # beyond longs: Python integers, an error that no long holds is null
    none = spark.createDataFrame([(1, None, 1, 1, "", "", 1)], SCHEMA)
    assert code_report(spark, none).collect() == [] and code_report(spark, none.limit(0)).collect() == []


def test_bounds_spare_most_distances():
    from ferrolake.llm.vector_codes import Assignment, integers
    points = integers(np.array(vectors(4096, 4, 5, groups=60)).ravel()).reshape(1, 4096, 4)
    book = points[:, :64].copy()
    got = Assignment(points, book, codes=True)
    dist = ((points[0][:, None] - book[0]) ** 2).sum(-1)
    assert (got.codes[0] == dist.argmin(1)).all()   # argmin: the lower index wins
    assert (np.bincount(dist.argmin(1), minlength=64) == got.counts[0]).all()
    assert got.worked < 0.35 * dist.size


def test_equal_entries_and_points():
    from ferrolake.llm.vector_codes import Assignment
    points = np.full((2, 100, 3), 7, np.int64)
    book = np.full((2, 5, 3), 7, np.int64)
    book[1, 0] = 9
    got = Assignment(points, book, codes=True)
    assert (got.codes == [[0]] * 1 + [[1]] * 1).all() and got.counts.tolist() == [[100, 0, 0, 0, 0], [0, 100, 0, 0, 0]]

"""Exact dedup and near-dedup against brute force."""

import hashlib
import random
import string
from collections import Counter

from conftest import SF_SMALL

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute_exact(pairs):
    """(doc_id, keep_id, group_size, sha) of every row, and how many rows stay."""
    norm = [(i, (t or "").translate(LOWER)) for i, t in pairs]
    groups = {}
    for i, t in norm:
        groups.setdefault(t, []).append(i)
    keep = {t: max((i for i in g if i is not None), default=None) for t, g in groups.items()}
    return Counter((i, keep[t], len(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for i, t in norm), len(groups)


def check_exact(rows, pairs):
    want, n_kept = brute_exact(pairs)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows) == want
    assert sum(r.kept for r in rows) == n_kept and all(r.doc_id == r.keep_id for r in rows if r.kept)


def test_exact_groups(spark, edge_docs, edges, no_docs):
    from ferrolake.llm.exact_dedup import exact_dedup, exact_groups
    pairs = [(i, t) for i, t, *_ in edges] + [(70, "ABC"), (71, "abc"), (72, "ÀBC"), (73, "àbc")]
    docs = edge_docs.select("doc_id", "text").union(spark.createDataFrame(pairs[-4:], "doc_id long, text string"))
    check_exact(exact_groups(spark, docs).collect(), pairs)
    check_exact(exact_groups(spark, docs, block_chars=500).collect(), pairs)  # several levels of pairs
    kept = exact_dedup(spark, edge_docs)
    assert kept.columns == edge_docs.columns and kept.count() == len({(t or "").translate(LOWER) for _, t, *_ in edges})
    assert exact_groups(spark, no_docs).collect() == [] and exact_dedup(spark, no_docs).collect() == []


def test_names_survive_colliding_digests(spark, monkeypatch):
    """A digest that maps many blocks to one value is replaced before any name is given."""
    from pyspark.sql import functions as F

    from ferrolake.llm import exact_dedup
    real = exact_dedup._digest
    monkeypatch.setattr(exact_dedup, "_digest", lambda b, seed: [F.length(b).cast("long"), F.lit(0).cast("long")] if seed == 0 else real(b, seed))
    pairs = [(1, "ab"), (2, "cd"), (3, "AB"), (4, "abcdefg"), (5, "abcdefh")]
    check_exact(exact_dedup.exact_groups(spark, spark.createDataFrame(pairs, "doc_id long, text string"), block_chars=3).collect(), pairs)


def brute_near(texts, similar=0.8):
    from ferrolake.llm.near_dedup import overlap, words_of
    up = list(range(len(texts)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            wa, wb = words_of(texts[a]), words_of(texts[b])
            if wa == wb or wa and wb and overlap(texts[a] or "", texts[b] or "") >= similar:
                up[max(top(a), top(b))] = min(top(a), top(b))
    return [top(i) for i in range(len(texts))]


def check_near(rows, pairs):
    """Every row's class must be the component of its text, named by its smallest id."""
    root = brute_near([t for _, t in pairs])
    ids = {}
    for (i, _), r in zip(pairs, root):
        ids.setdefault(r, []).append(-2**63 if i is None else i)
    want = Counter((i, min(ids[r]), len(ids[r])) for (i, _), r in zip(pairs, root))
    none = lambda x: -2**63 if x is None else x
    assert Counter((r.doc_id, none(r.class_id), r.class_size) for r in rows) == want
    assert sum(r.kept for r in rows) == len(ids)


def test_near_groups(spark, edge_docs, edges, no_docs):
    from ferrolake.llm.near_dedup import near_dedup, near_groups
    rng = random.Random(3)
    pairs = [(i, t) for i, t, *_ in edges]
    base = [f"t{rng.randrange(10**6)}" for _ in range(200)]
    more = []
    for i in range(60):  # a chain of near copies: neighbours are linked, the ends are far apart
        base = list(base)
        base[rng.randrange(200)] = f"t{rng.randrange(10**6)}"
        more.append((100 + i, " ".join(base)))
    docs = edge_docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    check_near(near_groups(spark, docs).collect(), pairs + more)
    kept = near_dedup(spark, edge_docs)
    assert kept.columns == edge_docs.columns
    assert kept.count() == len(set(brute_near([t for _, t, *_ in edges])))
    assert near_groups(spark, no_docs).collect() == [] and near_dedup(spark, no_docs).collect() == []


def test_near_groups_of_large_buckets(spark, monkeypatch):
    """Pivots find the same classes as buckets resolved in place."""
    from ferrolake.llm import near_dedup
    rng = random.Random(9)
    base = [f"t{rng.randrange(10**6)}" for _ in range(150)]
    family = []
    for i in range(70):  # members that are alike to very different degrees
        words = list(rng.choice(family)[1].split()) if i % 3 and family else list(base)
        for _ in range(rng.randrange(1, 7)):
            words[rng.randrange(150)] = f"t{rng.randrange(10**6)}"
        family.append((i, " ".join(words)))
    monkeypatch.setattr(near_dedup, "BUCKET_TEXTS", 3)
    check_near(near_dedup.near_groups(spark, spark.createDataFrame(family, "doc_id long, text string")).collect(), family)


def test_near_groups_on_the_small_table(spark):
    from ferrolake.llm.near_dedup import near_groups
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    check_near(near_groups(spark, docs).collect(), [tuple(r) for r in docs.collect()])


def test_bagminhash_is_unbiased():
    import numpy as np

    from ferrolake.llm.bagminhash import signatures
    rng = np.random.default_rng(1)
    for most in (1, 5, 60):
        a = {int(k): int(rng.integers(1, most + 1)) for k in rng.integers(0, 2**62, 80)}
        b = {k: (v if rng.random() < 0.8 else int(rng.integers(1, most + 1))) for k, v in a.items() if rng.random() < 0.9}
        true = sum(min(a[k], b.get(k, 0)) for k in a) / sum(max(a[k], b.get(k, 0)) for k in a)
        got = []
        for salt in rng.integers(0, 2**62, 40):
            keys = np.array([k ^ int(salt) for k in (*a, *b)], np.uint64)
            s = signatures(keys, np.array([*a.values(), *b.values()]), np.array([0] * len(a) + [1] * len(b)), 2, 64)
            got.append((s[0] == s[1]).mean())
        assert abs(np.mean(got) - true) < 0.04

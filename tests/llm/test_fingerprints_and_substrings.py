"""I-Match fingerprints and repeated-substring removal against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
from conftest import SF_SMALL


def test_imatch_edges(spark, edge_docs, edges, no_docs):
    from ferrolake.llm.imatch import imatch_report
    rows = imatch_report(spark, edge_docs).collect()
    assert len(rows) == len(edges)
    by_text = {}
    ids = sorted({-2**63 if i is None else i for i, *_ in edges})
    text_of = {i: min((t or "").encode() for j, t, *_ in edges if (-2**63 if j is None else j) == i).decode() for i in ids}
    following = dict(zip(ids, ids[1:] + ids[:1]))
    want = Counter()
    for i, t, *_ in edges:
        t, i = t or "", -2**63 if i is None else i
        half = len(t) // 2
        want[(i, len(t), hashlib.sha256((t[:len(t) - half] + text_of[following[i]][:half]).encode()).hexdigest())] += 1
    assert Counter((-2**63 if r.doc_id is None else r.doc_id, r.n_chars, r.edited_sha256) for r in rows) == want
    for r in rows:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if r.fingerprint == r.edited_fingerprint:
            assert r.near_edited == 1
    for r in rows:
        if r.doc_id in (1, 2, 4, 5):
            by_text.setdefault("a" if r.doc_id < 3 else "b", set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in by_text.values())
    assert imatch_report(spark, no_docs).collect() == []


def test_imatch_tells_edits_from_other_documents(spark):
    from ferrolake.llm.imatch import imatch_report
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = imatch_report(spark, docs).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    groups = {}
    for r in rows:
        groups.setdefault(texts[r.doc_id], set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in groups.values())
    assert sum(r.near_edited > r.near_next for r in rows) > 0.85 * len(rows)


def test_difference_cover():
    from ferrolake.llm.substring_dedup import PERIOD, difference_cover
    cover = difference_cover()
    assert len({(a - b) % PERIOD for a in cover for b in cover}) == PERIOD and len(cover) == 18


def brute_repeats(texts, length=400):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(raw[k:k + length] for raw in raws for k in range(len(raw) - length + 1))
    for raw in raws:
        hit = np.zeros(len(raw) + 1, bool)
        for k in range(len(raw) - length + 1):
            if seen[raw[k:k + length]] > 1:
                hit[k:k + length] = True
        kept = bytes(b for b, h in zip(raw, hit) if not h)
        yield len(raw), int(hit.sum()), int((hit[1:] & ~hit[:-1]).sum() + hit[0]), hashlib.sha256(kept).hexdigest()


def test_repeats_match_brute_force(spark, edge_docs, edges, no_docs):
    from ferrolake.llm.substring_dedup import repeat_report
    rng = random.Random(8)
    noise = lambda n: "".join(rng.choice("abcdé \n") for _ in range(n))
    shared, period = noise(900), noise(130)
    texts = [noise(700), noise(200) + shared[100:520] + noise(300), shared[90:530] + noise(5), noise(60) + shared[:399] + noise(9),
             shared, period * 7, noise(333) + period * 4, "z" * 399, "z" * 400, "z" * 401 + noise(100), noise(100) + shared[500:] + noise(900)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in repeat_report(spark, rows).collect()}
    assert [got[i] for i in range(len(texts))] == list(brute_repeats(texts))
    got = Counter((r.doc_id, *tuple(r)[1:]) for r in repeat_report(spark, edge_docs).collect())
    assert got == Counter((i, *x) for (i, *_), x in zip(edges, brute_repeats([t for _, t, *_ in edges])))
    assert repeat_report(spark, no_docs).collect() == []

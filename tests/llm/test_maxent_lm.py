"""The language model: counts and base scores by brute force, probabilities that add up, gain on held-out texts."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SF_SMALL

COLUMNS = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(pairs):
    toks = [WORD.findall((t or "").translate(LOWER)) + [""] for _, t in pairs]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in pairs]
    c = Counter(w for t, h in zip(toks, held) if not h for w in t)
    n, v = sum(c.values()), len(c)
    return [(i, h, len(t), sum(c[w] > 0 for w in t), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t))
            for (i, _), h, t in zip(pairs, held, toks)]


def check(spark, docs, pairs):
    from ferrolake.llm.maxent_lm import lm_report
    got = lm_report(spark, docs)
    assert got.columns == COLUMNS
    rows = got.collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[5], 6))
    assert len(rows) == len(pairs)
    for a, b in zip(sorted(rows, key=key), sorted(brute(pairs), key=key)):
        assert tuple(a)[:5] == b[:5] and a.base_score == pytest.approx(b[5], rel=1e-9, abs=1e-9)
        assert math.isfinite(a.score) and a.score <= 1e-6
    return rows


def test_edges(spark, edge_docs, edges, no_docs):
    from ferrolake.llm.maxent_lm import lm_report
    check(spark, edge_docs, [(e[0], e[1]) for e in edges])
    assert lm_report(spark, no_docs).collect() == []
    # Only held-out texts: nothing is known, every token has probability one half of an empty model or so.
    only = [(i, "a b c") for i in range(40) if zlib.crc32(str(i).encode()) % 7 == 2]
    check(spark, spark.createDataFrame(only, "doc_id long, text string"), only)


def test_rare_words_take_the_join(spark, edge_docs, edges, monkeypatch):
    """With room for four known words all others go through the table of counts; nothing changes."""
    from ferrolake.llm import maxent_lm
    want = sorted((r.doc_id or -1, r.n_tokens, round(r.base_score, 6)) for r in maxent_lm.lm_report(spark, edge_docs).collect())
    monkeypatch.setattr(maxent_lm, "KNOWN", 4)
    rows = check(spark, edge_docs, [(e[0], e[1]) for e in edges])
    assert sorted((r.doc_id or -1, r.n_tokens, round(r.base_score, 6)) for r in rows) == want


def test_rare_words_travel_in_spans(spark, monkeypatch):
    """Words that are not known are stored up to SPAN in a row, not in a row each; nothing changes."""
    from ferrolake.llm import maxent_lm
    pairs = [(i, " ".join(f"w{j % 90}" for j in range(7 * i, 16 * i))) for i in range(40)]
    docs = spark.createDataFrame(pairs, "doc_id long, text string")
    kept, store = {}, maxent_lm.stored
    monkeypatch.setattr(maxent_lm, "stored", lambda s, df, name: kept.setdefault(name, store(s, df, name)))
    monkeypatch.setattr(maxent_lm, "KNOWN", 4)
    monkeypatch.setattr(maxent_lm, "SPAN", 8)
    check(spark, docs, pairs)
    rows = kept["lm-scored"].where("n_tokens = 0").collect()
    spans = sum(-(-len(set(t.split())) // 8) for _, t in pairs)
    assert len(rows) == spans and all(0 < len(r.rare) <= 8 for r in rows)


def test_texts_and_gain(spark):
    from ferrolake.llm.maxent_lm import lm_report
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = lm_report(spark, docs).collect()
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert len(held) > 15


def model():
    from ferrolake.llm import maxent_lm as m

    class V:
        pass

    v, rng = V(), np.random.default_rng(3)
    words = [b"w%d" % i for i in range(1500)]
    v.known = {w: 5 for w in words} | {m.END: 9}
    v.single = {w: i for i, w in enumerate([m.END, *words][:m.SINGLE])}
    v.cell_bias, v.class_bias = (rng.normal(size=s).astype(np.float32) for s in ((m.CLASSES, m.CELLS), (m.CLASSES,)))
    weights = tuple(rng.normal(size=w.shape).astype(np.float32) for w in m.empty_weights())
    return m, v, weights, words


def test_cell_probabilities_add_up_to_one():
    """For one history, the probabilities of all cells and of the class without cells add up to 1."""
    m, v, weights, words = model()
    codes = m.Codes(v)
    one_of_each = {}
    for w in [m.END, *words]:
        one_of_each.setdefault((codes.of([w])[0] >> 32) & 1023, w)
    assert len(one_of_each) == m.SINGLE + 1
    total = 0.0
    for w in one_of_each.values():
        got = m.log10_probabilities(v, weights, codes.of([b"a", b"b", b"c", w]), np.array([3]))
        total += 10 ** got[0]
    assert total == pytest.approx(1, abs=1e-4)


def test_steps_cut_long_texts_alike():
    """Scores don't depend on where steps are cut, and no history crosses from one text to the next."""
    m, v, weights, words = model()
    codes = m.Codes(v)
    rng = np.random.default_rng(4)
    texts = [codes.of([words[i] for i in rng.integers(0, 1500, n)]) for n in (3, 1, 20_000, 5, 9000)]
    got = np.concatenate([m.log10_probabilities(v, weights, *s) for s in m._steps(iter(texts))])
    alone = np.concatenate([m.log10_probabilities(v, weights, np.r_[0, 0, 0, t], np.arange(len(t)), m.Room(20_000)) for t in texts])
    assert np.allclose(got, alone, atol=1e-4)


def test_words_are_looked_up_once_a_piece(monkeypatch):
    """Tokens are those of the words of each text, whatever the pieces; a word is looked up once for a piece, not for every token."""
    import pyarrow as pa
    m, v, *_ = model()
    texts = [b"  W1 w2\tW1\x0b\x0c\r\nw2 ", None, b"", b" \n ", b"w3", b"\xc3\x89 w1 \x1c a\x85b \xff\xc2 W\x00", b"w2 new New " * 500]
    want = [[*(t or b"").lower().split(), b""] for t in texts]
    column = pa.array([b"left out", *texts], pa.binary()).slice(1)
    assert all((len(t) + 1 == k) for t, k in zip([WORD.findall((t or b"").decode("latin-1")) for t in texts], m.tokens_of(column)[2]))
    for size, most in ((1 << 20, 12), (16, 30)):
        monkeypatch.setattr(m, "PIECE", size)
        looked = []
        codes = m.Codes(v)
        of = codes.of
        codes.of = lambda words: looked.append(len(words)) or of(words)
        got = list(codes.texts(column))
        assert [g.tolist() for g in got] == [of(w).tolist() for w in want]
        assert sum(looked) <= most
    monkeypatch.setattr(m, "COUNTED", 3)
    batch = pa.RecordBatch.from_arrays([column], names=["text"])
    counts = Counter()
    for b in m._counted(iter([batch, batch])):
        counts.update(dict(zip(b.column("word").to_pylist(), b.column("n").to_pylist())))
    assert counts == Counter(w for t in want * 2 for w in t)
    assert list(m._counted(iter([]))) == []


def test_update_adds_long_runs():
    """Rows that 1 to 40 tokens move get the sum of their slopes, however many are added at a time."""
    m, v, *_ = model()
    rng = np.random.default_rng(5)
    size = np.arange(1, 41)
    rows = np.repeat(np.arange(40), size)[None]
    n = rows.shape[1]
    t = m.Trainer(m.empty_weights())
    slope = t.room.logits[:n]
    slope[:] = rng.random((n, m.CELLS))
    of = rng.integers(0, m.CELLS, n)
    grad = np.add.reduceat(slope - np.eye(m.CELLS, dtype=np.float32)[of], np.cumsum(size) - size, axis=0)
    t._update(0, slope, of, rows)
    assert np.allclose(t.weights[0][:40], -m.RATE * grad / np.sqrt(m.START + (grad * grad).sum(1))[:, None], atol=1e-5)
    assert t.moved[0][:40].tolist() == size.tolist() and not t.weights[0][40:].any()


def test_update_is_the_gradient():
    """One step from zero moves every row against the summed slope of its tokens, at the row's own rate."""
    m, v, _, words = model()
    codes = m.Codes(v)
    token = np.r_[0, 0, 0, codes.of(words[:6] * 9)]
    pos = np.arange(len(token) - 3)
    t = m.Trainer(m.empty_weights())
    kind, rows, *_ = m._rows(token, pos)
    p = np.exp(v.class_bias) / np.exp(v.class_bias).sum()
    grad = {}
    for i, k in enumerate(kind):
        for r in rows[:, i]:
            grad[r] = grad.get(r, 0) + p - np.eye(m.CLASSES)[k]
    t.step(v, token, pos)
    for r, g in grad.items():
        assert np.allclose(t.weights[0][r], -m.RATE * g / np.sqrt(m.START + (g * g).sum()), atol=1e-4)
    assert np.flatnonzero(t.moved[0]).tolist() == sorted(grad)

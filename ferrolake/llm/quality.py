"""Quality classifier: a factorisation machine (operator 6).

Features of a text are its words, hashed into buckets with length-normalised counts; structure statistics
(shares of character classes, word and line repetition, lengths), each put into one of a few bins; and the
metadata n_chars, binned too. lang, source, doc_id and labels are never features. The score is

    sigmoid(w0 + sum_i w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2])

so all pairwise interactions cost time linear in the number of features.

The model is fitted on the driver from at most ``SAMPLE`` labelled documents (a documented bound: features of
about 2 kB each), taken by a keyed hash of doc_id; scoring runs over all rows in Arrow batches without a
shuffle.

Defined results: null text counts as empty, and empty texts are scored like any other (statistics of zero);
null n_chars is replaced by the text's length; a document labelled several times counts with its largest
label; null labels are not learned from; repeated rows get equal scores; without any usable label all scores
are 0.5; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Labelled documents learned from at most.
SAMPLE = 8000
BUCKETS = 1 << 15
FACTORS = 8
EPOCHS = 12
RATE = 0.08
DECAY = 2e-5
SEED = 6
_LOWER, _UPPER = slice(97, 123), slice(65, 91)
# Edges of the bins, per kind of statistic.
_SHARE = np.array([0.0005, 0.002, 0.005, 0.01, 0.02, 0.04, 0.08, 0.15, 0.25, 0.4, 0.6, 0.8, 0.9, 0.97, 0.995])
_COUNT = np.array([0.5, 2.5, 5.5, 10.5, 20.5, 50.5, 100.5, 250.5, 500.5, 1000.5, 2500.5, 10000.5])
_MEAN = np.array([0.5, 2, 3, 3.5, 4, 4.5, 5, 5.5, 6, 6.5, 7, 8, 9, 11, 15, 40])


def _statistics(text: str, words: list[str], counts: Counter, n_chars: float) -> list[int]:
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    of = np.bincount(raw, minlength=256)
    size = max(1, len(raw))
    letters = max(1, int(of[_LOWER].sum() + of[_UPPER].sum() + of[128:].sum()))
    lines = [x for x in text.split("\n") if x]
    n = max(1, len(words))
    stops = int(of[[33, 46, 63]].sum())
    marks = int(of[33:48].sum() + of[58:65].sum() + of[91:97].sum() + of[123:127].sum()) - stops - int(of[44])
    shares = [of[_UPPER].sum() / letters, of[48:58].sum() / size, marks / size, stops / n, of[44] / n, of[33] / n,
              of[124] / n, of[128:].sum() / size, len(counts) / n, max(counts.values(), default=0) / n,
              len(set(zip(words, words[1:]))) / max(1, n - 1), len(set(lines)) / max(1, len(lines)),
              sum(a == b for a, b in zip(words, words[1:])) / n, sum(map(str.isupper, words)) / n]
    numbers = [len(words), len(lines), n_chars]
    means = [sum(map(len, words)) / n, len(words) / max(1, len(lines))]
    bins = [np.searchsorted(_SHARE, shares), np.searchsorted(_COUNT, numbers), np.searchsorted(_MEAN, means)]
    return [BUCKETS + 16 * i + int(b) for i, b in enumerate(np.concatenate(bins))]


N_FEATURES = BUCKETS + 16 * 20 + 1


def features(text: str | None, n_chars: float | None) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of a text's features."""
    text = text or ""
    words = text.split()
    counts = Counter(words)
    structure = _statistics(text, words, counts, len(text) if n_chars is None or n_chars != n_chars else n_chars)
    hashed = np.fromiter((zlib.crc32(w.lower().encode("utf-8", "replace")) % BUCKETS for w in counts), np.int64, len(counts))
    amount = np.sqrt(np.fromiter(counts.values(), np.float32, len(counts)))
    if len(amount):
        amount /= np.sqrt((amount ** 2).sum())
    return (np.concatenate([hashed, np.array(structure)]).astype(np.int32),
            np.concatenate([amount, np.full(len(structure), 0.3)]).astype(np.float32))


@dataclass
class Model:
    bias: float
    w: np.ndarray
    v: np.ndarray

    def raw(self, idx: np.ndarray, val: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores before the sigmoid of documents stored back to back, sums of factors, and factor terms."""
        terms = self.v[idx] * val[:, None]
        sums = np.add.reduceat(terms, starts, axis=0)
        squares = np.add.reduceat((terms ** 2).sum(axis=1), starts)
        return self.bias + np.add.reduceat(self.w[idx] * val, starts) + 0.5 * ((sums ** 2).sum(axis=1) - squares), sums, terms


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> Model:
    """Adagrad on the logistic loss over shuffled mini-batches; repeatable for the same rows."""
    rng = np.random.default_rng(SEED)
    model = Model(0.0, np.zeros(N_FEATURES, np.float32), rng.normal(0, 0.05, (N_FEATURES, FACTORS)).astype(np.float32))
    if not rows:
        model.v[:] = 0
        return model
    share = (labels.sum() + 1) / (len(labels) + 2)
    model.bias = float(np.log(share / (1 - share)))
    seen_w, seen_v = np.full(N_FEATURES, 1e-2, np.float32), np.full(N_FEATURES, 1e-2, np.float32)
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), 64):
            some = order[at:at + 64]
            lens = np.array([len(rows[i][0]) for i in some])
            idx, val = (np.concatenate([rows[i][k] for i in some]) for k in (0, 1))
            score, sums, terms = model.raw(idx, val, np.concatenate([[0], np.cumsum(lens)[:-1]]))
            error = np.repeat(((_sigmoid(score) - labels[some]) / len(some)).astype(np.float32), lens)
            used, where = np.unique(idx, return_inverse=True)
            step = error * val
            grad_w = np.bincount(where, step, len(used)).astype(np.float32) + DECAY * model.w[used]
            by_factor = step[:, None] * (np.repeat(sums, lens, axis=0) - terms)
            grad_v = np.column_stack([np.bincount(where, by_factor[:, f], len(used)) for f in range(FACTORS)]).astype(np.float32)
            grad_v += DECAY * model.v[used]
            seen_w[used] += grad_w ** 2 * 1e3
            seen_v[used] += (grad_v ** 2).sum(axis=1) * 1e3
            model.w[used] -= RATE * 30 * grad_w / np.sqrt(seen_w[used])
            model.v[used] -= RATE * 30 * grad_v / np.sqrt(seen_v[used])[:, None]
            model.bias -= RATE * float((_sigmoid(score) - labels[some]).mean())
    return model


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1


_ROWS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("label", T.IntegerType()),
                      T.StructField("idx", T.BinaryType()), T.StructField("val", T.BinaryType())])


def _extract(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for p in parts:
        found = [features(t, n) for t, n in zip(p["text"], p["n_chars"])]
        yield pd.DataFrame({"doc_id": p["doc_id"], "label": p["label"], "idx": [f[0].tobytes() for f in found], "val": [f[1].tobytes() for f in found]})


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled documents that are not held out."""
    chosen = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
              .groupBy("doc_id").agg(F.max("quality").alias("label"))
              .orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id").limit(sample))
    text, n_chars = F.coalesce("text", F.lit("")), F.col("n_chars").cast("double")
    one = F.min(F.struct(F.xxhash64("text", n_chars).alias("hash"), text.alias("text"), n_chars.alias("n_chars")))
    rows = (docs.select("doc_id", "text", "n_chars").join(F.broadcast(chosen), "doc_id")  # at most ``sample`` rows
            .groupBy("doc_id", "label").agg(one.alias("one"))  # of repeated ids one text, combined in the map tasks
            .select("doc_id", "one.text", "one.n_chars", "label").mapInPandas(_extract, _ROWS).collect())
    rows = sorted(rows, key=lambda r: r.doc_id)
    return fit([(np.frombuffer(r.idx, np.int32).astype(np.int64), np.frombuffer(r.val, np.float32)) for r in rows],
               np.array([r.label for r in rows], np.float32))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``__score``."""
    @F.pandas_udf("double")
    def fm_score(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, n_chars in parts:
            out = np.empty(len(texts))
            for i, (t, n) in enumerate(zip(texts, n_chars)):
                idx, val = features(t, n)
                out[i] = model.raw(idx, val, np.array([0]))[0][0]
            yield pd.Series(_sigmoid(out))

    return docs.withColumn("__score", fm_score(F.col("text"), F.col("n_chars").cast("double")))


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted."""
    scored = score(docs.select("doc_id", "text", "n_chars"), train(docs, labels))
    return scored.select("doc_id", held_out().alias("held_out"), F.col("__score").alias("score"),
                         (F.col("__score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labelled: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the model, fitted on the labelled documents, does not reject."""
    return score(docs, train(labelled, labels)).where("__score >= 0.5").drop("__score")

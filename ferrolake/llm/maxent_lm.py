"""Language-model scoring with a hashed maximum-entropy model (operator 11).

The probability of a token given what stands before it is factored by classes,

    P(token | h) = P(class | h) * P(cell | class, h) * P(token | cell).

The first two are softmaxes over 32 outcomes. Their features are the last word, the last two words, and the
words two and three places back with the words between skipped, each hashed into its own part of a weight table; the
biases are the unigram counts. The most frequent words (991 and the end of a text) are cells of their own, binned into
classes by frequency. All others make up the last class, which has no cells: a word has its smoothed share of the
training counts there, (c + 1) / (S + n + 1) with S tokens and n distinct words in the class, as in the base model.

Texts are split and lower-cased by Arrow, a few megabytes at a time, and each distinct word of such a piece is looked up
once.

Training goes over all training texts: in each round every task takes AdaGrad steps over its share from the same
weights, and the rows of the weight table are averaged over tasks by the number of tokens that moved them. At most one
weight table per core and round is shuffled, whatever the corpus. Scoring works in numpy batches on the rows that
a batch names.

Counts are exact for all words. A word that makes up 1 / 2^19 of the training tokens or more is *known*: there can
be at most 2^19 of them, so they go to all tasks with their counts. All other (document, word) pairs are joined with the
table of counts, which therefore has no hot key.

Defined results: a null text counts as empty, and an empty text is one end token. A null doc_id is not held out. Rows
with the same doc_id are scored one by one. Without training texts N = V = 0. An empty table gives no rows. Other columns
of the input are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import compress, repeat
from math import log10

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored

END = b""                     # no word is empty
CLASSES = CELLS = 32
REST = CLASSES - 1            # the class of the hashed cells
SINGLE = REST * CELLS         # words with a cell of their own
KNOWN = 1 << 19
FEATURES, CLASS_BITS, CELL_BITS = 4, 13, 15   # rows of each feature in the two weight tables: 2^13 and 2^15
BLOCK = 1024                  # rows of the weight table that travel together
ROUNDS, RATE, START = 2, 0.5, 1.0
STEP, TOKEN_BITS = 8192, 14   # tokens a step: from 2^13 on, less than 2^14
PIECE = 1 << 22               # bytes of texts that are split at once, unless one text is longer
FEW, RUN = 4, 8               # tokens of a row that are added one by one; above, that many at a time
TOP = 60.0                    # logits stop here
COUNTED = 1 << 24             # bytes of words, distinct in their piece, a task holds before it adds up their counts and sends them on
SPAN = 64                     # words that are not known in a row
ABSENT = -30.0                # bias of cells that hold no word

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))


def pieces(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of texts with PIECE bytes or less, or one text."""
    ends, lo = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(), dtype=np.int64), 0
    while lo < len(ends):
        hi = max(lo + 1, int(np.searchsorted(ends, PIECE + (ends[lo - 1] if lo else 0), "right")))
        yield lo, hi
        lo = hi


def tokens_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words, the end first and then the distinct ones of these texts; which of them every token is; the tokens of each text.

    A text is its lower-cased (A-Z) words between the bytes 20 and 09 to 0D, then the end.
    """
    raw = pc.fill_null(texts.cast(pa.binary()), b"").view(pa.string())   # both functions go byte by byte, as ASCII
    split = pc.ascii_split_whitespace(pc.ascii_lower(raw))
    listed = pc.dictionary_encode(split.flatten())
    words = listed.dictionary.view(pa.binary())
    at = listed.indices.to_numpy() + 1
    # White space at either end of a text leaves empty words there.
    kept = (pc.binary_length(words).to_numpy() > 0)[at - 1]
    before = np.r_[0, np.cumsum(kept)]
    size = np.diff(before[split.offsets.to_numpy()]) + 1
    token = np.zeros(int(size.sum()), np.int32)
    inner = np.ones(len(token), bool)
    inner[np.cumsum(size) - 1] = False
    token[inner] = at[kept]
    return pa.concat_arrays([pa.array([END], pa.binary()), words]), token, size


def _inputs(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", held_out().alias("held_out"), F.col("text").cast("binary").alias("text"))


# ---------------------------------------------------------------- counts

def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words, counts, held = [], [], 0

    def out() -> pa.RecordBatch:
        listed = pc.dictionary_encode(pa.concat_arrays(words))
        n = np.bincount(listed.indices.to_numpy(), weights=np.concatenate(counts), minlength=len(listed.dictionary))
        return pa.RecordBatch.from_arrays([listed.dictionary, pa.array(n.astype(np.int64))], names=["word", "n"])

    for b in batches:
        texts = b.column("text")
        for lo, hi in pieces(texts):
            distinct, token, _ = tokens_of(texts.slice(lo, hi - lo))
            words.append(distinct)
            counts.append(np.bincount(token, minlength=len(distinct)))
            held += distinct.nbytes
            if held > COUNTED:
                yield out()
                words, counts, held = [], [], 0
    if held:
        yield out()


def word_counts(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(word, n) of all training tokens, the end included as the empty word."""
    training = _inputs(docs).where(~F.col("held_out")).select("text")
    return stored(spark, training.mapInArrow(_counted, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "lm-counts")


class Vocabulary:
    """What every task needs to know: counts of the known words, the cells, their unigram biases."""

    def __init__(self, counts: DataFrame):
        total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
        self.tokens, self.distinct = total.n, total.v
        # At most KNOWN rows: their shares are 1 / KNOWN each or more. The end is needed in any case.
        rows = counts.where((F.col("n") * KNOWN >= self.tokens) | (F.col("word") == F.lit(bytearray(END)))).collect()
        rows = sorted(((r.n, bytes(r.word)) for r in rows), key=lambda r: (-r[0], r[1]))
        single = [r for r in rows if r[1] != END][:SINGLE - 1]
        end = [(n, w) for n, w in rows if w == END] or [(0, END)]
        single = sorted([*single, *end], key=lambda r: (-r[0], r[1]))
        self.single = {w: i for i, (_, w) in enumerate(single)}
        self.known = {w: n for n, w in [*rows, *end]}
        rest = self.tokens - sum(n for n, _ in single)
        mass = np.zeros((CLASSES, CELLS))
        mass.ravel()[:len(single)] = [n for n, _ in single]
        mass[REST, 0] = rest
        there = np.arange(CLASSES * CELLS).reshape(CLASSES, CELLS) < len(single)
        there[REST, 0] = True
        self.cell_bias = np.where(there, np.log((mass + 1) / (mass.max() + 1)), ABSENT).astype(np.float32)
        self.class_bias = np.where(there.any(1), np.log((mass.sum(1) + 1) / (mass.sum() + 1)), ABSENT).astype(np.float32)
        self.rest_share = log10(rest + self.distinct - sum(n > 0 for n, _ in single) + 1)   # what (c + 1) is divided by


class Codes(dict):
    """word -> its hash (32 bits), cell (10 bits) and place among the known words (0: not known, worked out anew)."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        for i, w in enumerate(vocabulary.known, 1):
            crc = zlib.crc32(w)
            self[w] = crc | vocabulary.single.get(w, SINGLE) << 32 | i << 42
        self.log_count = np.log10(np.r_[0, list(vocabulary.known.values())].astype(np.float64) + 1)
        self.n_known = np.r_[0, [1 if n else 0 for n in vocabulary.known.values()]].astype(np.int64)

    def texts(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The codes of the tokens of each text."""
        for lo, hi in pieces(column):
            words, token, size = tokens_of(column.slice(lo, hi - lo))
            yield from np.split(self.of(words.to_numpy(zero_copy_only=False).tolist())[token], np.cumsum(size)[:-1])

    def of(self, words: list[bytes]) -> np.ndarray:
        out = np.fromiter(map(self.get, words, repeat(0)), np.int64, len(words))
        rare = out == 0   # a known word has a place, so its code is not 0
        if rare.any():
            crc = np.fromiter(map(zlib.crc32, compress(words, rare.tolist())), np.int64)
            out[rare] = crc | SINGLE << 32
        return out


# ---------------------------------------------------------------- model

def _rows(codes: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Class and rows of the first weight table (4, tokens); then, of the tokens that have a cell, which they are, their cell
    and rows of the second table. ``codes`` starts with the three tokens before."""
    n = len(pos)
    word = codes[3:]
    cell = (word >> 32) & 1023
    kind = cell // CELLS
    hashes = (codes & 0xFFFFFFFF).astype(np.uint64) + np.uint64(1)
    one, two, three = (np.where(pos >= k, hashes[3 - k:3 - k + n], np.uint64(0)) for k in (1, 2, 3))
    at = np.stack([one * _M1, (one * _M2) ^ (two * _M3), two * _M1 + _M3, three * _M2 + _M1])
    at ^= at >> np.uint64(29)
    own = np.arange(FEATURES, dtype=np.int64)[:, None]
    rows1 = (own << CLASS_BITS) + ((at * _M1) >> np.uint64(64 - CLASS_BITS)).astype(np.int64)
    held = np.flatnonzero(kind < REST)
    at = (at[:, held] ^ ((kind[held].astype(np.uint64) + np.uint64(1)) * _M2)) * _M3
    at ^= at >> np.uint64(31)
    rows2 = (own << CELL_BITS) + ((at * _M1) >> np.uint64(64 - CELL_BITS)).astype(np.int64)
    return kind, rows1, held, cell[held] % CELLS, rows2


class Room:
    """Arrays that steps work in: taking rows into memory that is there already costs half as much."""

    def __init__(self, n: int = 1 << TOKEN_BITS):
        self.logits, self.more = (np.empty((n, CELLS), np.float32) for _ in range(2))
        self.grad, self.rows = (np.empty((FEATURES * n, CELLS), np.float32) for _ in range(2))


def _taken(table: np.ndarray, at: np.ndarray, room: np.ndarray) -> np.ndarray:
    return np.take(table, at, axis=0, out=room[:len(at)], mode="clip")


def _put(table: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """``table[at] = rows``, a row as one item: that takes a third of the time."""
    item = f"V{table.itemsize * table.shape[1]}"
    np.put(table.view(item), at, rows.view(item), mode="clip")


def _softmax(weights: np.ndarray, bias: np.ndarray, rows: np.ndarray, of: np.ndarray, room: Room, scaled: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of all outcomes (in ``room.logits``; up to a factor if not ``scaled``), and the natural logarithm of that of
    the outcome ``of``."""
    logits = _taken(weights, rows[0], room.logits)
    for r in rows[1:]:
        logits += _taken(weights, r, room.more)
    logits += bias
    if len(of) and logits.max() > TOP:
        np.minimum(logits, TOP, out=logits)   # no sum can overflow
    own = logits.ravel()[np.arange(0, logits.size, CELLS) + of]
    power = np.exp(logits, out=logits)
    total = power @ np.ones(power.shape[1], np.float32)
    if scaled:
        power /= total[:, None]
    return power, own.astype(np.float64) - np.log(total)


def log10_probabilities(vocabulary: Vocabulary, weights: tuple[np.ndarray, np.ndarray], codes: np.ndarray, pos: np.ndarray,
                        room: Room | None = None) -> np.ndarray:
    """log10 of P(class | h) P(cell | class, h) of every token; of P(class | h) in the last class."""
    room = room or Room()
    kind, rows1, held, cell, rows2 = _rows(codes, pos)
    _, found = _softmax(weights[0], vocabulary.class_bias, rows1, kind, room, scaled=False)
    found[held] += _softmax(weights[1], _taken(vocabulary.cell_bias, kind[held], room.rows), rows2, cell, room, scaled=False)[1]
    return found / np.log(10)


class Trainer:
    """AdaGrad steps from given weights (a rate for each row), and how often every row was moved."""

    def __init__(self, weights: tuple[np.ndarray, np.ndarray]):
        self.start = weights
        self.weights = [w.copy() for w in weights]
        self.squares = [np.full(len(w), START, np.float32) for w in weights]
        self.moved = [np.zeros(len(w), np.float32) for w in weights]
        self.room = Room()

    def _update(self, i: int, slope: np.ndarray, of: np.ndarray, rows: np.ndarray) -> None:
        slope[np.arange(len(of)), of] -= 1
        self.room.logits[len(of)] = 0   # ``slope`` is what stands before
        # Row and token in one number: sorted, the tokens of a row stand together.
        key = np.sort((rows << TOKEN_BITS | np.arange(len(of))).astype(np.uint32).ravel())
        row, token = (key >> TOKEN_BITS).astype(np.int64), (key & ((1 << TOKEN_BITS) - 1)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]][:len(row)])
        size = np.diff(np.r_[first, len(row)])
        for few in range(1, FEW + 1):   # most rows have few tokens
            at = first[size == few]
            grad = _taken(slope, token[at], self.room.grad)
            for k in range(1, few):
                grad += _taken(slope, token[at + k], self.room.rows)
            self._move(i, row[at], grad, few)
        many = size > FEW
        if many.any():
            first, size = first[many], size[many]
            runs = -(-size // RUN)
            start = np.cumsum(runs) - runs
            at, end = np.repeat(first - RUN * start, runs) + RUN * np.arange(int(runs.sum())), np.repeat(first + size, runs)
            grad = _taken(slope, token[at], self.room.grad)
            for k in range(1, RUN):   # the last run of a row may be shorter: zeros stand behind the slopes
                grad += _taken(self.room.logits, np.where(at + k < end, token[np.minimum(at + k, len(token) - 1)], len(of)), self.room.rows)
            self._move(i, row[first], np.add.reduceat(grad, start, axis=0), size)

    def _move(self, i: int, row: np.ndarray, grad: np.ndarray, size) -> None:
        squares = self.squares[i][row] + np.einsum("ij,ij->i", grad, grad)
        self.squares[i][row] = squares
        grad *= (RATE / np.sqrt(squares))[:, None]
        moved = _taken(self.weights[i], row, self.room.rows)
        moved -= grad
        _put(self.weights[i], row, moved)
        self.moved[i][row] += size

    def step(self, vocabulary: Vocabulary, codes: np.ndarray, pos: np.ndarray) -> None:
        kind, rows1, held, cell, rows2 = _rows(codes, pos)
        self._update(0, _softmax(self.weights[0], vocabulary.class_bias, rows1, kind, self.room)[0], kind, rows1)
        bias = _taken(vocabulary.cell_bias, kind[held], self.room.rows)
        self._update(1, _softmax(self.weights[1], bias, rows2, cell, self.room)[0], cell, rows2)

    def blocks(self) -> Iterator[tuple[int, bytes]]:
        """Blocks of moved rows: the change times the tokens that made it, and those tokens."""
        at = 0
        for w, w0, n in zip(self.weights, self.start, self.moved):
            for lo in range(0, len(w), BLOCK):
                cut = slice(lo, lo + BLOCK)
                if n[cut].any():
                    yield at, np.c_[(w[cut] - w0[cut]) * n[cut, None], n[cut]].astype(np.float32).tobytes()
                at += 1


def _steps(texts: Iterator[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Tokens of texts in a row, about STEP at once: their codes, with three before, and their places in the texts."""
    before, held, places, n = np.zeros(3, np.int64), [], [], 0
    for codes in texts:
        for at in range(0, len(codes), STEP):
            piece = codes[at:at + STEP]
            held.append(piece)
            places.append(np.arange(at, at + len(piece)))
            n += len(piece)
            if n >= STEP:
                whole = np.concatenate([before, *held])
                yield whole, np.concatenate(places)
                before, held, places, n = whole[-3:], [], [], 0
    if n:
        yield np.concatenate([before, *held]), np.concatenate(places)


def empty_weights() -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.zeros((FEATURES << bits, CELLS), np.float32) for bits in (CLASS_BITS, CELL_BITS))


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks added up as they come: a partition holds each of its blocks once."""
    sums: dict[int, np.ndarray] = {}
    for b in batches:
        for block, data in zip(b.column("block").to_pylist(), b.column("data").to_pylist()):
            got = np.frombuffer(data, np.float32)
            sums[block] = sums[block] + got if block in sums else got
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], names=["block", "data"])


def train(spark: SparkSession, docs: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Weights after ``rounds`` distributed updates, each over its share of all training texts."""
    weights = empty_weights()
    shared = spark.sparkContext.broadcast(vocabulary)
    # A task per core: a weight table for each is shuffled, however large the corpus is.
    texts = _inputs(docs).where(~F.col("held_out")).coalesce(spark.sparkContext.defaultParallelism)
    for turn in range(rounds):
        now = spark.sparkContext.broadcast(weights)

        def run(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            known = shared.value
            codes, trainer = Codes(known), Trainer(now.value)
            read = (text for b in batches for text in codes.texts(b.column("text")))
            for step in _steps(read):
                trainer.step(known, *step)
            for block, data in trainer.blocks():
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([data], pa.binary())], names=["block", "data"])

        share = texts.where(F.pmod(F.xxhash64("doc_id"), F.lit(rounds)) == turn).select("text")
        moved = share.mapInArrow(run, "block int, data binary").repartition("block").mapInArrow(_summed, "block int, data binary")
        blocks = {r.block: np.frombuffer(r.data, np.float32).reshape(-1, CELLS + 1) for r in moved.collect()}   # one weight table
        whole = np.concatenate(weights)
        for block, b in blocks.items():
            whole[block * BLOCK:block * BLOCK + len(b)] += b[:, :-1] / np.maximum(b[:, -1:], 1)
        weights = whole[:len(weights[0])], whole[len(weights[0]):]
        now.destroy()
    shared.destroy()
    return weights


# ---------------------------------------------------------------- scores

_SCORED = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, logs double, score double, rare array<struct<word:binary,n:bigint>>"


def _score_rows(shared, now):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, weights, room = shared.value, now.value, Room()
        codes, row = Codes(known), TaskContext.get().partitionId() << 40

        def scored(ids: pa.Array, out: pa.Array, texts: pa.Array) -> pa.RecordBatch:
            """Documents and, up to SPAN in a row of their own (n_tokens 0), their words that are not known."""
            nonlocal row
            distinct, at, size = tokens_of(texts)
            coded = codes.of(distinct.to_numpy(zero_copy_only=False).tolist())
            token = coded[at]
            end = np.cumsum(size)
            start = end - size
            logp = np.concatenate([log10_probabilities(known, weights, *s, room) for s in _steps(iter(np.split(token, end[:-1])))])
            cell, place = (token >> 32) & 1023, token >> 42
            logs = codes.log_count[place]
            # The share of a word in the last class; log10(c + 1) of words that are not known comes from the join.
            logp += np.where(cell >= SINGLE, logs - known.rest_share, 0.0)
            rare = np.flatnonzero(place == 0)
            pair, counts = np.unique(np.repeat(np.arange(len(size)) * len(distinct), size)[rare] + at[rare], return_counts=True)
            words = distinct.take(pa.array(pair % len(distinct)))
            many = np.bincount(pair // len(distinct), minlength=len(size))
            spans = -(-many // SPAN)
            k, m = len(size), int(spans.sum())
            lens = np.minimum(SPAN, np.repeat(many, spans) - SPAN * (np.arange(m) - np.repeat(np.cumsum(spans) - spans, spans)))
            ends = pa.array(np.r_[np.zeros(k + 1, np.int64), np.cumsum(lens)].astype(np.int32))
            listed = pa.StructArray.from_arrays([words, pa.array(counts, pa.int64())], names=["word", "n"])
            number = np.arange(row, row + k)
            numbers = [pa.array(np.r_[x, np.zeros(m, x.dtype)], t) for x, t in (
                (size.astype(np.int64), pa.int64()), (np.add.reduceat(codes.n_known[place], start), pa.int64()),
                (np.add.reduceat(logs, start), pa.float64()), (np.add.reduceat(logp, start), pa.float64()))]
            batch = pa.RecordBatch.from_arrays(
                [pa.array(np.r_[number, np.repeat(number, spans)], pa.int64()), pa.concat_arrays([ids.cast(pa.int64()), pa.nulls(m, pa.int64())]), pa.concat_arrays([out, pa.nulls(m, pa.bool_())]),
                 *numbers, pa.ListArray.from_arrays(ends, listed)],
                names=["row", "doc_id", "held_out", "n_tokens", "n_known", "logs", "score", "rare"])
            row += k
            return batch

        for b in batches:
            for lo, hi in pieces(b.column("text")):
                yield scored(*(b.column(c).slice(lo, hi - lo) for c in ("doc_id", "held_out", "text")))

    return run


def score(spark: SparkSession, docs: DataFrame, counts: DataFrame, vocabulary: Vocabulary, weights: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    shared, now = spark.sparkContext.broadcast(vocabulary), spark.sparkContext.broadcast(weights)
    rows = stored(spark, _inputs(docs).mapInArrow(_score_rows(shared, now), _SCORED), "lm-scored")
    rare = rows.where(F.col("n_tokens") == 0).select("row", F.inline("rare"))   # a document has one token or more, its end
    seen = counts.where(F.col("n") * KNOWN < vocabulary.tokens).select("word", F.col("n").alias("c"))
    # The counts are dealt out over all tasks, one row per word: a hash table of a task's share spares two sorts.
    more = rare.join(seen.hint("shuffle_hash"), "word").groupBy("row").agg(F.sum("n").alias("more_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("more"))
    out = rows.where(F.col("n_tokens") > 0).join(more, "row", "left")
    gained = F.coalesce("more", F.lit(0.0))
    each = F.lit(log10(vocabulary.tokens + vocabulary.distinct + 1))
    return out.select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
                      F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
                      (F.col("logs") + gained - F.col("n_tokens") * each).alias("base_score"), (F.col("score") + gained).alias("score"))


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Texts reach Python 1,000 at a time: less memory per task."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "1000")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def lm_report(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Counts, training and scores over all documents."""
    with _small_batches(spark):
        counts = word_counts(spark, docs)
        vocabulary = Vocabulary(counts)
        return score(spark, docs, counts, vocabulary, train(spark, docs, vocabulary))

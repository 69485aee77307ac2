"""SentencePiece BPE encoding with seeded merge-dropout, and lossless decoding (operator 4).

A merge-type (BPE) SentencePiece model is applied with an agenda of candidate merges, best score first, then
leftmost. Each candidate is skipped for good with probability ``dropout``, decided by a keyed hash of the
occurrence (seed, doc_id, position in the text and copy of the row), the word, the candidate's place in it and
its two pieces; so every occurrence of a word is cut on its own, and yet every rerun agrees. Without dropout
each distinct word of a chunk is worked out once.

Words (leading spaces and what follows up to the next space) never merge with each other; ``Pieces`` refuses a
model where they could. The agendas of a chunk's words run in lockstep on numpy matrices, a column for each word:
per round each word takes its best live candidate. Words of more than ``LONG`` symbols use a heap instead, so
text without spaces costs n log n.

Characters that the model lacks, and a literal U+2581, become byte pieces. A space put before a non-empty text
is taken off when decoding, so decode(encode(text)) is the text, whatever it holds.

Defined results: null and empty texts have no pieces and decode to the empty text; a null doc_id counts as -1
in the hash; repeated rows get equal segmentations unless ``copy`` tells them apart; an empty table gives an empty result. Rows are
independent: no shuffle, and memory is bounded by a chunk of words or one text, whichever is larger.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bagminhash import mix

DROPOUT = 0.1
SEED = 4
LONG = 64
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
_CHUNK_WORDS = 1_000_000
_ROUND_WORDS = 100_000
_HEIGHTS = (*range(1, 13), 16, 24, 40, LONG)   # words of at most so many symbols are worked on side by side
_COLUMNS = 8192
_NEVER = np.int32(2**31 - 1)
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_WORD = re.compile(r" *[^ ]+| +")
_SPACE = "▁"


def _times(n: int, factor: np.uint64) -> np.uint64:
    return np.uint64(n * int(factor) % 2**64)


class Pieces:
    """The vocabulary of a merge-type model: symbols of characters, ranked merges, bytes of pieces."""

    def __init__(self, model: bytes) -> None:
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        byte = {int(names[i][3:5], 16): i for i in range(len(names)) if sp.is_byte(i)}
        if len(byte) < 256:
            raise ValueError("a model with byte fallback is needed for lossless decoding")
        normal = {p: i for i, p in enumerate(names) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))}
        if any(re.search(f"[^{_SPACE}]{_SPACE}", p) for p in normal):
            raise ValueError("a piece of this model crosses words")
        ranks = {s: r for r, s in enumerate(sorted({sp.get_score(i) for i in normal.values()}, reverse=True))}
        merges = [(normal[p[:k]] << 32 | normal[p[k:]], i, ranks[sp.get_score(i)])
                  for p, i in normal.items() for k in range(1, len(p)) if p[:k] in normal and p[k:] in normal]
        pair, into, rank = (np.array(x, t) for x, t in zip(zip(*merges), (np.int64, np.int32, np.int32)))
        # A hash table with linear probing, at most a quarter full.
        self.slots = (1 << int(4 * len(merges)).bit_length()) - 1
        self.pair, self.into, self.rank = np.full(self.slots + 1, -1), np.zeros(self.slots + 1, np.int32), np.full(self.slots + 1, _NEVER)
        rest, at = np.arange(len(pair)), self._slot(pair)
        while len(rest):
            free = np.flatnonzero(self.pair[at] < 0)
            slot, first = np.unique(at[free], return_index=True)
            put = rest[free[first]]
            self.pair[slot], self.into[slot], self.rank[slot] = pair[put], into[put], rank[put]
            left = np.ones(len(rest), dtype=bool)
            left[free[first]] = False
            rest, at = rest[left], (at[left] + 1) & self.slots
        self.merge, self.ranks = {p: (r, i) for p, i, r in merges}, len(ranks)
        self.single = np.full(0x110000, -1, np.int32)
        for p, i in normal.items():
            if len(p) == 1:
                self.single[ord(p)] = i
        self.single[ord(" ")], self.single[ord(_SPACE)] = normal[_SPACE], -1
        self.byte = np.array([byte[b] for b in range(256)], np.int32)
        for b in range(128):
            if self.single[b] < 0:
                self.single[b] = byte[b]
        self.raw = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace(_SPACE, " ").encode() if p in normal else b""
                    for i, p in enumerate(names)]

    def symbols(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(symbols, symbols per word, a hash per word); characters without a piece become their bytes."""
        code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        lens = np.fromiter(map(len, words), np.int64, len(words))
        start = np.cumsum(lens) - lens
        place = np.arange(len(code)) - np.repeat(start, lens)
        hashed = np.add.reduceat(mix(code.astype(np.uint64) * _A + place.astype(np.uint64) * _B), start)
        out = self.single[code]
        odd = np.flatnonzero(out < 0)
        if len(odd):
            raws = [chr(c).encode() for c in code[odd]]
            times = np.ones(len(code), np.int64)
            times[odd] = [len(r) for r in raws]
            first = np.cumsum(times) - times
            out = np.repeat(out, times)
            for at, r in zip(first[odd], raws):
                out[at:at + len(r)] = self.byte[list(r)]
            lens = np.add.reduceat(times, start)
        return out, lens, mix(hashed)

    def candidates(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged piece) of neighbours, _NEVER where they don't merge."""
        want = left.astype(np.int64) << 32 | right
        at = self._slot(want)
        found = self.pair[at]
        on = np.flatnonzero((found != want) & (found >= 0))
        while len(on):   # the slot holds another pair: the next ones, up to an empty one
            at[on] = (at[on] + 1) & self.slots
            found = self.pair[at[on]]
            on = on[(found != want[on]) & (found >= 0)]
        return np.where(self.pair[at] == want, self.rank[at], _NEVER), self.into[at]

    def _slot(self, pair: np.ndarray) -> np.ndarray:
        return ((pair.view(np.uint64) * _A) >> np.uint64(40)).astype(np.int64) & self.slots


@lru_cache(maxsize=4)
def pieces_of(model: bytes) -> Pieces:
    return Pieces(model)


def _skipped(key, place, left, right, dropout: float):
    """Whether the candidate (left, right) that begins at symbol ``place`` of a word is skipped."""
    u = np.uint64
    h = mix(key + place.astype(u) * _A + left.astype(u) * _B + right.astype(u) * _C)
    return (h >> u(11)).astype(np.float64) < dropout * float(1 << 53)


def _heap_word(p: Pieces, symbols: np.ndarray, key: np.uint64, dropout: float) -> list[int]:
    """The agenda of one word on a heap; the same result as ``_lockstep``."""
    n = len(symbols)
    sym, after, before = symbols.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
    agenda: list[tuple[int, int, int, int]] = []

    def offer(i: int, j: int) -> None:
        found = p.merge.get(sym[i] << 32 | sym[j])
        if found and not (dropout and _skipped(key, *(np.array([x]) for x in (i, sym[i], sym[j])), dropout)[0]):
            heapq.heappush(agenda, (found[0], i, sym[i], sym[j]))

    with np.errstate(over="ignore"):
        for i in range(n - 1):
            offer(i, i + 1)
        while agenda:
            _, i, left, right = heapq.heappop(agenda)
            j = after[i] if sym[i] >= 0 else n
            if j >= n or sym[i] != left or sym[j] != right:
                continue  # one of the two has merged meanwhile
            sym[i], sym[j] = p.merge[left << 32 | right][1], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                offer(i, after[i])
            if before[i] >= 0:
                offer(before[i], i)
    return [s for s in sym if s >= 0]


def _agendas(p: Pieces, sym: np.ndarray, keys: np.ndarray, dropout: float) -> np.ndarray:
    """The agendas of words of like length at once. ``sym`` has a column for each word, its symbols down, the rest and
    the last row -1; it is worked on in place and keeps the pieces, -1 where a symbol went into the one before it."""
    top, n = sym.shape[0] - 1, sym.shape[1]
    bits = top.bit_length()
    order = np.int32 if p.ranks << bits < _NEVER else np.int64
    row = np.arange(top + 1, dtype=np.int32)[:, None]
    after, before = (np.repeat(r, n, axis=1).ravel() for r in (row + np.int32(1), row - np.int32(1)))
    before[:n] = top   # the last row stands for what lies outside of a word
    flat, into, never = sym.ravel(), np.empty(sym.size, np.int32), order(np.iinfo(order).max)

    def scored(place, cell: np.ndarray, left: np.ndarray, right: np.ndarray, column: np.ndarray) -> np.ndarray:
        """Rank and place in one number, the smaller the earlier, of symbols and their right neighbours."""
        rank, into[cell] = p.candidates(left, right)
        live = np.flatnonzero(rank < _NEVER)
        out = np.full(len(rank), never)
        out[live] = (rank[live].astype(order) << bits) + place[live]
        if dropout:
            out[live[_skipped(keys[column[live]], place[live], left[live], right[live], dropout)]] = never
        return out

    column = np.arange(n)
    agenda = np.full((top + 1, n), never)
    if top > 1:
        agenda[:top - 1] = scored(np.repeat(row[:top - 1, 0], n), np.arange((top - 1) * n), flat[:(top - 1) * n],
                                  flat[n:top * n], np.tile(column, top - 1)).reshape(top - 1, n)
    while True:
        best = agenda.min(axis=0)
        live = np.flatnonzero(best < never)
        if not len(live):
            return sym
        best = best[live]
        if 4 * len(live) < 3 * agenda.shape[1]:
            agenda, column = np.take(agenda, live, axis=1), column[live]
            live = np.arange(len(live))
        word, cells, m = column[live], agenda.reshape(-1), agenda.shape[1]
        i = (best & order((1 << bits) - 1)).astype(np.int64)
        at = i * n + word
        j = after[at].astype(np.int64)
        gone = j * n + word
        k = after[gone]
        following = k.astype(np.int64) * n + word
        h = before[at].astype(np.int64)
        leading = h * n + word
        flat[at] = piece = into[at]
        flat[gone] = -1
        after[at], before[following] = k, i
        cells[j * m + live] = never
        cells[i * m + live] = scored(i, at, piece, flat[following], word)
        cells[h * m + live] = scored(h, leading, flat[leading], piece, word)


def _lockstep(p: Pieces, sym: np.ndarray, lens: np.ndarray, keys: np.ndarray, dropout: float) -> tuple[np.ndarray, np.ndarray]:
    """All words' agendas, side by side in matrices of words of like length: (pieces, pieces per word)."""
    out, start = sym.astype(np.int32), np.cumsum(lens) - lens
    order = np.argsort(lens, kind="stable")
    heights = [*_HEIGHTS, int(lens.max(initial=0))]
    ends = np.searchsorted(lens[order], heights, "right")
    for begin, end, height in zip([0, *ends], ends, heights):
        for lo in range(begin, end, _COLUMNS):
            words = order[lo:min(lo + _COLUMNS, end)]
            cell = start[words] + np.arange(height)[:, None]
            there = np.arange(height)[:, None] < lens[words]
            columns = np.full((height + 1, len(words)), -1, np.int32)
            columns[:height][there] = sym[cell[there]]
            out[cell[there]] = _agendas(p, columns, keys[words], dropout)[:height][there]
    kept = out >= 0
    return out[kept], np.add.reduceat(kept, start, dtype=np.int64) if len(start) else np.zeros(0, np.int64)


def encode_words(p: Pieces, words: list[str], lanes: np.ndarray, dropout: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(pieces, pieces per word) of words; ``lanes`` tells the occurrences of a word apart."""
    flat, counts = [], []
    for at in range(0, len(words), _ROUND_WORDS):
        some = words[at:at + _ROUND_WORDS]
        sym, lens, hashed = p.symbols(some)
        keys = mix(hashed + (lanes[at:at + len(some)].astype(np.uint64) + np.uint64(1)) * _C + _times(seed, _B))
        long = np.flatnonzero(lens > LONG)
        if not len(long):
            got, n = _lockstep(p, sym, lens, keys, dropout)
        else:
            start = np.cumsum(lens) - lens
            short = lens <= LONG
            got_short, n = _lockstep(p, sym[np.repeat(short, lens)], lens[short], keys[short], dropout)
            own = [None] * len(some)
            for i, part in zip(np.flatnonzero(short), np.split(got_short, np.cumsum(n)[:-1])):
                own[i] = part
            for i in long:
                own[i] = np.array(_heap_word(p, sym[start[i]:start[i] + lens[i]], keys[i], dropout), np.int64)
            got, n = np.concatenate(own), np.array([len(x) for x in own])
        flat.append(got)
        counts.append(n)
    return (np.concatenate(flat), np.concatenate(counts)) if flat else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def split_words(text: str) -> list[str]:
    """Words with their leading spaces, of a text with a space put before it."""
    if not text:
        return []
    if "  " in text or text[0] == " " or text[-1] == " ":
        return _WORD.findall(" " + text)
    return [" " + w for w in text.split(" ")]


def encode_texts(p: Pieces, texts: list[str | None], ids: list[int | None], dropout: float = DROPOUT, seed: int = SEED,
                 copies: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(pieces of all texts back to back, pieces per text)."""
    flat, counts, at = [], [], 0
    while at < len(texts):
        every, sizes = [], []
        while at + len(sizes) < len(texts) and len(every) < _CHUNK_WORDS:
            words = split_words(texts[at + len(sizes)] or "")
            sizes.append(len(words))
            every += words
        size = np.array(sizes, np.int64)
        if dropout:
            doc = np.array([-1 if i is None else i for i in ids[at:at + len(sizes)]], np.int64).astype(np.uint64)
            copy = np.array(copies[at:at + len(sizes)] if copies else [0] * len(sizes), np.uint64)
            place = np.arange(len(every)) - np.repeat(np.cumsum(size) - size, size)
            row = mix(mix(doc + _times(seed, _A)) + copy * _C)
            words, lane, which = every, mix(np.repeat(row, size) + place.astype(np.uint64) * _B), np.arange(len(every))
        else:
            words = list(dict.fromkeys(every))
            numbers = dict(zip(words, range(len(words))))
            lane, which = np.zeros(len(words), np.uint64), np.fromiter(map(numbers.__getitem__, every), np.int64, len(every))
        got, n = encode_words(p, words, lane, dropout, seed)
        first = np.cumsum(n) - n
        times = n[which]
        end = np.cumsum(times)
        flat.append(got[np.repeat(first[which] - (end - times), times) + np.arange(int(times.sum()))].astype(np.int32))
        total = np.concatenate([[0], end])
        upto = np.cumsum(size)
        counts.append(total[upto] - total[upto - size])
        at += len(sizes)
    return (np.concatenate(flat), np.concatenate(counts)) if flat else (np.zeros(0, np.int32), np.zeros(0, np.int64))


def decode(p: Pieces, ids: list[int]) -> str:
    return b"".join(map(p.raw.__getitem__, ids)).decode("utf-8", "replace")[1:]


def _encoder(model: bytes, dropout: float, seed: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces_of(model)
        for b in batches:
            texts, ids = b.column(1).to_pylist(), b.column(0).to_pylist()
            flat, n = encode_texts(p, texts, ids, dropout, seed, b.column(2).to_pylist())
            ends = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
            whole = [decode(p, flat[s:e].tolist()) == (t or "") for t, s, e in zip(texts, ends, ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.array(whole, pa.bool_())],
                names=["doc_id", "n_pieces", "pieces", "round_trip"])

    return run


def encode(docs: DataFrame, model_path: str = MODEL_PATH, dropout: float = DROPOUT, seed: int = SEED, copy: Column | None = None) -> DataFrame:
    """One row per input row: doc_id, n_pieces, pieces, round_trip (whether decoding gave the whole text back).
    ``copy`` (a never-null long) numbers repeated rows, which then vary too."""
    with open(model_path, "rb") as f:  # on the driver; tasks get the half megabyte with their code
        model = f.read()
    return docs.select("doc_id", "text", (F.lit(0) if copy is None else copy).cast("long").alias("copy")).mapInArrow(
        _encoder(model, dropout, seed), "doc_id long, n_pieces long, pieces array<int>, round_trip boolean")


def decoded(encoded: DataFrame, model_path: str = MODEL_PATH) -> DataFrame:
    """doc_id and text of rows with doc_id and pieces."""
    with open(model_path, "rb") as f:
        model = f.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces_of(model)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([decode(p, x or []) for x in b.column(1).to_pylist()], pa.string())],
                                             names=["doc_id", "text"])

    return encoded.select("doc_id", "pieces").mapInArrow(run, "doc_id long, text string")

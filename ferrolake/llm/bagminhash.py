"""BagMinHash signatures of weighted sets (multisets of word shingles), vectorised over many documents.

Each element has Poisson processes over its weight axis, one per dyadic piece [0,1), [1,2), [2,4), [4,8)...,
seeded by the element and the piece, the same in every document. A point of a process carries a time and a
slot of the signature; the signature keeps the earliest time per slot among points at levels below the
element's weight. A piece that has given its first point, or that a weight falls into, is split in two: a
hashed bit leaves the point at hand to one half, and the other half goes on from there at half the rate, down
to unit levels. The chance that two signatures agree in a slot is the weighted Jaccard similarity of the two multisets.

Times are generated in order, so a process ends as soon as its next point comes later than the latest slot:
about one point per element plus slots * log(slots) per document.
"""

from __future__ import annotations

import numpy as np

_M1, _M2, _M3 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


def _uniform(h: np.ndarray) -> np.ndarray:
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def _after(at: np.ndarray, state: np.ndarray, rate: np.ndarray | int) -> np.ndarray:
    return at - np.log(_uniform(state)) / rate


def signatures(elements: np.ndarray, weights: np.ndarray, owners: np.ndarray, n: int, slots: int) -> np.ndarray:
    """(n, slots) 64-bit signatures of n documents: element e of weight w >= 1 belongs to document owners[e].
    Equal elements of one document must have been counted together. Documents without elements get all ones."""
    elements = elements.astype(np.uint64)
    first = np.full(n * slots, np.inf)
    name = np.full(n * slots, _NONE, dtype=np.uint64)
    last = np.full(n, np.inf)  # the latest slot of each document
    # The agenda: one row per piece with its next point. (lo, width): the piece; state: its random stream;
    # point: names that point and its slot; at: its time; done: the signature has it already.
    top = np.ceil(np.log2(np.maximum(weights, 1))).astype(np.int64)  # pieces 0..top cover [0, 2**top)
    who = np.repeat(np.arange(len(elements)), top + 1)
    piece = np.arange(len(who)) - np.repeat(np.cumsum(top + 1) - (top + 1), top + 1)
    lo = np.where(piece == 0, 0, 1 << np.maximum(piece - 1, 0)).astype(np.int64)
    width = np.maximum(lo, 1)
    state = mix(elements[who] + _M3 * (piece + 1).astype(np.uint64))
    point, at = mix(state + _M1), _after(np.zeros(len(state)), state, width)
    owner, limit, done = owners[who].astype(np.int64), weights[who].astype(np.int64), np.zeros(len(who), dtype=bool)
    turn = 0

    def put(points: np.ndarray, times: np.ndarray, owners_: np.ndarray) -> None:
        slot = owners_ * slots + (points % np.uint64(slots)).astype(np.int64)
        np.minimum.at(first, slot, times)
        won = first[slot] == times
        name[slot[won]] = points[won]

    while len(at):
        fresh = ~done & (lo + width <= limit)
        put(point[fresh], at[fresh], owner[fresh])
        last = first.reshape(n, slots).max(axis=1)
        done = done | fresh
        live = at < last[owner]
        lo, width, state, point, at, owner, limit, done = (a[live] for a in (lo, width, state, point, at, owner, limit, done))
        # Unit pieces give their next points, more in each turn: what is left by then has few elements to fill its slots.
        unit = width == 1
        next_state = mix(state[unit] + _M2)
        draws = mix(next_state[:, None] + _M3 * np.arange(1, (1 << max(0, min(turn - 2, 8))) + 1, dtype=np.uint64))
        times = at[unit][:, None] - np.cumsum(np.log(_uniform(draws)), axis=1)
        of = np.broadcast_to(owner[unit][:, None], draws.shape)
        early = times < last[of]
        put(mix(draws[early] + _M1), times[early], of[early])
        # Wider ones are split. One half keeps the point, the other goes on from it at half the rate.
        # All of this depends on the element and the turn alone, never on a weight.
        wide = ~unit
        half = width[wide] // 2
        upper = (mix(state[wide] + _M3) & np.uint64(1)).astype(np.int64)
        keep_state, free_state = mix(state[wide] ^ _M2), mix(state[wide] ^ _M3)
        lo = np.concatenate([lo[unit], lo[wide] + upper * half, lo[wide] + (1 - upper) * half])
        width = np.concatenate([width[unit], half, half])
        point = np.concatenate([point[unit], point[wide], mix(free_state + _M1)])
        at = np.concatenate([times[:, -1], at[wide], _after(at[wide], free_state, np.maximum(half, 1))])
        state = np.concatenate([next_state, keep_state, free_state])
        owner = np.concatenate([owner[unit], owner[wide], owner[wide]])
        limit = np.concatenate([limit[unit], limit[wide], limit[wide]])
        done = np.concatenate([np.ones(len(next_state), dtype=bool), done[wide], np.zeros(len(half), dtype=bool)])
        useful = (lo < limit) & (at < last[owner])
        lo, width, state, point, at, owner, limit, done = (a[useful] for a in (lo, width, state, point, at, owner, limit, done))
        turn += 1
    return name.reshape(n, slots)

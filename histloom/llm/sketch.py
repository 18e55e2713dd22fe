"""Word shingles of whole texts and their fast similarity sketch, on numpy arrays.

The sketch follows the published fast similarity sketching: in rounds
0 .. t-1 every element is thrown into one of t bins by a hash of the round, with
value round + fraction; in rounds t .. 2t-1 every element goes to bin
``round - t``.  A bin keeps its least value; after the round that leaves no bin
empty the sketch is done.  So every coordinate fills, large sets need about one
round, and the number of equal coordinates of two sketches is concentrated about
t times their Jaccard similarity."""

from __future__ import annotations

import numpy as np

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True

_BASE = 0x9E3779B97F4A7C15                     # odd base of the words' polynomial hash
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0xD1342543DE82EF95)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)

#: Words per shingle.
WIDTH = 5


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_powers = np.ones(1, np.uint64)


def _powers_to(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        size = 1 << (n - 1).bit_length()
        _powers = np.concatenate([np.ones(1, np.uint64), np.full(size - 1, _BASE, np.uint64)]).cumprod(dtype=np.uint64)
    return _powers


def word_hashes(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of texts laid end to end in ``raw`` (text d
    from ``starts[d]`` to ``starts[d+1]``), and each text's number of words.
    Words are runs of other bytes than space and tab to CR; A-Z count as a-z."""
    n_docs = len(starts) - 1
    solid = ~_SPACE[raw]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    cuts = starts[:-1][starts[:-1] < len(raw)]
    first[cuts] |= solid[cuts]
    begin = np.flatnonzero(first)
    if not len(begin):
        return np.zeros(0, np.uint64), np.zeros(n_docs, np.int64)
    counts = np.diff(np.searchsorted(begin, starts))
    places = np.flatnonzero(solid)
    at = np.searchsorted(places, begin)        # where each word begins among the solid bytes
    length = np.diff(np.append(at, len(places)))
    offset = np.arange(len(places)) - np.repeat(at, length)
    values = (_LOWER[raw[places]].astype(np.uint64) + np.uint64(1)) * _powers_to(int(length.max()))[offset]
    return mix(np.add.reduceat(values, at) + length.astype(np.uint64) * _STEP), counts


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its WIDTH-word shingles; of a text
    with fewer words, one hash of the whole sequence; none without words."""
    starts = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
    words, counts = word_hashes(np.frombuffer(b"".join(texts), np.uint8), starts)
    rows = max(0, len(words) - WIDTH + 1)
    rolled = words[:rows].copy()
    for k in range(1, WIDTH):
        rolled = (rolled ^ (rolled >> np.uint64(29))) * _STEP + words[k:k + rows]
    rolled = mix(rolled)
    out, at = [], 0
    for n in counts.tolist():
        if n >= WIDTH:
            out.append(np.unique(rolled[at:at + n - WIDTH + 1]))
        elif n:
            h = np.array([n], np.uint64)
            for i in range(at, at + n):
                h = mix((h ^ (h >> np.uint64(29))) * _STEP + words[i:i + 1])
            out.append(h)
        else:
            out.append(np.zeros(0, np.uint64))
        at += n
    return out


def fast_similarity_sketch(sets: list[np.ndarray], t: int, seed: int = 1) -> np.ndarray:
    """(len(sets), t) sketches; the rows of empty sets stay at the largest value.
    The round is the top byte of a value, so ``t`` is at most 128."""
    if not 1 <= t <= 128:
        raise ValueError("t must be from 1 to 128")
    sizes = np.array([len(s) for s in sets], np.int64)
    table = np.full(len(sets) * t, _EMPTY, np.uint64)
    elements = np.concatenate([np.zeros(0, np.uint64), *sets])
    owner = np.repeat(np.arange(len(sets), dtype=np.int64), sizes)
    for i in range(2 * t):
        if not len(elements):
            break
        h = mix(elements + np.uint64((seed * 2 * 128 + i + 1) * int(_M1) & 0xFFFFFFFFFFFFFFFF))
        value = (mix(h + _STEP) >> np.uint64(8)) | np.uint64(i << 56)
        if i < t:
            place = ((h >> np.uint64(32)) * np.uint64(t) >> np.uint64(32)).astype(np.int64)
        else:
            place = np.int64(i - t)
        np.minimum.at(table, owner * t + place, value)
        unfinished = (table.reshape(-1, t) == _EMPTY).any(axis=1)
        going = unfinished[owner]
        if not going.all():
            elements, owner = elements[going], owner[going]
    return table.reshape(-1, t)


def band_keys(sketches: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band of ``rows`` coordinates (the band's number is part of it)."""
    bands = sketches.shape[1] // rows
    out = np.empty((len(sketches), bands), np.uint64)
    for b in range(bands):
        key = np.full(len(sketches), b + 1, np.uint64)
        for column in sketches[:, b * rows:(b + 1) * rows].T:
            key = mix((key ^ (key >> np.uint64(29))) * _STEP + column)
        out[:, b] = key
    return out


def intersections(sets: list[np.ndarray], width: int = 2048) -> np.ndarray:
    """Exact sizes of the intersections of all different pairs (the diagonal has
    no meaning): products of 0/1 matrices over the elements that occur at least
    twice, ``width`` of them at a time."""
    out = np.zeros((len(sets), len(sets)), np.float64)
    sizes = [len(s) for s in sets]
    if not sum(sizes):
        return out
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, column, uses = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = uses[column] > 1
    renumber = np.cumsum(uses > 1) - 1
    owner, column = owner[shared], renumber[column[shared]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [low, low + width])
        block = np.zeros((len(sets), width), np.float32)
        block[owner[a:b], column[a:b] - low] = 1
        out += block @ block.T
    return out

"""SentencePiece encoding with seeded merge-dropout, and decoding.

Merges are taken from an agenda (best score first, leftmost of equals).  Each
candidate that comes up is skipped with probability ``dropout``.  Every occurrence
of a word has coins of its own, keyed with the seed, the doc_id, the number of the
copy and the place of the word in the text: the same inputs give the same ids on
any executor and retry, another seed, document, copy or place other ids.  Any
segmentation decodes to the same text.

The agendas of many words are worked off side by side as arrays, one candidate of each
at a time; a word that needs more coins than were dealt, or is very long, is run by itself."""

from __future__ import annotations

import math
import struct
from array import array
from bisect import bisect_right
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush
from itertools import chain, count, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts
from .pieces import DEFAULT_MODEL, MARK, Vocabulary, load_vocabulary, pre_tokens

#: Stretches up to this length keep their agenda in a list, longer ones in a heap.
SHORT = 24
_COINS = struct.Struct("<8H")
#: Coins dealt to every word at once (further ones come from a keyed hash), and
#: words dealt to at a time.
WIDTH, DEALT = 32, 4096
#: Lengths up to which words are run side by side (longer ones one by one), words in
#: one such block, and words looked at together.
LENGTHS, BLOCK, AT_ONCE = (4, 6, 8, 10, 12, 16, 24, 64), 1 << 15, 1 << 17
#: The order of a merge that does not exist.
NEVER = np.iinfo(np.int32).max


def coins(stretch: str, salt: int, dropout: float) -> Iterator[bool]:
    """Whether to skip the first, second, ... candidate that comes up: 16-bit
    pieces of hashes keyed with ``salt``."""
    if dropout <= 0:
        yield from repeat(False)
    data, bar = stretch.encode(), round(dropout * 65536)
    for block in count():
        for x in _COINS.unpack(xxhash.xxh3_128_digest(data, salt + block)):
            yield x < bar


def _from_list(word: str, scores: dict[str, float], skip: Iterator[bool]) -> list[str]:
    """Pieces of a short stretch.  ``agenda[i]`` is the score of merging the
    symbols i and i + 1, or minus infinity (no piece, or skipped); the best is
    taken first, of equals the leftmost."""
    symbols = list(word)
    get, never = scores.get, -math.inf
    agenda = [get(a + b, never) for a, b in zip(symbols, symbols[1:])]
    while agenda:
        best = max(agenda)
        if best == never:
            break
        i = agenda.index(best)
        if next(skip):
            agenda[i] = never
            continue
        merged = symbols[i] + symbols[i + 1]
        symbols[i:i + 2] = (merged,)
        del agenda[i]
        if i < len(agenda):
            agenda[i] = get(merged + symbols[i + 1], never)
        if i:
            agenda[i - 1] = get(symbols[i - 1] + merged, never)
    return symbols


def _from_heap(word: str, scores: dict[str, float], skip: Iterator[bool]) -> list[str]:
    """Pieces of a stretch of any length, with the agenda in a heap."""
    n = len(word)
    end = list(range(1, n + 1))                # end[i]: where the symbol at i ends; 0 if merged away
    before = list(range(-1, n))                # before[i]: start of the symbol left of the one at i
    agenda = []
    for i in range(n - 1):
        s = scores.get(word[i:i + 2])
        if s is not None:
            agenda.append((-s, i, i + 1, i + 2))
    heapify(agenda)
    while agenda:
        _, left, middle, right = heappop(agenda)
        if end[left] != middle or end[middle] != right:
            continue                           # one side has been merged since
        if next(skip):
            continue
        end[left], end[middle] = right, 0
        if right < n:
            before[right] = left
            s = scores.get(word[left:end[right]])
            if s is not None:
                heappush(agenda, (-s, left, right, end[right]))
        p = before[left]
        if p >= 0:
            s = scores.get(word[p:right])
            if s is not None:
                heappush(agenda, (-s, p, left, right))
    out, i = [], 0
    while i < n:
        out.append(word[i:end[i]])
        i = end[i]
    return out


def segment(stretch: str, vocab: Vocabulary, skip: Iterator[bool]) -> list[int]:
    """Ids of a stretch of a pre-token, spaces written as the mark."""
    take = _from_list if len(stretch) <= SHORT else _from_heap
    pieces = take(stretch, vocab.scores, skip)
    out = []
    for p in pieces:
        found = vocab.ids.get(p)
        if found is None:
            out += vocab.bytes_of(p)
        else:
            out.append(found)
    return out


def segment_word(word: str, vocab: Vocabulary, skip: Iterator[bool]) -> bytes:
    """Ids of a pre-token as int32 bytes."""
    if word == MARK:                           # a literal mark is no space: its bytes
        return array("i", vocab.bytes_of(word)).tobytes()
    return array("i", segment(word.replace(" ", MARK), vocab, skip)).tobytes()


def dealt(key: bytes, n: int, dropout: float) -> Iterator[np.ndarray]:
    """The first ``WIDTH`` coins of each of ``n`` words as a mask, ``DEALT`` words at
    a time: bit i is set if candidate i is skipped."""
    raw = np.random.Philox(key=np.frombuffer(key, np.uint64)).random_raw
    bar = round(dropout * 65536)
    for start in range(0, n, DEALT):
        size = min(DEALT, n - start)
        if bar <= 0:
            yield np.zeros(size, np.int64)
            continue
        bits = raw(size * WIDTH // 4).astype("<u8", copy=False).view("<u2").reshape(size, WIDTH) < bar
        yield np.packbits(bits, axis=1, bitorder="little").view("<u4").ravel().astype(np.int64)


def all_coins(mask: int, key: bytes, word: str, place: int, dropout: float) -> Iterator[bool]:
    """The coins of one word: those of ``mask``, then a keyed stream."""
    salt = xxhash.xxh3_64_intdigest(key, place)
    mask = int(mask)
    return chain((bool(mask >> i & 1) for i in range(WIDTH)), coins(word, salt, dropout))


class Merges:
    """Every pair of pieces that merges, as sorted arrays.  A symbol is the id of a
    piece; a character that is no piece is ``base`` plus its code point plus 1; ``base``
    itself stands beside the ends of a word."""

    def __init__(self, vocab: Vocabulary):
        ids, scores = vocab.ids, vocab.scores
        self.base = max(ids.values(), default=0) + 1
        self.span = self.base + 0x110001
        order = {x: i for i, x in enumerate(sorted(set(scores.values()), reverse=True))}
        found = sorted((ids[p[:i]] * self.span + ids[p[i:]], order[scores[p]], ids[p])
                       for p in scores for i in range(1, len(p)) if p[:i] in ids and p[i:] in ids)
        table = np.array(found + [(np.iinfo(np.int64).max, NEVER, 0)], np.int64)
        self.keys = table[:, 0].copy()
        self.orders, self.merged = table[:, 1].astype(np.int32), table[:, 2].copy()
        self.symbols = np.arange(0x110000, dtype=np.int64) + self.base + 1
        for p, i in ids.items():
            if len(p) == 1 and p != MARK:
                self.symbols[ord(p)] = i
        if MARK in ids:                        # spaces are marks; a literal mark stays a character
            self.symbols[ord(" ")] = ids[MARK]
        else:
            self.symbols[ord(" ")] = self.symbols[ord(MARK)]
        if any(c not in ids for p in ids for c in p):
            raise ValueError("a piece holds a character that is no piece itself")
        self.bytes = np.array(vocab.byte_ids, np.int32)

    def look(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(order of the merge, NEVER if there is none; the piece it makes)."""
        key = left * self.span + right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.orders[at], NEVER), self.merged[at]

    def ids_of(self, symbols: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of rows of symbols, with the characters that are no pieces as bytes."""
        strange = np.flatnonzero(symbols >= self.base)
        if not len(strange):
            return symbols.astype(np.int32), counts
        chars = [chr(c).encode() for c in (symbols[strange] - self.base - 1).tolist()]
        sizes = np.ones(len(symbols), np.int64)
        sizes[strange] = [len(c) for c in chars]
        out = np.repeat(symbols, sizes)
        out[out >= self.base] = self.bytes[np.frombuffer(b"".join(chars), np.uint8)]
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])]
        return out.astype(np.int32), np.diff(ends)


def run_agendas(first: np.ndarray, sizes: np.ndarray, masks: np.ndarray,
                merges: Merges) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The agendas of many words side by side, one candidate of each at a time.

    ``first`` has a word's symbols per row, from column 1 on, with ``merges.base``
    around them.  Returns the symbols left (row after row), their number per row and
    the coins used per row: WIDTH + 1 where ``WIDTH`` coins were not enough."""
    n, width = first.shape
    symbols = first.ravel().copy()
    after = np.arange(1, len(symbols) + 1)     # the next symbol still there, and the one before
    before = np.arange(-1, len(symbols) - 1)
    orders = np.full(len(symbols), NEVER, np.int32)
    made = np.zeros(len(symbols), np.int64)
    columns = np.arange(width)
    there = ((columns >= 1) & (columns <= sizes[:, None])).ravel()
    pairs = np.flatnonzero(there[:-1] & there[1:])
    orders[pairs], made[pairs] = merges.look(symbols[pairs], symbols[pairs + 1])
    used = np.zeros(n, np.int64)
    table, rows = orders.reshape(n, width), np.arange(n)
    for step in range(WIDTH + 1):
        at = rows * width + table[rows].argmin(axis=1)
        live = orders[at] != NEVER
        rows, at = rows[live], at[live]
        used[rows] = step + 1
        if not len(rows) or step == WIDTH:
            break
        skip = (masks[rows] >> step & 1).astype(bool)
        orders[at[skip]] = NEVER
        left = at[~skip]
        right = after[left]
        end = after[right]
        symbols[left] = made[left]
        there[right], orders[right] = False, NEVER
        after[left], before[end] = end, left
        touched = np.concatenate([before[left], left])
        orders[touched], made[touched] = merges.look(symbols[touched], symbols[np.concatenate([left, end])])
    return symbols[there], there.reshape(n, width).sum(axis=1), used


class Rows:
    """Ids of rows that are found in any order: row i has the ``counts[i]`` ids from
    ``starts[i]`` on in the joined parts."""

    def __init__(self, n: int):
        self.starts, self.counts = np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.parts, self.size = [], 0

    def put(self, rows: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        self.starts[rows], self.counts[rows] = self.size + np.cumsum(counts) - counts, counts
        self.parts.append(ids)
        self.size += len(ids)

    def joined(self, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the rows ``order`` one after another, and their numbers."""
        counts = self.counts[order]
        at = np.repeat(self.starts[order] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        return np.concatenate([np.zeros(0, np.int32), *self.parts])[at], counts


class encoder:
    """(text, doc_id, copy) to the ids of the text as int32 bytes; ``many`` does a
    list of them at once, at most ``at_once`` words at a time.

    Of the words at hand each distinct one is run without skips first; occurrences
    whose coins skip none of its candidates take that result, all others are run
    with their own coins, side by side by length."""

    def __init__(self, vocab: Vocabulary, seed: int, variant: int, dropout: float, at_once: int):
        self.vocab, self.seed, self.variant = vocab, seed, variant
        self.dropout, self.at_once, self.merges = dropout, at_once, Merges(vocab)

    def __call__(self, text: str, doc_id: int | None = None, copy: int = 0) -> bytes:
        return self.many([(text, doc_id, copy)])[0].tobytes()

    def many(self, items: list[tuple[str, int | None, int]]) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        words: list[str] = []
        masks: list[np.ndarray] = []
        keys: list[bytes] = []
        ends = [0]
        for i, (text, doc_id, copy) in enumerate(items):
            mine = pre_tokens(text)
            name = f"{self.seed}:{self.variant}:{doc_id}:{copy}:{text if doc_id is None else ''}"
            keys.append(xxhash.xxh3_128_digest(name.encode()))
            masks += dealt(keys[-1], len(mine), self.dropout)
            words += mine
            ends.append(len(words))
            if len(words) >= self.at_once or i + 1 == len(items):
                out += self._texts(words, np.concatenate([np.zeros(0, np.int64), *masks]), keys, ends)
                words, masks, keys, ends = [], [], [], [0]
        return out

    def _texts(self, words: list[str], masks: np.ndarray, keys: list[bytes], ends: list[int]) -> list[np.ndarray]:
        def slow(i: int, word: str, mask: int) -> bytes:
            text = bisect_right(ends, i) - 1
            return segment_word(word, self.vocab, all_coins(mask, keys[text], word, i - ends[text], self.dropout))
        found = [self._slice(words[a:a + self.at_once], masks[a:a + self.at_once], a, slow)
                 for a in range(0, len(words), self.at_once)]
        ids = np.concatenate([np.zeros(0, np.int32), *[f[0] for f in found]])
        sizes = np.concatenate([np.zeros(1, np.int64), *[f[1] for f in found]])
        return np.split(ids, np.cumsum(sizes)[ends[1:-1]])

    def _slice(self, words: list[str], masks: np.ndarray, offset: int,
               slow: Callable[[int, str, int], bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, and how many each has."""
        numbers: dict[str, int] = {}
        which = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
        distinct = list(numbers)
        sizes = np.fromiter(map(len, distinct), np.int64, len(distinct))
        codes = np.frombuffer("".join(distinct).encode("utf-32-le"), "<u4")
        symbols = self.merges.symbols[codes]
        starts = np.cumsum(sizes) - sizes
        rows = Rows(len(distinct) + len(words))    # distinct words, then occurrences
        every = np.arange(len(distinct))
        looks = self._run(rows, every, every, np.zeros_like(every), symbols, starts, sizes)
        chosen = which.copy()
        own = np.flatnonzero(masks & looks[which] | looks[which] >> WIDTH)
        chosen[own] = len(distinct) + own
        short = own[looks[which[own]] >> WIDTH == 0]
        more = self._run(rows, len(distinct) + short, which[short], masks[short], symbols, starts, sizes)
        rest = np.concatenate([own[looks[which[own]] >> WIDTH != 0], short[more >> WIDTH != 0]])
        for i in rest.tolist():                    # very long, or more coins than were dealt
            ids = np.frombuffer(slow(offset + i, words[i], masks[i]), np.int32)
            rows.put(np.array([len(distinct) + i]), ids, np.array([len(ids)]))
        return rows.joined(chosen)

    def _run(self, rows: Rows, names: np.ndarray, which: np.ndarray, masks: np.ndarray, symbols: np.ndarray,
             starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Runs the words ``which`` and puts their ids under ``names``.  Returns the
        coins each looked at as a mask; bit ``WIDTH`` alone if it needs a run by itself."""
        looks = np.full(len(which), 1 << WIDTH, np.int64)
        length, shortest = sizes[which], 0
        for longest in LENGTHS:
            group = np.flatnonzero((length > shortest) & (length <= longest))
            shortest = longest
            for a in range(0, len(group), BLOCK):
                some = group[a:a + BLOCK]
                n = length[some]
                columns = np.arange(longest + 2)
                inside = (columns >= 1) & (columns <= n[:, None])
                first = np.full(inside.shape, self.merges.base, np.int64)
                first[inside] = symbols[(starts[which[some]][:, None] + columns - 1)[inside]]
                left, counts, used = run_agendas(first, n, masks[some], self.merges)
                rows.put(names[some], *self.merges.ids_of(left, counts))
                looks[some] = np.where(used > WIDTH, 1 << WIDTH, (1 << np.minimum(used, WIDTH)) - 1)
        return looks


def decode_ids(ids, vocab: Vocabulary) -> str:
    """The text of a list of ids (control ids vanish)."""
    raw = b"".join(map(vocab.surface.__getitem__, ids))
    return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


def encode_documents(docs: DataFrame, model: str = DEFAULT_MODEL, seed: int = 1, dropout: float = 0.1,
                     copies: bool = False, memo_size: int = AT_ONCE) -> DataFrame:
    """Ids of every whole text: doc_id, variant, n_tokens, ids (array<int>) and
    lossless (whether decoding the ids gave back the text).

    Every occurrence of a word is segmented by coins of its own.  Repeated rows
    are segmented alike (variant 0), unless ``copies``: then rows of equal doc_id
    and text that follow each other are numbered by variant from 0 and each has
    its own coins; a run that a task's border cuts starts anew.  One row per
    document row; an empty text has no ids; a null text has null ids, 0 tokens
    and lossless true (it decodes to null).  Without a doc_id the text stands for
    it.  Only doc_id and text are read.  Plain runs are shared among ``memo_size``
    words at a time, which never changes the result.  An empty table gives no rows."""
    vocab = load_vocabulary(model)

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        encode = encoder(vocab, seed, 0, dropout, memo_size)
        last, copy = None, 0

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            nonlocal last, copy
            doc_ids, texts, variant = batch.column(0).to_pylist(), batch.column(1).to_pylist(), []
            for one in zip(doc_ids, texts):
                if copies:
                    copy = copy + 1 if last == one else 0
                    last = one
                variant.append(copy)
            chunks = encode.many([(t or "", d, v) for t, d, v in zip(texts, doc_ids, variant)])
            nulls = [t is None for t in texts]
            good = [not t or decode_ids(ids.tolist(), vocab) == t for t, ids in zip(texts, chunks)]
            sizes = np.concatenate([[0], np.cumsum([len(c) for c in chunks])]).astype(np.int32)
            total = int(sizes[-1])
            values = pa.Array.from_buffers(pa.int32(), total, [None, pa.py_buffer(np.concatenate(chunks).tobytes())])
            lists = pa.ListArray.from_arrays(pa.array(sizes), values, mask=pa.array(nulls))
            n = np.diff(sizes).astype(np.int64)
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(variant, pa.int32()), pa.array(n), lists, pa.array(good)],
                names=["doc_id", "variant", "n_tokens", "ids", "lossless"])
        return step
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_texts(rows, ["doc_id", "text"],
                     "doc_id long, variant int, n_tokens long, ids array<int>, lossless boolean", make)


def decode_documents(encoded: DataFrame, model: str = DEFAULT_MODEL) -> DataFrame:
    """doc_id and text of rows with doc_id and ids; null ids give a null text."""
    vocab = load_vocabulary(model)

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [None if x is None else decode_ids(x, vocab) for x in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())],
                                              names=["doc_id", "text"])
        return step
    return map_texts(encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids"),
                     ["doc_id", "ids"], "doc_id long, text string", make)

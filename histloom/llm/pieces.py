"""Vocabulary and pre-tokens of a SentencePiece model, shared by the encoder and
the token counts."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

import sentencepiece

#: Default vocabulary file (a parameter everywhere; never copied here).
DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"

#: Fixed value: the mark that stands for a space in pieces.
MARK = "▁"

#: Pre-tokens: a word with the spaces before it, a line end, a literal mark, or
#: trailing spaces.  No piece holds a mark after another character, a line end
#: or a literal mark (the latter two are written as bytes), so no piece crosses
#: the borders and pre-tokens can be segmented one by one.
PRE_TOKEN = re.compile(f" *[^ \n{MARK}]+|\n|{MARK}| +")


def pre_tokens(text: str) -> list[str]:
    """Pre-tokens of a text with the model's leading dummy space; [] if empty."""
    return PRE_TOKEN.findall(" " + text) if text else []


@dataclass
class Vocabulary:
    """Plain tables of a model file, small enough to travel with a task
    (one row per piece, at most ``MAX_PIECES``)."""
    ids: dict[str, int]
    scores: dict[str, float]
    byte_ids: list[int]
    surface: list[bytes] = field(repr=False)

    MAX_PIECES = 1_000_000

    def bytes_of(self, text: str) -> list[int]:
        return [self.byte_ids[b] for b in text.encode()]


def load_vocabulary(path: str = DEFAULT_MODEL) -> Vocabulary:
    """Read on the driver; executors need no copy of the file."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    if n > Vocabulary.MAX_PIECES:
        raise ValueError(f"{n} pieces; at most {Vocabulary.MAX_PIECES}")
    ids, scores, byte_ids, surface = {}, {}, [0] * 256, []
    for i in range(n):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            value = int(piece[3:5], 16)
            byte_ids[value] = i
            surface.append(bytes([value]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            surface.append(b"")
        else:
            ids[piece] = i
            scores[piece] = model.get_score(i)
            surface.append(piece.replace(MARK, " ").encode())
    if any(MARK in p.lstrip(MARK) or "\n" in p for p in ids):
        raise ValueError("a piece crosses pre-tokens; this splitting does not fit the model")
    return Vocabulary(ids, scores, byte_ids, surface)


class Memo(dict):
    """A bounded memo of ``compute``: two generations of at most ``size``
    entries; entries in use move on, the rest are forgotten and recomputed."""

    def __init__(self, compute: Callable, size: int, longest: int = 64):
        super().__init__()
        self.compute, self.size, self.longest, self.old = compute, size, longest, {}

    def __missing__(self, word: str):
        found = self.old.get(word)
        if found is None:
            found = self.compute(word)
        if len(word) <= self.longest:
            if len(self) >= self.size:
                self.old = dict(self)
                self.clear()
            self[word] = found
        return found

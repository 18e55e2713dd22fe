"""Agendas run side by side give what each word's own run gives."""

import random

import numpy as np
import pytest

from histloom.llm import merge_dropout as md
from histloom.llm import pieces


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.5, 0.95])
def test_many_texts_equal_single_words(dropout):
    """Words of all lengths, unknown characters, marks, line ends, empty texts, and
    texts that several slices share or that take several slices."""
    vocab, rnd = pieces.load_vocabulary(), random.Random(11)
    words = ["the", "internationalisation", "a" * 24, "b" * 65, "ab" * 40, "▁", "\n", "  ", "naïve",
             "漢字", "\U0001f600\U0001f600x", "x́", "12345678901234567890123456789012", "-" * 64]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.randrange(60))) for _ in range(40)] + ["", " ", "\n\n"]
    for size in (1, 7, 100, 100_000):
        encode = md.encoder(vocab, 5, 0, dropout, size)
        got = encode.many([(t, i, i % 3) for i, t in enumerate(texts)])
        assert len(got) == len(texts)
        for i, (text, ids) in enumerate(zip(texts, got)):
            key = md.xxhash.xxh3_128_digest(f"5:0:{i}:{i % 3}:".encode())
            own = pieces.pre_tokens(text)
            masks = [m for block in md.dealt(key, len(own), dropout) for m in block]
            want = b"".join(md.segment_word(w, vocab, md.all_coins(m, key, w, j, dropout))
                            for j, (w, m) in enumerate(zip(own, masks)))
            assert ids.tobytes() == want
            assert md.decode_ids(ids.tolist(), vocab) == text


def test_nothing_at_all():
    encode = md.encoder(pieces.load_vocabulary(), 1, 0, 0.1, 10)
    assert encode.many([]) == []
    assert [len(x) for x in encode.many([("", 1, 0), ("", None, 0)])] == [0, 0]
    assert np.frombuffer(encode(""), np.int32).size == 0

"""Every occurrence of a word has its own coins."""

import random

import numpy as np

import corpus_pipeline as cp
from histloom.llm import merge_dropout as md
from histloom.llm import pieces

from . import cases


def test_memo_of_runs_equals_runs_without_memo():
    vocab, rnd = pieces.load_vocabulary(), random.Random(4)
    some = [w for _ in range(150) for w in cases.words(rnd, 1)] + ["internationalisation" * 3, "x" * 90, "\u2581", "  "]
    for dropout in (0.1, 0.6):
        encode = md.encoder(vocab, 3, 0, dropout, 200)          # small: the memo is forgotten on the way
        for doc in range(20):
            text = " ".join(rnd.choice(some) for _ in range(300))
            key = md.xxhash.xxh3_128_digest(f"3:0:{doc}:0:".encode())
            words = pieces.pre_tokens(text)
            masks = [m for block in md.dealt(key, len(words), dropout) for m in block]
            want = b"".join(md.segment_word(w, vocab, md.all_coins(m, key, w, i, dropout))
                            for i, (w, m) in enumerate(zip(words, masks)))
            assert encode(text, doc) == want


def test_a_frequent_word_gets_many_segmentations():
    vocab = pieces.load_vocabulary()
    encode = md.encoder(vocab, 1, 0, 0.1, 1000)
    texts = [encode("information", doc) for doc in range(2000)]
    assert len(set(texts)) > 10                                  # over documents
    plain = md.encoder(vocab, 1, 0, 0.0, 1000)("information")
    rnd = random.Random(6)
    free = [md.segment_word(" information", vocab, iter(lambda: rnd.random() < 0.1, None)) for _ in range(2000)]
    assert abs(np.mean([t == plain for t in texts]) - np.mean([t == plain for t in free])) < 0.06
    ids = np.frombuffer(encode("information " * 200, 5), "i4")
    one = np.frombuffer(encode("information", 5), "i4")
    assert len(ids) != 200 * len(one)                            # within one text


def test_copies_differ_and_do_not_depend_on_batches(spark):
    text = "the information of the international organisation " * 20
    docs = spark.createDataFrame([(1, text)] * 3 + [(2, text)], "doc_id long, text string").coalesce(1)
    rows = cp.encode(spark, docs, "").collect()
    assert [r.variant for r in rows] == [0, 1, 2, 0] and len({tuple(r.ids) for r in rows}) == 4
    assert all(r.lossless for r in rows)
    assert len({tuple(r.ids) for r in md.encode_documents(docs).collect()}) == 2

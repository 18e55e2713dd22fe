"""Small tables with nulls, empty and very long texts, ties, repeated rows and
extra columns whose names clash with helper columns."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "_row string, key long, `_bins` string, score double, kept boolean, shard int, node string, row_key long")


def words(rnd, n):
    return ["".join(rnd.choice(["an", "the", "re", "on", "tion", "ou", "é", "ß"]) for _ in range(rnd.randint(1, 4)))
            for _ in range(n)]


def edited(rnd, text, edits):
    parts = text.split(" ")
    for _ in range(edits):
        parts[rnd.randrange(len(parts))] = "".join(words(rnd, 1)) + "q"
    return " ".join(parts)


def rows(seed=5):
    rnd = random.Random(seed)
    out = []

    def add(doc_id, text, lang="en", source="src0"):
        out.append((doc_id, text, lang, source, None if text is None else len(text),
                    "x", 1, "y", 2.0, True, 9, "z", 4))
    base = " ".join(words(rnd, 120))
    for i in range(40):                                   # a hot group of near copies
        add(i, edited(rnd, base, rnd.choice([0, 1, 2, 4, 8])))
    for i in range(40, 60):
        add(i, " ".join(words(rnd, rnd.randint(60, 200))), rnd.choice(["en", "de", None]))
    add(60, None)
    add(61, "")
    add(62, " \n\t ")
    add(63, "one two three")
    add(64, "ONE Two three")                              # equal when lower-cased
    add(65, "a\nsingle\nsingle\nline\n\nsingle")
    add(66, " ".join(words(rnd, 40_000)), None, None)     # very long
    add(67, "x" * 50_000)                                 # one very long word
    add(68, base.upper())
    add(68, base.upper())                                 # repeated row
    add(69, "mail bob.t@mail.example.com or +1 (652) 555-5229 from 10.0.0.300 or 10.0.0.30, card 4111 1111 1111 1111")
    add(70, "▁ literal mark, a\u00a0no-break space, \U0001d4b3 and   three spaces ")
    add(None, base)
    add(None, "no id here at all")
    return out


def docs(spark, seed=5):
    return spark.createDataFrame(rows(seed), SCHEMA).repartition(5)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark, seed=5):
    got = [(r[0], 1, 1 if r[0] % 7 == 0 else 0) for r in rows(seed) if r[0] is not None and r[0] < 60]
    return spark.createDataFrame(got + [(65, 0, 0), (67, 0, 0), (None, 1, 0), (41, None, None), (999, 0, 1)],
                                 "doc_id long, quality int, toxic int")

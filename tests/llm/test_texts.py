"""Quality rules, personal data, pieces and token counts against plain Python."""

import collections
import hashlib
import random
import re

import sentencepiece

from histloom.llm import merge_dropout, pieces, pii, quality_rules, token_counts

from . import cases

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(s):
    return re.sub(r"[^0-9]", "", s)


def luhn(s):
    total = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(map(int, reversed(s))))
    return total % 10 == 0


def base_spans(t):
    return {"email": [m.span() for m in EMAIL.finditer(t)],
            "ip": [m.span() for m in IP.finditer(t) if all(int(x) <= 255 for x in m.group().split("."))],
            "card": [m.span() for m in CARD.finditer(t) if 16 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))],
            "phone": [m.span() for m in PHONE.finditer(t) if 8 <= len(digits(m.group())) <= 15]}


def test_personal_data_table(spark):
    got = sorted((tuple(r) for r in pii.find_personal_data(cases.docs(spark)).collect()), key=str)
    want = []
    for r in cases.rows():
        s = base_spans(r[1] or "")
        joined = ",".join(f"{k}:{a}:{b}" for k in ("email", "ip", "card", "phone") for a, b in s[k])
        want.append((r[0], *[len(s[k]) for k in ("email", "ip", "card", "phone")],
                     hashlib.sha256(joined.encode()).hexdigest(), joined, 0))
    assert got == sorted(want, key=str)
    assert pii.find_personal_data(cases.no_docs(spark)).count() == 0


def test_personal_data_fuzz():
    anchors, rnd = pii.build_anchors(), random.Random(8)
    for _ in range(20_000):
        t = "".join(rnd.choice("0123456789.@+-a ()") for _ in range(rnd.randint(1, 40)))
        found = pii.find_spans(t, anchors)
        assert {k: found[k] for k in pii.BASE_KINDS} == base_spans(t), t


def test_added_kinds_and_redaction():
    anchors = pii.build_anchors()
    t = "at 12 Main Street; IBAN DE89 3704 0044 0532 0130 00, ssn: 078-05-1120, http://bob:pw1@h.org/x password=45bb0d53"
    s = pii.find_spans(t, anchors)
    assert {k: [t[a:b] for a, b in v] for k, v in s.items() if v} == {
        "email": ["pw1@h.org"], "account": ["DE89 3704 0044 0532 0130 00", "078-05-1120"],
        "address": ["12 Main Street"], "url_login": ["bob:pw1"], "secret": ["45bb0d53"]}
    assert pii.redact(t, s).startswith("at <address>; IBAN <account>, ssn: <account>, http://<url_login>")
    assert pii.find_spans("a road to the street", anchors)["address"] == []


def test_redaction_keeps_rows_and_columns(spark):
    docs = cases.docs(spark)
    got = pii.redact_documents(docs)
    assert got.schema == docs.schema and got.count() == docs.count()
    row = got.where("doc_id = 69").first()
    assert row.text == "mail <email> or <phone> from 10.0.0.300 or <ip>, card <card>" and row.n_chars == len(row.text)


def counts(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = collections.Counter(zip(w, w[1:], w[2:]))
    covered = {j for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered), failed


def test_quality_counts(spark):
    got = quality_rules.judge_documents(cases.docs(spark), cases.labels(spark))
    rows = sorted((tuple(r)[:7] for r in got.collect()), key=str)
    assert rows == sorted(((r[0], *counts(r[1])) for r in cases.rows()), key=str)
    assert all(not r.kept for r in got.where("base_failed").collect())
    assert quality_rules.judge_documents(cases.no_docs(spark), cases.labels(spark)).count() == 0


def test_cutoffs_reject_marked_text_and_keep_the_rest(spark):
    rnd = random.Random(2)
    rows, marks = [], []
    for i in range(900):
        w = cases.words(rnd, 60 + i % 20)
        low = i % 9 == 0
        rows.append((i, " ".join(x + "&&&" if low else x for x in w), "en"))
        marks.append((i, 0 if low else 1))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    kept = {r.doc_id: r.kept for r in quality_rules.judge_documents(docs, labels, alpha=0.12).collect()}
    assert all(kept[i] == bool(q) for i, q in marks)
    whole = quality_rules.keep_documents(docs, labels, alpha=0.12)
    assert whole.columns == docs.columns and {r.doc_id for r in whole.collect()} == {i for i, q in marks if q}
    # too few labels certify nothing: only the base rule holds
    few = quality_rules.judge_documents(docs, labels.limit(20), alpha=0.01)
    assert few.where("kept").count() == few.where("NOT base_failed").count()


def test_binomial_bound():
    def plain(k, n, p):
        import math
        return sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1))
    for k, n, p in [(0, 10, .1), (3, 50, .02), (3, 50, .3), (49, 50, .9), (7, 400, .01), (50, 50, .5)]:
        assert abs(quality_rules.binomial_cdf(k, n, p) - min(1, plain(k, n, p))) < 1e-9
    assert quality_rules.certified(0, 300, 0.01, 0.05) and not quality_rules.certified(0, 290, 0.01, 0.05)


def test_pieces_equal_the_library_without_dropout():
    vocab = pieces.load_vocabulary()
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.DEFAULT_MODEL)
    encode = merge_dropout.encoder(vocab, 1, 0, 0.0, 1000)
    for t in [r[1] for r in cases.rows() if r[1] and "▁" not in r[1]][-30:] + [" a", "  ", "x\n\ny", "a   b "]:
        assert merge_dropout.array("i", encode(t)).tolist() == library.encode(t)


def test_list_and_heap_agendas_agree():
    vocab, rnd = pieces.load_vocabulary(), random.Random(9)
    for _ in range(2000):
        w = "▁" + "".join(cases.words(rnd, 2))
        salt = rnd.getrandbits(50)
        assert merge_dropout._from_list(w, vocab.scores, merge_dropout.coins(w, salt, 0.3)) == \
            merge_dropout._from_heap(w, vocab.scores, merge_dropout.coins(w, salt, 0.3))


def test_encoding_round_trip(spark):
    docs = cases.docs(spark)
    encoded = merge_dropout.encode_documents(docs, dropout=0.3).cache()
    assert encoded.count() == docs.count() and encoded.where("NOT lossless").count() == 0
    got = sorted((tuple(r) for r in merge_dropout.decode_documents(encoded).collect()), key=str)
    assert got == sorted(((r[0], r[1]) for r in cases.rows()), key=str)
    assert encoded.where("doc_id = 60").first().ids is None and encoded.where("doc_id = 61").first().ids == []
    again = merge_dropout.encode_documents(docs.repartition(3), dropout=0.3, memo_size=50)
    key = lambda r: (str(r.doc_id), str(r.ids))
    assert sorted(map(key, again.collect())) == sorted(map(key, encoded.collect()))
    other = merge_dropout.encode_documents(docs, dropout=0.3, seed=2)
    assert sorted(map(key, other.collect())) != sorted(map(key, encoded.collect()))
    assert merge_dropout.encode_documents(cases.no_docs(spark)).count() == 0


def best_tokens(word, model, unknown):
    """Plain Viterbi over all pieces: the best score, then the fewest tokens."""
    forward = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        ways = [(forward[s][0] + model[word[s:end]], forward[s][1] - 1)
                for s in range(max(0, end - 16), end) if word[s:end] in model]
        if word[end - 1] not in model:
            ways.append((forward[end - 1][0] + unknown, forward[end - 1][1] - len(word[end - 1].encode())))
        forward.append(max(ways))
    return -forward[-1][1]


def test_token_counts(spark):
    model = token_counts.unigram_model(pieces.load_vocabulary())
    unknown = min(model.values()) - token_counts.UNKNOWN_PENALTY

    def count(t):
        return sum(len(w.encode()) if w in ("\n", "▁") else best_tokens(w.replace(" ", "▁"), model, unknown)
                   for w in pieces.pre_tokens(t or ""))
    rows = [r for r in cases.rows() if r[0] != 66]
    got = token_counts.count_tokens(cases.docs(spark).where("doc_id IS NULL OR doc_id <> 66"), memo_size=40)
    assert sorted((str(r.doc_id), r.n_tokens) for r in got.collect()) == sorted((str(r[0]), count(r[1])) for r in rows)
    assert token_counts.count_tokens(cases.no_docs(spark)).count() == 0


def test_trie_shares_prefixes_and_resets():
    model = token_counts.unigram_model(pieces.load_vocabulary())
    trie = token_counts.PrefixTrie(model)
    trie.count(" thing")
    made = trie.nodes_made
    trie.count(" things")
    assert trie.nodes_made == made + 1
    small = token_counts.PrefixTrie(model, max_nodes=8)
    rnd = random.Random(1)
    for w in cases.words(rnd, 300):
        assert small.count(" " + w) == trie.count(" " + w)

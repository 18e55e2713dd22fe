"""Personal data by anchor expansion.

An Aho-Corasick automaton finds the anchors of a text in one pass (at-signs,
digits, plus signs, URL schemes and identifier cues); around each anchor a
deterministic local parser expands to the span's borders and validates it.
Each kind's spans are leftmost and do not overlap."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts

#: The base patterns of the contract, matched at an anchor.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
BASE_KINDS = ("email", "ip", "card", "phone")

#: Kinds that the method adds, in the order they are listed after the base ones.
MORE_KINDS = ("account", "address", "secret", "url_login")
KINDS = BASE_KINDS + MORE_KINDS

#: Cues that announce an identifier of a person or account (lower case).
ACCOUNT_CUES = ("iban", "ssn", "social security", "passport", "account no", "account number", "acct",
                "kontonummer", "konto-nr", "numéro de compte", "número de cuenta", "tax id", "customer id")
#: Street words; the house number stands before or after.
STREET_CUES = (" street", " avenue", " boulevard", " lane", " drive", " road", "straße", "strasse",
               "rue ", "calle ", "avenida ")
SCHEMES = ("://",)
#: Cues of account secrets; a value must follow after ``=`` or ``:``.
SECRET_CUES = ("password", "passwd", "token", "secret", "api_key", "api key", "apikey", "access_key")

_ACCOUNT = re.compile(r"(?:\s{0,2}(?:no\.?|number|nr\.?|is|:|=|#))*\s{0,2}([A-Za-z]{0,2}[0-9][A-Za-z0-9]*(?:[ -][A-Za-z0-9]*[0-9][A-Za-z0-9]*)*)",
                      re.IGNORECASE)
_SECRET = re.compile(r"\s?[=:]\s?[\"']?([A-Za-z0-9+/_.-]{8,})")
_LOGIN = re.compile(r"://([^\s/@:]+:[^\s/@]+)@")
_NUMBER_BEFORE = re.compile(r"[0-9]{1,5}[A-Za-z]?(?: [^\W\d_][\w'.-]*){1,4}$")
_NUMBER_AFTER = re.compile(r"(?: ?[^\W\d_][\w'.-]*){0,4},? [0-9]{1,5}[A-Za-z]?(?!\w)")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(s: str) -> str:
    return re.sub(r"[^0-9]", "", s)


def _iban_ok(s: str) -> bool:
    s = re.sub(r"[^A-Za-z0-9]", "", s).upper()
    if not re.fullmatch(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", s):
        return False
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def build_anchors() -> ahocorasick.Automaton:
    anchors = ahocorasick.Automaton()
    anchors.add_word("@", ("email", 1))
    anchors.add_word("+", ("phone", 1))
    for d in "0123456789":
        anchors.add_word(d, ("digit", 1))
    for kind, words in (("url_login", SCHEMES), ("account", ACCOUNT_CUES), ("address", STREET_CUES),
                        ("secret", SECRET_CUES)):
        for w in words:
            for form in dict.fromkeys((w, w.upper(), w.title(), w.capitalize())):
                anchors.add_word(form, (kind, len(form)))
    anchors.make_automaton()
    return anchors


def find_spans(text: str, anchors: ahocorasick.Automaton) -> dict[str, list[tuple[int, int]]]:
    """Spans per kind of a whole text (code points, end exclusive).

    A base pattern can only start at an anchor: at a digit (ip, card), at a plus
    sign (phone), or in the run of local characters before an at-sign (email).
    Trying each anchor not inside the kind's last match therefore gives exactly
    the leftmost non-overlapping matches; matches that fail their check are
    dropped and not tried again."""
    spans: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    done = dict.fromkeys(KINDS, 0)             # end of the last match, dropped ones too
    ip_free = card_free = 0                    # digits before these cannot start a match
    for last, (kind, length) in anchors.iter(text):
        at = last + 1 - length
        if kind == "digit":
            if at >= done["ip"] and at >= ip_free:
                m = _IP.match(text, at)
                if m:
                    done["ip"] = m.end()
                    if all(len(x) <= 3 and int(x or "0") <= 255
                           for x in (part.lstrip("0") for part in m.group().split("."))):
                        spans["ip"].append(m.span())
                else:                          # a later start in this run of digits fails alike
                    ip_free = _end_of_digits(text, at)
            if at >= done["card"] and at >= card_free:
                m = _CARD.match(text, at)
                if m:
                    done["card"] = m.end()
                    number = _digits(m.group())
                    if 16 <= len(number) <= 19 and luhn(number):
                        spans["card"].append(m.span())
                else:
                    card_free = at + 1
        elif kind == "phone":
            if at >= done["phone"] and (m := _PHONE.match(text, at)):
                done["phone"] = m.end()
                if 8 <= len(_digits(m.group())) <= 15:
                    spans["phone"].append(m.span())
        elif kind == "email":
            start = _start_of_local(text, at, done["email"])
            if start < at and (m := _DOMAIN.match(text, at + 1)):
                done["email"] = m.end()
                spans["email"].append((start, m.end()))
        elif kind == "url_login":
            if at >= done[kind] and (m := _LOGIN.match(text, at)):
                done[kind] = m.end()
                spans[kind].append(m.span(1))
        elif kind == "account":
            if at >= done[kind] and (m := _ACCOUNT.match(text, at + length)):
                found = m.group(1)
                cue = text[at:at + length].lower()
                if _iban_ok(found) if cue == "iban" else 6 <= len(_digits(found)) <= 20:
                    done[kind] = m.end()
                    spans[kind].append(m.span(1))
        elif kind == "secret":
            if at >= done[kind] and (m := _SECRET.match(text, at + length)):
                value = m.group(1)
                if any(c.isdigit() for c in value) and any(c.isalpha() for c in value):
                    done[kind] = m.end()
                    spans[kind].append(m.span(1))
        elif at >= done["address"] and (hit := _street(text, at, length, done["address"])):
            done["address"] = hit[1]
            spans["address"].append(hit)
    return spans


_DIGIT_RUN = re.compile(r"[0-9]+")


def _end_of_digits(text: str, at: int) -> int:
    return _DIGIT_RUN.match(text, at).end()


_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def _start_of_local(text: str, at: int, floor: int) -> int:
    while at > floor and text[at - 1] in _LOCAL:
        at -= 1
    return at


def _street(text: str, at: int, length: int, floor: int) -> tuple[int, int] | None:
    """House number and street around a street word, on one line."""
    end = at + length
    if text[at] == " " and not text[end:end + 1].isalpha():          # 12 Main Street
        begin = max(floor, at - 60)
        if m := _NUMBER_BEFORE.search(text[begin:at]):
            begin += m.start()
            while begin > floor and text[begin - 1] in "0123456789":     # the look back may cut a number
                begin -= 1
            return begin, end
        return None
    if text[at] != " " and (m := _NUMBER_AFTER.match(text, end, min(len(text), end + 60))):
        begin = at
        while begin > max(floor, at - 40) and text[begin - 1].isalpha():
            begin -= 1
        return begin, m.end()                                        # Hauptstraße 5, rue X 7
    return None


def spans_text(spans: dict[str, list[tuple[int, int]]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in spans[k])


def redact(text: str, spans: dict[str, list[tuple[int, int]]]) -> str:
    """The text with every span replaced by ``<kind>``; overlapping spans merge
    under the kind of the first (of equal starts, the longest)."""
    out, at = [], 0
    for a, b, k in sorted(((a, b, k) for k, s in spans.items() for a, b in s), key=lambda x: (x[0], -x[1])):
        if a >= at:
            out += (text[at:a], f"<{k}>")
        at = max(at, b)
    return "".join(out) + text[at:]


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Personal data of every whole text: doc_id, n_email, n_ip, n_card, n_phone,
    base_sha256 (of the base spans), spans (all spans) and n_more.

    One row per document row; a null text counts as empty; only doc_id and text
    are read."""
    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        anchors = build_anchors()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [find_spans(t.as_py() or "", anchors) for t in batch.column(1)]
            counts = [pa.array([len(s[k]) for s in found], pa.int64()) for k in BASE_KINDS]
            sha = [hashlib.sha256(spans_text(s, BASE_KINDS).encode()).hexdigest() for s in found]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), *counts, pa.array(sha, pa.string()),
                 pa.array([spans_text(s, KINDS) for s in found], pa.string()),
                 pa.array([sum(len(s[k]) for k in MORE_KINDS) for s in found], pa.int64())],
                names=["doc_id", *[f"n_{k}" for k in BASE_KINDS], "base_sha256", "spans", "n_more"])
        return step
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_texts(rows, ["doc_id", "text"],
                     "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
                     "base_sha256 string, spans string, n_more long", make)


def redact_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of personal data in ``text`` replaced by its kind
    in angle brackets, and ``n_chars`` (if there) brought up to date for changed
    texts.  Null texts stay null; other columns and the order of columns stay."""
    fields = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = build_anchors()
        for batch in batches:
            cols = list(batch.columns)
            i = fields.index("text")
            old = cols[i].to_pylist()
            new = [t if t is None else redact(t, find_spans(t, anchors)) for t in old]
            cols[i] = pa.array(new, cols[i].type)
            if "n_chars" in fields:
                j = fields.index("n_chars")
                cols[j] = pa.array([n if t == o else len(t) for t, o, n in zip(new, old, cols[j].to_pylist())],
                                   cols[j].type)
            yield pa.RecordBatch.from_arrays(cols, names=fields)
    return docs.mapInArrow(run, docs.schema)

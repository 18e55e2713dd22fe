"""Quality classifier by positive-unlabelled learning.

Trusted positives are documents labelled good; the unlabelled set is all
documents, whose labels are never looked at.  A first classifier of positives
against unlabelled gives the class prior: a best-bin estimate over every
unlabelled row it was not fitted on, by one aggregate.  Then the non-negative
unbiased risk
``prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))`` with logistic loss is
minimised.  The scorer is a sigmoid over binned features of the text alone."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.io import cut_lineage
from .common import map_texts
from .quality_rules import SYMBOLS, repeat_words

FEATURES = ("log_words", "word_length", "distinct_share", "top_word_share", "symbols_per_char", "upper_share",
            "digit_share", "exclaim_per_word", "stop_per_word", "comma_per_word", "dup_line_share",
            "repeat_share", "words_per_line", "non_ascii_share", "short_word_share", "capital_word_share")
#: About so many different rows of either kind at most are fitted on (chosen by a hash of the row;
#: repeated rows count as one, with a weight).
FIT_ROWS = 20_000
BINS = 16

_UPPER, _DIGITS = bytes(range(0x41, 0x5B)), b"0123456789"


def features(text: str | None) -> list[float]:
    """FEATURES of a whole text; null counts as empty (all zero)."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    n_bytes = sum(map(len, words))
    uses = Counter(words)
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    lengths = list(map(len, words))
    return [
        math.log1p(n), (n_bytes - len(raw) + len(text)) / n, len(uses) / n, max(uses.values()) / n,
        sum(map(text.count, SYMBOLS)) / n_bytes, (len(raw) - len(raw.translate(None, _UPPER))) / n_bytes,
        (len(raw) - len(raw.translate(None, _DIGITS))) / n_bytes, raw.count(b"!") / n, raw.count(b".") / n,
        raw.count(b",") / n, 1 - len(set(lines)) / len(lines), (repeat_words(words) if n > 3 else 0) / n,
        n / len(lines), (len(raw) - len(text)) / n_bytes, sum(x <= 3 for x in lengths) / n,
        sum(65 <= w[0] <= 90 for w in words) / n]


@dataclass
class Scorer:
    """Cut points per feature, one weight per bin, a bias."""
    cuts: list[np.ndarray]
    weights: np.ndarray
    bias: float
    prior: float = float("nan")

    def columns(self, x: np.ndarray) -> np.ndarray:
        """The bin of every feature as an index into ``weights``."""
        return np.stack([np.searchsorted(c, x[:, f], "right") + f * BINS for f, c in enumerate(self.cuts)], axis=1)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self.weights[self.columns(x)].sum(axis=1) + self.bias

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -40, 40)))


def _cuts(x: np.ndarray) -> list[np.ndarray]:
    """At most BINS - 1 cut points per feature, at quantiles (finer at both ends)."""
    at = np.array([0.002, 0.01, 0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.65, 0.8, 0.9, 0.95, 0.98, 0.99, 0.998])
    return [np.unique(np.quantile(x[:, f], at)) for f in range(x.shape[1])]


def _one_hot(scorer: Scorer, x: np.ndarray) -> np.ndarray:
    """Bins as 0/1 columns, and a column of ones for the bias."""
    out = np.zeros((len(x), len(FEATURES) * BINS + 1), np.float32)
    np.put_along_axis(out, scorer.columns(x), 1.0, axis=1)
    out[:, -1] = 1
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _descend(p: np.ndarray, u: np.ndarray, wp: np.ndarray, wu: np.ndarray, gradient: Callable, steps: int,
             decay: float = 1e-4, rate: float = 0.1) -> np.ndarray:
    """Adam over the weights (the last one is the bias), the rate falling to a
    tenth; ``gradient(zp, zu, wp, wu)`` gives d risk / d logit.  ``wp`` and ``wu``
    are the rows' shares of their kind (each sums to 1)."""
    w = np.zeros(p.shape[1])
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        small = w.astype(np.float32)
        dp, du = gradient((p @ small).astype(float), (u @ small).astype(float), wp, wu)
        g = p.T @ dp.astype(np.float32) + u.T @ du.astype(np.float32) + decay * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * 0.1 ** (t / steps) * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def _negative_risk(zp: np.ndarray, zu: np.ndarray, wp: np.ndarray, wu: np.ndarray, prior: float) -> float:
    return float(wu @ np.logaddexp(0, zu) - prior * (wp @ np.logaddexp(0, zp)))


def nn_pu_gradient(prior: float) -> Callable:
    """d risk / d logit of the non-negative unbiased risk with logistic loss.
    While the estimated risk of the negatives is below 0, the step goes up its
    gradient instead, so that the fit cannot run below 0."""
    def gradient(zp, zu, wp, wu) -> tuple[np.ndarray, np.ndarray]:
        sp, su = _sigmoid(zp), _sigmoid(zu)
        to_negative_p, to_negative_u = -prior * sp * wp, su * wu
        if _negative_risk(zp, zu, wp, wu, prior) < 0:
            return -to_negative_p, -to_negative_u
        return prior * (sp - 1) * wp + to_negative_p, to_negative_u
    return gradient


def _against_gradient(zp, zu, wp, wu) -> tuple[np.ndarray, np.ndarray]:
    """Plain logistic loss of positives against unlabelled, both halves equal."""
    return (_sigmoid(zp) - 1) * wp / 2, _sigmoid(zu) * wu / 2


def prior_cuts(zp: np.ndarray) -> np.ndarray:
    """Ascending scores of positives at which the shares above are compared."""
    return np.unique(np.quantile(zp, np.linspace(0, 0.99, 200)))


def below(cuts: np.ndarray, z: np.ndarray, weight: np.ndarray | None = None) -> np.ndarray:
    """How many of ``z`` lie below the first cut, between each cut and the next,
    and from the last one up."""
    return np.bincount(np.searchsorted(cuts, z, "right"), weight, len(cuts) + 1)


def best_bin_prior(p: np.ndarray, u: np.ndarray, n_p: int, delta: float = 0.1, gamma: float = 0.01) -> float:
    """Share of positives among the unlabelled: the ratio of the shares above a
    cut, at the cut where its upper confidence bound is least.  ``p`` and ``u``
    are counts as of ``below``; ``n_p`` is the number of positives."""
    n_u = int(u.sum())
    qp, qu = (np.cumsum(x[::-1])[::-1][1:] / x.sum() for x in (p, u))
    slack = math.sqrt(math.log(4 / delta) / 2 / n_u) + math.sqrt(math.log(4 / delta) / 2 / n_p)
    best = int(np.argmin((qu + (1 + gamma) * slack) / qp))
    return float(np.clip(qu[best] / qp[best], 0.01, 0.99))


@dataclass
class Sample:
    """Features of different rows, how often each occurs, and whether the first
    classifier is fitted on it (the prior is then estimated without it)."""
    x: np.ndarray
    n: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, x: np.ndarray) -> Sample:
        return cls(x, np.ones(len(x)), np.arange(len(x)) % 2 == 0)

    def shares(self, rows=slice(None)) -> np.ndarray:
        return self.n[rows] / self.n[rows].sum()


def fit(p: Sample, u: Sample, counts: Callable[[Scorer, np.ndarray], np.ndarray] | None = None,
        steps: int = 800) -> Scorer:
    """Scorer from positives and unlabelled rows.  ``counts(first, cuts)`` gives
    ``below`` of all unlabelled rows that the first classifier was not fitted on
    (by default those of ``u``).  Without rows of either kind every text scores
    0.5; with 20 of either kind or fewer the prior is 0.5."""
    if not len(p.x) or not len(u.x):
        return Scorer([np.zeros(0)] * len(FEATURES), np.zeros(len(FEATURES) * BINS), 0.0)
    scorer = Scorer(_cuts(np.concatenate([p.x, u.x])), np.zeros(0), 0.0)
    hp, hu = _one_hot(scorer, p.x), _one_hot(scorer, u.x)
    scorer.prior = 0.5
    if min(len(p.x), len(u.x)) > 20 and all(s.first.any() and not s.first.all() for s in (p, u)):
        w = _descend(hp[p.first], hu[u.first], p.shares(p.first), u.shares(u.first), _against_gradient, steps // 4)
        first = Scorer(scorer.cuts, w[:-1], float(w[-1]))
        zp = first.logit(p.x[~p.first])
        cuts = prior_cuts(zp)
        among = counts(first, cuts) if counts else below(cuts, first.logit(u.x[~u.first]), u.n[~u.first])
        if among.sum():
            scorer.prior = best_bin_prior(below(cuts, zp, p.n[~p.first]), among, int(p.n[~p.first].sum()))
    w = _descend(hp, hu, p.shares(), u.shares(), nn_pu_gradient(scorer.prior), steps, rate=0.5)
    scorer.weights, scorer.bias = w[:-1], float(w[-1])
    return scorer


def fold(doc_id: Column) -> Column:
    """crc32 of doc_id as text, modulo 5; fold 0 is held out (a null id counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5


def _hash(seed: int, buckets: int) -> Column:
    """A bucket of the row, the same for equal rows."""
    return F.pmod(F.xxhash64(F.lit(seed), "doc_id", "x"), F.lit(buckets))


_PER = 1_000_000


def _drawn(n: int, limit: int, seed: int) -> Column:
    """Whether a row is among about ``limit`` of ``n`` different rows (all, if there are fewer)."""
    return F.lit(True) if n <= limit else _hash(seed, _PER) < F.lit(max(1, limit * _PER // n))


def _sample(rows: DataFrame, drawn: Column) -> Sample:
    """The drawn rows, equal ones as one with their number (so one row that
    fills a third of the table takes one place); in the order of a hash."""
    got = (rows.where(drawn).groupBy("doc_id", "x").agg(F.count(F.lit(1)).alias("n"), F.first(_hash(4, 2) == 0).alias("first"),
                                                         F.first(_hash(5, 1 << 62)).alias("h")).toPandas())
    got = got.sort_values("h", kind="stable")
    x = np.vstack(got["x"].to_numpy()) if len(got) else np.zeros((0, len(FEATURES)))
    return Sample(x, got["n"].to_numpy(float), got["first"].to_numpy(bool))


def _counts(rows: DataFrame) -> Callable[[Scorer, np.ndarray], np.ndarray]:
    """``below`` over all of ``rows`` by one aggregate; a task gives at most one row per cut."""
    def counts(first: Scorer, cuts: np.ndarray) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(cuts) + 1, np.int64)
            for batch in batches:
                if batch.num_rows:
                    x = batch.column(0).flatten().to_numpy().reshape(-1, len(FEATURES))
                    total += below(cuts, first.logit(x))
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["at", "n"])
        got = (rows.select("x").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect())
        out = np.zeros(len(cuts) + 1)
        for r in got:
            out[r["at"]] = r["n"]
        return out
    return counts


def score_documents(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Score of every whole text: doc_id, held_out (fold 0), score (0 to 1),
    predicted (1 if score >= 0.3).

    Labels are only read of rows outside the held-out fold, and only positives;
    label, language, source and id are no inputs of a score.  Features are
    computed of all rows, and the class prior is estimated over all; the
    classifier is fitted on about ``fit_rows`` different positives and as many
    unlabelled rows.  One row per document row; repeated rows get equal scores,
    null and empty texts are scored as texts without words, very long ones
    whole.  Without positives every score is 0.5; an empty table gives no rows.
    Only doc_id and text are read; the same rows give the same sample however
    they are dealt over files."""
    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            x = [features(t.as_py()) for t in batch.column(1)]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))],
                                              names=["doc_id", "x"])
        return step
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = cut_lineage(map_texts(rows, ["doc_id", "text"], "doc_id long, x array<double>", make))
    trusted = (labels.where((F.col("quality") == 1) & (fold(F.col("doc_id")) != 0))
               .select(F.col("doc_id").cast("long").alias("doc_id")).distinct())
    good = known.join(trusted, "doc_id", "left_semi")
    n_good, n_known = (df.select("doc_id", "x").distinct().count() for df in (good, known))
    drawn = _drawn(n_known, fit_rows, 2)
    scorer = fit(_sample(good, _drawn(n_good, fit_rows, 1)), _sample(known, drawn),
                 _counts(known.where(~(drawn & (_hash(4, 2) == 0)))))

    def make_scores() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            x = batch.column(1).flatten().to_numpy().reshape(-1, len(FEATURES))
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(scorer.score(x))], names=["doc_id", "score"])
        return step
    scored = map_texts(known, ["doc_id", "x"], "doc_id long, score double", make_scores)
    return scored.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))

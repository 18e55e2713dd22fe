"""Soft-membership mixing: document rates that bring domains to target weights.

1. A classifier learned from a labelled table gives every document posteriors of
   the domains.  It is a naive Bayes model over binned features of the text and
   per domain the number of its cue words (words that its labelled texts hold far
   more often than the others'), all in Spark expressions.
2. Rates r >= 0 are fitted so that the expected domain token totals
   ``sum_d r_d * n_d * p_dk`` match the targets, by distributed
   projected-gradient least squares from r = 1 (nothing changed).

The gradient step is scaled by each document's tokens and the residual of a
domain by its present total.  So the step of document d is ``p_d . g`` for one
vector g of all documents, documents of equal posteriors get equal rates, and
the step length 1 is safe: the scaled Gram matrix has no eigenvalue above 1,
because posteriors sum to 1.  Domains that the classifier tells apart are fitted
in a few steps; where it cannot, the number of steps keeps rates moderate and
the totals stay short of the targets.  A whole iteration is then
one aggregation, over the distinct posteriors with their token sums, and a rate
is a short fold over the steps so far, computed where it is needed."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.io import cut_lineage
from .common import packed, scalar

#: Bounds of the model: labelled rows learned from (about, by hash of doc_id),
#: domains, cue words per domain.
LABELLED_ROWS = 20_000
MAX_DOMAINS = 32
CUES = 32
#: A cue occurs in at least so many labelled texts, and so many times more often
#: in its domain's texts than in the others'.
CUE_TEXTS, CUE_LIFT = 20, 8.0

#: Bin borders of the features.
BORDERS = {
    "distinct_share": (0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.97),
    "symbol_share": (0.0005, 0.005, 0.02, 0.05, 0.1, 0.2, 0.3),
    "exclaim_per_word": (0.05, 0.1, 0.2, 0.5, 1.0, 1.9),
    "word_length": (2.0, 3.0, 4.0, 4.5, 5.0, 5.5, 6.0, 7.0, 8.0, 10.0, 15.0),
    "n_words": (1, 10, 25, 50, 100, 200, 400, 800, 2000, 5000),
}
#: Bin borders of the number of cue words, for each domain that has any.
CUE_BORDERS = (1, 2, 4)
_SYMBOLS = "#*$%&|"


def once(df: DataFrame, value: Column, name: str) -> DataFrame:
    """Adds a column that is computed once per row: a one-element explode, which
    the optimiser does not fold into the expressions that use it."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def _bin(value: Column, borders: tuple) -> Column:
    """How many borders ``value`` reaches."""
    out = F.lit(0)
    for b in borders:
        out = out + (value >= F.lit(b)).cast("int")
    return out


def _words(text: Column) -> Column:
    """Words between space and tab to CR.  Plain replacements and a split on one
    character are several times cheaper than a split on an expression."""
    for c in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def _count(text: Column, mark: str) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(mark), F.lit("")))


def borders_of(cues: dict[str, list[str]]) -> list[tuple]:
    """Bin borders of all features: those of BORDERS, then one per list of cues."""
    return [*BORDERS.values(), *[CUE_BORDERS] * len(cues)]


def described(docs: DataFrame, cues: dict[str, list[str]], columns: list[str]) -> DataFrame:
    """``columns``, then _n_words and _bins (one int per feature of ``borders_of``)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = once(docs.select(*columns, text.alias("_text")), _words(F.col("_text")), "_words")
    rows = once(rows, F.array_distinct("_words"), "_forms")
    n, chars = F.greatest(F.size("_words"), F.lit(1)), F.greatest(F.octet_length("_text"), F.lit(1))
    symbols = _count(F.col("_text"), _SYMBOLS[0])
    for c in _SYMBOLS[1:]:
        symbols = symbols + _count(F.col("_text"), c)
    measures = {
        "distinct_share": F.size("_forms") / n,
        "symbol_share": symbols / chars,
        "exclaim_per_word": _count(F.col("_text"), "!") / n,
        "word_length": F.length("_text") / n,
        "n_words": F.size("_words"),
    }
    held = [F.size(F.array_intersect("_forms", F.array(*[F.lit(c) for c in words]))) for words in cues.values()]
    rows = once(rows, F.array(*[x.cast("double") for x in [*[measures[f] for f in BORDERS], *held]]), "_measures")
    bins = F.array(*[_bin(F.col("_measures")[i], b) for i, b in enumerate(borders_of(cues))])
    return once(rows.withColumn("_n_words", F.size("_words").cast("long")), bins, "_bins").select(
        *columns, "_n_words", "_bins")


def learn_cues(labelled: DataFrame) -> dict[str, list[str]]:
    """Cue words per domain that has any, from rows (domain, text).  Counts are combined
    before the shuffle; at most CUES words a domain reach the driver."""
    texts = labelled.groupBy("domain").agg(F.count(F.lit(1)).alias("texts"))
    total = scalar(texts, F.sum("texts")) or 0
    uses = (labelled.select("domain", F.explode(F.array_distinct(_words(F.col("text")))).alias("word"))
            .groupBy("word", "domain").agg(F.count(F.lit(1)).alias("n")).where(f"n >= {CUE_TEXTS} AND word <> ''"))
    all_uses = (labelled.select(F.explode(F.array_distinct(_words(F.col("text")))).alias("word"))
                .groupBy("word").agg(F.count(F.lit(1)).alias("all_n")).where(f"all_n >= {CUE_TEXTS}"))
    rated = (uses.join(all_uses, "word").join(texts, "domain")
             .withColumn("lift", (F.col("n") / F.col("texts"))
                         / ((F.col("all_n") - F.col("n") + 1) / F.greatest(F.lit(total) - F.col("texts"), F.lit(1))))
             .where(f"lift >= {CUE_LIFT}"))
    best = rated.groupBy("domain").agg(F.slice(F.array_sort(F.collect_list(
        F.struct((-F.col("n")).alias("o"), "word"))), 1, CUES).alias("best"))
    return {r["domain"]: sorted(r["words"])
            for r in best.select("domain", F.col("best.word").alias("words")).orderBy("domain").collect()}


@dataclass
class DomainModel:
    """Log weights of naive Bayes: prior per domain, and per feature, bin and domain."""
    domains: list[str]
    cues: dict[str, list[str]]
    prior: list[float]
    weights: list[list[list[float]]]

    def add_posteriors(self, rows: DataFrame) -> DataFrame:
        """Adds _p, the posteriors in the order of ``domains``, to rows with _bins."""
        logs = []
        for k in range(len(self.domains)):
            total = F.lit(self.prior[k])
            for f in range(len(self.weights)):
                by_bin = F.array(*[F.lit(w[k]) for w in self.weights[f]])
                total = total + F.element_at(by_bin, F.element_at("_bins", f + 1) + 1)
            logs.append(total)
        if not logs:
            return rows.withColumn("_p", F.array().cast("array<double>"))
        rows = once(rows, F.array(*logs), "_logs")
        rows = once(rows, F.transform("_logs", lambda x: F.exp(x - F.array_max("_logs"))), "_odds")
        rows = once(rows, F.aggregate("_odds", F.lit(0.0), lambda a, b: a + b), "_sum")
        return once(rows, F.transform("_odds", lambda x: x / F.col("_sum")), "_p").drop("_logs", "_odds", "_sum")


def learn_domains(docs: DataFrame, labelled: DataFrame, max_rows: int = LABELLED_ROWS) -> DomainModel:
    """Model of the domains in ``labelled`` (doc_id, domain), learned from about
    ``max_rows`` of its documents, chosen by a hash of doc_id.  A doc_id with
    several domains counts for each; rows without domain or document are left out."""
    labelled = labelled.where("domain IS NOT NULL").select("doc_id", F.col("domain").cast("string").alias("domain"))
    labelled = labelled.select(F.col("doc_id").cast("long").alias("doc_id"), "domain")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n = scalar(labelled, F.count(F.lit(1)))
    if n > max_rows:                           # on both sides, so that only these texts are shuffled
        chosen = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < max(1, int(max_rows / n * 1_000_000))
        labelled, texts = labelled.where(chosen), texts.where(chosen)
    rows = cut_lineage(texts.join(labelled, "doc_id"))
    cues = learn_cues(rows)
    borders = borders_of(cues)
    cells = (described(rows, cues, ["domain"]).select("domain", F.posexplode("_bins").alias("feature", "bin"))
             .groupBy("domain", "feature", "bin").agg(F.count(F.lit(1)).alias("n")))
    counts: dict[str, list[list[int]]] = {}
    for r in cells.collect():                  # domains x features x bins rows
        table = counts.setdefault(r["domain"], [[0] * (len(b) + 1) for b in borders])
        table[r["feature"]][r["bin"]] += r["n"]
    domains = sorted(counts)
    if len(domains) > MAX_DOMAINS:
        raise ValueError(f"{len(domains)} domains; at most {MAX_DOMAINS}")
    size = [sum(counts[d][0]) for d in domains]
    prior = [math.log(s / sum(size)) for s in size]
    weights = [[[math.log((counts[d][f][b] + 0.5) / (size[k] + 0.5 * (len(border) + 1)))
                 for k, d in enumerate(domains)] for b in range(len(border) + 1)]
               for f, border in enumerate(borders)]
    return DomainModel(domains, cues, prior, weights)


def rate_of(posteriors: Column, steps: list[list[float]]) -> Column:
    """The rate after the given steps from 1: r <- max(0, r - p . g)."""
    def step(rate: Column, g: Column) -> Column:
        moved = F.aggregate(F.zip_with(posteriors, g, lambda p, x: p * x), F.lit(0.0), lambda a, b: a + b)
        return F.greatest(F.lit(0.0), rate - moved)
    if not steps:
        return F.lit(1.0)
    return F.aggregate(F.array(*[F.array(*[F.lit(float(x)) for x in g]) for g in steps]), F.lit(1.0), step)


@dataclass
class Rates:
    steps: list[list[float]]
    totals: list[float]
    targets: list[float]


def fit_rates(weighed: DataFrame, targets: list[float], max_steps: int = 30, tolerance: float = 1e-4) -> Rates:
    """Steps that fit rates of rows (p array<double>, n tokens) to ``targets``
    (token totals).  Equal posteriors are summed up first.  Stops when the totals
    are within ``tolerance`` of the sum of targets, or after ``max_steps``."""
    k = len(targets)
    summed = cut_lineage(weighed.where("n > 0").groupBy("p").agg(F.sum("n").cast("double").alias("n")))
    goal = np.array(targets, float)

    def totals(steps: list[list[float]]) -> np.ndarray:
        rate = rate_of(F.col("p"), steps)
        got = (once(summed, F.col("n") * rate, "w")
               .agg(*[F.sum(F.col("w") * F.col("p")[i]).alias(f"t{i}") for i in range(k)]).first())
        return np.array([got[f"t{i}"] or 0.0 for i in range(k)])

    steps: list[list[float]] = []
    now = totals(steps)
    weight = 1 / np.maximum(now, 1e-9 * max(now.sum(), 1.0))
    while len(steps) < max_steps and np.abs(now - goal).sum() > tolerance * max(goal.sum(), 1.0):
        steps.append((weight * (now - goal)).tolist())
        now = totals(steps)
    return Rates(steps, now.tolist(), goal.tolist())


def share_targets(weighed: DataFrame, domains: list[str], shares: dict[str, float]) -> list[float]:
    """Targets with the present number of tokens in all, split by ``shares``
    (scaled to 1 over the domains there are; a domain not named gets 0)."""
    total = float(scalar(weighed, F.sum("n")) or 0)
    given = [max(0.0, shares.get(d, 0.0)) for d in domains]
    return [total * g / sum(given) if sum(given) else 0.0 for g in given]


def factor_targets(weighed: DataFrame, domains: list[str], factors: dict[str, float]) -> list[float]:
    """Targets that multiply the present expected total of each domain in
    ``factors``; the other domains share the difference in proportion, so the
    number of tokens in all stays (unless there is no other domain)."""
    row = weighed.agg(*[F.sum(F.col("n") * F.col("p")[i]).alias(f"t{i}") for i in range(len(domains))]).first()
    now = [float(row[f"t{i}"] or 0) for i in range(len(domains))]
    goal = [t * factors[d] if d in factors else t for d, t in zip(domains, now)]
    rest = sum(t for d, t in zip(domains, now) if d not in factors)
    spare = sum(now) - sum(goal)
    return [g if d in factors or not rest else g + spare * t / rest for d, g, t in zip(domains, goal, now)]


def quality_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of a table of labels: toxic, else good or low by quality."""
    return labels.select("doc_id", F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good")
                         .when(F.col("quality") == 0, "low").alias("domain"))


#: Target shares of tokens in the production mix, and the factors of the
#: pipeline's, whose documents have been through the quality rules.
SHARES = {"good": 0.9, "low": 0.04, "toxic": 0.06}
FACTORS = {"low": 0.5, "toxic": 0.5}


@dataclass
class Mix:
    """A fitted mix: the model and the steps of the rates."""
    model: DomainModel
    rates: Rates

    def add(self, rows: DataFrame) -> DataFrame:
        """Adds _p and _rate (1 where there are no tokens) to rows with _n_words and _bins."""
        rows = self.model.add_posteriors(rows)
        return once(rows, F.when(F.col("_n_words") > 0, rate_of(F.col("_p"), self.rates.steps))
                    .otherwise(F.lit(1.0)), "_rate")


def fit_mix(rows: DataFrame, model: DomainModel, shares: dict[str, float] | None,
            factors: dict[str, float] | None) -> Mix:
    """Rates of all ``rows`` (_n_words, _bins) that fit ``shares``, or ``factors``
    of the present totals.  A model without domains leaves every rate at 1."""
    if not model.domains:
        return Mix(model, Rates([], [], []))
    # posteriors depend on the bins alone, so they are computed per distinct bins
    summed = cut_lineage(rows.groupBy("_bins").agg(F.sum("_n_words").alias("n")))
    weighed = cut_lineage(model.add_posteriors(summed).select(F.col("_p").alias("p"), "n"))
    if factors is not None:
        return Mix(model, fit_rates(weighed, factor_targets(weighed, model.domains, factors)))
    return Mix(model, fit_rates(weighed, share_targets(weighed, model.domains, shares or {})))


def mix_documents(docs: DataFrame, labelled: DataFrame, shares: dict[str, float] | None = SHARES,
                  factors: dict[str, float] | None = None) -> DataFrame:
    """Per document row: doc_id, n_tokens (words), domain (likeliest; of equals
    the first by name), posteriors (array in the order of domain names), rate, copies.

    ``copies`` is the whole part of the rate, plus one where a hash of doc_id and
    text falls below the rest, so its mean is the rate and equal rows share it.
    Null and empty texts have no tokens and rate 1; an empty table gives no rows;
    without labelled documents domain is null and every rate is 1.  Only doc_id
    and text are read."""
    model = learn_domains(docs, labelled)
    rows = cut_lineage(described(docs.select("doc_id", "text", _key().alias("_key")), model.cues, ["doc_id", "_key"]))
    mix = fit_mix(rows, model, shares, factors)
    names = F.array(*[F.lit(d) for d in mix.model.domains]) if mix.model.domains else F.array().cast("array<string>")
    rows = mix.add(rows)
    likely = F.try_element_at(names, F.array_position(F.col("_p"), F.array_max("_p")).cast("int"))
    return rows.select("doc_id", F.col("_n_words").alias("n_tokens"),
                       (likely if mix.model.domains else F.lit(None).cast("string")).alias("domain"),
                       F.col("_p").alias("posteriors"), F.col("_rate").alias("rate"),
                       _copies(F.col("_rate"), F.col("_key")).alias("copies"))


def _key() -> Column:
    return F.xxhash64("doc_id", "text", F.lit("mix"))


def _copies(rate: Column, key: Column) -> Column:
    coin = F.pmod(key, F.lit(1 << 30)) / F.lit(float(1 << 30))
    return (F.floor(rate) + (coin < rate - F.floor(rate)).cast("long")).cast("int")


def resample_documents(docs: DataFrame, labelled: DataFrame, shares: dict[str, float] | None = None,
                       factors: dict[str, float] | None = None) -> DataFrame:
    """``docs`` with every row as often as its copies say, with its own columns.
    The texts are read twice (fit, then filter) but neither shuffled nor stored."""
    model = learn_domains(docs, labelled)
    mix = fit_mix(described(docs, model.cues, []), model, shares, factors)
    rows = mix.add(described(docs.select(packed(docs), "text", _key().alias("_key")), model.cues, ["_row", "_key"]))
    return (rows.withColumn("_copies", _copies(F.col("_rate"), F.col("_key"))).where("_copies > 0")
            .select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("_row.*"))

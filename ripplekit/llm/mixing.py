"""Mixing documents to target domain weights with soft membership.

1. A subword classifier (``subword.py``) fitted on a labelled table gives
   every document a posterior over domains, rounded to ``GRAIN``.
2. Document i with n_i tokens and posterior p_i gets a rate r_i >= 0 such
   that the expected tokens per domain, sum_i r_i n_i p_id, come as close as
   possible (least squares, relative to the target) to weight_d times the
   token budget; a vanishing pull towards rate one (``PULL``) picks among the
   many solutions the one that changes least and moves the totals by about
   ``PULL`` times the rate.
3. Projected gradient steps find the rates: each needs the domain totals at
   the current rates, one aggregation in Spark of a few numbers, moves every
   rate against its gradient and cuts it at zero.  Rates of rare domains move
   further (a diagonal preconditioner, under which the cut is still the
   projection), and steps carry momentum that starts afresh when it points
   uphill.  All rates start at one and a step depends on the posterior alone,
   so rows with one posterior are summed once, the steps run over these sums,
   and a document's rate follows from its posterior and the steps' numbers
   without a join.  Steps end when the totals meet their targets, or when the
   rates no longer move: totals that stay away (a domain that the documents do
   not have) are reported.
4. A document of rate r is used floor(r) times, and once more with the
   probability of the rest, drawn from a hash of its id.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ripplekit.llm import subword
from ripplekit.llm.common import bounded_batches, unused
from ripplekit.plans.lineage import materialize

GRAIN = 0.01      # posteriors are rounded to this
PULL = 1e-6       # weight of (rate - 1)^2
STEPS = 1000      # at most
TOLERANCE = 1e-4  # of a total, relative to its target
STILL = 1e-7      # mean square root move of the rates that counts as none
WRITTEN = 25      # steps after which the rates of the sums are written
MOST_MISS = 0.01  # of a total, relative to its target; beyond it is reported

_log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Mix:
    """Targets, the errors of the expected totals (relative to the targets;
    none without tokens) and the steps: all that a rate depends on.  A step is
    its momentum and, per domain, the excess of the total over its target in
    units of the target."""

    domains: tuple[str, ...]
    targets: tuple[float, ...]
    errors: tuple[float, ...]
    steps: tuple[tuple[float, ...], ...]
    reach: tuple[float, ...]    # per domain, how much further rates move
    size: float                 # of a step
    pull: float

    def further(self, posterior: Column) -> Column:
        """The preconditioner of a document."""
        return sum((posterior[d] * F.lit(float(x)) for d, x in enumerate(self.reach)), F.lit(0.0))

    def state(self, posterior: Column, start: Column, steps: tuple[tuple[float, ...], ...]) -> Column:
        """``struct<rate, last, looked>`` behind ``steps``: the rate, the one
        before and the point where its gradient was taken."""
        def move(at, step):
            looked = at["rate"] + step[0] * (at["rate"] - at["last"])
            uphill = sum((posterior[d] * step[d + 1] for d in range(len(self.domains))),
                         F.lit(self.pull) * (looked - 1.0))
            rate = F.greatest(F.lit(0.0), looked - F.lit(self.size) * self.further(posterior) * uphill)
            return F.struct(rate.alias("rate"), at["rate"].alias("last"), looked.alias("looked"))
        if not steps:
            return start
        numbers = F.array(*[F.array(*[F.lit(float(x)) for x in step]) for step in steps])
        return F.aggregate(numbers, start, move)

    def rate(self, posterior: Column) -> Column:
        """Rate of a document from its posterior."""
        return self.state(posterior, _start(), self.steps)["rate"]


def _start() -> Column:
    return F.struct(*[F.lit(1.0).alias(c) for c in ("rate", "last", "looked")])


def n_tokens(text_col: str = "text") -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; a null text has none."""
    t = F.coalesce(F.col(text_col), F.lit(""))
    return F.size(F.filter(F.split(t, r"[\x20\x09-\x0D]+"), lambda w: w != "")).cast("long")


def with_posterior(docs: DataFrame, model: subword.Model, text_col: str = "text", tokens: str = "tokens",
                   posterior: str = "posterior") -> DataFrame:
    """``docs`` with ``tokens long`` and ``posterior array<double>``; columns
    of those names are replaced."""
    bounded_batches(docs.sparkSession)
    p = subword.posterior_column(model, text_col)
    return docs.withColumn(tokens, n_tokens(text_col)).withColumn(posterior, F.transform(
        p, lambda x: F.round(x / GRAIN) * GRAIN))


def fit_mix(scored: DataFrame, domains: tuple[str, ...], weights: dict[str, float], budget: float = 1.0,
            pull: float = PULL, steps: int = STEPS, tokens: str = "tokens", posterior: str = "posterior") -> Mix:
    """Rates for ``scored(tokens, posterior)`` whose expected tokens per
    domain match ``weights`` (made to add up to one) times ``budget`` times
    all tokens.  A domain without weight gets 10^-6.  Without any token every
    rate is one."""
    total_w = sum(max(weights.get(d, 0.0), 1e-6) for d in domains)
    targets = tuple(budget * max(weights.get(d, 0.0), 1e-6) / total_w for d in domains)
    cells = materialize(scored.groupBy(F.col(posterior).alias("posterior")).agg(F.sum(tokens).alias("tokens")),
                        "mix-cells")
    total = cells.agg(F.sum("tokens").alias("n")).first()["n"] or 0
    k, goal, p = len(domains), np.array(targets), F.col("posterior")
    if not total:
        return Mix(domains, targets, (), (), (1.0,) * k, 0.0, pull)
    cells = cells.select("posterior", (F.col("tokens") / F.lit(float(total))).alias("share"))
    have = np.array(list(cells.agg(*[F.sum(F.col("share") * p[d]) for d in range(k)]).first()))
    reach = goal / np.maximum(have, 1e-9)
    mix = Mix(domains, targets, (), (), tuple(reach.tolist()), 0.0, pull)
    # The largest curvature along preconditioned rates bounds the step.
    curves = cells.select("share", "posterior", mix.further(p).alias("s")).agg(
        F.max("s"), *[F.sum(F.col("share") * F.col("s") * p[d] * p[e]) for d in range(k) for e in range(k)]).first()
    products = np.array(list(curves)[1:]).reshape(k, k) / np.sqrt(np.outer(goal, goal))
    mix = replace(mix, size=float(1 / (np.linalg.eigvalsh(products)[-1] + pull * curves[0])))

    at = cells.withColumn("state", _start())   # rates behind the steps that are written
    done: list[tuple[float, ...]] = []
    fresh: list[tuple[float, ...]] = []
    before, weight = have, 1.0
    while True:
        s = F.col("now")
        now = at.select("posterior", "share", mix.further(p).alias("s"),
                        mix.state(p, F.col("state"), tuple(fresh)).alias("now"))
        moved = s["rate"] - s["last"]
        got = now.agg(
            F.sum(F.col("share") * moved * moved), F.sum(F.col("share") / F.col("s") * (s["looked"] - s["rate"]) * moved),
            *[F.sum(F.col("share") * s["rate"] * p[d]) for d in range(k)]).first()
        totals = np.array(list(got)[2:])
        errors = (totals - goal) / goal
        if (np.abs(errors) <= TOLERANCE).all() or len(done) >= steps or done and got[0] <= STILL**2:
            break
        if got[1] > 0:
            weight, momentum = 1.0, 0.0
        else:
            grown = (1 + np.sqrt(1 + 4 * weight**2)) / 2
            weight, momentum = grown, (weight - 1) / grown
        looked = totals + momentum * (totals - before)
        step = (float(momentum), *((looked - goal) / goal).tolist())
        before = totals
        done.append(step)
        fresh.append(step)
        if len(fresh) == WRITTEN:
            at = materialize(at.select("posterior", "share", mix.state(p, F.col("state"), tuple(fresh)).alias("state")),
                             "mix-rates")
            fresh = []
    for d, e in zip(domains, errors):
        if abs(e) > MOST_MISS:
            _log.warning("mix: the tokens of %s miss their target by %.3g of it", d, e)
    return replace(mix, errors=tuple(errors.tolist()), steps=tuple(done))


def copies(rate: Column, id_col: str = "doc_id") -> Column:
    """How often a document of that rate is used."""
    draw = F.pmod(F.xxhash64(F.lit("mix"), F.col(id_col)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return (F.floor(rate) + (draw < rate - F.floor(rate)).cast("int")).cast("int")


def mix(docs: DataFrame, labelled: DataFrame, weights: dict[str, float], budget: float = 1.0,
        rows: int = subword.SAMPLE_ROWS, keep: tuple[str, ...] = ("doc_id",), tokens: str = "tokens",
        posterior: str = "posterior") -> tuple[subword.Model, Mix, DataFrame]:
    """Fit both models: domains are the keys of ``weights``; ``labelled`` is
    ``doc_id, label string`` and at most ``rows`` of it are used.  The third
    result is a written table of all rows: the columns ``keep`` of ``docs`` with
    ``tokens`` and ``posterior``, so that the texts are classified once."""
    domains = tuple(sorted(weights))
    model = subword.train(docs, labelled, domains, rows, ngrams=(3,))
    cols = list(dict.fromkeys([*keep, "text"]))
    scored = materialize(with_posterior(docs.select(*cols), model, tokens=tokens, posterior=posterior)
                         .select(*keep, tokens, posterior), "mix-posteriors")
    return model, fit_mix(scored, domains, weights, budget, tokens=tokens, posterior=posterior), scored


def rated(scored: DataFrame, fitted: Mix) -> DataFrame:
    """``scored`` with ``rate, copies``.  Rows that repeat get one rate; rows
    with a null id draw alike; columns of those names are replaced."""
    r = scored.withColumn("rate", fitted.rate(F.col("posterior")))
    return r.withColumn("copies", copies(F.col("rate")))


def repeated(scored: DataFrame, fitted: Mix, cols: list[str], posterior: str = "posterior") -> DataFrame:
    """The columns ``cols`` of ``scored`` as often as the rates say."""
    n = unused(scored, "copies")
    return scored.withColumn(n, copies(fitted.rate(F.col(posterior)))).where(F.col(n) > 0) \
        .withColumn(n, F.explode(F.sequence(F.lit(1), F.col(n)))).select(*cols)


def with_copies(docs: DataFrame, model: subword.Model, fitted: Mix) -> DataFrame:
    """``docs`` as often as their rates say; other columns as they are."""
    p, n = unused(docs, "posterior"), unused(docs, "tokens")
    return repeated(with_posterior(docs, model, tokens=n, posterior=p), fitted, docs.columns, p)

"""Mixing to target weights with soft membership.

A classifier learned from a table of labels gives every document a posterior over domains. Document rates, none below
zero, are fitted by projected gradient so that the expected tokens of each domain (rate x tokens x posterior, summed)
match the targets in the sense of least squares. A step needs a few sums over all documents; a document's rate follows
from its own posterior and one number per domain, so no state is kept or shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motorlake.llm.common import CHOSEN_ROWS, ROW, give_back, identity, nested, small_side, staged, unnested
from motorlake.llm.language import SAMPLE_BROADCAST
from motorlake.llm.shingles import texts, word_hashes

FEATURE_BITS = 18
#: Labelled rows per domain that the classifier learns from, at most.
SAMPLE_PER_DOMAIN = 4000
BUCKETS = 64
EPOCHS = 10
STEPS = 100
#: Steps end when every domain's gradient is below this share of the domain.
TOLERANCE = 1e-9
#: Weight of staying near rate 1; it makes the solution unique.
PULL = 1e-3


def places(text: bytes) -> tuple[np.ndarray, int]:
    """Places of a text's distinct lower-cased words in a table of 2**FEATURE_BITS, and the number of its words."""
    words = word_hashes(text)
    return np.unique(words >> np.uint64(64 - FEATURE_BITS)).astype(np.int64), len(words)


class DomainModel:
    """Multinomial logistic regression over presence features, each text scaled to length one."""

    def __init__(self, domains: list[str], weights: np.ndarray, bias: np.ndarray):
        self.domains, self.weights, self.bias = domains, weights, bias

    def posterior(self, found: np.ndarray) -> np.ndarray:
        z = self.bias + (self.weights[found].sum(0) / np.sqrt(len(found)) if len(found) else 0)
        e = np.exp(z - z.max(initial=0))
        return e / e.sum()


def fit(docs: DataFrame, marks: DataFrame, per_domain: int = SAMPLE_PER_DOMAIN, seed: int = 3, key: str = "doc_id",
        text: str = "text") -> DomainModel:
    """A model from the texts of at most ``per_domain`` marked documents of each domain (those with the smallest hashes).

    The sample is drawn from the narrow marks (``doc_id, domain``, each id once) before any text is fetched. Marks
    without domain and documents without text teach nothing. Only integer places of the sample come to the driver.
    """
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = [places(t)[0].astype(np.int32).tobytes() for t in texts(b.column("text"))]
            yield pa.RecordBatch.from_pydict({"domain": b.column("domain"), "places": pa.array(raw, pa.binary())})

    drawn, bucket = marks.where(F.col("domain").isNotNull()), F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(BUCKETS))
    for parts in (["domain", bucket], ["domain"]):  # the smallest of every bucket first, so that no task ranks a whole domain
        order = Window.partitionBy(*parts).orderBy(F.xxhash64("doc_id"), "doc_id")
        drawn = drawn.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= per_domain).drop("_n")
    side = small_side(staged(drawn.select(F.col("doc_id").alias("_id"), "domain"), "drawn"), SAMPLE_BROADCAST)
    whole = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").cast("string").alias("text")).where(F.col("text").isNotNull())
    # A key that many rows share teaches once, with the text of the smallest hash.
    taken = whole.join(side, F.col("_key") == F.col("_id")).groupBy("_id", "domain").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    rows = taken.select("text", "domain").mapInArrow(features, "domain string, places binary").toPandas()
    rows = rows.sort_values(["domain", "places"])
    domains = sorted(set(rows.domain))
    weights, bias = np.zeros((1 << FEATURE_BITS, len(domains)), np.float64), np.zeros(len(domains))
    if len(domains) > 1:
        sets = [np.frombuffer(p, np.int32) for p in rows.places]
        y = rows.domain.map({d: i for i, d in enumerate(domains)}).to_numpy()
        rng = np.random.default_rng(seed)
        total = np.full_like(weights, 1e-8)
        for epoch in range(EPOCHS):
            for i in rng.permutation(len(sets)):
                found = sets[i]
                z = bias + (weights[found].sum(0) / np.sqrt(len(found)) if len(found) else 0)
                e = np.exp(z - z.max())
                g = e / e.sum()
                g[y[i]] -= 1
                bias -= 0.02 * g
                if len(found):
                    step = g / np.sqrt(len(found))
                    total[found] += step * step
                    weights[found] -= 0.5 * step / np.sqrt(total[found])
    elif domains:
        bias[:] = 0
    del rows
    give_back()
    return DomainModel(domains, weights.astype(np.float32), bias)


def posteriors(docs: DataFrame, model: DomainModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, posterior`` (in the order of ``model.domains``) of every row; tokens are words here.

    A null or empty text has no tokens and the prior of the model. Repeated rows and null keys give a row each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            out, many = [], []
            for t in texts(b.column("text")):
                found, n = places(t)
                out.append(m.posterior(found))
                many.append(n)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(many, pa.int64()), pa.array([list(p) for p in out], pa.list_(pa.float64()))],
                names=["doc_id", "n_tokens", "posterior"])

    rows = docs.select(F.col(f"`{key}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    return rows.mapInArrow(score, "doc_id bigint, n_tokens bigint, posterior array<double>")


def _rate(pull: np.ndarray) -> Column:
    """A document's rate, never below zero, for a pull on each domain."""
    slope = F.lit(0.0)
    for i, v in enumerate(pull):
        slope = slope + F.lit(float(v)) * F.col("posterior")[i]
    return F.greatest(F.lit(0.0), 1 - slope)


def rates(members: DataFrame, domains: list[str], targets: dict[str, float], steps: int = STEPS) -> DataFrame:
    """``members`` (with ``n_tokens, posterior``) and ``rate``: nonnegative, matching the target shares in expectation.

    Least squares over the rates: every domain's error in tokens, relative to what there is of it, and ``PULL`` for
    staying near rate 1. A gradient step is scaled by the inverse Hessian of the rates that are free (above zero), and
    projected onto rates not below zero. Scaled so, a document's rate after any step is a function of its posterior and
    one number per domain; a pass over the documents gives the gradient and the Hessian in a few sums. Steps are
    shortened until the objective falls enough, and end where no domain's error, relative to its share, moves any more.

    ``targets`` are shares of the tokens there are; a domain that is not named has target 0, and a share of a domain
    that no label knows goes to no one. Without tokens every rate is 1.
    """
    k = len(domains)
    want = np.array([targets.get(d, 0.0) for d in domains])
    weighed = members.where(F.col("n_tokens") > 0).select("n_tokens", "posterior")

    def sums(pull: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, float]:
        """Tokens; tokens of each domain at these rates; their products over the free documents; squared rates."""
        p, t = [F.col("posterior")[i] for i in range(k)], F.col("n_tokens")
        rated = weighed.withColumn("_rate", _rate(pull))
        r, free = F.col("_rate"), F.when(F.col("_rate") > 0, t).otherwise(0)
        row = rated.agg(F.sum(t), F.sum(t * r * r), *[F.sum(t * r * x) for x in p],
                        *[F.sum(free * p[i] * p[j]) for i in range(k) for j in range(i, k)]).first()
        values = [float(v or 0) for v in row]
        gram = np.zeros((k, k))
        gram[np.triu_indices(k)] = values[2 + k:]
        return values[0], np.array(values[2:2 + k]), gram + np.triu(gram, 1).T, values[1]

    pull = np.zeros(k)
    total, tokens, gram, squares = sums(pull)
    if not k or not total:
        return members.withColumn("rate", F.lit(1.0))
    share = (tokens / total).clip(1e-12)

    def value(pull: np.ndarray, squares: float) -> float:
        return squares / total / 2 + want @ pull + PULL / 2 * (share * pull * pull).sum()

    for _ in range(steps):
        slope = want - tokens / total + PULL * share * pull
        if np.abs(slope / share).max() < TOLERANCE:
            break
        step = -np.linalg.solve(gram / total + PULL * np.diag(share), slope)
        now, length = value(pull, squares), 1.0
        while True:
            new = sums(pull + length * step)
            if value(pull + length * step, new[3]) <= now + 1e-4 * length * (slope @ step) + 1e-15 or length < 1e-6:
                break
            length /= 2
        pull = pull + length * step
        _, tokens, gram, squares = new
    return members.withColumn("rate", _rate(pull))


def mix(docs: DataFrame, marks: DataFrame, targets: dict[str, float], key: str = "doc_id", text: str = "text") -> tuple[DataFrame, list[str]]:
    """Posterior and rate of every document (``doc_id, n_tokens, posterior, rate``), and the domains in their order."""
    model = fit(docs, marks, key=key, text=text)
    return rates(staged(posteriors(docs, model, key, text), "posteriors"), model.domains, targets), model.domains


def resample(docs: DataFrame, marks: DataFrame, targets: dict[str, float], key: str = "doc_id", text: str = "text",
             seed: int = 11) -> DataFrame:
    """The documents repeated or left out by their rates, with all their columns.

    A document comes floor(rate) times, and once more with the probability of the fraction, decided by a hash of its
    key, its text and the seed; a document without tokens comes once.
    """
    model = fit(docs, marks, key=key, text=text)
    own = docs.select(identity(key, text).alias("id"), F.col(f"`{text}`").alias("t"))
    rated = rates(staged(posteriors(own, model, "id", "t"), "posteriors"), model.domains, targets)
    draw = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    times = F.when(F.col("n_tokens") > 0, F.floor(F.col("rate")) + (draw < F.col("rate") - F.floor("rate")).cast("int")).otherwise(1)
    counted = rated.select(F.col("doc_id").alias("_id"), times.cast("int").alias("_times")).where("_times > 0").distinct()
    side = small_side(staged(counted, "times"), CHOSEN_ROWS)
    found = docs.select(identity(key, text).alias("_own"), nested(docs)).join(side, F.col("_own") == F.col("_id"))
    return unnested(found.select(F.explode(F.expr("sequence(1, _times)")), ROW), docs.columns)


def domain_marks(labels: DataFrame) -> DataFrame:
    """``doc_id, domain`` of the labels: toxic, poor or good; a missing mark teaches nothing."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "poor").when(F.col("quality") == 1, "good")
    marks = labels.where(F.col("doc_id").isNotNull()).select("doc_id", domain.alias("domain"))
    return marks.groupBy("doc_id").agg(F.max("domain").alias("domain"))  # of conflicting marks the worst by name: toxic first

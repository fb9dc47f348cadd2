"""Mixing sources to target weights by soft domain membership.

A classifier trained on labelled documents gives every document a posterior over the domains. The
nonnegative rate of each document is found by projected-gradient least squares: so that the
expected tokens of each domain, summed over all documents by rate, tokens and posterior, meet the
targets. The gradient of a document's rate is its tokens times its posterior times what the domains
are off by; distances between rates count by token, so a step moves a rate by the posterior alone and
does not favour short or long documents. The sum of all steps is one number per domain, and the rate
is the projection of one less the posterior times that sum. A pass over all documents gives what the domains
are off by and the Gram matrix of the documents whose rate is not held at zero, which scales the
next step; steps end when the optimality condition holds. There is no state to keep or lose.

Of all rates that meet the targets these are the nearest to one, token by token. Targets that no
rates meet, or only few documents many times over, cost most documents their place; ``pull`` weighs
the distance of the rates to one against what the targets are missed by, and keeps rates moderate.

Defined results: null, empty and word-less texts have no tokens and keep rate 1. Repeated rows get
equal rates. Labels with nulls are left out; without labels of at least two domains all rates are
1. An empty table gives no rows. Columns other than the id and the text are carried along by
``mix``, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from aprisco.llm.blocks import Texts, blocks, mix as spread, owners
from aprisco.sources.shared import cut_lineage

DOMAINS = ("good", "low", "toxic")
TARGETS = (0.90, 0.08, 0.02)
BUCKETS = 2048  # hashed words that the classifier sees


def bags(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Rows of hashed word frequencies, scaled to unit length, and each text's number of words."""
    hashes, offsets = texts.lowered().word_hashes()
    n = np.diff(offsets)
    cell = owners(offsets) * BUCKETS + (hashes % np.uint64(BUCKETS)).astype(np.int64)
    bag = np.bincount(cell, minlength=texts.rows * BUCKETS).reshape(texts.rows, BUCKETS)
    bag = np.sqrt(bag.astype(np.float32))
    return bag / np.maximum(np.linalg.norm(bag, axis=1, keepdims=True), 1e-9), n


def fit_softmax(x: np.ndarray, y: np.ndarray, classes: int, steps: int = 300, decay: float = 1e-4) -> np.ndarray:
    """Multinomial logistic regression by accelerated gradient descent; the last row is the bias."""
    x = np.column_stack([x, np.ones(len(x), np.float32)])
    w = v = np.zeros((x.shape[1], classes), np.float32)
    hot = np.eye(classes, dtype=np.float32)[y]
    for i in range(steps):
        p = softmax(x @ v)
        to = v - 4.0 * (x.T @ (p - hot) / len(x) + decay * v)
        v, w = to + i / (i + 3) * (to - w), to
    return w


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


@dataclass(frozen=True)
class MixModel:
    weights: np.ndarray | None  # of the classifier
    sum_of_steps: tuple[float, ...] = ()

    def posteriors(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        bag, n = bags(texts)
        return softmax(bag @ self.weights[:-1] + self.weights[-1]).astype(float), n

    def rates(self, p: np.ndarray, n: np.ndarray) -> np.ndarray:
        if not self.sum_of_steps:
            return np.ones(len(n))
        return np.where(n > 0, np.maximum(0.0, 1.0 - p @ np.array(self.sum_of_steps)), 1.0)


def fit_classifier(docs: DataFrame, labels: DataFrame, fit_rows: int = 6_000) -> MixModel:
    """From at most about ``fit_rows`` labelled documents, drawn by the hash of their id."""
    domain = F.when(F.col("toxic") > 0, 2).when(F.col("quality") > 0, 0).otherwise(1)
    known = labels.where("quality is not null and toxic is not null").groupBy("doc_id").agg(F.min(domain).alias("domain"))
    share = min(1.0, fit_rows / max(known.count(), 1))
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("mix")), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1)
    rows = docs.select("doc_id", "text").join(F.broadcast(known.where(drawn)), "doc_id")
    # An id counts once, however many rows have it
    rows = rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("domain").alias("domain"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text"):
                bag, _ = bags(Texts(block.column("text")))
                places = [np.flatnonzero(b).astype(np.int32) for b in bag]
                yield pa.RecordBatch.from_pydict(
                    {"domain": block.column("domain"), "places": places, "values": [b[i] for b, i in zip(bag, places)]}
                )

    sample = rows.mapInArrow(run, "domain int, places array<int>, values array<float>").toArrow()
    y = sample.column("domain").to_numpy()
    if len(np.unique(y)) < 2:
        return MixModel(None)
    x = np.zeros((len(y), BUCKETS), np.float32)
    for row, (at, values) in enumerate(zip(sample.column("places"), sample.column("values"))):
        x[row, at.values.to_numpy()] = values.values.to_numpy()
    return MixModel(fit_softmax(x, y, len(DOMAINS)))


def posteriors(docs: DataFrame, model: MixModel) -> DataFrame:
    """doc_id, n_tokens and the posterior of every document."""
    own = docs.select("doc_id", "text")
    names = [f"p_{d}" for d in DOMAINS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text"):
                p, n = model.posteriors(Texts(block.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [block.column("doc_id"), pa.array(n), *(pa.array(p[:, k]) for k in range(len(DOMAINS)))],
                    names=["doc_id", "n_tokens", *names],
                )

    kind = own.schema["doc_id"].dataType.simpleString()
    return own.mapInArrow(run, f"doc_id {kind}, n_tokens long, " + ", ".join(f"{n} double" for n in names))


def rate_column(sum_of_steps: tuple[float, ...]) -> Column:
    """The rate by the steps so far."""
    if not sum_of_steps:
        return F.lit(1.0)
    toward = sum((F.col(f"p_{d}") * F.lit(float(s)) for d, s in zip(DOMAINS, sum_of_steps)), F.lit(0.0))
    return F.when(F.col("n_tokens") > 0, F.greatest(F.lit(0.0), F.lit(1.0) - toward)).otherwise(1.0)


def fit_rates(members: DataFrame, targets: tuple[float, ...] = TARGETS, tolerance: float = 1e-5, pull: float = 1e-10) -> tuple[float, ...]:
    """The sum of the projected-gradient steps at which the least squares are optimal to
    ``tolerance`` of all tokens. ``members`` should be a stored table; a pass reads it once.

    The distance to rates of one is added to the squares, by ``pull`` of the first Gram matrix'
    trace. However small, it makes the optimum unique and every step a descent; steps that do not
    lower the objective enough are halved.
    """
    k = len(DOMAINS)
    p = [F.col(f"p_{d}") for d in DOMAINS]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    n = F.col("n_tokens").cast("double")

    def look(steps: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Tokens by domain, the Gram matrix of the rates above zero, and half their squares, by token."""
        rate = rate_column(tuple(steps.tolist()))
        free = F.when(rate > 0, n).otherwise(0.0)
        row = members.agg(
            *(F.sum(rate * n * x) for x in p), *(F.sum(free * p[i] * p[j]) for i, j in pairs), F.sum(n * rate * rate) / 2
        ).first()
        gram = np.zeros((k, k))
        for (i, j), value in zip(pairs, row[k:-1]):
            gram[i, j] = gram[j, i] = value
        return np.array(row[:k], float), gram, float(row[-1])

    total = float(members.agg(F.sum("n_tokens")).first()[0] or 0)
    if not total:
        return ()
    goal, steps = total * np.array(targets), np.zeros(k)
    got, gram, half = look(steps)
    trace = pull * np.trace(gram)
    value = half + goal @ steps + trace / 2 * steps @ steps
    while True:
        off = got - goal - trace * steps
        if np.abs(off).max() <= tolerance * total:
            return tuple(steps.tolist())
        step, share = np.linalg.solve(gram + trace * np.eye(k), off), 1.0
        while True:
            to = steps + share * step
            got, gram, half = look(to)
            new = half + goal @ to + trace / 2 * to @ to
            if new <= value - 1e-4 * share * (off @ step) or share < 1e-9:
                break
            share /= 2
        if share < 1e-9 or new >= value:  # no lower value can be told from this one
            return tuple(to.tolist())
        steps, value = to, new


def fit_mix(
    docs: DataFrame, labels: DataFrame, targets: tuple[float, ...] = TARGETS, pull: float = 1e-10
) -> tuple[MixModel, DataFrame | None]:
    model = fit_classifier(docs, labels)
    if model.weights is None:
        return model, None
    members = cut_lineage(posteriors(docs, model))
    return MixModel(model.weights, fit_rates(members, targets, pull=pull)), members


def soft_rates(docs: DataFrame, labels: DataFrame, targets: tuple[float, ...] = TARGETS) -> DataFrame:
    """doc_id, n_tokens, the posterior and the rate of every document."""
    model, members = fit_mix(docs, labels, targets)
    if members is None:
        members = posteriors(docs, MixModel(np.zeros((BUCKETS + 1, len(DOMAINS)), np.float32)))
    return members.withColumn("rate", rate_column(model.sum_of_steps))


def mix(
    docs: DataFrame, labels: DataFrame, targets: tuple[float, ...] = TARGETS, seed: int = 3, pull: float = 1e-10
) -> DataFrame:
    """The documents, each as often as its rate says: its whole part, and once more with the
    chance of the rest, drawn by the hash of the text."""
    model, members = fit_mix(docs, labels, targets, pull)
    if members is None:
        return docs
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.rename_columns([str(i) for i in range(batch.num_columns)]), str(at)):
                texts = Texts(block.column(at))
                rate = model.rates(*model.posteriors(texts))
                draw = spread(texts.hashes() + np.uint64(seed))
                copies = np.floor(rate + (draw >> np.uint64(11)) / float(1 << 53)).astype(np.int64)
                yield block.take(pa.array(np.repeat(np.arange(len(copies)), copies))).rename_columns(batch.schema.names)

    return docs.mapInArrow(run, docs.schema)

"""Quality of documents by attention-based multiple-instance learning.

A document is a bag of passages of PASSAGE words each. Every passage is encoded: format rates and
hashed words go through a learned layer. A gated attention (a tanh branch times a sigmoid branch)
weighs the passages, and the score is a logistic function of the weighted mean of their codes. The
encoder, the attention and the score are learned together from the labels of documents alone.

The network is fitted on a bounded sample of labelled documents, drawn by the hash of their id;
of a bag of more than ``fit_passages`` passages evenly spread ones are used there. Scores read all
passages of all documents: the softmax of the attention is carried along in chunks, so a text of
any length takes bounded memory beside the text itself.

Defined results: a null, empty or word-less text is one passage without words. Repeated rows get
equal scores. An id counts once in fitting, with its smallest text and label. A null id has no
label and is not held out. Without labels of both sorts every score is the share of good ones (0.5
without any label). Labels, language, source and id are no inputs. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from aprisco.llm.blocks import (
    NEWLINE, WHITE, Texts, blocks, covered, digests, numbered, repeated, spans_sum, window_numbers, window_starts,
)

PASSAGE = 64  # words
CHUNK = 2048  # passages encoded at a time
BUCKETS = 256  # of hashed words
CODE, GATE = 24, 16  # sizes of a passage's code and of the attention's branches


def bytes_of(chars: bytes) -> np.ndarray:
    flags = np.zeros(256, bool)
    flags[np.frombuffer(chars, np.uint8)] = True
    return flags


CLASSES = (
    bytes_of(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), bytes_of(b"0123456789"), bytes_of(b"#*$%&"), bytes_of(b"|<>"),
    bytes_of(b"!?"), bytes_of(b".,;:"), bytes_of(b"\"'()[]{}=@/\\+-_~^`"), WHITE, NEWLINE, np.arange(256) > 127,
)
FORMAT = len(CLASSES) + 5
INPUTS = FORMAT + BUCKETS


@dataclass(frozen=True)
class Bags:
    """Passages of some texts, and how to encode them in chunks."""

    offsets: np.ndarray  # passages before each text
    format: np.ndarray  # rates, a row per passage
    words: np.ndarray  # bucket of every word
    bounds: np.ndarray  # words before each passage

    @classmethod
    def of(cls, texts: Texts) -> Bags:
        starts, ends, words = texts.words()
        n = np.diff(words)
        passages = np.maximum(-(-n // PASSAGE), 1)
        offsets = np.concatenate([[0], np.cumsum(passages)])
        within = np.arange(offsets[-1]) - np.repeat(offsets[:-1], passages)
        bounds = np.append(np.repeat(words[:-1], passages) + within * PASSAGE, len(starts))
        # A passage reaches from its first word, the first one from its text's begin, to the next one
        first = np.repeat(texts.offsets[:-1], passages)
        inner = np.flatnonzero(within)
        first[inner] = starts[bounds[inner]]
        first = np.append(first, texts.offsets[-1])

        numbers, distinct = numbered(texts.parts(starts, ends))
        lowered = texts.lowered()
        same, plain = numbered(lowered.parts(starts, ends))
        bucket = (digests(plain.to_pylist()) % np.uint64(BUCKETS)).astype(np.int32)[same]
        again, _ = repeated(numbers.astype(np.int64), bounds)  # within the passage
        at = window_starts(words, 5)
        windows = window_numbers(numbers, 5)[at] if len(at) else np.empty(0, np.int64)
        twice, _ = repeated(windows, np.searchsorted(at, words))
        in_twice = covered(len(starts), at[twice], at[twice] + 5)

        size = np.maximum(np.diff(first), 1)
        count = np.diff(bounds)
        rates = [spans_sum(flags[texts.data], first) / size for flags in CLASSES]
        rates += [
            np.log1p(count) / 5, (ends[-1:].sum() and spans_sum(ends - starts, bounds)) / np.maximum(count, 1) / 10,
            spans_sum(again, bounds) / np.maximum(count, 1), spans_sum(in_twice, bounds) / np.maximum(count, 1),
            np.log1p(np.repeat(n, passages)) / 10,
        ]
        return cls(offsets, np.column_stack(rates).astype(np.float32), bucket, bounds)

    def rows(self, first: int, last: int) -> np.ndarray:
        """Inputs of the passages from the first to before the last."""
        a, b = int(self.bounds[first]), int(self.bounds[last])
        owner = np.repeat(np.arange(last - first), np.diff(self.bounds[first : last + 1]))
        bag = np.bincount(owner * BUCKETS + self.words[a:b], minlength=(last - first) * BUCKETS)
        bag = np.sqrt(bag.reshape(-1, BUCKETS).astype(np.float32))
        bag /= np.maximum(np.linalg.norm(bag, axis=1, keepdims=True), 1e-9)
        return np.concatenate([self.format[first:last], bag], axis=1)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


@dataclass
class Network:
    """Weights by name; ``center`` and ``scale`` put the inputs on one scale."""

    center: np.ndarray
    scale: np.ndarray
    w: dict[str, np.ndarray]
    slope: float = 1.0  # calibration of the logit
    shift: float = 0.0

    @classmethod
    def new(cls, x: np.ndarray, seed: int) -> Network:
        rng = np.random.default_rng(seed)
        scale = x.std(0)
        scale[scale < 1e-6] = 1
        draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        w = {
            "encode": draw(INPUTS, CODE), "encode_bias": np.zeros(CODE, np.float32), "tanh": draw(CODE, GATE),
            "gate": draw(CODE, GATE), "attend": draw(GATE, 1)[:, 0], "score": draw(CODE, 1)[:, 0],
            "score_bias": np.zeros(1, np.float32),
        }
        return cls(x.mean(0), scale.astype(np.float32), w)

    def encoded(self, x: np.ndarray) -> tuple[np.ndarray, ...]:
        """Codes of passages, the two branches, and the attention before its softmax."""
        code = np.tanh((x - self.center) / self.scale @ self.w["encode"] + self.w["encode_bias"])
        up, gate = np.tanh(code @ self.w["tanh"]), sigmoid(code @ self.w["gate"])
        return code, up, gate, (up * gate) @ self.w["attend"]

    def loss_and_gradient(self, x: np.ndarray, offsets: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean log loss of bags that lie end to end, and its gradient by every weight."""
        w, begin, sizes = self.w, offsets[:-1], np.diff(offsets)
        code, up, gate, e = self.encoded(x)
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, begin), sizes))
        a = e / np.repeat(np.add.reduceat(e, begin), sizes)
        z = np.add.reduceat(a[:, None] * code, begin)
        p = sigmoid(z @ w["score"] + w["score_bias"][0])
        loss = -np.mean(np.log(np.where(y > 0, p, 1 - p) + 1e-12))
        d_logit = ((p - y) / len(y)).astype(np.float32)
        d_z = np.repeat(d_logit[:, None] * w["score"], sizes, axis=0)
        d_code, d_a = a[:, None] * d_z, (d_z * code).sum(1)
        d_e = a * (d_a - np.repeat(np.add.reduceat(a * d_a, begin), sizes))
        d_both = d_e[:, None] * w["attend"]
        d_up, d_gate = d_both * gate * (1 - up**2), d_both * up * gate * (1 - gate)
        d_code = (d_code + d_up @ w["tanh"].T + d_gate @ w["gate"].T) * (1 - code**2)
        return float(loss), {
            "encode": ((x - self.center) / self.scale).T @ d_code, "encode_bias": d_code.sum(0),
            "tanh": code.T @ d_up, "gate": code.T @ d_gate, "attend": (up * gate).T @ d_e,
            "score": z.T @ d_logit, "score_bias": d_logit.sum(keepdims=True),
        }

    def logits(self, bags: Bags) -> np.ndarray:
        """One per text. Passages come in chunks; of a text that is cut by one, the largest
        attention so far, the weights' sum and the codes' weighted sum are carried on."""
        texts = len(bags.offsets) - 1
        most, total = np.full(texts, -np.inf), np.zeros(texts)
        codes = np.zeros((texts, CODE))
        owner = np.repeat(np.arange(texts), np.diff(bags.offsets))
        for first in range(0, len(owner), CHUNK):
            last = min(first + CHUNK, len(owner))
            code, _, _, e = self.encoded(bags.rows(first, last))
            own, begin = np.unique(owner[first:last], return_index=True)
            new = np.maximum(most[own], np.maximum.reduceat(e, begin))
            weight = np.exp(e - np.repeat(new, np.diff(np.append(begin, last - first))))
            faded = np.exp(most[own] - new)
            total[own] = total[own] * faded + np.add.reduceat(weight, begin)
            codes[own] = codes[own] * faded[:, None] + np.add.reduceat(weight[:, None] * code, begin)
            most[own] = new
        return (codes / total[:, None]) @ self.w["score"] + self.w["score_bias"][0]

    def scores(self, texts: Texts) -> np.ndarray:
        return sigmoid(self.slope * self.logits(Bags.of(texts)) + self.shift)


def chosen_rows(offsets: np.ndarray, bags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Passages of the chosen bags, and the offsets of these."""
    sizes = np.diff(offsets)[bags]
    to = np.concatenate([[0], np.cumsum(sizes)])
    return np.repeat(offsets[bags] - to[:-1], sizes) + np.arange(to[-1]), to


def train(
    x: np.ndarray, offsets: np.ndarray, y: np.ndarray, epochs: int = 12, bags: int = 128, rate: float = 3e-3,
    decay: float = 1e-4, seed: int = 9,
) -> Network:
    """Adam over batches of whole bags."""
    net = Network.new(x, seed)
    rng = np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in net.w.items()}
    v = {k: np.zeros_like(w) for k, w in net.w.items()}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), bags):
            own = order[at : at + bags]
            rows, to = chosen_rows(offsets, own)
            _, gradient = net.loss_and_gradient(x[rows], to, y[own])
            step += 1
            slower = rate * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
            for k, g in gradient.items():
                g = g + decay * net.w[k]
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                net.w[k] -= (slower * m[k] / (1 - 0.9**step) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def calibrate(net: Network, z: np.ndarray, y: np.ndarray, steps: int = 50) -> None:
    """Slope and shift of the logit by Newton's method, so that scores are shares of good ones."""
    theta = np.array([1.0, 0.0])
    x = np.column_stack([z, np.ones(len(z))])
    # Targets a little off 0 and 1 keep separable ones finite
    good, bad = (y > 0).sum(), (y <= 0).sum()
    goal = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    for _ in range(steps):
        p = sigmoid(x @ theta)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        theta -= np.linalg.solve(hessian, x.T @ (p - goal) + 1e-3 * (theta - [1.0, 0.0]))
    net.slope, net.shift = max(float(theta[0]), 1e-3), float(theta[1])


def name_hash(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def held_out(doc_id: Column) -> Column:
    return name_hash(doc_id) % 4 == 2


def training_bags(docs: DataFrame, known: DataFrame, fit_passages: int) -> pa.Table:
    """label, part (of four, one for calibration) and the inputs of the passages of labelled rows."""
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    rows = rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label"))
    rows = rows.select("text", "label", F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(4)).cast("int").alias("part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text"):
                bags = Bags.of(Texts(block.column("text")))
                inputs = []
                for a, b in zip(bags.offsets[:-1].tolist(), bags.offsets[1:].tolist()):
                    some = np.unique(np.linspace(a, b - 1, min(b - a, fit_passages)).astype(np.int64))
                    inputs.append(np.concatenate([bags.rows(i, i + 1) for i in some.tolist()]).astype("<f2").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [block.column("label"), block.column("part"), pa.array(inputs, pa.binary())], names=["label", "part", "inputs"]
                )

    return rows.mapInArrow(run, "label int, part int, inputs binary").toArrow()


def fit_network(docs: DataFrame, labels: DataFrame, fit_rows: int = 5_000, fit_passages: int = 64) -> Network | float:
    """From about ``fit_rows`` labelled documents that are not held out, and ``fit_passages``
    passages of each, at most; a quarter of them calibrates the scores. Without labels of both
    sorts, the share of good ones."""
    known = labels.where("doc_id is not null and quality is not null").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("quality").cast("int").alias("label"))
    share = min(1.0, fit_rows / max(known.count(), 1))
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("bags")), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1)
    sample = training_bags(docs, known.where(drawn), fit_passages)
    label, part, data = sample.column("label").to_numpy(), sample.column("part").to_numpy(), sample.column("inputs").to_pylist()
    order = sorted(range(len(label)), key=lambda i: (data[i], label[i]))  # the same whatever the partitions
    y, part = (label[order] > 0).astype(float), part[order]
    if len(np.unique(y)) < 2:
        return float(y.mean()) if len(y) else 0.5
    sizes = np.array([len(data[i]) // (2 * INPUTS) for i in order])
    x = np.frombuffer(b"".join(data[i] for i in order), "<f2").reshape(-1, INPUTS).astype(np.float32)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    fit = np.flatnonzero(part > 0)
    if len(np.unique(y[fit])) < 2:
        fit = np.arange(len(y))
    rest = np.flatnonzero(part == 0) if len(np.unique(y[part == 0])) == 2 else fit
    rows, to = chosen_rows(offsets, fit)
    net = train(x[rows], to, y[fit])
    rows, to = chosen_rows(offsets, rest)
    calibrate(net, bag_logits(net, x[rows], to), y[rest])
    return net


def bag_logits(net: Network, x: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Logits of bags whose inputs are at hand."""
    code, _, _, e = net.encoded(x)
    begin, sizes = offsets[:-1], np.diff(offsets)
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, begin), sizes))
    z = np.add.reduceat(e[:, None] * code, begin) / np.add.reduceat(e, begin)[:, None]
    return z @ net.w["score"] + net.w["score_bias"][0]


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **fit: int) -> DataFrame:
    """doc_id, held_out (its label was not learned from), score and predicted of every document."""
    own = docs.select("doc_id", "text")
    net = fit_network(own, labels, **fit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text"):
                score = np.full(block.num_rows, net) if isinstance(net, float) else net.scores(Texts(block.column("text")))
                yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(score.astype(float))], names=["doc_id", "score"])

    scored = own.mapInArrow(run, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, score double")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )

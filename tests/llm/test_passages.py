"""The attention network against plain Python and numerical slopes, and its held-out accuracy."""

from __future__ import annotations

import math
import os
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from aprisco.llm import passages
from aprisco.llm.blocks import Texts
from aprisco.llm.queries import table
from tests.llm.data import EXTRA, awkward, prose, with_extra

SCHEMA, LABELS = "doc_id long, text string", "doc_id long, quality int, toxic int"
SF_DIR = "/root/testdata/sf0.01"


def some_network(seed: int = 3) -> passages.Network:
    rng = np.random.default_rng(seed)
    net = passages.Network.new(rng.random((50, passages.INPUTS)).astype(np.float32), seed)
    net.w = {k: rng.standard_normal(v.shape).astype(np.float64) / 3 for k, v in net.w.items()}
    return net


def plain_score(net: passages.Network, bag: np.ndarray) -> float:
    """One bag by loops over passages."""
    w, codes, weights = net.w, [], []
    for x in bag:
        code = [math.tanh(v) for v in ((x - net.center) / net.scale) @ w["encode"] + w["encode_bias"]]
        up = [math.tanh(v) for v in np.dot(code, w["tanh"])]
        gate = [1 / (1 + math.exp(-v)) for v in np.dot(code, w["gate"])]
        codes.append(code)
        weights.append(math.exp(sum(a * b * c for a, b, c in zip(up, gate, w["attend"]))))
    mean = np.array(weights) @ np.array(codes) / sum(weights)
    return 1 / (1 + math.exp(-(net.slope * (mean @ w["score"] + w["score_bias"][0]) + net.shift)))


def test_scores_match_plain_loops_in_chunks_of_any_size(monkeypatch):
    net = some_network()
    texts = Texts(pa.array([t for _, t in awkward(51)]))
    bags = passages.Bags.of(texts)
    plain = [plain_score(net, bags.rows(a, b)) for a, b in zip(bags.offsets[:-1], bags.offsets[1:])]
    for chunk in (2048, 7, 1):
        monkeypatch.setattr(passages, "CHUNK", chunk)
        assert np.allclose(net.scores(texts), plain, atol=1e-6)


def test_passages_cover_whole_texts():
    rows = [t for _, t in awkward(52)]
    bags = passages.Bags.of(Texts(pa.array(rows)))
    words = [len((t or "").replace(" ", "x").split()) for t in rows]
    assert np.diff(bags.offsets).tolist() == [max(1, -(-n // passages.PASSAGE)) for n in words]
    assert int(bags.bounds[-1]) == sum(words) and np.isfinite(bags.format).all()
    assert (np.diff(bags.bounds) <= passages.PASSAGE).all()


def test_gradient_is_the_slope_of_the_loss():
    net, rng = some_network(4), np.random.default_rng(5)
    x = rng.random((9, passages.INPUTS))
    offsets, y = np.array([0, 4, 5, 9]), np.array([1.0, 0.0, 1.0])
    _, gradient = net.loss_and_gradient(x, offsets, y)
    for name, w in net.w.items():
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in w.shape)
            was, step = w[at], 1e-5
            w[at] = was + step
            up, _ = net.loss_and_gradient(x, offsets, y)
            w[at] = was - step
            down, _ = net.loss_and_gradient(x, offsets, y)
            w[at] = was
            assert abs((up - down) / (2 * step) - gradient[name][at]) < 1e-4


def corpus(n: int = 500):
    """Bad documents have one odd passage among good ones."""
    rng = random.Random(53)
    docs = []
    for i in range(n):
        parts = [prose(rng, 64) for _ in range(rng.randrange(1, 6))]
        if i % 3 == 0:
            parts[rng.randrange(len(parts))] = " ".join(f"BUY!! w{rng.randrange(400)} $$$" for _ in range(22))
        docs.append((i, " ".join(parts)))
    return docs, [(i, int(i % 3 > 0), 0) for i in range(n)]


def test_one_odd_passage_tells(spark):
    docs, marks = corpus()
    df, labels = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(marks, LABELS)
    got = {r.doc_id: r for r in passages.score_quality(df, labels).collect()}
    held = [i for i, _ in docs if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sorted(i for i, r in got.items() if r.held_out) == held
    assert np.mean([got[i].predicted == (i % 3 > 0) for i in held]) > 0.9
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in got.values())

    # Held-out labels and other columns change nothing, nor do partitions
    turned = [(i, q if i not in held else 1 - q, 1) for i, q, _ in marks]
    other = spark.createDataFrame([(i, t, "x", "x", 1, None, "x", "x", 2) for i, t in docs], EXTRA).repartition(3)
    again = passages.score_quality(other, spark.createDataFrame(turned, LABELS)).collect()
    assert all(abs(r.score - got[r.doc_id].score) < 1e-4 for r in again)  # sums in single precision


def test_awkward_rows_and_missing_labels(spark):
    rows = awkward(54) + [(None, "no id"), (1, "same"), (1, "same")]
    df = spark.createDataFrame(with_extra(rows), EXTRA)
    marks = [(i, k % 2, 0) for k, (i, _) in enumerate(rows)] + [(rows[3][0], None, None), (7777, 1, 0)]
    labels = spark.createDataFrame(marks, LABELS)
    got = passages.score_quality(df, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id == 1}) == 1
    assert not any(r.held_out for r in got if r.doc_id is None)
    assert {r.score for r in passages.score_quality(df, labels.limit(0)).collect()} == {0.5}
    assert {r.score for r in passages.score_quality(df, labels.where("quality = 1")).collect()} == {1.0}
    assert passages.score_quality(df.limit(0), labels).collect() == []


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no given tables")
def test_held_out_accuracy_on_given_tables(spark):
    docs, labels = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")
    got = passages.score_quality(docs, labels).join(labels, "doc_id").where("held_out and quality is not null").toPandas()
    good = got[got.quality == 1]
    assert (got.predicted == got.quality).mean() > 0.93 and good.predicted.mean() > 0.95

"""Quality rules: exact rule statistics of whole texts, and an isolation forest over them.

The rule statistics of every document come from one pass. What the forest sees of them is by how
much they lie outside the range of good labelled documents, so that what is usual is alike and only
what is unusual can be odd. An isolation forest (random splits on random subsamples; short paths
mean odd documents) is grown on a bounded number of labelled documents that pass the base rules,
and the score above which a document goes is calibrated on all labelled ones:
from the lowest one that rejects no more than ``max_good_loss`` of the labelled good documents,
and ten others for each of these, halfway up to where 95 % of those others still lie above.

Defined results: a null text has no words and fails the base rules, as an empty one does. A text
of any length is judged whole. Repeated rows get equal verdicts. Without labelled rows there is
no forest, and the base rules alone decide. Columns other than the id and the text are carried
along untouched by ``keep_good``, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from aprisco.llm.blocks import (
    NEWLINE, WHITE, Texts, blocks, covered, numbered, repeated, spans_sum, window_numbers, window_starts,
)
from aprisco.sources.shared import cut_lineage

SYMBOLS = np.zeros(256, bool)
SYMBOLS[np.frombuffer(b"#*$%&|<>", np.uint8)] = True
UPPER, DIGIT, PUNCTUATION = (np.zeros(256, bool) for _ in range(3))
UPPER[0x41:0x5B] = True
DIGIT[0x30:0x3A] = True
PUNCTUATION[np.frombuffer(b"!?.,;:\"'()[]{}=@/\\+-_~^`", np.uint8)] = True

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_chars", "n_upper", "n_digits", "n_punctuation", "n_lines",
)
COUNT_SCHEMA = ", ".join(f"{c} long" for c in COUNTS)


def count_rules(texts: Texts) -> dict[str, np.ndarray]:
    """The counts named by COUNTS for each text."""
    data, offsets = texts.data, texts.offsets
    starts, ends, words = texts.words()
    head = (data & 0xC0) != 0x80  # the first byte of each code point

    own, _ = numbered(texts.parts(starts, ends))
    at = window_starts(words, 5)
    windows = window_numbers(own, 5)[at] if len(at) else np.empty(0, np.int64)
    again, _ = repeated(windows, np.searchsorted(at, words))
    in_repeat = covered(len(starts), at[again], at[again] + 5)

    breaks = np.flatnonzero(data == 0x0A)
    inner = offsets[1:-1]
    line_starts = np.sort(np.concatenate([offsets[:1], breaks + 1, inner]))
    line_ends = np.sort(np.concatenate([breaks, inner, offsets[-1:]]))
    has_word = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    contents, _ = numbered(texts.parts(line_starts, line_ends, NEWLINE))
    lines = np.searchsorted(line_starts[has_word], offsets)
    _, dup_lines = repeated(contents[has_word], lines)
    return {
        "n_words": np.diff(words),
        "word_chars": texts.sums(head & ~WHITE[data]),
        "n_symbols": texts.sums(SYMBOLS[data]),
        "n_dup_lines": dup_lines,
        "n_repeat_words": spans_sum(in_repeat, words),
        "n_chars": texts.sums(head),
        "n_upper": texts.sums(UPPER[data]),
        "n_digits": texts.sums(DIGIT[data]),
        "n_punctuation": texts.sums(PUNCTUATION[data]),
        "n_lines": np.diff(lines),
    }


def features(counts: dict[str, np.ndarray]) -> np.ndarray:
    """Rates that do not depend on a document's length, and the length itself on a log scale."""
    c = {k: np.asarray(v, float) for k, v in counts.items()}
    words, chars, lines = (np.maximum(c[k], 1) for k in ("n_words", "n_chars", "n_lines"))
    return np.column_stack(
        [
            np.log1p(c["n_words"]),
            c["word_chars"] / words,
            c["n_symbols"] / words,
            c["n_dup_lines"] / lines,
            c["n_repeat_words"] / words,
            c["n_upper"] / chars,
            c["n_digits"] / chars,
            c["n_punctuation"] / words,
            np.log1p(words / lines),
        ]
    )


def base_failed(counts: dict[str, np.ndarray], min_words: int = 10, repeat_percent: int = 20) -> np.ndarray:
    words = counts["n_words"]
    return (words < min_words) | (100 * counts["n_repeat_words"] > repeat_percent * words)


@dataclass(frozen=True)
class Forest:
    """Isolation trees as arrays over their nodes; a leaf is its own child."""

    feature: np.ndarray
    split: np.ndarray
    left: np.ndarray
    right: np.ndarray
    path: np.ndarray  # depth of a leaf, and what an unsplit rest would still have added
    norm: float

    @staticmethod
    def rest(n: np.ndarray | int) -> np.ndarray:
        """Mean path length of an unsuccessful search in a tree of n rows."""
        n = np.asarray(n, float)
        m = np.maximum(n, 2)
        return np.where(n > 2, 2 * (np.log(m - 1) + 0.5772156649015329) - 2 * (m - 1) / m, np.where(n == 2, 1.0, 0.0))

    @classmethod
    def grow(cls, x: np.ndarray, trees: int = 100, rows: int = 256, seed: int = 7) -> Forest:
        rng = np.random.default_rng(seed)
        size = min(rows, len(x))
        limit = int(np.ceil(np.log2(max(size, 2))))
        grown = []
        for _ in range(trees):
            nodes: list[list[float]] = []

            def build(sample: np.ndarray, depth: int, nodes: list[list[float]] = nodes) -> int:
                at = len(nodes)
                nodes.append([0, 0.0, at, at, depth + float(cls.rest(len(sample)))])
                spread = np.flatnonzero(sample.min(0) < sample.max(0)) if len(sample) > 1 else []
                if depth < limit and len(spread):
                    k = int(rng.choice(spread))
                    cut = float(rng.uniform(sample[:, k].min(), sample[:, k].max()))
                    low = sample[:, k] <= cut
                    nodes[at][:4] = [k, cut, build(sample[low], depth + 1), build(sample[~low], depth + 1)]
                return at

            build(x[rng.choice(len(x), size, replace=False)], 0)
            grown.append(np.array(nodes))
        most = max(map(len, grown))
        cube = np.stack([np.pad(t, ((0, most - len(t)), (0, 0))) for t in grown])
        return cls(
            cube[:, :, 0].astype(np.int32), cube[:, :, 1], cube[:, :, 2].astype(np.int32),
            cube[:, :, 3].astype(np.int32), cube[:, :, 4], max(float(cls.rest(size)), 1.0),
        )

    def score(self, x: np.ndarray) -> np.ndarray:
        """Anomaly score in (0, 1); the higher, the odder."""
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for f, s, a, b, p in zip(self.feature, self.split, self.left, self.right, self.path):
            at = np.zeros(len(x), np.int32)
            while True:
                to = np.where(x[rows, f[at]] <= s[at], a[at], b[at])
                if (to == at).all():
                    break
                at = to
            total += p[at]
        return 2.0 ** (-total / (len(self.feature) * self.norm))


@dataclass(frozen=True)
class QualityModel:
    forest: Forest | None
    threshold: float
    low: np.ndarray | None = None  # range of the features of good documents
    high: np.ndarray | None = None

    def excess(self, x: np.ndarray) -> np.ndarray:
        """By how much of its width each feature lies outside its range."""
        width = np.where(self.high > self.low, self.high - self.low, 1.0)
        return (np.maximum(0, x - self.high) + np.maximum(0, self.low - x)) / width

    def judge(self, counts: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """base_failed, anomaly score, kept."""
        failed = base_failed(counts)
        score = self.forest.score(self.excess(features(counts))) if self.forest else np.zeros(len(failed))
        return failed, score, ~failed & (score < self.threshold)


def rule_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and the counts of every document, from one pass over the texts."""
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text"):
                counts = count_rules(Texts(block.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [block.column("doc_id"), *(pa.array(counts[c].astype(np.int64)) for c in COUNTS)],
                    names=["doc_id", *COUNTS],
                )

    return own.mapInArrow(run, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, {COUNT_SCHEMA}")


def fit_quality(
    statistics: DataFrame,
    labels: DataFrame,
    fit_rows: int = 20_000,
    max_good_loss: float = 0.001,
    tail: float = 0.0005,
    margin: float = 0.25,
    trees: int = 100,
    bins: int = 4096,
) -> QualityModel:
    """Forest from about ``fit_rows`` labelled documents at most, drawn by the hash of their id;
    threshold from all labelled ones, by a histogram of their scores. The range of a feature leaves
    out a share ``tail`` of the good documents drawn at either end, and reaches ``margin`` of its
    width further. ``statistics`` should be a stored table, as it is read twice."""
    labelled = labels.groupBy("doc_id").agg(F.min("quality").alias("quality")).where("quality is not null")
    rows = cut_lineage(statistics.join(labelled, "doc_id"))
    share = min(1.0, fit_rows / max(rows.count(), 1))
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("forest")), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1)
    # An id counts once, however many rows have it
    sample = rows.where(drawn).groupBy("doc_id").agg(F.min(F.struct(*COUNTS, "quality")).alias("c")).select("c.*")
    sample = sample.toPandas().sort_values([*COUNTS, "quality"])
    sample = sample[~base_failed({c: sample[c].to_numpy() for c in COUNTS})]
    good_rows = sample.quality.to_numpy() > 0
    if len(sample) < 2 or not good_rows.any():
        return QualityModel(None, 2.0)
    x = features({c: sample[c].to_numpy() for c in COUNTS})
    low = np.quantile(x[good_rows], tail, axis=0, method="lower")
    high = np.quantile(x[good_rows], 1 - tail, axis=0, method="higher")
    unbound = QualityModel(None, 2.0, low - margin * (high - low), high + margin * (high - low))
    forest = Forest.grow(unbound.excess(x), trees)
    unbound = replace(unbound, forest=forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = {c: batch.column(c).to_numpy() for c in COUNTS}
            failed, score, _ = unbound.judge(counts)
            passed = pa.array(np.minimum((score * bins).astype(np.int32), bins - 1)).filter(pa.array(~failed))
            yield pa.RecordBatch.from_arrays(
                [passed, batch.column("quality").filter(pa.array(~failed))], names=["bin", "quality"]
            )

    scored = rows.select(*COUNTS, F.col("quality").cast("int")).mapInArrow(run, "bin int, quality int")
    histogram = scored.groupBy("bin").agg(
        F.sum(F.when(F.col("quality") > 0, 1).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("quality") > 0, 0).otherwise(1)).alias("bad"),
    )
    good, bad = np.zeros(bins + 1), np.zeros(bins + 1)
    for r in histogram.collect():  # at most one row per bin
        good[r["bin"]], bad[r["bin"]] = r["good"], r["bad"]
    good_above, bad_above = (np.cumsum(v[::-1])[::-1] for v in (good, bad))
    allowed = (good_above <= max_good_loss * good.sum()) & (bad_above > 10 * good_above)
    found = np.flatnonzero(allowed)
    if not len(found):
        return unbound
    # Where nearly as many of the others lie higher up, the border goes halfway to them
    least = int(found[0])
    most = int(np.flatnonzero(bad_above >= 0.95 * bad_above[least])[-1])
    return replace(unbound, threshold=(least + max(least, most)) / 2 / bins)


def judge_statistics(statistics: DataFrame, model: QualityModel) -> DataFrame:
    """The stored statistics with base_failed, score and kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            failed, score, kept = model.judge({c: batch.column(c).to_numpy() for c in COUNTS})
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(failed), pa.array(score), pa.array(kept)],
                names=[*batch.schema.names, "base_failed", "score", "kept"],
            )

    kind = statistics.schema["doc_id"].dataType.simpleString()
    return statistics.select("doc_id", *COUNTS).mapInArrow(
        run, f"doc_id {kind}, {COUNT_SCHEMA}, base_failed boolean, score double, kept boolean"
    )


def quality_verdicts(docs: DataFrame, labels: DataFrame, **fit: float) -> DataFrame:
    """One row per document: the counts, base_failed, the anomaly score and kept."""
    statistics = cut_lineage(rule_statistics(docs))
    return judge_statistics(statistics, fit_quality(statistics, labels, **fit))


def keep_good(docs: DataFrame, labels: DataFrame, text_col: str = "text", **fit: float) -> DataFrame:
    """The documents that pass, with all their columns. The texts are read twice: for the
    statistics the model needs, and to filter, which spares joining texts to verdicts."""
    model = fit_quality(cut_lineage(rule_statistics(docs, text_col=text_col)), labels, **fit)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.rename_columns([str(i) for i in range(batch.num_columns)]), str(at)):
                _, _, kept = model.judge(count_rules(Texts(block.column(at))))
                yield block.filter(pa.array(kept)).rename_columns(batch.schema.names)

    return docs.mapInArrow(run, docs.schema)

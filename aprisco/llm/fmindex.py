"""Substring dedup of words with a compressed FM-index per shard.

The segments of a shard (see ``repeats``) are indexed by the Burrows-Wheeler transform of their
words, held in a wavelet matrix of packed bits. All of the shard's segments are then streamed
against it at once, right to left: backward search extends every match by one word, and a match
longer than the threshold is cut back to it by its group of suffixes with that common prefix. So
the search knows, for every word, the suffixes that match it over the threshold, and reports the
words at which one of them lies in a document with a smaller id.

Defined results: null, empty and word-less texts have no words and lose none. Texts are judged
whole. Rows with one id never remove words of each other, be they equal or not. A row without an
id is compared with no other and loses nothing. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from aprisco.llm.blocks import Texts, blocks, spans_sum
from aprisco.llm.repeats import covered_by, ranges_of, repeated_windows, with_ranges, with_uid

GRAM = 12


class WaveletMatrix:
    """Ranks of symbols in a sequence, from bits packed into words with a running count."""

    def __init__(self, values: np.ndarray, symbols: int):
        self.levels = max(1, int(symbols - 1).bit_length())
        self.bits, self.ones, self.zeros = [], [], []
        for level in reversed(range(self.levels)):
            bit = (values >> level & 1).astype(bool)
            packed = np.packbits(np.concatenate([bit, np.zeros(64 + -len(bit) % 64, bool)]), bitorder="little").view(np.uint64)
            counts = np.zeros(len(packed) + 1, np.int64)
            np.cumsum(np.bitwise_count(packed), out=counts[1:])
            self.bits.append(packed)
            self.ones.append(counts)
            self.zeros.append(len(bit) - int(bit.sum()))
            values = np.concatenate([values[~bit], values[bit]])
        self.starts = self.walk(np.arange(symbols), np.zeros(symbols, np.int64))

    def walk(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for i, level in enumerate(reversed(range(self.levels))):
            word, rest = at >> 6, (at & 63).astype(np.uint64)
            below = self.bits[i][word] & ((np.uint64(1) << rest) - np.uint64(1))
            ones = self.ones[i][word] + np.bitwise_count(below)
            at = np.where(symbol >> level & 1, self.zeros[i] + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often the symbol occurs before this place."""
        return self.walk(symbol, at) - self.starts[symbol]


def ranked(values: np.ndarray) -> np.ndarray:
    return np.unique(values, return_inverse=True)[1].astype(np.int64)


def suffix_order(symbols: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array by prefix doubling, and for every suffix the class of its first ``window``
    symbols. The last symbols of texts must be unique, so that no two suffixes are equal."""
    n = len(symbols)
    rank, width = ranked(symbols), 1
    classes = rank if window == 1 else None
    while True:
        if classes is None and width * 2 >= window:
            ahead = np.full(n, -1, np.int64)
            ahead[: max(0, n - (window - width))] = rank[window - width :]
            classes = ranked(rank * (n + 1) + ahead + 1)
        if rank.max() == n - 1 and classes is not None:
            break
        ahead = np.full(n, -1, np.int64)
        ahead[: max(0, n - width)] = rank[width:]
        rank, width = ranked(rank * (n + 1) + ahead + 1), width * 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    return order, classes


class FMIndex:
    """Index of word sequences; each carries the id of its document."""

    def __init__(self, words: list[np.ndarray], documents: np.ndarray, window: int):
        self.window, count = window, len(words)
        lengths = np.fromiter(map(len, words), np.int64, count)
        names, inverse = np.unique(np.concatenate(words), return_inverse=True)
        self.names = names
        symbols = np.empty(int(lengths.sum()) + count, np.int64)
        stops = np.cumsum(lengths + 1) - 1
        inside = np.ones(len(symbols), bool)
        inside[stops] = False
        symbols[inside] = inverse + count  # the ends 0 .. count - 1 are unique and come first
        symbols[stops] = np.arange(count)
        order, classes = suffix_order(symbols, window)
        before = symbols[order - 1]
        transform = np.where(before < count, 0, before - count + 1)  # ends are one symbol here
        self.matrix = WaveletMatrix(transform, len(names) + 1)
        self.first = count + np.concatenate([[0], np.cumsum(np.bincount(inverse, minlength=len(names)))])
        self.size = len(symbols)
        owner = np.repeat(np.arange(count), lengths + 1)
        own = classes[order]
        fresh = np.concatenate([[True], own[1:] != own[:-1]])
        self.group = np.cumsum(fresh) - 1
        self.group_start = np.flatnonzero(fresh)
        self.group_end = np.append(self.group_start[1:], self.size)
        self.earliest = np.minimum.reduceat(documents[owner[order]], self.group_start)

    def stream(self, words: list[np.ndarray], documents: np.ndarray) -> list[np.ndarray]:
        """For every sequence, at which words a match over the threshold begins whose suffixes
        include one of a document with a smaller id. The sequences' words must be indexed."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        names = np.searchsorted(self.names, np.concatenate(words)) + 1
        ends = np.cumsum(lengths)
        hits = [np.zeros(n, bool) for n in lengths.tolist()]
        low, high = np.zeros(len(words), np.int64), np.full(len(words), self.size, np.int64)
        match = np.zeros(len(words), np.int64)
        for step in range(1, int(lengths.max()) + 1):
            live = np.flatnonzero(lengths >= step)
            symbol = names[ends[live] - step]
            low[live] = self.first[symbol - 1] + self.matrix.rank(symbol, low[live])
            high[live] = self.first[symbol - 1] + self.matrix.rank(symbol, high[live])
            match[live] = np.where(high[live] > low[live], match[live] + 1, 0)
            over = live[match[live] >= self.window]
            group = self.group[low[over]]
            match[over] = self.window
            low[over], high[over] = self.group_start[group], self.group_end[group]
            for i in over[self.earliest[group] < documents[over]].tolist():
                hits[i][lengths[i] - step] = True
        return hits


def word_symbols(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    return texts.word_hashes()


def remove_repeats(docs: DataFrame, window: int = 50) -> DataFrame:
    """doc_id, n_words, n_removed and kept (the words that stay, joined by one space)."""
    own = with_uid(docs)

    def judge(table: pa.Table) -> list[list[tuple[int, int]]]:
        words = [np.frombuffer(s.as_buffer(), np.uint64) for s in table.column("symbols")]
        # Ids of any type compare like their ranks
        ids = np.unique(table.column("least").to_numpy(zero_copy_only=False), return_inverse=True)[1]
        return [ranges_of(hit) for hit in FMIndex(words, ids, window).stream(words, ids)]

    found = repeated_windows(own.where("doc_id is not null"), word_symbols, judge, window, min(GRAM, window), earlier=True, dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text"):
                texts = Texts(block.column("text"))
                starts, ends, offsets = texts.words()
                gone = covered_by(block.column("ranges"), offsets, window, len(starts))
                n_words, n_removed = np.diff(offsets), spans_sum(gone, offsets)
                data = texts.data.tobytes()
                kept = []
                stay = np.flatnonzero(~gone)
                at = np.searchsorted(stay, offsets).tolist()
                pieces = [data[a:b] for a, b in zip(starts[stay].tolist(), ends[stay].tolist())]
                for a, b in zip(at[:-1], at[1:]):
                    kept.append(b" ".join(pieces[a:b]).decode())
                yield pa.RecordBatch.from_arrays(
                    [block.column("doc_id"), pa.array(n_words), pa.array(n_removed), pa.array(kept, pa.string())],
                    names=["doc_id", "n_words", "n_removed", "kept"],
                )

    kind = own.schema["doc_id"].dataType.simpleString()
    return with_ranges(own, found).mapInArrow(run, f"doc_id {kind}, n_words long, n_removed long, kept string")

"""Periodic runs of words by seeds and their extension along diagonals.

A run is a maximal stretch of words with smallest period q and four periods or more. Its words equal
those q further on over three periods at least, so all grams of that length in it repeat at lag q,
and, as they are no shorter than q, not sooner. Lags are taken in bands that double; each band has
its own gram length, the overlap that its shortest period guarantees. The grams of a band are
indexed by exact numbers, and every occurrence is paired with the next one in its document only,
which is enough and keeps pairs linear in the text. Neighbouring seeds of a lag are one seed; it is
extended to both sides along the diagonal of its lag, and a table of how far each lag is covered
suppresses seeds that lie in what was extended before.

Defined results: null, empty and word-less texts have no words and no runs. Texts of any length are
searched whole, and runs never cross texts. A null id hashes like an empty one where planting asks
for a hash. Repeated rows get equal results. Other columns play no part, whatever they are called.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from aprisco.llm.blocks import Texts, blocks, covered, numbered, owners

POWER = 4  # periods of the shortest run
SHORTEST = 6  # words of the shortest run


def least_match(period: int) -> int:
    """Words of a run that equal those a period further on, at least."""
    return max(SHORTEST, POWER * period) - period


def pair_numbers(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return numbered(pa.array(left * (int(right.max()) + 1) + right))[0].astype(np.int64)


def band_grams(words: np.ndarray, longest: int) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """For each band of lags, from ``low`` to ``high``, the gram length and the numbers of all
    grams; as far as grams repeat and the longest text has room for a run."""
    own, size, low, high = words, 1, 1, 1
    while max(SHORTEST, POWER * low) <= longest:
        length = min(least_match(low), least_match(high))
        while 2 * size <= length:
            if len(own) <= size:
                return
            own, size = pair_numbers(own[:-size], own[size:]), 2 * size
        n = len(words) - length + 1
        if n <= 0:
            return
        grams = own[:n] if size == length else pair_numbers(own[:n], own[length - size : length - size + n])
        if int(grams.max()) + 1 == n:  # all different, and so are longer ones
            return
        yield low, high, length, grams
        low, high = high + 1, 2 * high


def seeds(grams: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lag, first and last place of neighbouring pairs (an occurrence of a gram and the next one)
    of one lag in the band, by lag and place."""
    often = np.flatnonzero(np.bincount(grams)[grams] > 1)
    order = often[np.argsort(grams[often], kind="stable")]
    lag = np.diff(order)
    pair = (grams[order[1:]] == grams[order[:-1]]) & (lag >= low) & (lag <= high)
    at, lag = order[:-1][pair], lag[pair]
    order = np.lexsort((at, lag))
    at, lag = at[order], lag[order]
    new = np.ones(len(at), bool)
    new[1:] = (lag[1:] != lag[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at))[: len(first)] - 1
    return lag[first], at[first], at[last]


def extended(words: np.ndarray, begin: int, end: int, lag: int) -> tuple[int, int]:
    """The stretch of the diagonal around [begin, end) on which words equal those a lag further on."""
    step = 16
    while end + lag < len(words):
        to = min(end + step, len(words) - lag)
        differ = np.flatnonzero(words[end:to] != words[end + lag : to + lag])
        if len(differ):
            end += int(differ[0])
            break
        end, step = to, 2 * step
    step = 16
    while begin > 0:
        to = max(begin - step, 0)
        differ = np.flatnonzero(words[to:begin] != words[to + lag : begin + lag])
        if len(differ):
            begin = to + int(differ[-1]) + 1
            break
        begin, step = to, 2 * step
    return begin, end


def smaller_period(words: np.ndarray, start: int, period: int) -> bool:
    """Whether a stretch of four periods has a period that divides this one."""
    divisors = {d for k in range(1, isqrt(period) + 1) if period % k == 0 for d in (k, period // k)} - {period}
    block = words[start : start + 2 * period]
    return any((block[:period] == block[d : d + period]).all() for d in divisors)


def find_runs(words: np.ndarray, longest: int) -> list[tuple[int, int, int]]:
    """Start, length and period of all runs, by start and period. Equal words have equal numbers,
    and words of different texts never do; ``longest`` is the number of words of the longest text."""
    found = []
    if not len(words):
        return found
    for low, high, length, grams in band_grams(words.astype(np.int64), longest):
        furthest: dict[int, int] = {}
        for lag, first, last in zip(*(x.tolist() for x in seeds(grams, low, high))):
            if first < furthest.get(lag, 0):
                continue
            begin, end = extended(words, first, last + length, lag)
            furthest[lag] = end
            if end - begin + lag >= max(SHORTEST, POWER * lag) and not smaller_period(words, begin, lag):
                found.append((begin, end - begin + lag, lag))
    return sorted(found, key=lambda r: (r[0], r[2]))


def planted(source: np.ndarray, offsets: np.ndarray, ids: pa.Array) -> np.ndarray:
    """For every word the one that stands in its place after planting: of every tenth document by
    the hash of its id, from some word on the text repeats a stretch."""
    for k, name in enumerate(ids.to_pylist()):
        h, first, n = zlib.crc32(b"" if name is None else str(name).encode()), int(offsets[k]), int(offsets[k + 1] - offsets[k])
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            period = 1 + (n - a) // (3 + g % 8)
            source[first + a : first + n] = first + a + np.arange(n - a) % period
    return source


def periodic_runs(docs: DataFrame, plant: bool = False) -> DataFrame:
    """doc_id, runs (start, length, period, by start and period) and collapsed of every document:
    its words, joined by one space, without those that a run holds after its first period.
    ``plant`` first makes every tenth document periodic (``planted``)."""
    own = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text"):
                texts = Texts(block.column("text"))
                starts, ends, offsets = texts.words()
                numbers = numbered(texts.parts(starts, ends))[0].astype(np.int64)
                if plant:
                    source = planted(np.arange(len(starts)), offsets, block.column("doc_id"))
                    numbers, starts, ends = numbers[source], starts[source], ends[source]
                    del source
                if texts.rows > 1 and len(numbers):
                    numbers = pair_numbers(owners(offsets), numbers)
                found = find_runs(numbers, int(np.diff(offsets).max()))
                rows = np.array(found, np.int64).reshape(-1, 3)
                dropped = covered(len(starts), rows[:, 0] + rows[:, 2], rows[:, 0] + rows[:, 1])
                stay = np.flatnonzero(~dropped)
                data = memoryview(texts.data)
                parts = [data[a:b] for a, b in zip(starts[stay].tolist(), ends[stay].tolist())]
                at = np.searchsorted(stay, offsets).tolist()
                owner = np.searchsorted(offsets, rows[:, 0], side="right") - 1
                struct = pa.StructArray.from_arrays(
                    [pa.array(rows[:, 0] - offsets[owner]), pa.array(rows[:, 1]), pa.array(rows[:, 2])], ["start", "length", "period"]
                )
                bounds = np.searchsorted(owner, np.arange(texts.rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        block.column("doc_id"), pa.ListArray.from_arrays(pa.array(bounds), struct),
                        pa.array([b" ".join(parts[a:b]) for a, b in zip(at[:-1], at[1:])], pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "runs", "collapsed"],
                )

    kind = own.schema["doc_id"].dataType.simpleString()
    return own.mapInArrow(
        run, f"doc_id {kind}, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    )


def digest(docs: DataFrame) -> DataFrame:
    """Of each document the number of runs, the run of most periods, and what names all of them."""
    found = periodic_runs(docs, plant=True)
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    more = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    best = F.aggregate("runs", none, lambda best, r: F.when(more(best, r), r).otherwise(best))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        "best.start", "best.length", "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.encode(F.array_join(F.transform("runs", line), ""), "utf-8"), 256).alias("runs_sha256"),
        F.sha2(F.encode("collapsed", "utf-8"), 256).alias("collapsed_sha256"),
    )

"""Periodic runs against checking every lag of every text."""

from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np

from aprisco.llm import runs
from tests.llm.data import EXTRA, WORDS, awkward, balanced, prose, with_extra

SCHEMA = "doc_id long, text string"


def plainly(words: list) -> list[tuple[int, int, int]]:
    found, n = [], len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if length >= max(6, 4 * q):
                own = words[start : start + length]
                if not any(own[d:] == own[:-d] for d in range(1, q)):
                    found.append((start, length, q))
            i += 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def repetitive(rng: random.Random, n: int, letters: int) -> list[str]:
    words: list[str] = []
    while len(words) < n:
        words += [f"v{rng.randrange(letters)}" for _ in range(rng.randrange(1, 14))] * rng.choice((1, 1, 3, 4, 5, 9))
    return words[:n]


def test_runs_of_random_sequences():
    rng = random.Random(41)
    for _ in range(600):
        words = repetitive(rng, rng.randrange(0, 130), rng.choice((1, 2, 3, 9)))
        numbers = np.array([int(w[1:]) for w in words], np.int64)
        assert runs.find_runs(numbers, len(words)) == plainly(words)


def test_words_after_planting():
    offsets, ids = np.array([0, 9, 9, 30]), [12, 3, 25]
    import pyarrow as pa

    source = runs.planted(np.arange(30), offsets, pa.array(ids)).tolist()
    for k, i in enumerate(ids):
        a, b = int(offsets[k]), int(offsets[k + 1])
        assert source[a:b] == [a + x for x in replanted(i, b - a)]


def replanted(doc_id, n: int) -> list[int]:
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    g = h // 10
    if h % 10 or not n:
        return list(range(n))
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [i if i < a else a + (i - a) % p for i in range(n)]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def expected(doc_id, text: str | None) -> tuple:
    words = WORDS.findall(text or "")
    words = [words[i] for i in replanted(doc_id, len(words))]
    found = plainly(words)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    dropped = {i for s, n, q in found for i in range(s + q, s + n)}
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    one = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(found), *one, sha(lines), sha(kept))


def test_digest_matches_every_lag(spark):
    rng = random.Random(43)
    rows = awkward(43)
    rows += [(1000 + i, " ".join(repetitive(rng, rng.randrange(1, 200), 3))) for i in range(120)]
    rows += [(5000, " ".join(["tie"] * 3000)), (5001, "A a " * 9), (5002, " ".join(balanced(9))), (5003, "x y " * 30)]
    rows += [(5004, " ".join(f"{prose(rng, 7)} {prose(rng, 3)}" * 5)), (5005, "a b c a b c a b c a b c")]
    found = runs.digest(spark.createDataFrame(with_extra(rows), EXTRA).repartition(3)).collect()
    got = {r.doc_id: tuple(r)[1:] for r in found}
    assert len(found) == len(rows) and sum(v[0] > 0 for v in got.values()) > 100
    assert got == {i: expected(i, t) for i, t in rows}


def test_runs_never_cross_texts_or_rows(spark):
    rows = [(1, "a a a"), (2, "a a a"), (2, "a a a"), (None, "b b b b b b"), (None, None), (4, "b")]
    found = {(r.doc_id, r.collapsed): [tuple(x) for x in r.runs] for r in runs.periodic_runs(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found == {(1, "a a a"): [], (2, "a a a"): [], (None, "b"): [(0, 6, 1)], (None, ""): [], (4, "b"): []}
    assert runs.digest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_covered_lags_are_extended_once(monkeypatch):
    calls, extended = [], runs.extended
    monkeypatch.setattr(runs, "extended", lambda *a: calls.append(a[1:]) or extended(*a))
    words = np.array([0, 1, 2] * 4000 + [9] + [3, 4] * 3000, np.int64)
    assert runs.find_runs(words, len(words)) == [(0, 12_000, 3), (12_001, 6_000, 2)]
    assert len(calls) <= 3

"""Substring, suffix-array and near-duplicate operators against brute force."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from aprisco.llm import fmindex, neardup, repeats, suffixes
from aprisco.llm.components import connected_components
from aprisco.llm.minhash import superminhash
from tests.llm.data import EXTRA, WORDS, awkward, components, prose, shingles, with_extra

SCHEMA = "doc_id long, text string"


def covered(n: int, starts: list[int], width: int) -> list[bool]:
    out = [False] * n
    for s in starts:
        out[s : s + width] = [True] * width
    return out


def word_repeats(rows, width=50):
    words = {i: WORDS.findall(t or "") for i, t in rows}
    least: dict = {}
    for i in sorted(words):
        for p in range(len(words[i]) - width + 1):
            least.setdefault(tuple(words[i][p : p + width]), i)
    out = {}
    for i, w in words.items():
        gone = covered(len(w), [p for p in range(len(w) - width + 1) if least[tuple(w[p : p + width])] < i], width)
        out[i] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g))
    return out


def byte_repeats(rows, width=400):
    data = {i: (t or "").encode() for i, t in rows}
    times = Counter(b[p : p + width] for b in data.values() for p in range(len(b) - width + 1))
    out = {}
    for i, b in data.items():
        gone = covered(len(b), [p for p in range(len(b) - width + 1) if times[b[p : p + width]] > 1], width)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out[i] = (len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g))
    return out


@pytest.mark.parametrize("group", [4096, 3])
def test_word_repeats_match_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(repeats, "GROUP", group)  # small: anchors split by longer context
    rows = awkward()
    df = spark.createDataFrame(with_extra(rows), EXTRA)
    found = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in fmindex.remove_repeats(df).collect()}
    assert found == word_repeats(rows)


@pytest.mark.parametrize("group", [4096, 40])
def test_byte_repeats_match_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(repeats, "GROUP", group)
    rows = awkward(2)
    df = spark.createDataFrame(with_extra(rows), EXTRA)
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffixes.remove_repeats(df).collect()}
    assert found == byte_repeats(rows)


@pytest.mark.parametrize("size, removed", [(399, 0), (400, 400)])
def test_passages_go_by_bytes_from_both_copies(spark, size, removed):
    passage = prose(random.Random(6), 120, 5000)[:size]
    assert len(WORDS.findall(passage)) > 50
    df = spark.createDataFrame([(1, f"({passage})"), (2, f"[{passage}]"), (3, "other")], SCHEMA)
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in suffixes.remove_repeats(df).collect()}
    assert found == {**{i: (size + 2, removed, removed // 400) for i in (1, 2)}, 3: (5, 0, 0)}


def test_repeated_rows_and_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(300))
    df = spark.createDataFrame([(1, text), (1, text), (None, text), (2, text)], SCHEMA)
    words = sorted((r.doc_id or 0, r.n_removed) for r in fmindex.remove_repeats(df).collect())
    assert words == [(0, 0), (1, 0), (1, 0), (2, 300)]
    assert all(r.n_removed == r.n_bytes and r.n_spans == 1 for r in suffixes.remove_repeats(df).collect())


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert fmindex.remove_repeats(empty).collect() == suffixes.remove_repeats(empty).collect() == []
    assert neardup.near_duplicates(empty).collect() == []
    blank = spark.createDataFrame([(1, None), (2, "")], SCHEMA)
    assert [r.n_words for r in fmindex.remove_repeats(blank).collect()] == [0, 0]
    assert all(r.kept for r in neardup.near_duplicates(blank).collect())


def test_deep_shallow_order_and_prefixes():
    rng = random.Random(5)
    strings = [bytes(rng.choice(b"ab\0") for _ in range(rng.randrange(0, 160))) for _ in range(300)]
    trunk = bytes(rng.choice(b"xy") for _ in range(300))
    strings += [trunk[: rng.randrange(80, 300)] + bytes(rng.choice(b"xy") for _ in range(rng.randrange(4))) for _ in range(200)]
    strings += [strings[7], strings[320], b""]
    groups = np.array([rng.randrange(3) for _ in strings])
    order, shared = suffixes.deep_shallow_sort(strings, groups)
    placed = [(groups[i], strings[i]) for i in order]
    assert placed == sorted(placed)
    for k in range(1, len(placed)):
        (g, a), (h, b) = placed[k - 1], placed[k]
        same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert shared[k] == (same if g == h else 0)


def test_fm_index_reports_earlier_documents():
    rng = np.random.default_rng(3)
    words = [rng.integers(0, 4, rng.integers(6, 40)).astype(np.uint64) for _ in range(60)]
    ids = rng.permutation(60)
    hits = fmindex.FMIndex(words, ids, 6).stream(words, ids)
    least: dict = {}
    for w, i in zip(words, ids):
        for p in range(len(w) - 5):
            key = tuple(w[p : p + 6])
            least[key] = min(least.get(key, i), i)
    for w, i, hit in zip(words, ids, hits):
        assert hit.tolist() == [p <= len(w) - 6 and least[tuple(w[p : p + 6])] < i for p in range(len(w))]


@pytest.mark.parametrize("block", [200_000, 1500])
def test_groups_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK_SHINGLES", block)  # small: clusters of several blocks
    rows = awkward(3)
    df = spark.createDataFrame(with_extra(rows), EXTRA)
    found = neardup.near_duplicates(df, 4, 80).collect()
    expected = components(rows, 4, 80)
    assert {r.doc_id: r.component_id for r in found} == expected
    assert {r.doc_id: r.n_shingles for r in found} == {i: len(shingles(t, 4)) for i, t in rows}
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_one_of_each_stays_with_all_columns(spark):
    rows = awkward(4)
    df = spark.createDataFrame(with_extra(rows + rows[6:8]), EXTRA)
    kept = neardup.keep_one_of_each(df)
    assert kept.columns == df.columns
    expected = components(rows, 5, 80)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, c in expected.items() if i == c)


def test_one_row_of_each_group_stays(spark):
    rng = random.Random(14)
    texts = [prose(rng, 120) for _ in range(5)]
    a, b, c, d, e = texts
    edited = lambda t: " ".join(["edited" if k == 60 else w for k, w in enumerate(t.split(" "))])
    rows = [(None, a), (None, edited(a)), (None, a), (7, b), (None, edited(b))]
    rows += [(1, c), (3, edited(c)), (3, d), (8, e), (8, edited(e)), (8, e)]
    blank = [(5, ""), (5, ""), (6, None), (6, None), (None, " "), (None, " ")]
    df = spark.createDataFrame(with_extra(rows + blank), EXTRA)
    kept = neardup.keep_one_of_each(df)
    assert kept.columns == df.columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert Counter(r for r in got if r in blank) == Counter(blank)
    assert sorted((i for i, t in got if (i, t) not in blank), key=str) == [1, 3, 7, 8, None]
    assert {(1, c), (3, d), (7, b)} <= set(got)
    assert sum(t in (a, edited(a)) for _, t in got) == sum(t in (e, edited(e)) for _, t in got) == 1


def test_superminhash_estimates_similarity():
    rng = np.random.default_rng(8)
    errors = []
    for _ in range(60):
        pool = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
        a, b = np.unique(pool[:300]), np.unique(pool[60:])
        s = superminhash(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), 160)
        errors.append((s[0] == s[1]).mean() - len(np.intersect1d(a, b)) / len(np.union1d(a, b)))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.05
    tiny = superminhash(np.array([1, 2, 1, 2, 3], np.uint64), np.array([0, 2, 2, 5]), 64)
    assert (tiny[1] == np.iinfo(np.uint64).max).all()
    assert 0.3 < (tiny[0] == tiny[2]).mean() < 0.95


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3), (200, 201)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200}

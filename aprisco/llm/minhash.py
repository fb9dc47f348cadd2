"""Shingle sets and SuperMinHash signatures of whole texts.

Each element of a set deals its random ranks to the positions of the signature along a random
permutation of its own: in layer j it offers the value ``j + r`` at the j-th place of that
permutation, and a position keeps the smallest offer. As the places of an element are distinct,
positions are negatively correlated, which lowers the variance against independent minima. After
a layer in which every position of a set holds a value of that layer or an earlier one, later
layers cannot change anything: the set is done (early stopping).
"""

from __future__ import annotations

import numpy as np

from aprisco.llm.blocks import GOLDEN, Texts, mix, owners, stretch_hashes, window_hashes, window_starts

EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_sets(texts: Texts, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each text's word shingles, and where each text's begin. A text
    of fewer words has one shingle, all its words; one without words has none."""
    hashes, words = texts.lowered().word_hashes()
    at = window_starts(words, width)
    full = window_hashes(hashes, width)[at] if len(at) else np.empty(0, np.uint64)
    n = np.diff(words)
    short = np.flatnonzero((n > 0) & (n < width))
    whole = stretch_hashes(hashes, words[short], words[short + 1])
    owner = np.concatenate([owners(words)[at], short])
    values = np.concatenate([full, whole])[np.argsort(owner, kind="stable")]
    offsets = np.zeros(texts.rows + 1, np.int64)
    np.cumsum(np.bincount(owner, minlength=texts.rows), out=offsets[1:])
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        values[a:b].sort()
    first = np.ones(len(values), bool)
    first[1:] = values[1:] != values[:-1]
    first[offsets[:-1][offsets[:-1] < len(values)]] = True
    kept = np.zeros(len(values) + 1, np.int64)
    np.cumsum(first, out=kept[1:])
    return values[first], kept[offsets]


def superminhash(values: np.ndarray, offsets: np.ndarray, m: int) -> np.ndarray:
    """Signatures, a row of m values for each set; an empty set has EMPTY everywhere."""
    sets = len(offsets) - 1
    signature = np.full(sets * m, EMPTY, np.uint64)
    owner = owners(offsets)
    state = values.copy()
    open_, places = np.diff(offsets) > 0, None
    for j in range(m):
        if j:  # elements of sets that are done drop out
            live = open_[owner]
            if not live.any():
                break
            owner, state = owner[live], state[live]
            if places is None:
                # the first swap of each element's permutation has been made without a table
                places = np.broadcast_to(np.arange(m, dtype=np.uint16), (len(owner), m)).copy()
                rows = np.arange(len(owner))
                was = swapped[live]
                places[rows, was] = 0
            else:
                places = places[live]
                rows = np.arange(len(owner))
        state = state + GOLDEN
        bits = mix(state)
        k = j + ((bits >> np.uint64(32)) * np.uint64(m - j) >> np.uint64(32)).astype(np.int64)
        if j == 0:
            place = swapped = k
        else:
            place = places[rows, k].astype(np.int64)
            places[rows, k] = places[rows, j]
        offer = (np.uint64(j) << np.uint64(32)) | (bits & np.uint64(0xFFFFFFFF))
        np.minimum.at(signature, owner * m + place, offer)
        open_ = signature.reshape(sets, m).max(1) >= np.uint64((j + 1) << 32)
        open_ &= np.diff(offsets) > 0
    return signature.reshape(sets, m)


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """One hash per band of so many neighbouring positions."""
    sets, m = signature.shape
    keys = np.zeros((sets, m // rows), np.uint64)
    for r in range(rows):
        keys = mix(keys * GOLDEN + signature[:, r::rows])
    return keys


def set_digest(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that name each set."""
    out = []
    for salt in (np.uint64(1), np.uint64(0xC2B2AE3D27D4EB4F)):
        total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(mix(values ^ salt), out=total[1:])
        out.append(total[offsets[1:]] - total[offsets[:-1]])
    return out[0], out[1]

"""Content-defined segments: every window of a sequence is named by an anchor inside it.

The anchor of a window is its run of ``gram`` symbols with the smallest hash, the leftmost of
several. Equal windows have their anchors at equal places, so all occurrences of a window meet
under one key, the anchor's hash, whatever lies around them. Neighbouring windows with one anchor
form a segment; two segments of equal content hold the same windows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from aprisco.llm.blocks import PIECE, owners, stretch_hashes, window_hashes, window_starts

PLACE_BITS = 20  # of a ranked hash; a piece and a window have fewer places


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by running minima of blocks from both sides."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    grid = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    m = n - width + 1
    return np.minimum(behind[:m], ahead[width - 1 : width - 1 + m])


@dataclass(frozen=True)
class Segments:
    """Per segment: its text, first and last window start, anchor place, anchor hash, and hash of
    the whole content (from the first window's start to the last one's end)."""

    owner: np.ndarray
    first: np.ndarray
    last: np.ndarray
    anchor: np.ndarray
    key: np.ndarray
    content: np.ndarray


def segments(symbols: np.ndarray, offsets: np.ndarray, window: int, gram: int) -> Segments:
    """Segments of the texts whose symbols lie end to end. ``offsets`` says where each begins.
    A long sequence is worked on in pieces, which cut segments in two."""
    n, mask = int(offsets[-1]), np.uint64((1 << PLACE_BITS) - 1)
    if window > PIECE:
        raise ValueError(f"a window has {PIECE} symbols at most")
    found = [np.empty((3, 0), np.int64)]
    keys = [np.empty(0, np.uint64)]
    for a in range(0, n, PIECE):
        starts = window_starts(offsets, window, a, min(a + PIECE, n))
        if not len(starts):
            continue
        grams = window_hashes(symbols[a : a + PIECE + window - 1], gram)
        ranked = (grams & ~mask) | np.arange(len(grams), dtype=np.uint64)
        anchor = (sliding_min(ranked, window - gram + 1)[starts - a] & mask).astype(np.int64) + a
        new = np.ones(len(starts), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)
        new[1:] |= np.isin(starts[1:], offsets) if window == 1 else False
        head = np.flatnonzero(new)
        tail = np.concatenate([head[1:], [len(starts)]]) - 1
        found.append(np.stack([starts[head], starts[tail], anchor[head]]))
        keys.append(grams[anchor[head] - a])
    first, last, at = np.concatenate(found, axis=1)
    owner = np.searchsorted(offsets, first, side="right") - 1
    return Segments(owner, first, last, at, np.concatenate(keys), stretch_hashes(symbols, first, last + window))

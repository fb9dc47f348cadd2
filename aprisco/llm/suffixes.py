"""Suffix-array dedup of bytes with deep-shallow sorting.

The suffixes that matter begin at the anchors of the segments that ``repeats`` sends to a shard,
once to the right and once, reversed, to the left. They are sorted by a multikey quicksort on
characters of eight bytes to a shallow depth, all groups of a depth at once; groups that still
agree there have long common prefixes and go through a blind trie each, which looks at one byte
per branch and at one whole string per insertion. Sorted neighbours and their common prefixes to
both sides tell which 400-byte windows around an anchor are equal.

Defined results: null and empty texts keep all of their nothing (0 bytes, 0 spans). Texts are
judged whole, as UTF-8 bytes; what is left may be invalid UTF-8, so ``kept`` is binary. Repeated
rows are repeats of each other. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from aprisco.llm.blocks import Texts, blocks, spans_sum
from aprisco.llm.repeats import covered_by, ranges_of, repeated_windows, with_ranges, with_uid

GRAM = 64
SHALLOW = 96  # bytes sorted by the multikey quicksort; the anchors' own bytes are GRAM of them


def common_prefix(a: bytes, b: bytes, low: int) -> int:
    """Length of the common prefix, known to be ``low`` at least."""
    high = min(len(a), len(b))
    if a[low:high] == b[low:high]:
        return high
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


class BlindTrie:
    """Compacted trie of strings with a common prefix. An inner node is [depth, children], the
    children by the byte at that depth (-1: the string ends there); a leaf lists equal strings."""

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.root: list = []

    def insert(self, new: int, known: int) -> None:
        text = self.strings[new]
        if not self.root:
            self.root = [-1, [new]]
            return
        path, node = [], self.root
        while node[0] >= 0:  # down to any leaf, looking at branching bytes only
            path.append(node)
            depth, children = node
            byte = text[depth] if depth < len(text) else -1
            node = children.get(byte) or next(iter(children.values()))
        other = self.strings[node[1][0]]
        shared = common_prefix(text, other, known)
        if shared == len(text) == len(other):
            node[1].append(new)
            return
        byte, was = (s[shared] if shared < len(s) else -1 for s in (text, other))
        above = None
        for at in path:  # the first node at or below the depth where they part
            if at[0] >= shared:
                node = at
                break
            above = at
        if node[0] == shared:
            node[1][byte] = [-1, [new]]
            return
        fresh = [shared, {was: node, byte: [-1, [new]]}]
        if above is None:
            self.root = fresh
        else:
            above[1][text[above[0]] if above[0] < len(text) else -1] = fresh

    def sorted(self) -> tuple[list[int], list[int]]:
        """The strings in order, and the common prefix of each with the one before it."""
        order: list[int] = []
        shared: list[int] = []
        stack = [(self.root, 0)]
        while stack:
            node, before = stack.pop()
            if node[0] < 0:
                n = len(self.strings[node[1][0]])
                order += node[1]
                shared += [before] + [n] * (len(node[1]) - 1)
            else:
                children = sorted(node[1].items(), reverse=True)
                stack += [(child, node[0]) for _, child in children[:-1]]
                stack.append((children[-1][1], before))
        return order, shared


def deep_shallow_sort(strings: list[bytes], groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings by group and bytes, and the common prefix of each with the one
    before it (0 at the start of a group)."""
    n = len(strings)
    lengths = np.fromiter(map(len, strings), np.int64, n)
    grid = np.frombuffer(b"".join(s[:SHALLOW].ljust(SHALLOW, b"\0") for s in strings), ">u8")
    words = grid.reshape(n, SHALLOW // 8).astype(np.uint64)
    order = np.argsort(groups, kind="stable")
    fresh = np.ones(n, bool)  # where a group of equal prefixes begins
    fresh[1:] = groups[order][1:] != groups[order][:-1]
    shared = np.zeros(n, np.int64)
    for level in range(SHALLOW // 8):
        number = np.cumsum(fresh)
        size = np.bincount(number)[number]
        open_ = np.flatnonzero(size > 1)
        if not len(open_):
            break
        # Padding equals a zero byte, so ends count as a second character of this depth
        own, ends = words[order[open_], level], np.clip(lengths[order[open_]] - 8 * level, 0, 8)
        at = np.lexsort((ends, own, number[open_]))
        order[open_] = order[open_][at]
        own, ends, group = own[at], ends[at], number[open_][at]
        part = (group[1:] == group[:-1]) & ((own[1:] != own[:-1]) | (ends[1:] != ends[:-1]))
        where = np.flatnonzero(part) + 1
        differ = own[where] ^ own[where - 1]
        same = np.where(differ == 0, 8, 7 - np.floor(np.log2(np.maximum(differ, 1).astype(float))).astype(np.int64) // 8)
        # log2 may round up at a byte border; the exact test settles it
        up = np.minimum(same + 1, 8)
        tops = np.where(up < 8, differ >> (np.uint64(8) * (8 - np.minimum(up, 7)).astype(np.uint64)), differ)
        same = np.where((same < 8) & (tops == 0), up, same)
        limit = np.minimum(ends[where], ends[where - 1])
        fresh[open_[where]] = True
        shared[open_[where]] = 8 * level + np.minimum(same, limit)
    number = np.cumsum(fresh)
    bounds = np.flatnonzero(fresh)
    ends = np.append(bounds[1:], n)
    for a, b in zip(bounds[ends - bounds > 1].tolist(), ends[ends - bounds > 1].tolist()):
        members = order[a:b].tolist()
        known = int(min(lengths[members].min(), SHALLOW))
        trie = BlindTrie([strings[i] for i in members])
        for i in range(b - a):
            trie.insert(i, known)
        local, common = trie.sorted()
        order[a:b] = [members[i] for i in local]
        shared[a + 1 : b] = common[1:]
    return order, shared


def judge_windows(keys: np.ndarray, parts: list[bytes], head: np.ndarray, windows: np.ndarray, window: int) -> list[np.ndarray]:
    """For each segment, which of its windows another segment of the same key has too."""
    n = len(parts)
    left = [p[:h][::-1] for p, h in zip(parts, head.tolist())]
    right = [p[h:] for p, h in zip(parts, head.tolist())]
    sides = [deep_shallow_sort(s, keys) for s in (left, right)]
    hits = [np.zeros(w, bool) for w in windows.tolist()]
    # A window that begins b bytes before the anchor needs b equal bytes to the left and
    # window - b to the right; b runs over head - windows + 1 .. head.
    most, least = head, head - windows + 1

    def numbers(side: int, need: int) -> np.ndarray:
        order, shared = sides[side]
        fresh = shared < need
        fresh[starts] = True
        out = np.empty(n, np.int64)
        out[order] = np.cumsum(fresh)
        return out

    by_key = np.sort(keys, kind="stable")
    starts = np.flatnonzero(np.concatenate([[True], by_key[1:] != by_key[:-1]]))
    for before in range(int(least.min()), int(most.max()) + 1):
        active = np.flatnonzero((least <= before) & (before <= most))
        if len(active) < 2:
            continue
        pair = numbers(0, before)[active] * (n + 1) + numbers(1, window - before)[active]
        order = np.argsort(pair, kind="stable")
        own = pair[order]
        twin = np.zeros(len(own), bool)
        twin[1:] = own[1:] == own[:-1]
        twin[:-1] |= own[1:] == own[:-1]
        for i in active[order[twin]].tolist():
            hits[i][head[i] - before] = True
    return hits


def byte_symbols(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    return texts.data, texts.offsets


def remove_repeats(docs: DataFrame, window: int = 400) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (binary) of every document."""
    own = with_uid(docs)

    def judge(table: pa.Table) -> list[list[tuple[int, int]]]:
        parts = table.column("symbols").to_pylist()
        hits = judge_windows(
            table.column("key").to_numpy(), parts, table.column("head").to_numpy(), table.column("windows").to_numpy(), window
        )
        return [ranges_of(hit) for hit in hits]

    found = repeated_windows(own, byte_symbols, judge, window, min(GRAM, window), earlier=False, dtype=np.uint8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text"):
                texts = Texts(block.column("text"))
                gone = covered_by(block.column("ranges"), texts.offsets, window, len(texts.data))
                begins = gone.copy()
                begins[1:] &= ~gone[:-1]
                inner = texts.offsets[:-1][np.diff(texts.offsets) > 0]
                begins[inner] = gone[inner]
                left = texts.data[~gone].tobytes()
                at = np.concatenate([[0], np.cumsum(np.diff(texts.offsets) - texts.sums(gone))]).tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        block.column("doc_id"), pa.array(np.diff(texts.offsets)), pa.array(texts.sums(gone)),
                        pa.array(spans_sum(begins, texts.offsets)),
                        pa.array([left[a:b] for a, b in zip(at[:-1], at[1:])], pa.binary()),
                    ],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
                )

    kind = own.schema["doc_id"].dataType.simpleString()
    return with_ranges(own, found).mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary"
    )

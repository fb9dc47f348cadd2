"""Fill-in-middle by a piece table.

The texts of a block are one immutable buffer, the sentinels another. A document starts as one
descriptor (buffer, start, length) over its text. Cutting splits it into prefix, middle and suffix,
an arrangement is a permutation of these and of the sentinels' descriptors, and bytes are copied
once, where the output is written; its hash streams the descriptors. To restore, the sentinels are
found in an output, which makes descriptors over that output, and the inverse permutation puts
them back in order.

Cuts and forms follow from the hash of the seed and the id alone, so a task that runs again, or
another partitioning, gives the same rows.

Defined results: a null text is empty, and an empty one is plain. A null id hashes like an empty
one. Texts that hold a sentinel are plain, so that every output can be restored. Texts of any
length are cut whole. Repeated rows get equal results. Other columns play no part, whatever they
are called.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from aprisco.llm.blocks import Texts, blocks, spans_sum

SENTINELS = b"<P><S><M>"
PREFIX, MIDDLE, SUFFIX, P, S, M, NOTHING = range(7)
FORMS = ("plain", "psm", "spm")
#: The descriptors of each form in the order of its output
ARRANGEMENTS = np.array(
    [
        [PREFIX, MIDDLE, SUFFIX, NOTHING, NOTHING, NOTHING],
        [P, PREFIX, S, SUFFIX, M, MIDDLE],
        [S, SUFFIX, P, PREFIX, M, MIDDLE],
    ]
)
TEXT, SENTINEL = 0, 1


@dataclass(frozen=True)
class PieceTable:
    """A row of descriptors per document, over two buffers that never change."""

    buffers: tuple[memoryview, memoryview]
    buffer: np.ndarray
    start: np.ndarray
    length: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray, offsets: np.ndarray) -> PieceTable:
        """One descriptor per text."""
        start = offsets[:-1, None]
        return cls(
            (memoryview(np.ascontiguousarray(data)), memoryview(SENTINELS)),
            np.full(start.shape, TEXT), start, np.diff(offsets)[:, None],
        )

    def cut(self, first: np.ndarray, second: np.ndarray) -> PieceTable:
        """The single descriptor of each text split at two places of the buffer."""
        begin, end = self.start[:, 0], self.start[:, 0] + self.length[:, 0]
        start = np.stack([begin, first, second], axis=1)
        return PieceTable(self.buffers, np.full(start.shape, TEXT), start, np.stack([first, second, end], axis=1) - start)

    def with_sentinels(self) -> PieceTable:
        """Descriptors numbered as in ARRANGEMENTS."""
        own = np.tile([0, 3, 6, 0], (len(self.start), 1))
        return PieceTable(
            self.buffers,
            np.concatenate([self.buffer, np.full(own.shape, SENTINEL)], axis=1),
            np.concatenate([self.start, own], axis=1),
            np.concatenate([self.length, np.tile([3, 3, 3, 0], (len(own), 1))], axis=1),
        )

    def permuted(self, order: np.ndarray) -> PieceTable:
        """Each text's descriptors in the order of its row."""
        return PieceTable(self.buffers, *(np.take_along_axis(x, order, 1) for x in (self.buffer, self.start, self.length)))

    def pieces(self) -> Iterator[list[memoryview]]:
        ends = (self.start + self.length).tolist()
        for buffer, start, end in zip(self.buffer.tolist(), self.start.tolist(), ends):
            yield [self.buffers[k][a:b] for k, a, b in zip(buffer, start, end) if b > a]

    def texts(self) -> pa.Array:
        """What the descriptors say, copied once."""
        offsets = np.concatenate([[0], np.cumsum(self.length.sum(1))])
        data = b"".join([part for parts in self.pieces() for part in parts])
        return pa.LargeStringArray.from_buffers(len(self.start), pa.py_buffer(offsets), pa.py_buffer(data)).cast(pa.string())

    def hashes(self) -> pa.Array:
        """SHA-256 of what the descriptors say, streamed from the buffers."""
        out = []
        for parts in self.pieces():
            state = sha256()
            for part in parts:
                state.update(part)
            out.append(state.hexdigest())
        return pa.array(out, pa.string())


def draws(ids: pa.Array, seed: int) -> np.ndarray:
    """Four numbers below 2**32 for each id."""
    names = (b"%d:%b" % (seed, b"" if i is None else str(i).encode()) for i in ids.to_pylist())
    found = b"".join([sha256(name).digest()[:16] for name in names])
    return np.frombuffer(found, ">u4").reshape(-1, 4).astype(np.int64)


def units(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units of each text (a word with what precedes it, or blanks at the end), and the ends of all
    words with the number of words before each text."""
    _, ends, words = texts.words()
    last = np.where(np.diff(words) > 0, ends[np.maximum(words[1:] - 1, 0)] if len(ends) else 0, texts.offsets[:-1])
    return np.diff(words) + (texts.offsets[1:] > last), ends, words


def fill_in_middle(docs: DataFrame, seed: int = 42, fim_percent: int = 50, spm_percent: int = 80) -> DataFrame:
    """doc_id, n (units), form, prefix_chars and middle_chars (null if plain), output and its
    SHA-256 of every document."""
    own = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text"):
                texts = Texts(block.column("text"))
                n, ends, words = units(texts)
                h = draws(block.column("doc_id"), seed)
                cuts = np.sort(h[:, :2] % (n + 1)[:, None], axis=1)
                marked = pc.fill_null(pc.match_substring_regex(block.column("text"), "<[PSM]>"), False)
                plain = (np.diff(texts.offsets) == 0) | marked.to_numpy(zero_copy_only=False) | (h[:, 2] % 100 >= fim_percent)
                form = np.where(plain, 0, np.where(h[:, 3] % 100 < spm_percent, 2, 1))

                def place(unit: np.ndarray) -> np.ndarray:
                    """The byte at which so many units of each text end."""
                    at = words[:-1] + np.minimum(unit, np.diff(words)) - 1
                    inner = ends[np.maximum(at, 0)] if len(ends) else texts.offsets[:-1]
                    inner = np.where(unit == 0, texts.offsets[:-1], inner)
                    return np.where(unit > np.diff(words), texts.offsets[1:], inner)

                first, second = place(cuts[:, 0]), place(cuts[:, 1])
                table = PieceTable.of(texts.data, texts.offsets).cut(first, second).with_sentinels()
                table = table.permuted(ARRANGEMENTS[form])
                bounds = np.stack([texts.offsets[:-1], first, second], axis=1).ravel()
                heads = (texts.data & 0xC0) != 0x80  # the first byte of each code point
                chars = spans_sum(heads, np.append(bounds, texts.offsets[-1])).reshape(-1, 3)
                yield pa.RecordBatch.from_arrays(
                    [
                        block.column("doc_id"), pa.array(n), pa.array(np.array(FORMS)[form], pa.string()),
                        pa.array(chars[:, 0], mask=plain), pa.array(chars[:, 1], mask=plain),
                        table.texts(), table.hashes(),
                    ],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "output_sha256"],
                )

    kind = own.schema["doc_id"].dataType.simpleString()
    return own.mapInArrow(
        run, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string, output_sha256 string"
    )


def restore(outputs: DataFrame) -> DataFrame:
    """The rows of ``outputs`` without ``output``, but with the text (``restored``) that it was made
    from, told by ``output`` and ``form`` alone, and the text's SHA-256."""
    named = [f for f in outputs.schema if f.name != "output"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "output"):
                texts = Texts(block.column("output"))
                form = np.array([FORMS.index(f) for f in block.column("form").to_pylist()])
                data, length = texts.data.tobytes(), np.diff(texts.offsets)
                start, size = np.zeros((len(form), 6), np.int64), np.zeros((len(form), 6), np.int64)
                start[:, 0], size[:, 0] = texts.offsets[:-1], length
                for i in np.flatnonzero(form).tolist():
                    a, b = int(texts.offsets[i]), int(texts.offsets[i + 1])
                    marks = [data.index(SENTINELS[3 * k : 3 * k + 3], a, b) for k in ARRANGEMENTS[form[i], ::2] - P]
                    start[i, ::2], start[i, 1::2] = marks, np.array(marks) + 3
                    size[i, ::2], size[i, 1::2] = 3, np.array([*marks[1:], b]) - start[i, 1::2]
                table = PieceTable((memoryview(data), memoryview(SENTINELS)), np.full(start.shape, TEXT), start, size)
                table = table.permuted(np.argsort(ARRANGEMENTS[form], axis=1, kind="stable")[:, :3])
                yield pa.RecordBatch.from_arrays(
                    [*(block.column(f.name) for f in named), table.texts(), table.hashes()],
                    names=[*(f.name for f in named), "restored", "restored_sha256"],
                )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in named)
    return outputs.mapInArrow(run, f"{kinds}, restored string, restored_sha256 string")


def digest(docs: DataFrame) -> DataFrame:
    return restore(fill_in_middle(docs)).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"
    )

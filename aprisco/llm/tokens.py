"""Token counts by a two-tier look-up on the map side.

A pre-token always becomes the same tokens, so a document's count is the sum over its pre-tokens.
The first tier is a compact table of the lengths of frequent pre-tokens, sent to every task; the
second is a cache in each Python worker, filled by encoding what misses. No pre-token is shuffled.
Both tiers only save work: a count is the tokenizer's own, whatever they hold.

Defined results: a null or empty text has no tokens. Texts are counted whole, whatever their
length; special strings in a text are single tokens, as the tokenizer's default has it. Repeated
rows get equal counts. Other columns play no part.
"""

from __future__ import annotations

import json
import os
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

from aprisco.llm.blocks import blocks

TABLE_ENTRIES = 30_000  # of at most TABLE_BYTES bytes each, which bounds the broadcast
TABLE_BYTES = 32
CACHE_ENTRIES = 200_000
SEEN = pa.schema([("token", pa.string()), ("n", pa.int64())])
CACHED_CHARS = 64  # longer pre-tokens are encoded each time


class Counter_:
    """Counts tokens of texts for a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str, frequent: dict[str, int]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; threads would only take memory
        import public_tokenizers
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            added = [t["content"] for t in json.load(file)["added_tokens"]]
        self.tokenizer = Tokenizer.from_file(path)
        self.split = regex.compile(public_tokenizers.PATTERN).findall
        self.special = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.plain = regex.compile(r" \p{L}+").fullmatch
        self.frequent, self.cache = frequent, {}

    def pretokens(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens of what lies between special strings, and the number of those."""
        if self.special is None or "<" not in text:
            return self.split(text), 0
        parts = self.special.split(text)
        return [t for part in parts for t in self.split(part)], len(parts) - 1

    def lengths(self, missing: list[str]) -> list[int]:
        """Tokens of each pre-token. Those of a space and letters end where the next one begins,
        so they are encoded as running text, and the library tells which word a token is of."""
        found: dict[str, int] = {}
        plain = [t for t in missing if self.plain(t)]
        for at in range(0, len(plain), 2048):
            part = plain[at : at + 2048]
            counts = np.bincount(np.array(self.tokenizer.encode("".join(part), add_special_tokens=False).word_ids))
            if len(counts) == len(part):
                found.update(zip(part, counts.tolist()))
        rest = [t for t in missing if t not in found]
        for at in range(0, len(rest), 1024):  # encodings are large, so few at a time
            part = rest[at : at + 1024]
            found.update(zip(part, (len(e.ids) for e in self.tokenizer.encode_batch(part, add_special_tokens=False))))
        return [found[t] for t in missing]

    def count(self, texts: list[str]) -> list[int]:
        """Unknown pre-tokens of all these texts are encoded in one call."""
        first, cache, totals, open_ = self.frequent.get, self.cache, [], []
        for i, text in enumerate(texts):
            tokens, total = self.pretokens(text)
            for token in tokens:
                n = first(token) or cache.get(token)
                if n:
                    total += n
                else:
                    open_.append((i, token))
            totals.append(total)
        missing = list(dict.fromkeys(token for _, token in open_))
        found = dict(zip(missing, self.lengths(missing)))
        for i, token in open_:
            totals[i] += found[token]
        if len(cache) + len(found) > CACHE_ENTRIES:
            cache.clear()
        cache.update((t, n) for t, n in found.items() if len(t) <= CACHED_CHARS)
        return totals


def frequent_lengths(docs: DataFrame, path: str, fit_rows: int = 20_000, per_task: int = 5_000) -> dict[str, int]:
    """Lengths of the most frequent pre-tokens in a sample of about ``fit_rows`` rows, drawn by
    the hash of their id: a speed-up only, so neither the sample nor the ``per_task`` most frequent
    ones that a task reports leave a trace in the counts."""
    share = min(1.0, fit_rows / max(docs.count(), 1))
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, seen = Counter_(path, {}), Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                seen.update(counter.pretokens(text)[0])
        top = [(t, n) for t, n in seen.most_common(per_task) if len(t.encode()) <= TABLE_BYTES]
        yield pa.RecordBatch.from_pydict({"token": [t for t, _ in top], "n": [n for _, n in top]}, SEEN)

    counts = docs.where("text is not null").where(drawn).select("text").mapInArrow(run, "token string, n long")
    most = counts.groupBy("token").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "token").limit(TABLE_ENTRIES)
    top = [r["token"] for r in most.collect()]
    return dict(zip(top, Counter_(path, {}).lengths(top)))


def count_tokens(docs: DataFrame, path: str, limit: int = 512, sub_bytes: int = 1 << 19) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every document."""
    own = docs.select("doc_id", "text")
    table = docs.sparkSession.sparkContext.broadcast(frequent_lengths(own, path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter_(path, table.value)
        for batch in batches:
            for part in blocks(batch, "text", sub_bytes):
                texts = pc.fill_null(part.column("text"), "")
                counts = np.array(counter.count(texts.to_pylist()), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pc.binary_length(texts).cast(pa.int64()), pa.array(counts), pa.array(counts > limit)],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    kind = own.schema["doc_id"].dataType.simpleString()
    return own.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")

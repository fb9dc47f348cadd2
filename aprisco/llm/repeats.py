"""What substring and suffix-array dedup share: find the windows that may repeat, judge them by
shards, and bring the verdicts back to the documents.

1. One pass cuts every text into segments of windows (``anchors``), told by the hash of their
   anchor and of their content.
2. Anchors that occur once are dropped. Segments of equal content are one from here on: copies are
   settled by counting, so a large group of them costs one row per copy and nothing else.
3. The distinct segments of an anchor with several, which is where copies begin, end or differ,
   get their content and go to shards by anchor; the operator's index judges their windows there.
4. An anchor with more than GROUP distinct segments is not held in one task. Its segments are cut
   in two: the windows in which the anchor stands early, and those in which it stands late. All
   windows of such a half share more symbols around the anchor, and these become its key; equal
   windows have equal ones. Halves of equal content are one again, and the index judges them. What
   is still crowded is halved further; a half with one window left is its own key, so this ends.
5. Windows found are joined to the documents, whose texts cross the network twice in all.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from aprisco.llm.anchors import segments
from aprisco.llm.blocks import Texts, blocks, covered, digests
from aprisco.llm.skew import join_by_counts
from aprisco.sources.shared import cut_lineage

GROUP = 4096  # distinct segments of one key that meet in one task at most
SHARD = 8192  # segments of a shard, about
SYMBOLS = Callable[[Texts], tuple[np.ndarray, np.ndarray]]  # symbols of all texts, and where each begins
JUDGE = Callable[[pa.Table], list[list[tuple[int, int]]]]  # ranges of repeated windows per segment
SCAN_SCHEMA = "uid long, doc_id {}, key long, content long, first int, last int, anchor int"
HELD_SCHEMA = "key long, content long, least {}, n long, head int, windows int, symbols binary"
FOUND_SCHEMA = "key long, content long, ranges array<struct<a:int,b:int>>"


def ranges_of(hit: np.ndarray) -> list[tuple[int, int]]:
    """First and last place of each run of hits."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    return list(zip(edge[::2].tolist(), (edge[1::2] - 1).tolist()))


def found_table(keys: pa.Array, contents: pa.Array, ranges: list[list[tuple[int, int]]]) -> pa.Table:
    kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
    rows = pa.array([[{"a": a, "b": b} for a, b in own] for own in ranges], kind)
    return pa.table({"key": keys, "content": contents, "ranges": rows}).filter(pa.array([bool(r) for r in ranges]))


def scan(docs: DataFrame, symbols: SYMBOLS, window: int, gram: int) -> DataFrame:
    """All segments of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text"):
                values, offsets = symbols(Texts(block.column("text")))
                found = segments(values, offsets, window, gram)
                owner, base = pa.array(found.owner), offsets[found.owner]
                ints = (pa.array((x - base).astype(np.int32)) for x in (found.first, found.last, found.anchor))
                yield pa.RecordBatch.from_arrays(
                    [
                        block.column("uid").take(owner), block.column("doc_id").take(owner),
                        pa.array(found.key.view(np.int64)), pa.array(found.content.view(np.int64)), *ints,
                    ],
                    names=["uid", "doc_id", "key", "content", "first", "last", "anchor"],
                )

    return docs.mapInArrow(run, SCAN_SCHEMA.format(docs.schema["doc_id"].dataType.simpleString()))


def contents(docs: DataFrame, wanted: DataFrame, symbols: SYMBOLS, window: int) -> DataFrame:
    """The wanted segments (key, content, least, n, uid, doc_id, first, last, anchor) with their
    symbols as bytes; ``head`` is the anchor's place in them."""
    own = wanted.groupBy("uid", "doc_id").agg(
        F.collect_list(F.struct("key", "content", "least", "n", "first", "last", "anchor")).alias("parts")
    )
    own = cut_lineage(own.withColumnsRenamed({"uid": "u", "doc_id": "d"}))
    joined = docs.join(own, (docs["uid"] == own["u"]) & docs["doc_id"].eqNullSafe(own["d"]))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text"):
                values, offsets = symbols(Texts(block.column("text")))
                size = values.dtype.itemsize
                parts = block.column("parts")
                flat = parts.flatten()
                base = offsets[np.repeat(np.arange(block.num_rows), parts.value_lengths().to_numpy())]
                first, last, anchor = (flat.field(c).to_numpy() for c in ("first", "last", "anchor"))
                data = values.view(np.uint8).tobytes()
                cut = [
                    data[a * size : b * size]
                    for a, b in zip((base + first).tolist(), (base + last + window).tolist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(flat.field(c) for c in ("key", "content", "least", "n")),
                        pa.array(anchor - first), pa.array(last - first + 1), pa.array(cut, pa.binary()),
                    ],
                    names=["key", "content", "least", "n", "head", "windows", "symbols"],
                )

    found = joined.select("text", "parts").mapInArrow(run, HELD_SCHEMA.format(kind))
    return found.dropDuplicates(["key", "content"])  # repeated rows hold the same segments


def halves(held: DataFrame, low: int, high: int, size: int, window: int) -> DataFrame:
    """The segments cut in two, after ``of_key`` and ``of_content`` of what they are cut from and
    the place ``at`` of the half in it. The anchor's place in a window, counted in symbols of
    ``size`` bytes, is between ``low`` and ``high``, and to one side of their middle in a half."""
    middle = (low + high) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [memoryview(s.as_buffer()) for s in batch.column("symbols")]
            head, windows = (batch.column(c).to_numpy().astype(np.int64) for c in ("head", "windows"))
            for least, most in ((low, middle), (middle + 1, high)):
                first = np.maximum(head - most, 0)
                last = np.minimum(head - least, windows - 1)
                rows = np.flatnonzero(last >= first)
                a, b = (first[rows] * size).tolist(), ((last[rows] + window) * size).tolist()
                cut = [bytes(data[i][x:y]) for i, x, y in zip(rows.tolist(), a, b)]
                # All windows of the half share what lies between these places
                a = ((head - least)[rows] * size).tolist()
                b = ((head - most + window)[rows] * size).tolist()
                names = (b"%d %d " % (least, most) + data[i][x:y] for i, x, y in zip(rows.tolist(), a, b))
                take = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).take(take) for c in ("key", "content")), pa.array(first[rows].astype(np.int32)),
                        pa.array(digests(names).view(np.int64)),
                        pa.array(digests(cut).view(np.int64)),
                        *(batch.column(c).take(take) for c in ("least", "n")),
                        pa.array((head - first)[rows].astype(np.int32)),
                        pa.array((last - first + 1)[rows].astype(np.int32)), pa.array(cut, pa.binary()),
                        pa.array(np.full(len(rows), least >= middle + 1)),
                    ],
                    names=["of_key", "of_content", "at", "key", "content", "least", "n", "head", "windows", "symbols", "late"],
                )

    kind = held.schema["least"].dataType.simpleString()
    return held.mapInArrow(run, f"of_key long, of_content long, at int, {HELD_SCHEMA.format(kind)}, late boolean")


def shifted(ranges: str, by: str) -> Column:
    return F.transform(ranges, lambda r: F.struct((r["a"] + F.col(by)).alias("a"), (r["b"] + F.col(by)).alias("b")))


def whole(first: Column, last: Column) -> Column:
    return F.array(F.struct(first.alias("a"), last.alias("b")))


def judged(held: DataFrame, judge: JUDGE, low: int, high: int, size: int, window: int, earlier: bool) -> DataFrame:
    """key, content and the ranges of repeated windows of the distinct segments ``held``."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        return found_table(table.column("key"), table.column("content"), judge(table))

    crowds = cut_lineage(held.groupBy("key").agg(F.count("*").alias("m")).where(F.col("m") > GROUP))
    shards = max(1, -(-held.count() // SHARD))
    tame = held.join(crowds, "key", "left_anti").withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
    found = tame.groupBy("shard").applyInArrow(run, FOUND_SCHEMA)
    if crowds.isEmpty():
        return cut_lineage(found)
    found = cut_lineage(found)
    # One row per crowded key, each of more than GROUP segments
    crowded = join_by_counts(held, crowds, ["key"], "m").drop("m")
    parts = cut_lineage(halves(crowded, low, high, size, window))
    own = F.struct("head", "windows", "symbols").alias("own")
    distinct = parts.groupBy("late", "key", "content").agg(
        F.sum("n").alias("n"), F.min("least").alias("least"), F.first(own, ignorenulls=True).alias("own")
    )
    distinct = cut_lineage(distinct.select("late", "key", "content", "least", "n", "own.*"))
    middle, below = (low + high) // 2, []
    for late, least, most in ((False, low, middle), (True, middle + 1, high)):
        if least < most:
            half = distinct.where(F.col("late") == late).drop("late")
            below.append(judged(half, judge, least, most, size, window, earlier))
        # Windows with the anchor at one place are repeats if their counts say so
    verdicts = distinct.select("key", "content", F.col("least").alias("__least"), F.col("n").alias("__n"))
    nothing = found.where("false")
    for more in below:
        nothing = nothing.unionByName(more)
    verdicts = verdicts.join(nothing, ["key", "content"], "left")
    met = join_by_counts(parts.drop("symbols", "late"), verdicts, ["key", "content"], "__n")
    settled = F.col("least") > F.col("__least") if earlier else F.col("__n") > 1
    ranges = F.when(settled, whole(F.col("at"), F.col("at") + F.col("windows") - 1)).otherwise(shifted("ranges", "at"))
    met = met.withColumn("ranges", ranges).where("ranges is not null")
    met = met.groupBy(F.col("of_key").alias("key"), F.col("of_content").alias("content")).agg(
        F.flatten(F.collect_list("ranges")).alias("ranges")
    )
    return cut_lineage(found.unionByName(met))


def repeated_windows(
    docs: DataFrame, symbols: SYMBOLS, judge: JUDGE, window: int, gram: int, earlier: bool, dtype: type
) -> DataFrame:
    """``uid``, ``doc_id`` and ``ranges`` of window starts that are repeats, of documents that
    have any. With ``earlier`` a repeat needs a smaller doc_id, else any other place."""
    cuts = cut_lineage(scan(docs, symbols, window, gram))
    keys = cuts.groupBy("key").agg(F.count("*").alias("m"), F.min("content").alias("c0"), F.max("content").alias("c1"))
    keys = keys.where("m > 1").select("key", "m", (F.col("c0") != F.col("c1")).alias("several"))
    cuts = cut_lineage(join_by_counts(cuts, keys, ["key"], "m").drop("m"))
    distinct = cut_lineage(
        cuts.groupBy("key", "content").agg(
            F.count("*").alias("n"),
            F.first("several").alias("several"),
            F.min(F.struct("doc_id", "uid", "first", "last", "anchor")).alias("holder"),
        )
    ).withColumn("least", F.col("holder.doc_id"))
    apart = distinct.where("several").select("key", "content", "least", "n", "holder.*")
    held = cut_lineage(contents(docs, apart, symbols, window))
    found = judged(held, judge, 0, window - gram, np.dtype(dtype).itemsize, window, earlier)
    settled = F.col("doc_id") > F.col("least") if earlier else F.col("n") > 1
    verdicts = distinct.where("several or n > 1").join(found, ["key", "content"], "left")
    verdicts = verdicts.select("key", "content", "n", "least", "ranges").where("n > 1 or ranges is not null")
    ranges = F.when(settled, whole(F.col("first"), F.col("last"))).otherwise(shifted("ranges", "first"))
    return cut_lineage(
        join_by_counts(cuts.select("uid", "doc_id", "key", "content", "first", "last"), verdicts, ["key", "content"], "n")
        .withColumn("ranges", ranges)
        .where("ranges is not null")
        .groupBy("uid", "doc_id")
        .agg(F.flatten(F.collect_set("ranges")).alias("ranges"))  # repeated rows have the same
    )


def with_uid(docs: DataFrame) -> DataFrame:
    """doc_id, text, and a number that tells rows with one id and different texts apart."""
    return docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("uid"))


def with_ranges(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The documents with their ranges; null where nothing repeats."""
    found = found.withColumnsRenamed({"uid": "u", "doc_id": "d"})
    return docs.join(found, (docs["uid"] == found["u"]) & docs["doc_id"].eqNullSafe(found["d"]), "left").select(
        "doc_id", "text", "ranges"
    )


def covered_by(ranges: pa.ListArray, offsets: np.ndarray, window: int, n: int) -> np.ndarray:
    """Which symbols of a block lie in a window of the ranges of their text."""
    flat = ranges.flatten()
    lengths = np.nan_to_num(ranges.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    base = np.repeat(offsets[:-1], lengths)
    return covered(n, base + flat.field("a").to_numpy(), base + flat.field("b").to_numpy() + window)

"""Near-duplicates: SuperMinHash, banding, verification on full sets, union-find grouping.

1. Every document gets its set of word shingles; equal sets are one node from here on.
2. SuperMinHash signatures are cut into bands. All nodes that share a band with a bucket's
   smallest node form a candidate cluster with it, so two nodes that share any band are in one.
3. Inside a cluster all sets meet in blocks of bounded size, where intersections are counted
   exactly, and a task returns for each set one link to the smallest set of its group found there. Clusters of one block
   are done then. Larger ones are contracted first (blocks, then one set of each group found), and
   what is still apart meets in pairs of blocks; two blocks of one group found never meet, so a
   large group of close copies costs in proportion to its size.
4. The links' connected components are the groups.

Two sets of similarity s share none of 32 bands of 5 with probability (1 - s**5)**32: 3e-6 at
s = 0.8, and less above. Nothing is capped: buckets and clusters may have any size.

Defined results: null, empty and word-less texts have the empty set and are linked with nothing.
A text of fewer words than a shingle has one shingle, all its words. Texts of any length are
compared whole. Repeated rows are one group; an id with several texts is judged row by row. A
group's component_id is its smallest id that is not null. Other columns play no part, whatever
they are called.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from aprisco.llm.blocks import Texts, blocks
from aprisco.llm.components import connected_components
from aprisco.llm.minhash import band_keys, set_digest, shingle_sets, superminhash
from aprisco.sources.shared import cut_lineage

BANDS, ROWS = 32, 5
BLOCK_SHINGLES = 200_000  # of a block of sets that meet in one task
LEAST_SHINGLES = 200  # what a set counts at least, so a block has at most a thousand sets
PAIRED = 8  # shingles of up to so many sets of a block are counted pair by pair


def set_ids(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """128-bit names of sets; null for the empty set."""
    pair = np.stack(set_digest(values, offsets), axis=1)
    names = pa.Array.from_buffers(pa.binary(16), len(pair), [None, pa.py_buffer(np.ascontiguousarray(pair))])
    return pa.array(names.to_pylist(), pa.binary(), mask=np.diff(offsets) == 0)


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """n_shingles, set_id and the band keys of every document, after its columns beside the text."""
    named = [f for f in docs.schema if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text"):
                values, offsets = shingle_sets(Texts(block.column("text")), width)
                keys = band_keys(superminhash(values, offsets, BANDS * ROWS), ROWS).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(block.column(f.name) for f in named),
                        pa.array(np.diff(offsets)),
                        set_ids(values, offsets),
                        pa.FixedSizeListArray.from_arrays(pa.array(keys.ravel()), BANDS).cast(pa.list_(pa.int64())),
                    ],
                    names=[*(f.name for f in named), "n_shingles", "set_id", "bands"],
                )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in named)
    return docs.mapInArrow(run, f"{kinds}, n_shingles long, set_id binary, bands array<long>")


def full_sets(docs: DataFrame, width: int) -> DataFrame:
    """set_id, its size and its sorted shingle hashes as bytes, of documents that have any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text"):
                values, offsets = shingle_sets(Texts(block.column("text")), width)
                data = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets * 8), pa.py_buffer(values)]
                )
                out = pa.RecordBatch.from_arrays(
                    [set_ids(values, offsets), pa.array(np.diff(offsets)), data.cast(pa.binary())],
                    names=["set_id", "n", "shingles"],
                )
                yield out.filter(pa.array(np.diff(offsets) > 0))

    return docs.select("text").mapInArrow(run, "set_id binary, n long, shingles binary")


def intersections(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many elements every two of the sets share."""
    d = len(offsets) - 1
    owner = np.repeat(np.arange(d), np.diff(offsets))
    order = np.argsort(values, kind="stable")
    owner, ordered = owner[order], values[order]
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    counts = np.diff(np.concatenate([starts, [len(ordered)]]))
    shared = np.zeros((d, d), np.float32)
    for size in range(2, PAIRED + 1):
        at = starts[counts == size]
        for i in range(size if len(at) else 0):
            for j in range(i + 1, size):
                shared += np.bincount(owner[at + i] * d + owner[at + j], minlength=d * d).reshape(d, d)
    shared += shared.T
    many = np.flatnonzero(counts > PAIRED)
    for part in range(0, len(many), 4096):
        columns = many[part : part + 4096]
        n = counts[columns]
        grid = np.zeros((d, len(columns)), np.float32)
        first = np.repeat(starts[columns] - np.cumsum(n) + n, n) + np.arange(n.sum())
        grid[owner[first], np.repeat(np.arange(len(columns)), n)] = 1
        shared += grid @ grid.T
    return shared


def groups_of(near: np.ndarray) -> list[int]:
    """For each set the first one that is linked to it over any number of links."""
    first = [-1] * len(near)
    left = np.ones(len(near), bool)
    for root in range(len(near)):
        if left[root]:
            left[root], front = False, [root]
            while front:
                at = front.pop()
                first[at] = root
                new = np.flatnonzero(near[at] & left)
                left[new] = False
                front += new.tolist()
    return first


def links_within(rows: DataFrame, group: list[str], percent: int) -> DataFrame:
    """Among the sets of each group of rows: ``a`` with the smallest ``b`` it is connected to by
    true links, where that is another one."""

    def run(table: pa.Table) -> pa.Table:
        order = pc.sort_indices(table.column("set_id"))
        table = table.take(order).combine_chunks()
        ids, sizes = table.column("set_id").to_pylist(), table.column("n").to_numpy()
        edges: list[tuple[int, int]] = []
        if len(ids) > 1:
            values = np.concatenate([np.frombuffer(s.as_buffer(), np.uint64) for s in table.column("shingles")])
            offsets = np.concatenate([[0], np.cumsum(sizes)])
            both = np.rint(intersections(values, offsets)).astype(np.int64)
            near = 100 * both >= percent * (sizes[:, None] + sizes[None, :] - both)
            edges = [(i, root) for i, root in enumerate(groups_of(near)) if i != root]
        return pa.table(
            {"a": pa.array([ids[i] for i, _ in edges], pa.binary()), "b": pa.array([ids[j] for _, j in edges], pa.binary())}
        )

    return rows.select(*group, "set_id", "n", "shingles").groupBy(*group).applyInArrow(run, "a binary, b binary")


def weight(n: str = "n") -> Column:
    return F.greatest(F.col(n), F.lit(LEAST_SHINGLES))


def salt(parts: str, *columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.col(parts)).cast("int")


def parts_for(total: str) -> Column:
    return F.ceil(F.col(total) / F.lit(BLOCK_SHINGLES)).cast("int")


def candidate_clusters(nodes: DataFrame) -> DataFrame:
    """set_id and cluster of the nodes that share a band with another."""
    banded = nodes.select("set_id", F.posexplode("bands").alias("band", "key"))
    buckets = banded.groupBy("band", "key").agg(F.min("set_id").alias("b"), F.max("set_id").alias("most"))
    stars = banded.join(buckets.where("b <> most").drop("most"), ["band", "key"])
    edges = stars.where("set_id <> b").select(F.col("set_id").alias("a"), "b").distinct()
    found = connected_components(edges)
    return found.select(F.col("node").alias("set_id"), F.col("component").alias("cluster"))


def near_links(docs: DataFrame, nodes: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) between sets; within a cluster, enough of them to connect what is linked."""
    clusters = cut_lineage(candidate_clusters(nodes))
    weighed = clusters.join(nodes.select("set_id", F.col("n_shingles").alias("n")), "set_id")
    sizes = weighed.groupBy("cluster").agg(F.sum(weight()).alias("total")).withColumn("parts", parts_for("total"))
    # A document of each node: the one with the smallest id
    wanted = clusters.join(nodes.select("set_id", "doc_id"), "set_id")
    wanted = wanted.select(F.col("doc_id").alias("d")).distinct()
    chosen = docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["d"]), "left_semi")
    sets = cut_lineage(
        full_sets(chosen, width).dropDuplicates(["set_id"]).join(clusters, "set_id").join(sizes, "cluster")
    )
    links = cut_lineage(links_within(sets.withColumn("block", salt("parts", "set_id")), ["cluster", "block"], percent))
    large = sets.where("parts > 1")
    if large.select("cluster").isEmpty():
        return links

    # A set is in one block, so what its links lead to needs no search: a leader or itself.
    leads = links.withColumnsRenamed({"a": "set_id", "b": "leader"})
    met = large.join(leads, "set_id", "left_anti")
    met_sizes = met.groupBy("cluster").agg(F.sum(weight()).alias("__total")).withColumn("fewer", parts_for("__total"))
    met = met.join(met_sizes, "cluster").withColumn("block", salt("fewer", "set_id"))
    further = cut_lineage(links_within(met, ["cluster", "block"], percent))
    links = links.unionByName(further)
    state = large.select("cluster", "set_id", "n", "parts").join(leads, "set_id", "left")
    state = state.withColumn("leader", F.coalesce("leader", "set_id"))
    state = state.join(further.withColumnsRenamed({"a": "leader", "b": "component"}), "leader", "left")
    state = cut_lineage(state.withColumn("component", F.coalesce("component", "leader")).drop("leader"))

    # A group found that fills a block has blocks of its own; the others share blocks.
    filled = state.groupBy("cluster", "component").agg(F.sum(weight()).alias("__total"))
    filled = filled.withColumn("own", F.when(F.col("__total") >= BLOCK_SHINGLES, parts_for("__total"))).drop("__total")
    placed = state.join(filled, ["cluster", "component"]).select(
        "cluster", "set_id",
        F.when(F.col("own").isNotNull(), F.col("component")).alias("of"),
        F.when(F.col("own").isNotNull(), salt("own", "set_id")).otherwise(salt("parts", "component")).alias("block"),
    )
    placed = cut_lineage(placed.withColumn("label", F.xxhash64("of", "block")))
    labels = placed.select("cluster", "of", "label").distinct()
    left, right = (labels.select("cluster", F.col("of").alias(f"of{i}"), F.col("label").alias(f"l{i}")) for i in (1, 2))
    pairs = left.join(right, "cluster").where("l1 <= l2 and not (of1 is not null and of1 <=> of2)")
    sides = pairs.select("cluster", "l1", "l2", F.explode(F.array_distinct(F.array("l1", "l2"))).alias("label"))
    meeting = placed.join(sides, ["cluster", "label"]).join(large.select("set_id", "n", "shingles"), "set_id")
    return links.unionByName(links_within(meeting, ["cluster", "l1", "l2"], percent))


def grouped_sets(own: DataFrame, found: DataFrame, width: int, percent: int) -> DataFrame:
    """set_id, the least id and the component of every set that ``signatures`` found."""
    nodes = cut_lineage(
        found.where("set_id is not null")
        .groupBy("set_id")
        .agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"))
    )
    groups = connected_components(near_links(own, nodes, width, percent)).withColumnRenamed("node", "set_id")
    named = nodes.select("set_id", F.col("doc_id").alias("least")).join(groups, "set_id", "left")
    return named.withColumn("component", F.coalesce("component", "set_id"))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document."""
    own = docs.select("doc_id", "text")
    found = cut_lineage(signatures(own, width))
    named = grouped_sets(own, found, width, percent)
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    by_set = named.join(least, "component").select("set_id", "component_id")
    return (
        found.select("doc_id", "n_shingles", "set_id")
        .join(by_set, "set_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def keep_one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The documents that stay, with all their columns: of each group one row with its smallest id,
    or one without an id where none has any, and every row without words."""
    uid = F.xxhash64("doc_id", "text")  # tells rows with one id and different texts apart
    own = docs.select("doc_id", "text", uid.alias("uid"))
    found = cut_lineage(signatures(own, width))
    groups = grouped_sets(own, found, width, percent).select("set_id", "component")
    row = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "uid")
    kept = found.select("set_id", row.alias("row")).join(groups, "set_id").groupBy("component").agg(F.min("row").alias("row"))
    kept = kept.select(F.col("row.doc_id").alias("__kept"), F.col("row.uid").alias("__uid"))
    worded = F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    same = docs["doc_id"].eqNullSafe(kept["__kept"]) & (uid == kept["__uid"])
    stay = docs.where(worded).join(kept, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return stay.unionByName(docs.where(~worded))

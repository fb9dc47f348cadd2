"""Sharding by a hypergeometric communication matrix.

Rows are dealt by the blocks (tasks) they happen to lie in. How many rows each block sends to each
shard is drawn from the multivariate hypergeometric law, so that every shard gets exactly its size;
a block permutes its rows locally and sends consecutive runs of them; a shard permutes what it gets
again. The matrix is drawn in two levels, for groups of blocks and in tasks for the blocks of each,
which is the same law. The result is a uniform permutation cut into shards of exact sizes.

Defined results: an empty table gives no rows. Null or empty texts and repeated rows are rows like
any other, so no key can be hot. Rows are numbered and written once, so a task that is run again
deals the same rows in the same way. Columns that the table has already under the names of the
added ones are replaced; all others are carried along, whatever they are called.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from aprisco.sources.shared import cut_lineage

GROUP_BLOCKS = 1024  # blocks whose rows of the matrix one task draws

def draw_hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """How many good ones are among those drawn. Exact ratios of neighbouring probabilities,
    from the mode outwards over 40 standard deviations, so the sizes may be of any magnitude."""
    low, high = max(0, drawn - bad), min(good, drawn)
    if low == high:
        return low
    total = good + bad
    mode = min(max((drawn + 1) * (good + 1) // (total + 2), low), high)
    spread = np.sqrt(max(drawn * (good / total) * (bad / total) * (total - drawn) / max(total - 1, 1), 1.0))
    reach = int(40 * spread) + 10
    a, b = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(a, b, dtype=float)
    with np.errstate(divide="ignore"):
        steps = np.log(good - k) + np.log(drawn - k) - np.log(k + 1) - np.log(bad - drawn + k + 1)
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    weights = np.cumsum(np.exp(logs - logs.max()))
    return a + int(np.searchsorted(weights, rng.random() * weights[-1], side="right"))


def split_counts(rng: np.random.Generator, rows: int, left: list[int]) -> list[int]:
    """How many of so many rows, drawn without replacement, each shard's room gives."""
    sent, rest = [], sum(left)
    for room in left:
        rest -= room
        n = draw_hypergeometric(rng, room, rest, rows)
        sent.append(n)
        rows -= n
    return sent


def communication_matrix(block_rows: list[int], shard_rows: list[int], seed: int, of: int = 0) -> list[list[int]]:
    """Rows that each block sends to each shard; block and shard sums are exact. Blocks draw from
    what those before them have left, the first one's number being ``of``."""
    left, matrix = list(shard_rows), []
    for i, rows in enumerate(block_rows):
        sent = split_counts(np.random.default_rng([seed, of + i]), rows, left)
        left = [a - b for a, b in zip(left, sent)]
        matrix.append(sent)
    return matrix


def upto_by_block(spark: SparkSession, counts: DataFrame, block: str, upto: str, sizes: list[int], seed: int) -> DataFrame:
    """For each block the rows that it sends to the shards up to each, drawn by a tree: the driver
    draws what every group of GROUP_BLOCKS blocks sends, tasks what the blocks of a group do."""
    group = F.floor(F.col(block) / GROUP_BLOCKS).cast("long")
    grouped = counts.groupBy(group.alias("group")).agg(F.sum("count").alias("count")).orderBy("group").collect()
    drawn = communication_matrix([r["count"] for r in grouped], sizes, seed)
    totals = spark.createDataFrame([(r["group"], d) for r, d in zip(grouped, drawn)], "group long, sent array<long>")

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by(block)
        blocks, rows = table.column(block), table.column("count").to_pylist()
        matrix = communication_matrix(rows, table.column("sent")[0].as_py(), seed + 1, blocks[0].as_py())
        summed = pa.array([np.cumsum(sent).tolist() for sent in matrix], pa.list_(pa.int64()))
        return pa.table({block: blocks, upto: summed})

    numbered = counts.withColumn("group", group).join(totals, "group")
    return cut_lineage(numbered.groupBy("group").applyInArrow(run, f"`{block}` int, `{upto}` array<long>"))


def shard_uniformly(
    docs: DataFrame, n_shards: int = 8, seed: int = 11, rows_per_bucket: int = 50_000,
    broadcast_cells: int = 4_000_000,
) -> DataFrame:
    """All columns of the rows, their ``shard`` and their ``slot`` in it (gapless from 0).

    Shard sizes differ by one at most. ``rows_per_bucket`` bounds what one task permutes: a shard
    is cut by the random key into as many buckets as its size asks for. The matrix is broadcast up
    to ``broadcast_cells`` numbers of 8 bytes, and joined by a shuffle beyond.
    """
    if n_shards < 1:
        raise ValueError("at least one shard is needed")
    docs = docs.drop("shard", "slot")
    free = "_"  # of the names of working columns
    while any(c.startswith(free) for c in docs.columns):
        free += "_"
    block_, rank_, key_, bucket_, upto_, first_ = (f"{free}{c}" for c in ("block", "rank", "key", "bucket", "upto", "first"))
    spark = docs.sparkSession
    ordinal = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    permuted = (
        docs.withColumn(block_, F.spark_partition_id())
        .withColumn(key_, F.rand(seed))
        .sortWithinPartitions(key_)
        .withColumn(rank_, ordinal)
        .drop(key_)
    )
    rows = cut_lineage(permuted)

    counts = cut_lineage(rows.groupBy(block_).count())
    total, blocks = counts.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count("*")).first()
    sizes = [total // n_shards + (k < total % n_shards) for k in range(n_shards)]
    table = upto_by_block(spark, counts, block_, upto_, sizes, seed)
    if blocks * n_shards <= broadcast_cells:  # spares a shuffle of the texts
        table = F.broadcast(table)
    buckets = max(1, -(-max(sizes) // rows_per_bucket))

    def place(df: DataFrame) -> DataFrame:
        key: Column = F.xxhash64(F.lit(seed), block_, rank_)
        return (
            df.join(table, block_)
            .withColumn("shard", F.size(F.filter(upto_, lambda n: n <= F.col(rank_))))
            .withColumn(key_, key)
            .withColumn(bucket_, F.pmod(F.shiftrightunsigned(key_, 20), F.lit(buckets)).cast("int"))
            .drop(upto_)
        )

    filled = place(rows.select(block_, rank_)).groupBy("shard", bucket_).count().collect()
    before, offsets = {}, []  # at most shards x buckets rows, one for rows_per_bucket rows
    for r in sorted(filled, key=lambda r: (r["shard"], r[bucket_])):
        at = before.get(r["shard"], 0)
        offsets.append((r["shard"], r[bucket_], at))
        before[r["shard"]] = at + r["count"]
    first = spark.createDataFrame(offsets, f"shard int, {bucket_} int, {first_} long")
    within = Window.partitionBy("shard", bucket_).orderBy(key_, block_, rank_)
    return (
        place(rows)
        .withColumn("slot", F.row_number().over(within).cast("long") - 1)
        .join(first, ["shard", bucket_])
        .withColumn("slot", F.col("slot") + F.col(first_))
        .select(*(f"`{c}`" for c in docs.columns), "shard", "slot")
    )


def digest(docs: DataFrame, n_shards: int = 8) -> DataFrame:
    """A table of whole documents put into shards; of each row what names and measures it."""
    data = F.encode("text", "utf-8")
    return shard_uniformly(docs, n_shards).select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce(data, F.lit(b""))).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )

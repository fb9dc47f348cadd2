"""Benchmark decontamination with DataFrame functions only.

The benchmark's word n-grams, normalised, become a table of hashes and words that is broadcast
when its measured size is below ``broadcast_bytes``. Every document's words are hashed once, window
hashes are put together by doubling, and each window looks itself up by its hash; a hit counts only
if the words are the n-gram's own. They lie beside the windows, in the generated code of one stage,
so texts are read once and never shuffled. A larger table is joined by a shuffle of the hashes, and
the words are compared for documents with hits. Items are looked up by n-gram afterwards. The words
inside occurring n-grams are counted once each.

Defined results: null, empty and word-less texts have no words, no hits, and are clean. A benchmark
row without words has no n-gram; one with fewer words than ``n`` is one n-gram; one without an id
hits but is no item. Benchmark rows with one id are one item. Repeated rows get equal results.
Other columns are carried along by ``drop_contaminated``, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from aprisco.sources.shared import cut_lineage

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words with A-Z lower-cased and nothing else."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), SEPARATORS), "")


def hashed(*columns: Column) -> Column:
    return F.xxhash64(*columns)


def joined_hashes(left: Column, right: Column, by: int, length: int) -> Column:
    """Hashes of windows of ``length`` words: each left window, of ``by`` words, with the right
    one that begins where it ends. ``__n`` is the number of words."""
    n = F.greatest(F.col("__n") - (length - 1), F.lit(0))
    return F.zip_with(F.slice(left, 1, n), F.slice(right, by + 1, n), lambda a, b: hashed(a, b))


def with_hashes(df: DataFrame, lengths: list[int], *keep: str) -> DataFrame:
    """``hashes``: for each window length the hashes of all windows, from an array ``words``."""
    df = df.select(*keep, F.size("words").alias("__n"), F.transform("words", lambda w: hashed(w)).alias("__h1"))
    powers = [1 << i for i in range(max(lengths, default=1).bit_length())]
    for half in powers[:-1]:
        both = joined_hashes(F.col(f"__h{half}"), F.col(f"__h{half}"), half, 2 * half)
        df = df.withColumn(f"__h{2 * half}", both)
    arrays = []
    for length in lengths:
        parts = [p for p in reversed(powers) if length & p]
        column, done = F.col(f"__h{parts[0]}"), parts[0]
        for part in parts[1:]:
            column = joined_hashes(column, F.col(f"__h{part}"), done, done + part)
            done += part
        arrays.append(F.struct(F.lit(length).alias("length"), column.alias("windows")))
    return df.select(*keep, F.array(*arrays).alias("hashes"))


def windows(df: DataFrame, lengths: list[int], *keep: str) -> DataFrame:
    """A row per window: its length, place and hash (null for a text without windows; the outer
    form spares a filter into which Spark would copy the whole expression)."""
    each = with_hashes(df, lengths, *keep).select(*keep, F.explode_outer("hashes").alias("w"))
    each = each.select(*keep, F.col("w.length").alias("length"), F.col("w.windows").alias("windows"))
    return each.select(*keep, "length", F.posexplode_outer("windows").alias("place", "h"))


def window_words() -> Column:
    return F.slice("words", F.col("place") + 1, F.col("length"))


def same_words() -> Column:
    """Equality, put so that it stays a condition behind the hash: as a key of the join, the words
    of every window would be cut out and hashed."""
    return (window_words() <= F.col("gram_words")) & (window_words() >= F.col("gram_words"))


def benchmark_grams(benchmark: DataFrame, n: int) -> tuple[DataFrame, DataFrame, list[int]]:
    """Distinct n-grams (length, h, gram_words, gram), the items of each (gram, item_id) and the
    lengths there are (at most n)."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("words"))
    items = cut_lineage(items.where("size(words) > 0").withColumn("own", F.least(F.size("words"), F.lit(n))))
    lengths = sorted(r["own"] for r in items.select("own").distinct().collect())
    if not lengths:
        return items, items, lengths
    rows = windows(items, lengths, "item_id", "own", "words").where("own = length and h is not null")
    rows = cut_lineage(rows.select("item_id", "length", "h", window_words().alias("gram_words")).distinct())
    key = ["length", "h", "gram_words"]
    grams = cut_lineage(rows.select(*key).distinct().withColumn("gram", F.monotonically_increasing_id()))
    return grams, cut_lineage(rows.join(grams, key).where("item_id is not null").select("gram", "item_id")), lengths


def broadcast_below(df: DataFrame, size: Column, limit: int) -> tuple[DataFrame, bool]:
    """The table, broadcast if its rows, of ``size`` bytes and 64 more each, stay below the limit."""
    small = (df.agg(F.sum(size + 64)).first()[0] or 0) <= limit
    return (F.broadcast(df) if small else df), small


def verified_hits(own: DataFrame, grams: DataFrame, lengths: list[int], broadcast_bytes: int) -> DataFrame:
    """A row (__uid, doc_id, length, place, gram) per window that is an n-gram, word by word."""
    bytes_of = F.octet_length(F.concat_ws(" ", "gram_words")) + 16 * F.size("gram_words")
    grams, small = broadcast_below(grams, bytes_of, broadcast_bytes)
    result = ["__uid", "doc_id", "length", "place", "gram"]
    if small:
        each = windows(own, lengths, "__uid", "doc_id", "words").join(grams, ["length", "h"])
        return each.where(same_words()).select(*result)
    each = windows(own, lengths, "__uid", "doc_id").join(grams, ["length", "h"])
    each = cut_lineage(each.select(*result, "gram_words").distinct())
    texts = own.select(F.col("__uid").alias("u"), F.col("doc_id").alias("d"), "words")
    same = (F.col("__uid") == F.col("u")) & F.col("doc_id").eqNullSafe(F.col("d"))
    return each.join(texts, same).where(same_words()).select(*result)


def contamination(
    docs: DataFrame, benchmark: DataFrame, n: int = 13, percent: int = 5, broadcast_bytes: int = 256 << 20
) -> DataFrame:
    """Per document: __uid (tells rows with one id apart), doc_id, n_words, n_hit, items (sorted
    as strings), contaminated: at least ``percent`` of the words are in n-grams of the benchmark."""
    grams, items, lengths = benchmark_grams(benchmark, n)
    uid = F.xxhash64("doc_id", "text").alias("__uid")
    own = docs.select(uid, "doc_id", words(F.col("text")).alias("words"))
    counted = own.select("__uid", "doc_id", F.size("words").cast("long").alias("n_words"))
    none = F.array().cast("array<string>")
    if not lengths:
        return counted.select(
            "*", F.lit(0).cast("long").alias("n_hit"), none.alias("items"), F.lit(False).alias("contaminated")
        )
    hits = verified_hits(own, grams, lengths, broadcast_bytes)
    found = hits.groupBy(F.col("__uid").alias("u"), F.col("doc_id").alias("d")).agg(
        F.collect_set(F.struct("place", "length")).alias("places"), F.collect_set("gram").alias("grams")
    )
    inside = F.flatten(F.transform("places", lambda s: F.sequence(s["place"], s["place"] + s["length"] - 1)))
    found = cut_lineage(found.select("u", "d", F.size(F.array_distinct(inside)).cast("long").alias("n_hit"), "grams"))
    items, _ = broadcast_below(items, F.octet_length("item_id"), broadcast_bytes)
    named = found.select("u", "d", F.explode("grams").alias("gram")).join(items, "gram")
    named = named.groupBy("u", "d").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    named = named.select(F.col("u").alias("u2"), F.col("d").alias("d2"), "items")
    found = found.join(named, (F.col("u") == F.col("u2")) & F.col("d").eqNullSafe(F.col("d2")), "left")
    found = cut_lineage(found.select("u", "d", "n_hit", "items"))
    same = (F.col("__uid") == F.col("u")) & F.col("doc_id").eqNullSafe(F.col("d"))
    joined = counted.join(found, same, "left").select(
        "__uid", "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("items", none).alias("items")
    )
    return joined.withColumn("contaminated", F.expr(f"n_hit > 0 and 100 * n_hit >= {percent} * n_words"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **rule: int) -> DataFrame:
    """The clean documents, with all their columns."""
    found = contamination(docs, benchmark, **rule).where("contaminated")
    found = cut_lineage(found.select(F.col("__uid").alias("u"), F.col("doc_id").alias("d")).distinct())
    same = (F.xxhash64(docs["doc_id"], docs["text"]) == found["u"]) & docs["doc_id"].eqNullSafe(found["d"])
    return docs.join(found, same, "left_anti")


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return contamination(docs, benchmark).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), "contaminated",
    )

"""URL filters: rules first, then the ratio of two character language models.

URLs that a rule decides teach two smoothed variable-order Markov models, one of accepted and one
of rejected URLs: Witten-Bell interpolation from the longest context down to a uniform law. All
counts come from all such URLs but a held-out tenth, on which the threshold of the
length-normalised log-likelihood difference is calibrated. Counts and scores are tables that grow
with the input and meet in joins; nothing of them is broadcast or collected.

Defined results: a null URL, or one without ``://``, has an empty host and path and fits no rule;
a null scores 0, another one by its text. URLs are read whole. Repeated URLs are judged alike and
teach once. Without URLs of both sorts every score is 0 and the threshold is 0, so the verdict is
allow. Other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from aprisco.llm.skew import join_by_counts
from aprisco.sources.shared import cut_lineage

ORDER = 5  # characters of the longest gram: four of context and the next one
BINS = 200
START, END = "\u0002", "\u0003"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (host, path, verdict); the longest rule that fits wins
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict; null if none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, start, says in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        rule = F.when(fits, F.lit(name + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def grams(urls: DataFrame) -> DataFrame:
    """For every character of every URL, and its end, the gram that ends there."""
    chars = F.concat(
        F.array_repeat(F.lit(START), ORDER - 1), F.array_remove(F.split("url", ""), ""), F.array(F.lit(END))
    )
    whole = urls.withColumn("chars", chars)
    each = F.transform(
        F.sequence(F.lit(1), F.size("chars") - (ORDER - 1)), lambda i: F.array_join(F.slice("chars", i, ORDER), "")
    )
    return whole.withColumn("grams", each).drop("chars").select(*urls.columns, F.explode("grams").alias("gram"))


def markov_tables(taught: DataFrame) -> tuple[DataFrame, dict[str, float]]:
    """For each string up to ORDER characters, by sort: how often it occurs (n), how often it is
    followed (t) and by how many different characters (k); and the totals of the empty context."""
    longest = taught.groupBy("gram").agg(
        F.sum(F.col("accepted").cast("long")).alias("n_a"), F.sum((~F.col("accepted")).cast("long")).alias("n_r")
    )
    suffixes = F.transform(F.sequence(F.lit(1), F.lit(ORDER)), lambda n: F.substr("gram", ORDER + 1 - n, n))
    counts = cut_lineage(
        longest.withColumn("string", F.explode(suffixes))
        .groupBy("string")
        .agg(F.sum("n_a").alias("n_a"), F.sum("n_r").alias("n_r"))
    )
    sums = (
        F.sum("n_a").alias("t_a"), F.sum("n_r").alias("t_r"),
        F.sum((F.col("n_a") > 0).cast("long")).alias("k_a"), F.sum((F.col("n_r") > 0).cast("long")).alias("k_r"),
    )
    followed = F.substr("string", F.lit(1), F.length("string") - 1)
    contexts = counts.where("length(string) > 1").groupBy(followed.alias("context")).agg(*sums)
    zero = F.lit(0).cast("long")
    # A string can be a context without being a suffix of a gram (at the start) and the other way
    # round, so both sorts of rows are summed by string.
    stats = counts.select("string", "n_a", "n_r", zero.alias("t_a"), zero.alias("t_r"), zero.alias("k_a"), zero.alias("k_r"))
    stats = stats.unionByName(
        contexts.select(F.col("context").alias("string"), zero.alias("n_a"), zero.alias("n_r"), "t_a", "t_r", "k_a", "k_r")
    )
    stats = stats.groupBy("string").agg(*(F.sum(c).alias(c) for c in ("n_a", "n_r", "t_a", "t_r", "k_a", "k_r")))
    empty = counts.where("length(string) = 1").agg(*sums).first().asDict()
    return stats, {k: float(v or 0) for k, v in empty.items()}


def gram_ratios(seen: DataFrame, taught: DataFrame) -> DataFrame:
    """The log ratio of the two models' chances of each distinct gram's last character, and how
    often the gram occurs."""
    stats, empty = markov_tables(taught)
    distinct = cut_lineage(seen.groupBy("gram").agg(F.count("*").alias("times")))
    parts = [F.struct(F.lit(f"s{n}").alias("role"), F.substr("gram", F.lit(ORDER + 1 - n), F.lit(n)).alias("string")) for n in range(1, ORDER + 1)]
    parts += [F.struct(F.lit(f"c{n}").alias("role"), F.substr("gram", F.lit(ORDER + 1 - n), F.lit(n - 1)).alias("string")) for n in range(2, ORDER + 1)]
    needed = distinct.select("gram", "times", F.explode(F.array(*parts)).alias("p")).select("gram", "times", "p.role", "p.string")
    joined = needed.join(stats, "string", "left")
    pick = lambda role, c: F.coalesce(F.max(F.when(F.col("role") == role, F.col(c))), F.lit(0)).cast("double")
    wide = joined.groupBy("gram").agg(
        F.first("times").alias("times"),
        *(pick(f"s{n}", f"n_{x}").alias(f"n{n}_{x}") for n in range(1, ORDER + 1) for x in "ar"),
        *(pick(f"c{n}", f"{v}_{x}").alias(f"{v}{n}_{x}") for n in range(2, ORDER + 1) for v in "tk" for x in "ar"),
    )
    for x in "ar":
        chance = F.lit(1 / 256)
        for n in range(1, ORDER + 1):
            t, k = (F.lit(empty[f"t_{x}"]), F.lit(empty[f"k_{x}"])) if n == 1 else (F.col(f"t{n}_{x}"), F.col(f"k{n}_{x}"))
            smoothed = (F.col(f"n{n}_{x}") + k * chance) / (t + k)
            wide = wide.withColumn(f"p{n}_{x}", F.when(t > 0, smoothed).otherwise(chance))
            chance = F.col(f"p{n}_{x}")
    return wide.select("gram", "times", (F.log(f"p{ORDER}_a") - F.log(f"p{ORDER}_r")).alias("ratio"))


def score_urls(urls: DataFrame) -> DataFrame:
    """url and score of distinct URLs with ``accepted`` (null: no rule) and ``held`` (held out)."""
    seen = grams(urls)
    ratios = gram_ratios(seen, seen.where("accepted is not null and not held"))
    return join_by_counts(seen, ratios, ["gram"], "times").groupBy("url").agg(F.avg("ratio").alias("score"))


def calibrated(scored: DataFrame) -> float:
    """The threshold with the best balanced accuracy on held-out URLs."""
    bin_ = F.least(F.greatest(F.floor(F.col("score") * (BINS // 10)), F.lit(-BINS // 2)), F.lit(BINS // 2)).cast("int")
    counts = scored.where("accepted is not null and held").groupBy(bin_.alias("bin")).agg(
        F.sum(F.col("accepted").cast("long")).alias("a"), F.sum((~F.col("accepted")).cast("long")).alias("r")
    )
    rows = sorted((r["bin"], r["a"], r["r"]) for r in counts.collect())  # at most a row per bin
    a, r = sum(x[1] for x in rows), sum(x[2] for x in rows)
    if not a or not r:
        return 0.0
    best, threshold, passed_a, passed_r = -1.0, 0.0, a, r
    for at, more_a, more_r in rows:
        if (good := passed_a / a + 1 - passed_r / r) > best:
            best, threshold = good, at / (BINS // 10)
        passed_a, passed_r = passed_a - more_a, passed_r - more_r
    return threshold


def distinct_urls(judged: DataFrame) -> DataFrame:
    """Each URL once, with what a rule says and whether it is held out, stored in many files.

    A URL makes many grams, so its table is small but its work is not. Dealt by the URL alone the
    rows would stay where the grouping left them, which may be a single task.
    """
    held = F.pmod(F.xxhash64("url"), F.lit(10)) == 0
    distinct = judged.where("url is not null").groupBy("url").agg((F.first("says") == "allow").alias("accepted"))
    parts = int(judged.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut_lineage(distinct.withColumn("held", held).repartition(parts, F.xxhash64("url")))


def judge_urls(pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    """page_id, host, path, rule, score and verdict of every page."""
    url = F.col("url")
    own = pages.select("page_id", "url", host_of(url).alias("host"), path_of(url).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    own = own.withColumn("rule", rule).withColumn("says", verdict)
    distinct = distinct_urls(own)
    scores = cut_lineage(distinct.join(score_urls(distinct), "url", "left"))
    sorts = distinct.where("not held").agg(F.max("accepted").alias("a"), F.min("accepted").alias("r")).first()
    both = sorts["a"] is True and sorts["r"] is False
    threshold = calibrated(scores) if both else 0.0
    score = F.coalesce("score", F.lit(0.0)) if both else F.lit(0.0)
    return (
        own.join(scores.select("url", "score"), "url", "left")
        .withColumn("score", score)
        .select(
            "page_id", "host", "path", "rule", "score",
            F.coalesce("says", F.when(F.col("score") >= threshold, "allow").otherwise("block")).alias("verdict"),
        )
    )

"""Personal data with DataFrame functions and boosted trees on the JVM; no Python on the rows.

Base spans follow fixed rules per kind. Beside them, high-recall generators propose spans that
may overlap anything: numbers with separators, addresses with a spelled-out at sign, long runs
that hold letters and digits. Gradient-boosted trees score every candidate by its format and context.

The trees learn from cases whose truth is known by construction, each distinct one once: spans
that the rules confirm, the same rewritten as people write them (no plus sign, other separators,
[at] and [dot]), values assigned to a name like token or password; against them what the rules
refute (check digit, part ranges, numbers inside words) and what the confirmed ones become when
rewritten into something else: a plain number, a date, a decimal, a name without a domain, words
joined by dashes. Half of the cases by hash, at most about ``fit_rows``, fit the trees. On those
that are left the score above which a candidate is redacted is calibrated per kind: the lowest
that keeps ``precision`` among at least ``least`` true cases. A kind that never gets there adds
nothing. Added spans are of the base kinds or of the kind secret.

Patterns are possessive and begin where a run of their characters begins, so they take time in
proportion to the text, whatever its length.

Defined results: a null text is an empty one, without spans. Places are code points. Rows that
repeat get equal results; rows with one id and different texts are kept apart. Without cases
of both sorts there is no model and nothing is added. Other columns play no part.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from aprisco.sources.shared import cut_lineage

KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
GENERATORS = {
    "spelled": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++(?:\x20?[(\[]at[)\]]\x20?|@)[A-Za-z0-9-]++(?:(?:\.|\x20?[(\[]dot[)\]]\x20?)[A-Za-z0-9-]++)*+",
    "number": r"\+?[0-9][\x20().0-9-]{5,}[0-9]",
    "opaque": r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{16,}+={0,2}",
}
SPANS = (*KINDS, "secret")
ASSIGNED = r"(?i)(token|key|secret|passw(or)?d|pwd|credentials?)[\"']?\s*[=:]\s*[\"']?$"
PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
CONTEXT = 16  # characters to either side that the context features see
FEATURES = (
    "n_chars", "n_digits", "n_groups", "longest_group", "n_spaces", "n_dots", "n_dashes", "n_brackets",
    "n_letters", "n_upper", "n_switches", "check_digit", "parts_fit", "spelled", "assigned",
    "at_sign", "before_letter", "after_letter", "before_space", "after_space", "before_word", "before_quote",
)


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the digits pass the check-digit test."""
    value = F.transform(
        F.split(F.reverse(number), ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            F.when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)
        ),
    )
    return F.aggregate(value, F.lit(0), lambda a, b: a + b) % 10 == 0


def confirmed(kind: Column, match: Column) -> Column:
    n = F.length(digits(match))
    return (
        F.when(kind == "email", F.lit(True))
        .when(kind == "ip", match.rlike(rf"^(?:{PART}\.){{3}}{PART}$"))
        .when(kind == "card", F.when(n.between(14, 19), luhn(digits(match))).otherwise(F.lit(False)))
        .when(kind == "phone", n.between(10, 15))
        .otherwise(F.lit(False))
    )


def matches(docs: DataFrame) -> DataFrame:
    """A row per match of any pattern or generator, with its place and what stands around it."""
    text = F.coalesce("text", F.lit(""))
    own = docs.select(F.xxhash64("doc_id", "text").alias("uid"), "doc_id", text.alias("text"))
    found = [
        F.struct(
            F.lit(kind).alias("kind"),
            F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("found"),
            F.split("text", pattern, -1).alias("between"),
        )
        for kind, pattern in {**PATTERNS, **GENERATORS}.items()
    ]
    # Every pattern needs a digit or an at sign, as such or spelled out
    rows = own.where(F.col("text").rlike("[0-9]|@|[(\\[]at[)\\]]")).select("uid", "doc_id", F.explode(F.array(*found)).alias("f"))
    rows = rows.where("size(f.found) > 0").select("uid", "doc_id", "f.kind", "f.found", "f.between")
    each = F.transform(
        "found",
        lambda m, i: F.struct(
            m.alias("match"),
            F.length(F.get("between", i)).alias("gap"),
            F.substring(F.get("between", i), -CONTEXT, CONTEXT).alias("before"),
            F.substring(F.get("between", i + 1), 1, CONTEXT).alias("after"),
        ),
    )
    rows = rows.select("uid", "doc_id", "kind", F.posexplode(each).alias("i", "m"))
    rows = rows.select("uid", "doc_id", "kind", "i", "m.*").dropDuplicates(["uid", "doc_id", "kind", "i"])
    upto = Window.partitionBy("uid", "doc_id", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.length("match")).over(upto))
    return rows.withColumn("start", F.col("end") - F.length("match")).drop("gap", "i")


def with_features(candidates: DataFrame) -> DataFrame:
    """Format and context of each candidate, and the kind it would be redacted as."""
    match, n = F.col("match"), F.length(digits(F.col("match")))
    groups = F.regexp_extract_all(match, F.lit("[0-9]+"), F.lit(0))
    count = lambda chars: F.length(match) - F.length(F.regexp_replace(match, chars, ""))
    flag = lambda c: c.cast("double")
    return candidates.select(
        "*",
        F.when(F.col("kind") == "spelled", "email").when(F.col("kind") == "opaque", "secret").when(n >= 14, "card")
        .when(match.rlike(r"^[0-9]+(\.[0-9]+){3}$"), "ip").otherwise("phone").alias("as"),
        F.length(match).cast("double").alias("n_chars"),
        n.cast("double").alias("n_digits"),
        F.size(groups).cast("double").alias("n_groups"),
        F.coalesce(F.array_max(F.transform(groups, F.length)), F.lit(0)).cast("double").alias("longest_group"),
        count(r"\x20").cast("double").alias("n_spaces"),
        count(r"\.").cast("double").alias("n_dots"),
        count("-").cast("double").alias("n_dashes"),
        count("[()]").cast("double").alias("n_brackets"),
        count("[A-Za-z]").cast("double").alias("n_letters"),
        count("[A-Z]").cast("double").alias("n_upper"),
        F.size(F.regexp_extract_all(match, F.lit("[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])"), F.lit(0))).cast("double").alias("n_switches"),
        flag(F.when(n.between(14, 19), luhn(digits(match))).otherwise(F.lit(False))).alias("check_digit"),
        flag(match.rlike(rf"^(?:{PART}\.){{3}}{PART}$")).alias("parts_fit"),
        flag(match.rlike(r"(?:\.|[(\[]dot[)\]]\x20?)[A-Za-z0-9-]+$")).alias("spelled"),
        flag(F.col("before").rlike(ASSIGNED)).alias("assigned"),
        flag(match.contains("@")).alias("at_sign"),
        flag(F.col("before").rlike("[A-Za-z0-9]$")).alias("before_letter"),
        flag(F.col("after").rlike("^[A-Za-z0-9]")).alias("after_letter"),
        flag(F.col("before").rlike("(^|[\\s])$")).alias("before_space"),
        flag(F.col("after").rlike("^([\\s.,;]|$)")).alias("after_space"),
        flag(F.lower("before").rlike("(tel|phone|call|mail|card|ip|address|contact)\\W*$")).alias("before_word"),
        flag(F.col("before").rlike("[\"'=]\\s*$")).alias("before_quote"),
    )


def touched(candidates: DataFrame, base: DataFrame) -> DataFrame:
    """``label``: whether the candidate overlaps a base span. One sorted pass per document."""
    both = candidates.withColumn("base", F.lit(False)).unionByName(
        base.withColumn("base", F.lit(True)), allowMissingColumns=True
    )
    by = Window.partitionBy("uid", "doc_id").orderBy("start", F.desc("base"), "end")
    reach = F.max(F.when(F.col("base"), F.col("end"))).over(by.rowsBetween(Window.unboundedPreceding, 0))
    ahead = F.min(F.when(F.col("base"), F.col("start"))).over(by.rowsBetween(0, Window.unboundedFollowing))
    marked = both.withColumn("reach", reach).withColumn("ahead", ahead).where("not base")
    near = F.coalesce(F.col("reach") > F.col("start"), F.lit(False)) | F.coalesce(F.col("ahead") < F.col("end"), F.lit(False))
    return marked.withColumn("label", near.cast("double")).drop("base", "reach", "ahead")


def rewritten(kind: Column, match: Column, before: Column, after: Column) -> Column:
    """What a confirmed span becomes when written otherwise: (kind, match, label), 1 where it stays
    personal data."""
    d, one = digits(match), lambda k, m, label: F.struct(F.lit(k).alias("kind"), m.alias("match"), F.lit(label).alias("label"))
    name, host = F.split(match, "@")[0], F.split(match, "@")[1]
    grouped = lambda x, by: F.concat_ws(by, F.regexp_extract_all(x, F.lit("[0-9]{1,4}"), F.lit(0)))
    tail = lambda i, n: F.substring(d, i, n)
    wrong = F.concat(F.left(d, F.length(d) - 1), ((F.right(d, F.lit(1)).cast("int") + 1) % 10).cast("string"))
    slug = lambda by: F.regexp_replace(F.concat(before, F.lit(" "), after, F.lit("1")), "[^A-Za-z0-9]+", by)
    return (
        F.when(kind == "email", F.array(
            one("spelled", F.concat(name, F.lit(" [at] "), host), 1),
            one("spelled", F.concat(name, F.lit("(at)"), F.regexp_replace(host, r"\.", " (dot) ")), 1),
            one("spelled", F.concat(name, F.lit("@"), F.split(host, r"\.")[0]), 0),
            one("spelled", F.concat(name, F.lit(" (at) "), F.split(host, r"\.")[0]), 0),
        ))
        .when(kind == "phone", F.array(
            one("number", F.regexp_replace(match, r"^\+", ""), 1),
            one("number", F.concat_ws("-", tail(-10, 3), tail(-7, 3), tail(-4, 4)), 1),
            one("number", F.concat(F.lit("("), tail(-10, 3), F.lit(") "), tail(-7, 3), F.lit("-"), tail(-4, 4)), 1),
            one("number", F.concat_ws(".", tail(-10, 3), tail(-7, 3), tail(-4, 4)), 1),
            one("number", d, 0),
            one("number", F.concat(F.lit("20"), tail(-2, 2), F.lit("-0"), tail(-4, 1), F.lit("-1"), tail(-3, 1)), 0),
            one("number", F.concat(tail(-10, 7), F.lit("."), tail(-3, 2)), 0),
        ))
        .when(kind == "card", F.array(
            one("number", grouped(d, "."), 1), one("number", grouped(d, " - "), 1),
            one("number", grouped(wrong, "."), 0), one("number", grouped(wrong, " - "), 0), one("number", wrong, 0),
        ))
        .when(kind == "ip", F.array(one("number", match, 1), one("number", F.concat(F.lit("7"), match, F.lit("00")), 0)))
        .when(kind == "secret", F.array(one("opaque", slug("-"), 0), one("opaque", slug("/"), 0), one("opaque", slug("_"), 0)))
    )


def known_cases(found: DataFrame) -> DataFrame:
    """Distinct cases of known truth with their features, ``label`` and ``side``, a number that a
    case shares with what it was rewritten from."""
    real = F.col("kind").isin(*KINDS) & confirmed(F.col("kind"), F.col("match"))
    secret = (F.col("kind") == "opaque") & F.col("before").rlike(ASSIGNED) & F.col("match").rlike("[A-Za-z]")
    inside = F.col("before").rlike("[A-Za-z0-9]$") | F.col("after").rlike("^[A-Za-z0-9]")
    refuted = (F.col("kind") == "number") & (
        inside | ~confirmed(F.col("as"), F.col("match")) & F.col("as").isin("ip", "card")
    ) | (F.col("kind") == "opaque") & ~F.col("match").rlike("[A-Za-z]")
    sort = F.when(real, F.col("kind")).when(secret, "secret").when(refuted, "refuted")
    each = with_features(found).select("kind", sort.alias("sort"), "match", "before", "after").where("sort is not null")
    each = each.groupBy("kind", "sort", "match").agg(F.min(F.struct("before", "after")).alias("around"))
    each = cut_lineage(each.select("kind", "sort", "match", "around.*", F.xxhash64("match").alias("side")))
    new = rewritten(F.col("sort"), F.col("match"), F.col("before"), F.col("after"))
    made = each.where("sort <> 'refuted'").select(F.explode(new).alias("c"), "before", "after", "side")
    alike = F.when(F.col("kind") == "email", "spelled").when(F.col("kind").isin(*KINDS), "number").otherwise(F.col("kind"))
    as_is = each.select(alike.alias("kind"), "match", "before", "after", "side", (F.col("sort") != "refuted").cast("int").alias("label"))
    return with_features(as_is.unionByName(made.select("c.*", "before", "after", "side"))).select(
        "as", F.col("label").cast("double").alias("label"), "side", *FEATURES
    )


def further_spans(
    candidates: DataFrame, known: DataFrame, fit_rows: int = 20_000, precision: float = 0.99, least: int = 10, rounds: int = 20
) -> DataFrame | None:
    """The candidates that the calibrated thresholds select. The trees see at most about
    ``fit_rows`` known cases, drawn by hash; the thresholds are set on the rest."""
    n = known.count()
    share = min(0.5, fit_rows / max(n, 1))
    fit = F.pmod(F.col("side"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)))
    sample = cut_lineage(known.where(fit).select("label", *FEATURES).coalesce(1))
    if sample.select("label").distinct().count() < 2:
        return None
    to_vector = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    trees = GBTClassifier(maxIter=rounds, maxDepth=4, stepSize=0.3, maxBins=32, seed=5)
    model = trees.fit(to_vector.transform(sample))
    score = F.floor(vector_to_array("probability")[1] * 1000).cast("int").alias("score")
    held_out = model.transform(to_vector.transform(known.where(~fit))).select("as", "label", score)
    by_kind: dict[str, list[tuple[int, float, int]]] = {}
    for r in held_out.groupBy("as", "score").agg(F.sum("label").alias("hits"), F.count("*").alias("n")).collect():
        by_kind.setdefault(r["as"], []).append((r["score"], r["hits"], r["n"]))  # at most 1001 scores per kind
    chosen = F.lit(False)
    for kind, seen in sorted(by_kind.items()):
        hits, n, threshold = 0.0, 0, None
        for score_of, more, of in sorted(seen, reverse=True):
            hits, n = hits + more, n + of
            if hits >= least and hits >= precision * n:
                threshold = score_of
        if threshold is not None:
            chosen = chosen | (F.col("as") == kind) & (F.col("score") >= threshold)
    scored = model.transform(to_vector.transform(candidates)).select("uid", "doc_id", "start", "end", "as", score)
    return scored.where(chosen).select("uid", "doc_id", F.col("as").alias("kind"), "start", "end")


def find_personal_data(docs: DataFrame, **model: float) -> DataFrame:
    """Per document: doc_id, n_<kind> of the base spans, ``base`` and ``spans``: the base spans
    and all spans, as arrays of (start, kind_no, end, kind) by start and kind."""
    found = cut_lineage(matches(docs))
    in_base = F.col("kind").isin(*KINDS)
    base = found.where(in_base).where(confirmed(F.col("kind"), F.col("match")))
    base = cut_lineage(base.select("uid", "doc_id", "kind", "start", "end"))
    candidates = with_features(found.where(~in_base)).drop("kind", "match", "before", "after")
    free = touched(candidates, base.drop("kind")).where("label = 0").drop("label")
    more = further_spans(free, known_cases(found), **model)
    spans = base.withColumn("base", F.lit(True))
    if more is not None:
        spans = spans.unionByName(more.distinct().withColumn("base", F.lit(False)))
    number = F.array_position(F.array(*map(F.lit, SPANS)), F.col("kind")).cast("int")
    one = F.struct("start", number.alias("kind_no"), "end", "kind")
    grouped = spans.groupBy(F.col("uid").alias("u"), F.col("doc_id").alias("d")).agg(
        F.array_sort(F.collect_list(F.when(F.col("base"), one))).alias("base"), F.array_sort(F.collect_list(one)).alias("spans")
    )
    own = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("uid"))
    joined = own.join(grouped, (F.col("uid") == F.col("u")) & F.col("doc_id").eqNullSafe(F.col("d")), "left")
    count = lambda kind: F.coalesce(F.size(F.filter("base", lambda s: s["kind"] == kind)), F.lit(0))
    return joined.select(
        "doc_id", *(F.when(F.col("base").isNull(), 0).otherwise(count(k)).cast("long").alias(f"n_{k}") for k in KINDS), "base", "spans"
    )


def digest(docs: DataFrame) -> DataFrame:
    def named(spans: str) -> Column:
        each = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
        return F.concat_ws(",", each)

    return find_personal_data(docs).select(
        "doc_id", *(f"n_{k}" for k in KINDS),
        F.sha2(named("base").cast("binary"), 256).alias("base_sha256"), named("spans").alias("spans"),
    )

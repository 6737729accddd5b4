"""URL filter: rules first, then a character language-model ratio.

Two smoothed variable-order Markov models over the characters of a url, one of the urls
that rules accept and one of those that rules reject, are interpolated from order ``order``
down to a uniform one (Witten-Bell: the weight of the shorter context is the number of
different characters seen after the longer one). A url's score is the mean over its
characters of ``ln P_accepted - ln P_rejected``. One fifth of the rule-judged urls (by a hash), scored by the counts
of the others, sets the threshold with the least class-balanced error; the remaining urls are scored by the counts of all.

All counts cover every distinct rule-judged url (a url of many pages counts once, after a
combining aggregation, so a hot url or host is one row). The model holds a row for each
distinct character n-gram; it is joined by broadcast up to ``broadcast_grams`` rows and by a
shuffle beyond.

Edge cases: a null url counts as ''; null, empty or without ``://`` has an empty host and
path, fits no rule and is judged by the method (its only character is the end mark). A null
id has a row. Repeated rows are judged each. If no url is rule-judged, all scores and the
threshold are 0 and the verdict is allow; if one class is missing, the threshold is 0. An empty table gives no rows. Other
columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch

START, END = "\x02", "\x03"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FOLDS = 5
FIXED = 1_000_000_000  # log ratios are added up in billionths


@dataclass(frozen=True)
class Rule:
    """``text`` is a host and a path, such as ``net/es/``; it fits the host and its subdomains."""

    text: str
    verdict: str

    def fits(self, host: Column, path: Column) -> Column:
        name, slash, rest = self.text.partition("/")
        return ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    text = F.coalesce(url, F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, text.substr(at + 3, F.length(text))).otherwise("")
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null if none fits."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):  # the longest is asked first
        fits = r.fits(host, path)
        text, verdict = F.when(fits, r.text).otherwise(text), F.when(fits, r.verdict).otherwise(verdict)
    return text, verdict


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(v)`` with ``v`` bound to ``value``, which is then computed once and not in every step of an inner function."""
    return F.element_at(F.transform(F.array(value), body), 1)


def grams(url: Column, order: int) -> Column:
    """One string of ``order`` characters for each character of the url and the end mark."""

    def places(length: Column) -> Column:
        return F.sequence(F.lit(1), length - (order - 1))

    # a substring is found from the start of the text, so a very long url is cut into characters first
    def short(t: Column) -> Column:
        return F.transform(places(F.length(t)), lambda i: F.substr(t, i, F.lit(order)))

    def long(t: Column) -> Column:
        return _bound(F.split(t, ""), lambda c: F.transform(places(F.size(c)), lambda i: F.array_join(F.slice(c, i, order), "")))

    text = F.concat(F.lit(START * (order - 1)), F.translate(url, UPPER, LOWER), F.lit(END))
    return _bound(text, lambda t: F.when(F.length(t) <= 1024, short(t)).otherwise(long(t)))


def ratio_model(counts: DataFrame, order: int) -> DataFrame:
    """``(gram, llr)`` of every gram in ``counts (gram, a, b)``: a and b are how often it
    stands in accepted and rejected urls (0 for grams that only wait for a score)."""
    uniform = 1.0 / max(1, counts.select(F.substring("gram", -1, 1).alias("c")).distinct().count())
    model = None
    for k in range(1, order + 1):
        suffix = F.substring("gram", -k, k)
        level = counts.groupBy(suffix.alias("s")).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
        context = F.substring("s", 1, k - 1) if k > 1 else F.lit("")
        level = level.withColumn("ctx", context)
        seen = level.groupBy("ctx").agg(
            F.sum("a").alias("na"), F.sum("b").alias("nb"), F.count(F.when(F.col("a") > 0, 1)).alias("ta"), F.count(F.when(F.col("b") > 0, 1)).alias("tb")
        )
        joined = level.join(seen, "ctx")
        if model is None:
            joined = joined.withColumn("pa0", F.lit(uniform)).withColumn("pb0", F.lit(uniform))
        else:
            shorter = model.select(F.col("s").alias("s0"), F.col("pa").alias("pa0"), F.col("pb").alias("pb0"))
            joined = joined.withColumn("s0", F.substring("s", 2, k - 1)).join(shorter, "s0")

        def blend(c: str, n: str, t: str, p: str) -> Column:
            return F.when(F.col(n) == 0, F.col(p)).otherwise((F.col(c) + F.col(t) * F.col(p)) / (F.col(n) + F.col(t)))

        model = joined.select("s", blend("a", "na", "ta", "pa0").alias("pa"), blend("b", "nb", "tb", "pb0").alias("pb"))
    return model.select(F.col("s").alias("gram"), (F.log("pa") - F.log("pb")).alias("llr"))


def threshold(scored: DataFrame, step: float = 0.01) -> float:
    """Of ``(score, verdict)`` rows of both classes: the cut with the least balanced error, in
    the middle of the gap between scores that it lies in. Counts are combined into bins of ``step``; a mean log ratio spans a few thousand of them."""
    bins = scored.groupBy(F.floor(F.col("score") / step).alias("bin")).agg(
        F.count(F.when(F.col("verdict") == "allow", 1)).alias("a"), F.count(F.when(F.col("verdict") == "block", 1)).alias("b")
    )
    below, every = W.orderBy("bin").rowsBetween(W.unboundedPreceding, -1), W.orderBy("bin").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    cuts = bins.select(
        "bin",
        F.coalesce(F.sum("a").over(below), F.lit(0)).alias("missed"),
        (F.sum("b").over(every) - F.coalesce(F.sum("b").over(below), F.lit(0))).alias("passed"),
        F.sum("a").over(every).alias("na"),
        F.sum("b").over(every).alias("nb"),
        F.lag("bin").over(W.orderBy("bin")).alias("before"),
    ).where("na > 0 and nb > 0")
    error = F.col("missed") / F.col("na") + F.col("passed") / F.col("nb")
    middle = (F.col("bin") + F.coalesce(F.col("before") + 1, F.col("bin"))) / 2
    got = cuts.select(middle.alias("cut"), error.alias("error")).orderBy("error", F.abs("cut"), "cut").first()
    return got["cut"] * step if got else 0.0


def judge_urls(
    spark: SparkSession,
    pages: DataFrame,
    rules: list[Rule],
    order: int = 5,
    broadcast_grams: int = 500_000,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """``(page_id, host, path, rule, verdict, score)`` of every row; ``score`` is the
    ratio above the threshold, null where a rule decides."""
    scratch = Scratch(spark)
    rows = pages.select(F.col(id_col).alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"))
    host, path = url_parts(F.col("url"))
    urls = rows.select("url").distinct().withColumn("host", host).withColumn("path", path)
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    urls = urls.withColumn("rule", rule).withColumn("verdict", verdict)
    fold = F.pmod(F.xxhash64("url"), F.lit(FOLDS))
    role = F.when(F.col("rule").isNull(), "wanted").when(fold == 0, "fold").otherwise("learn")
    # dealt anew: a few small files would be one task for all grams
    urls = scratch.keep(urls.withColumn("role", role).repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))), "urls")
    spread = urls.select("url", "role", "verdict", F.explode(grams(F.col("url"), order)).alias("gram"))
    learn = F.col("role") == "learn"
    counts = scratch.keep(
        spread.groupBy("gram").agg(
            *[F.count(F.when((F.col("verdict") == v) & own, 1)).alias(f"{c}{of}") for of, own in (("_part", learn), ("_all", F.lit(True))) for c, v in (("a", "allow"), ("b", "block"))]
        ),
        "gram-counts",
    )
    models = [ratio_model(counts.select("gram", F.col(f"a_{of}").alias("a"), F.col(f"b_{of}").alias("b")), order) for of in ("part", "all")]
    part, whole = (m.withColumnRenamed("llr", f"llr_{of}") for m, of in zip(models, ("part", "all"), strict=True))
    model = scratch.keep(part.join(whole, "gram"), "gram-model")
    small = model.limit(broadcast_grams + 1).count() <= broadcast_grams
    scored = spread.where(~learn).join(F.broadcast(model) if small else model, "gram")
    llr = F.when(F.col("role") == "fold", F.col("llr_part")).otherwise(F.col("llr_all"))
    # summed as whole numbers, so that no order of the rows moves a url over the threshold
    mean = F.sum(F.round(llr * FIXED).cast("long")) / F.count(F.lit(1)) / FIXED
    scored = scratch.keep(scored.groupBy("url", "role", "verdict").agg(mean.alias("score")), "url-scores")
    cut = threshold(scored.where("role = 'fold'"))
    judged = urls.join(scored.where("role = 'wanted'").select("url", "score"), "url", "left").select(
        "url", "host", "path", "rule", "verdict", (F.col("score") - cut).alias("score")
    )
    judged = judged.withColumn("verdict", F.coalesce("verdict", F.when(F.col("score") >= 0, "allow").otherwise("block")))
    return rows.join(judged, "url").select("page_id", "host", "path", "rule", "verdict", "score")

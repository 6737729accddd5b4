"""Benchmark decontamination by a prefix-filtered set join.

``A-Z`` is lower-cased and words are the runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``. Every run of
``window`` words of a benchmark item is a window; an item of fewer words, but not none, is one
window. A document word inside any occurrence of a window is hit.

A window is the set of its (up to) ``shingle``-word shingles with their places. All documents are counted for how
often each benchmark shingle occurs in them, which orders a window's shingles by rarity. An occurrence of
the window contains all its shingles (containment 1), so its necessary prefix is one token:
the rarest. Documents are joined on that token alone; the place of the token in the
window must leave room before it and after it in the document (positional and length bounds),
and what is left is verified word by word over the item-sized window.

The windows of the benchmark, and the pairs of window and item, are broadcast up to ``broadcast_windows`` of them; a larger
benchmark is joined by a shuffle of the documents' tokens, which carry no words; places that the bounds leave get their text's words back. Hits of a document are merged as intervals in document order.

Edge cases: a null text has no words; a document without words is not contaminated. An item that is
null, has no words, or has a null id takes no part. Rows that repeat a document id are judged each by their own text.
Repeated items count once in ``n_items``. A null document id has a row. Empty tables give
no rows, or no hits. Other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch
from .urls import LOWER, UPPER

NO_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def words(text: Column) -> Column:
    """Array of words; empty for null."""
    # a run of separators is one cut, so only the ends can leave an empty word
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), NO_WORD), "")


def item_windows(benchmark: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """``(words, size, items)``: every different window with the ids of its items."""
    items = benchmark.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("string").alias("item_id"), words(F.col(text_col)).alias("all"))
    size = F.least(F.lit(window), F.size("all"))
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("all") - window + 1))
    cut = items.where(F.size("all") > 0).select("item_id", "all", size.alias("size"), F.explode(starts).alias("at"))
    rows = cut.select("item_id", "size", F.slice("all", F.col("at"), F.col("size")).alias("words"))
    return rows.groupBy("words", "size").agg(F.collect_set("item_id").alias("items"))


def token(at: Column, all_words: str, width: int) -> Column:
    """Hash of ``width`` words from the zero-based place ``at``."""
    return F.xxhash64(F.lit(width), *(F.get(F.col(all_words), at + k) for k in range(width)))


def placed_tokens(docs: DataFrame, widths: list[int], *keep: str) -> DataFrame:
    """One row ``(*keep, at, width, token)`` for each place of each document and each width."""
    spread = docs.select(*keep, "n_words", "words", F.posexplode("words").alias("at", "word"))
    if len(widths) == 1:
        return spread.withColumn("width", F.lit(widths[0])).withColumn("token", token(F.col("at"), "words", widths[0]))
    each = F.array(*(F.struct(F.lit(w).alias("width"), token(F.col("at"), "words", w).alias("token")) for w in widths))
    return spread.withColumn("t", F.explode(each)).select("*", "t.width", "t.token").drop("t")


def contamination(
    spark: SparkSession,
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 13,
    shingle: int = 3,
    share: int = 20,
    broadcast_windows: int = 200_000,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, text_hash)`` of every row;
    contaminated if anything is hit and ``share * n_hit >= n_words``."""
    scratch = Scratch(spark)
    # rows of one id and one text are judged alike, so the two name a row wherever it is read
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_hash"), F.col(text_col).alias("text"))
    listed = scratch.keep(item_windows(benchmark, window, item_col, item_text_col).withColumn("window", F.monotonically_increasing_id()), "windows")
    small = listed.limit(broadcast_windows + 1).count() <= broadcast_windows
    hint = F.broadcast if small else (lambda df: df)
    widths = sorted(r["width"] for r in listed.select(F.least("size", F.lit(shingle)).alias("width")).distinct().collect())
    n_words = F.size("words")
    whole = rows.select("doc_id", "text_hash", F.size(words(F.col("text"))).alias("n_words"))
    if not widths:
        return _report(whole.withColumn("n_hit", F.lit(None).cast("long")).withColumn("items", F.lit(None).cast("array<string>")), share)

    # every shingle of every window, with its place
    shingles = None
    for w in widths:
        own = listed.where(F.least("size", F.lit(shingle)) == w).withColumn("wplace", F.explode(F.sequence(F.lit(0), F.col("size") - w)))
        own = own.select("window", "size", "wplace", F.lit(w).alias("width"), token(F.col("wplace"), "words", w).alias("token"))
        shingles = own if shingles is None else shingles.union(own)
    shingles = scratch.keep(shingles, "shingles")

    # rarity over all documents
    split = rows.select("text", words(F.col("text")).alias("words")).withColumn("n_words", n_words)
    counted = placed_tokens(split, widths).join(hint(shingles.select("token").distinct()), "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("freq"))
    ranked = shingles.join(scratch.keep(counted, "token-counts"), "token", "left").withColumn("freq", F.coalesce("freq", F.lit(0)))
    place = F.row_number().over(W.partitionBy("window").orderBy("freq", "token", "wplace"))
    # a window whose rarest shingle never occurs has no occurrence
    prefix = ranked.withColumn("place", place).where("place = 1 and freq > 0").select("window", "size", "wplace", "width", "token")
    prefix = scratch.keep(prefix.join(listed.select("window", F.col("words").alias("window_words")), "window"), "prefixes")

    keyed = rows.select("doc_id", "text_hash", words(F.col("text")).alias("words")).withColumn("n_words", n_words)
    places = placed_tokens(keyed, widths, "doc_id", "text_hash")
    if not small:  # the places are shuffled by their token: without the words, which the few that are left get back
        places = places.select("doc_id", "text_hash", "n_words", "at", "width", "token")
    met = places.join(hint(prefix.withColumnRenamed("width", "pwidth")), "token")
    first = F.col("at") - F.col("wplace")
    met = met.where((F.col("width") == F.col("pwidth")) & (first >= 0) & (first + F.col("size") <= F.col("n_words")))
    if not small:
        once = keyed.select("doc_id", "text_hash", "words").dropDuplicates(["doc_id", "text_hash"])
        met = _joined(met, once, "inner")
    met = met.where(F.slice("words", first + 1, F.col("size")) == F.col("window_words"))
    found = met.select("doc_id", "text_hash", first.alias("first"), (first + F.col("size")).alias("end"), "window").distinct()
    found = scratch.keep(found, "occurrences")

    before = W.partitionBy("doc_id", "text_hash").orderBy("first", "end").rowsBetween(W.unboundedPreceding, -1)
    spans = found.select("doc_id", "text_hash", "first", "end").distinct().withColumn("reach", F.max("end").over(before))
    new = F.col("end") - F.greatest("first", F.coalesce("reach", F.lit(0)))
    hits = spans.groupBy("doc_id", "text_hash").agg(F.sum(F.greatest(new, F.lit(0))).alias("n_hit"))
    of_items = listed.select("window", F.explode("items").alias("item_id"))
    few = of_items.limit(broadcast_windows + 1).count() <= broadcast_windows
    named = found.select("doc_id", "text_hash", "window").distinct().join(F.broadcast(of_items) if few else of_items, "window")
    items = named.groupBy("doc_id", "text_hash").agg(F.collect_set("item_id").alias("items"))
    both = _joined(hits, items, "inner")
    return _report(_joined(whole, both, "left"), share)


def _joined(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on ``doc_id`` (null matches null) and ``text_hash``."""
    right = right.withColumnRenamed("doc_id", "r_id").withColumnRenamed("text_hash", "r_hash")
    return left.join(right, F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("text_hash") == F.col("r_hash")), how).drop("r_id", "r_hash")


def _report(found: DataFrame, share: int) -> DataFrame:
    n_words, n_hit = F.col("n_words").cast("long"), F.coalesce("n_hit", F.lit(0)).cast("long")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return found.select(
        "doc_id",
        n_words.alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(items), ",").cast("binary"), 256).alias("items_sha256"),
        ((n_hit > 0) & (share * n_hit >= n_words)).alias("contaminated"),
        "text_hash",
    )

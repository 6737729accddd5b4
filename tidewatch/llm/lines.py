"""Line deduplication on levelled sorted runs of line hashes.

A text is split at ``\\n``. A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends, with ``A-Z``
lower-cased; keys of fewer than ``least_chars`` code points are left alone. A key found in at least
``least_docs`` documents loses all its lines except in the document that keeps it.

The index (``LineRuns``) is a set of runs, tables of ``(hi, lo, docs, keeper)`` bucketed and sorted by the
128-bit hash of the key. A batch is reduced to one row a key and joined, bucket by bucket, with every
run: the keys that no run holds (the merge anti-join) are new, and the batch's largest id keeps
them; of the others only the number of documents is noted. These rows are the batch's own run, on level 0.
As soon as a level has ``fanout`` runs they are merged into one of the next level, so a batch meets a number of
runs that grows with the logarithm of the batches. Two runs are merged by a full merge join of their
buckets, so a batch is shuffled once, before it is a run.

``dedup_lines`` deals a table to the index in batches of falling ids, so a key's keeper is the largest id that
holds it, merges the runs, and removes the lines. The keys of the most frequent lines, at most ``HOT_KEYS`` of them,
are broadcast; any other key has fewer than one in ``HOT_KEYS`` of all lines, so its join is even.

Edge cases: a null or empty text is one empty line. Rows that share an id are one document: a key counts
once for them, and all of them keep its lines if their id is the largest. Null ids are one document, below all others.
Lines repeated inside a document stay or go together. An empty table gives no rows. Columns other than
the id and the text are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import release, work_path
from .common import Scratch
from .urls import LOWER, UPPER

SPACE = " \t\n\x0b\x0c\r"
HOT_KEYS = 20_000
KEY = ["hi", "lo"]


def long_keys(text: Column, least_chars: int) -> Column:
    """``array<struct<pos, hi, lo>>``: place and key hash of every line whose key is long enough."""
    keys = F.transform(F.split(F.translate(text, UPPER, LOWER), "\n", -1), lambda line: F.btrim(line, F.lit(SPACE)))
    marked = F.transform(
        keys,
        lambda k, i: F.struct(
            i.cast("int").alias("pos"), F.xxhash64(k).alias("hi"), F.xxhash64(F.lit(1), k).alias("lo"), (F.char_length(k) >= least_chars).alias("long")
        ),
    )
    return F.transform(F.filter(marked, lambda m: m["long"]), lambda m: F.struct(m["pos"].alias("pos"), m["hi"].alias("hi"), m["lo"].alias("lo")))


class LineRuns:
    """Levels of runs; ``add`` takes ``(hi, lo, docs, id)`` with one row a key."""

    def __init__(self, spark: SparkSession, fanout: int = 4) -> None:
        self.spark, self.fanout = spark, fanout
        # buckets are the partitions of the aggregations, so that their rows are written where they are
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[tuple[str, str]]] = []

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name, _ in level]

    def _write(self, rows: DataFrame, level: int) -> None:
        name, path = f"line_run_{uuid.uuid4().hex}", work_path(self.spark, "llm", "line-runs")
        rows.write.bucketBy(self.buckets, *KEY).sortBy(*KEY).option("path", path).format("parquet").saveAsTable(name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append((name, path))

    def _drop(self, runs: list[tuple[str, str]]) -> None:
        for name, path in runs:
            self.spark.sql(f"DROP TABLE {name}")
            release(self.spark, path)

    def merged(self) -> DataFrame:
        """One row a key over all runs: its number of documents and its keeper."""
        return self._merge(self.runs())

    @staticmethod
    def _merge(runs: list[DataFrame]) -> DataFrame:
        rows = runs[0]
        for run in runs[1:]:
            more = run.select(*KEY, F.col("docs").alias("more"), F.col("keeper").alias("other")).hint("merge")
            docs = F.coalesce("docs", F.lit(0)) + F.coalesce("more", F.lit(0))
            # only the run that met a key first names a keeper
            rows = rows.join(more, KEY, "full").select(*KEY, docs.alias("docs"), F.coalesce("keeper", "other").alias("keeper"))
        return rows

    def add(self, batch: DataFrame) -> None:
        rows, known = batch, F.lit(False)
        for i, run in enumerate(self.runs()):
            rows = rows.join(run.select(*KEY, F.lit(True).alias(f"in_{i}")).hint("merge"), KEY, "left")
            known = known | F.col(f"in_{i}").isNotNull()
        self._write(rows.select(*KEY, "docs", F.when(~known, F.col("id")).alias("keeper")), 0)
        level = 0
        while len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._write(self._merge([self.spark.table(name) for name, _ in full]), level + 1)
            self._drop(full)
            level += 1

    def release(self) -> None:
        for level in self.levels:
            self._drop(level)
        self.levels = []


def batch_keys(rows: DataFrame, repeated: DataFrame | None) -> DataFrame:
    """``(hi, lo, docs, id)`` of ``rows (doc_id, keys)``: one row a key, its documents and the largest id.
    The keys of a row are distinct, so only rows whose id is among ``repeated`` need a comparison of documents."""
    lines = rows.select("doc_id", F.explode(F.array_distinct(F.transform("keys", lambda k: F.struct(k["hi"].alias("hi"), k["lo"].alias("lo"))))).alias("k"))
    lines = lines.select("doc_id", "k.hi", "k.lo")
    if repeated is None:
        return lines.groupBy(*KEY).agg(F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("id"))
    again = repeated.select(F.col("doc_id").alias("again_id"), F.lit(True).alias("again"))
    lines = lines.join(again, F.col("doc_id").eqNullSafe(F.col("again_id")), "left")
    own = F.when(F.col("again"), F.col("doc_id")).alias("own")
    some = lines.groupBy(*KEY, "again", own).agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("id"))
    docs = F.when(F.col("again"), 1).otherwise(F.col("n"))
    return some.groupBy(*KEY).agg(F.sum(docs).alias("docs"), F.max("id").alias("id"))


def _without_lines(text: Column, gone: Column) -> Column:
    """The text without the lines at the sorted places ``gone``: the stretches between them, joined again."""
    lines = F.split(text, "\n", -1)
    edges = F.concat(F.array(F.lit(-1)), gone, F.array(F.size(lines)))

    def joined(bound: Column) -> Column:
        def stretch(i: Column) -> Column:
            before, after = F.get(bound["edges"], i), F.get(bound["edges"], i + 1)
            return F.slice(bound["lines"], before + 2, after - before - 1)

        return F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size(bound["edges"]) - 2), stretch)), "\n")

    # lines and edges are bound once, not once a stretch
    kept = F.get(F.transform(F.array(F.struct(lines.alias("lines"), edges.alias("edges"))), joined), 0)
    return F.when(F.size(gone) == 0, text).otherwise(kept)


def dedup_lines(
    spark: SparkSession,
    docs: DataFrame,
    least_chars: int = 20,
    least_docs: int = 3,
    batches: int = 4,
    fanout: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(doc_id, text, n_lines, n_dropped)`` of every row, the text without the repeated lines."""
    scratch = Scratch(spark)
    whole = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # rows of one id and one text lose the same lines, so the two name a row wherever it is read
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole.alias("text"))
    rows = rows.select("doc_id", "text", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"))
    ids = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    cuts = ids.agg(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)], 1000).alias("cuts")).first()["cuts"] or []
    # falling ids: the largest are batch 0, null ids the last
    batch = sum((F.when(F.col("doc_id") > c, 0).otherwise(1) for c in sorted(set(cuts))), F.lit(0))
    keyed = rows.select("doc_id", "h1", "h2", long_keys(F.col("text"), least_chars).alias("keys"), batch.alias("batch"))
    keyed = scratch.keep(keyed.where(F.size("keys") > 0), "line-keys")
    repeated = scratch.keep(ids.where("n > 1").select("doc_id"), "repeated-ids")
    repeated = None if repeated.isEmpty() else repeated

    runs = LineRuns(spark, fanout)
    for i in range(len(set(cuts)) + 1):
        runs.add(batch_keys(keyed.where(F.col("batch") == i), repeated))
    held = scratch.keep(runs.merged().where(F.col("docs") >= least_docs), "held-lines")
    runs.release()

    total = held.agg(F.sum("docs")).first()[0] or 0
    hot = F.col("docs") > total // HOT_KEYS  # fewer than HOT_KEYS keys can have more
    lines = keyed.select("doc_id", "h1", "h2", F.explode("keys").alias("k")).select("doc_id", "h1", "h2", "k.pos", "k.hi", "k.lo")
    few = F.broadcast(held.where(hot).select(*KEY, "keeper"))
    found = lines.join(few, KEY).select("doc_id", "h1", "h2", "pos", "keeper")
    rest = lines.join(F.broadcast(held.where(hot).select(*KEY)), KEY, "left_anti").join(held.where(~hot).select(*KEY, "keeper"), KEY)
    found = found.unionByName(rest.select("doc_id", "h1", "h2", "pos", "keeper"))
    found = found.where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    gone = found.groupBy(F.col("doc_id").alias("g_id"), F.col("h1").alias("g1"), F.col("h2").alias("g2")).agg(F.array_sort(F.collect_set("pos")).alias("gone"))
    gone = scratch.keep(gone, "dropped-lines")
    scratch.drop("line-keys")
    scratch.drop("held-lines")
    scratch.drop("repeated-ids")

    same = F.col("doc_id").eqNullSafe(F.col("g_id")) & (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2"))
    out = rows.join(gone, same, "left").withColumn("gone", F.coalesce("gone", F.array().cast("array<int>")))
    return out.select(
        "doc_id",
        _without_lines(F.col("text"), F.col("gone")).alias("text"),
        F.size(F.split("text", "\n", -1)).cast("long").alias("n_lines"),
        F.size("gone").cast("long").alias("n_dropped"),
    )

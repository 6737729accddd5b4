"""Near-duplicate groups by MinHash with tensored banding, links verified on full sets.

A document's set holds the distinct shingles of ``shingle`` words (``A-Z`` lower-cased, words
are cut at ASCII white space), as 64-bit fingerprints; a text of fewer words is one shingle.
Two small collections of ``groups`` keys each join ``rows`` minhashes to a key. A
table key pairs one key of the first collection with one of the second, so
``groups ** 2`` tables need only ``2 * groups * rows`` minhashes. Two documents of
Jaccard ``s`` share a table unless one collection has no equal key: at the
defaults and ``s = 0.8`` that has a probability of about 6e-6. Keys of four minhashes keep unrelated documents
(``s`` about 0.1) from sharing keys as the corpus grows.

Candidates never expand a bucket into all its pairs. Equal sets are one class from the start.
In a bucket each class meets the smallest one; met pairs are filtered by size and
verified on the full sets, and links merge into components. Equal buckets are worked on once.
Classes of buckets that still hold more than one component go on: in the buckets of the
first collection the next ``LEADERS`` (then four times as many, and so on) meet those after them in
tiles. A pair is verified once, if it shares a table, lies in two components and its bitmaps allow the
similarity (an exact bound), until every bucket is one component or all its pairs have met.

The planner sizes a staged table by its packed files, and one exploded from it as if it were not exploded. So a join
that could broadcast such a table is a merge join, unless its rows have been counted.

Edge cases: an empty or null text has an empty set, 0 shingles and no link. A null id is
linked with nothing: its ``component_id`` is null and it is kept. Rows that repeat an id count as
one document with the largest of their texts and give one row. An empty table gives no
rows. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, planned, slices, small_side

TILE = 512  # classes that meet as one matrix product
LEADERS = 1024  # classes of a bucket that meet all after them in the first round
BITS = 2048  # of a set's bitmap
_ROOM = 1 << 17  # word fingerprints kept by a worker
_FEW = 400_000  # rows of two longs that the planner may broadcast
_FEW_ITEMS = 4 << 20  # fingerprints of full sets that it may broadcast
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Fingerprints of the shingles of a text."""

    def __init__(self, width: int) -> None:
        self.width = width
        self.known: dict[bytes, int] = {}

    def _word(self, w: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(w)
        if len(self.known) < _ROOM:
            self.known[w] = h
        return h

    def shingles(self, text: str | None) -> np.ndarray:
        """Sorted distinct fingerprints."""
        found = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not found:
            return np.zeros(0, np.uint64)
        known, make = self.known.get, self._word
        h = np.array([known(w) or make(w) for w in found], np.uint64)
        n = min(self.width, len(h))
        out = np.full(len(h) - n + 1, n, np.uint64)
        for k in range(n):
            out = _mix(out * _MIX + h[k : len(h) - n + 1 + k])
        return np.unique(out)


def collections(fingerprints: np.ndarray, seeds: np.ndarray, rows: int) -> np.ndarray:
    """Keys of both collections: one for every ``rows`` minhashes."""
    low = np.full(len(seeds), np.iinfo(np.uint64).max)
    for at in range(0, len(fingerprints), 4096):  # a block of a very long text at a time
        part = fingerprints[at : at + 4096, None]
        low = np.minimum(low, ((part ^ (part >> np.uint64(29))) * seeds).min(0))
    key = np.arange(1, len(seeds) // rows + 1, dtype=np.uint64)
    for k in range(rows):
        key = _mix(key * _MIX + low[k::rows])
    return key.view(np.int64)


def bitmap(fingerprints: np.ndarray) -> bytes:
    """Which of the ``BITS`` classes of fingerprints a set has a member in. A class that one
    set has and another has not holds at least one fingerprint in which they differ."""
    out = np.zeros(BITS, bool)
    out[(fingerprints & np.uint64(BITS - 1)).astype(np.int64)] = True
    return np.packbits(out).tobytes()


def signatures(docs: DataFrame, shingle: int, groups: int, rows: int, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, n, same, bits, first, second)``: size, 128-bit fingerprint and bitmap of the
    set, and the keys of the two collections."""
    seeds = np.random.default_rng(1009).integers(1 << 62, 1 << 63, 2 * groups * rows, np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Shingler(shingle)
        for b in slices(batches):
            sets = [make.shingles(t) for t in b.column("text").to_pylist()]
            keys = [collections(s, seeds, rows) if len(s) else np.zeros(0, np.int64) for s in sets]
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    pa.array([bitmap(s) for s in sets], pa.binary()),
                    pa.array([k[:groups] for k in keys], longs),
                    pa.array([k[groups:] for k in keys], longs),
                ],
                ["doc_id", "n", "same", "bits", "first", "second"],
            )

    return _texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, n long, same binary, bits binary, first array<long>, second array<long>")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def _sets(docs: DataFrame, wanted: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, items)``: the full sets of the ``wanted`` documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Shingler(shingle)
        for b in slices(batches):
            sets = [make.shingles(t).view(np.int64) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(sets, pa.list_(pa.int64()))], ["doc_id", "items"])

    texts = _texts(docs, id_col, text_col).join(small_side(wanted), "doc_id", "left_semi")
    return texts.mapInArrow(run, "doc_id long, items array<long>")


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The ``(a, b)`` whose sets have a Jaccard of ``percent`` / 100 or more, counted in integers."""
    a = sets.select(F.col("doc_id").alias("a"), F.col("items").alias("a_items"))
    b = sets.select(F.col("doc_id").alias("b"), F.col("items").alias("b_items"))
    both = F.size(F.array_intersect("a_items", "b_items"))
    union = F.size("a_items") + F.size("b_items") - both
    # near copies pack well: files of a few MB may hold sets of very many
    if (sets.agg(F.sum(F.size("items"))).first()[0] or 0) > _FEW_ITEMS:
        a, pairs = a.hint("merge"), small_side(pairs)
    # many pairs may share one ``a``: it comes last, when a skewed partition shows its bytes and is split
    return pairs.join(b, "b").join(a, "a").where(100 * both >= percent * union).select("a", "b")


def components(spark: SparkSession, links: DataFrame, scratch: Scratch) -> DataFrame:
    """``(doc_id, component_id)`` of every linked document: the smallest id reachable, by
    alternating large-star and small-star steps on written tables."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    step, last = 0, None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        both = planned(both, 2 * _FEW)
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        edges = scratch.keep(small.where("u != v").distinct(), f"star-{step}")
        if last:
            scratch.drop(last)
        last, step = f"star-{step}", step + 1
        # done once every edge leads to a root: no node has two edges, none is both ends
        ends = edges.select("u").union(edges.select("v").distinct()).groupBy("u").agg(F.count(F.lit(1)).alias("c"))
        if not ends.where("c > 1").limit(1).count():
            break
    roots = edges.select(F.col("u").alias("doc_id"), F.col("v").alias("component_id"))
    return roots.union(edges.select(F.col("v").alias("doc_id"), F.col("v").alias("component_id")).distinct())


def live_keys(classes: DataFrame) -> DataFrame:
    """``(doc_id, n, first, second)`` with only those keys of the two collections that
    another class has too. Counts are combined before the shuffle, so a key that very
    many classes share is one row of each task."""
    groups = F.size("first")
    rows = classes.select("doc_id", "n", groups.alias("groups"), F.posexplode(F.concat("first", "second")).alias("pos", "key"))
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key")
    return (
        rows.join(shared, "key", "left_semi")
        .groupBy("doc_id")
        .agg(
            F.max("n").alias("n"),
            F.collect_list(F.when(F.col("pos") < F.col("groups"), F.col("key"))).alias("first"),
            F.collect_list(F.when(F.col("pos") >= F.col("groups"), F.col("key"))).alias("second"),
        )
        .where((F.size("first") > 0) & (F.size("second") > 0))
    )


def buckets(live: DataFrame) -> DataFrame:
    """``(bucket, doc_id, n, first)``: the different memberships of the tables' buckets of two or more, with the
    smallest of the first keys whose tables have that bucket (all its members share it)."""
    keys = F.explode(F.flatten(F.transform("first", lambda x: F.transform("second", lambda y: F.struct(x.alias("first"), F.xxhash64(x, y).alias("key"))))))
    rows = live.select("doc_id", "n", keys.alias("k")).select("doc_id", "n", "k.first", "k.key")
    low_bits = F.xxhash64("doc_id").bitwiseAND(0xFFFFFFFFFF)
    sums = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.sum(low_bits).alias("sum"))
    named = sums.where("size > 1").select("key", F.xxhash64("size", "low", "high", "sum").alias("bucket"))
    # once ``named`` proves large, the planner would broadcast ``rows``, of which it sees only the size of ``live``
    return rows.join(named.hint("merge"), "key").groupBy("bucket", "doc_id", "n").agg(F.min("first").alias("first"))


def near_pairs(ranked: DataFrame, leaders: int, percent: int) -> DataFrame:
    """``(a, a_n, b, b_n)``: pairs of ``ranked`` rows whose bitmaps allow the similarity, of the first
    ``leaders`` places of each bucket with all after them. Places are cut into tiles, and two tiles meet in
    one matrix product, so a very large bucket is many tasks. A pair is taken
    once, at its smallest shared bucket, and only if it also shares a key of the second collection."""
    tile = F.floor(F.col("place") / TILE).cast("int")
    sizes = ranked.groupBy("bucket").agg(F.max("place").alias("most"))
    rows = ranked.join(small_side(sizes), "bucket").withColumn("tile", tile)
    most = F.floor(F.col("most") / TILE).cast("int")
    # a row waits in its own tile for all tiles of leaders up to it, and goes as a leader to all tiles after it
    later = rows.select("*", F.explode(F.sequence(F.lit(0), F.least("tile", F.lit((leaders - 1) // TILE)))).alias("x"), F.col("tile").alias("y"), F.lit(1).alias("side"))
    first = rows.where((F.col("place") < leaders) & (F.col("tile") < most))
    first = first.select("*", F.col("tile").alias("x"), F.explode(F.sequence(F.col("tile") + 1, most)).alias("y"), F.lit(0).alias("side"))
    met = first.union(later).repartition("bucket", "x", "y").sortWithinPartitions("bucket", "x", "y", "side", "place")
    columns = ["bucket", "x", "y", "side", "doc_id", "n", "comp", "place", "bits", "first", "second"]

    def ones(rows: list[tuple]) -> np.ndarray:
        packed = np.frombuffer(b"".join(r[8] for r in rows), np.uint8).reshape(-1, BITS // 8)
        return np.unpackbits(packed, axis=1).astype(np.float32)

    def meet(rows: list[tuple]) -> Iterator[tuple]:
        right = [r for r in rows if r[3] == 1]
        left = [r for r in rows if r[3] == 0] or right  # a tile meets itself without a copy
        a, b = ones(left), ones(right)
        both = a @ b.T
        n, m = (np.array([r[5] for r in side], np.float64) for side in (left, right))
        most_shared = np.minimum(n[:, None] - (a.sum(1)[:, None] - both), m - (b.sum(1) - both))
        may = (100 + percent) * most_shared >= percent * (n[:, None] + m)
        may &= np.array([r[7] for r in left])[:, None] < np.array([r[7] for r in right])
        may &= np.array([r[6] for r in left])[:, None] != np.array([r[6] for r in right])
        for i, j in np.argwhere(may).tolist():
            x, y = left[i], right[j]
            if min(set(x[9]) & set(y[9])) == x[0] and not set(x[10]).isdisjoint(y[10]):
                yield x[4], x[5], y[4], y[5]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        out: list[tuple] = []

        def flush() -> pa.RecordBatch:
            done = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else [()] * 4)], ["a", "a_n", "b", "b_n"])
            out.clear()
            return done

        for batch in slices(batches):
            for row in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
                if held and row[:3] != held[0][:3]:
                    out.extend(meet(held))
                    held = []
                    if len(out) > 50_000:
                        yield flush()
                held.append(row)
        if held:
            out.extend(meet(held))
        yield flush()

    return met.select(*columns).mapInArrow(run, "a long, a_n long, b long, b_n long")


def _with_component(rows: DataFrame, comps: DataFrame) -> DataFrame:
    return rows.join(comps, "doc_id", "left").withColumn("comp", F.coalesce("component_id", "doc_id")).drop("component_id")


def _mixed(rows: DataFrame, by: str) -> DataFrame:
    """Buckets that hold several components."""
    return rows.groupBy(by).agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select(by)


def _verified(scratch: Scratch, docs: DataFrame, met: DataFrame, shingle: int, percent: int, id_col: str, text_col: str, step: str) -> DataFrame:
    """The links among ``met (a, a_n, b, b_n)``, from the full sets."""
    pairs = scratch.keep(met.where(_fits(percent)).select("a", "b").distinct(), f"pairs-{step}")
    if not pairs.limit(1).count():
        return pairs
    wanted = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    sets = scratch.keep(_sets(docs, wanted, shingle, id_col, text_col), f"sets-{step}")
    links = scratch.keep(linked(pairs, sets, percent), f"links-{step}")
    scratch.drop(f"sets-{step}")
    scratch.drop(f"pairs-{step}")
    return links


def _fits(percent: int) -> F.Column:
    return 100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n")


def near_duplicates(
    spark: SparkSession,
    docs: DataFrame,
    shingle: int = 5,
    percent: int = 80,
    groups: int = 24,
    rows: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` of every document."""
    scratch = Scratch(spark)
    found = scratch.keep(signatures(docs, shingle, groups, rows, id_col, text_col), "signatures")
    repeated = found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1")
    if repeated.limit(1).count():
        ids = repeated.select("doc_id")
        once = scratch.keep(_united(docs, ids, id_col, text_col), "united")
        again = signatures(once, shingle, groups, rows, "doc_id", "text")
        found = scratch.keep(found.join(ids, "doc_id", "left_anti").union(again), "signatures-once")
        docs, id_col, text_col = _texts(docs, id_col, text_col).join(ids, "doc_id", "left_anti").union(once), "doc_id", "text"
    classes = found.where("doc_id is not null and n > 0").groupBy("same").agg(F.min("doc_id").alias("doc_id"))
    classes = scratch.keep(classes, "classes")  # so that joins on a hot class have plain shuffles, which can be split
    reps = found.select("doc_id", "n", "first", "second").join(planned(classes.select("doc_id"), _FEW), "doc_id")
    live = scratch.keep(live_keys(reps), "live")
    todo = scratch.keep(buckets(live), "buckets")
    lead = todo.groupBy("bucket").agg(F.min(F.struct("doc_id", "n")).alias("a"))
    met = planned(todo, _FEW).join(lead, "bucket").where("doc_id != a.doc_id")
    pairs = met.select(F.col("a.doc_id").alias("a"), F.col("a.n").alias("a_n"), F.col("doc_id").alias("b"), F.col("n").alias("b_n"))
    links = _verified(scratch, docs, pairs, shingle, percent, id_col, text_col, "0")
    comps = planned(scratch.keep(components(spark, links, scratch), "components-0"), _FEW)

    # what the leaders left open: documents with a first key of a bucket in which several components remain
    rest = _with_component(met.select("bucket", "doc_id", "first"), comps)
    mixed = rest.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min("first").alias("key")).where("lo < hi").select("key").distinct()
    # one row a document and first key, not one a document and table
    unsure = live.select("doc_id", F.explode("first").alias("key")).join(mixed, "key", "left_semi").select("doc_id").distinct()
    ints = [F.transform(c, lambda x: F.hash(x)).alias(c) for c in ("first", "second")]
    keyed = live.join(unsure, "doc_id", "left_semi").select("doc_id", "n", *ints).join(found.select("doc_id", "bits"), "doc_id")
    todo = scratch.keep(keyed.select("*", F.explode(F.array_distinct("first")).alias("bucket")), "todo-0")
    scratch.drop("buckets")
    scratch.drop("live")
    step, leaders = 1, LEADERS
    while True:
        todo = _with_component(todo, comps)
        todo = todo.join(_mixed(todo, "bucket"), "bucket", "left_semi")
        place = F.row_number().over(W.partitionBy("bucket").orderBy("doc_id")) - 1
        ranked = scratch.keep(todo.withColumn("place", place), f"ranked-{step}")
        scratch.drop(f"todo-{step - 1}")
        if not ranked.limit(1).count():
            break
        pairs = near_pairs(ranked, leaders, percent)
        new = _verified(scratch, docs, pairs, shingle, percent, id_col, text_col, str(step))
        if new.limit(1).count():
            links = links.union(new)
            comps = planned(scratch.keep(components(spark, links, scratch), f"components-{step}"), _FEW)
        todo = scratch.keep(ranked.where(F.col("place") >= leaders).drop("place", "comp"), f"todo-{step}")
        scratch.drop(f"ranked-{step}")
        step, leaders = step + 1, leaders * 4
    rep = planned(classes.select("same", F.col("doc_id").alias("rep")), _FEW // 4)
    out = found.select("doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.col("same")).alias("same")).join(rep, "same", "left")
    out = out.join(comps.select(F.col("doc_id").alias("rep"), "component_id"), "rep", "left")
    component = F.coalesce("component_id", "rep", "doc_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _united(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row for each repeated id, with the largest of its texts."""
    return _texts(docs, id_col, text_col).join(ids, "doc_id", "left_semi").groupBy("doc_id").agg(F.max("text").alias("text"))


def one_row_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with only the row of the largest text for each id that several rows repeat."""
    counts = docs.where(F.col(id_col).isNotNull()).groupBy(id_col).count().where("count > 1").select(id_col)
    if not counts.limit(1).count():
        return docs
    row = F.max_by(F.struct(*docs.columns), F.coalesce(F.col(text_col), F.lit("")))
    again = docs.join(counts, id_col, "left_semi").groupBy(id_col).agg(row.alias("row")).select("row.*")
    return docs.join(counts, id_col, "left_anti").select(*docs.columns).union(again)

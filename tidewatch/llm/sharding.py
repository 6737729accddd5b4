"""Sharding by minimax contiguous partition of atomic groups.

All documents of equal text are one group and stay together. Groups stand in the order of
their smallest id; the ``shards`` runs of that order have the smallest
possible largest size (UTF-8 bytes plus one a document). That capacity comes from a binary
search whose check cuts greedily. The cuts then go where shards come out most even within it.

The running sizes of all groups never reach the driver. A search works on a bounded
sorted list of known running sizes; between two of them the true cut is only bounded,
which bounds the capacity from both sides. Each round reads the smallest and largest running size
of at most ``FENCES`` cells, only where a cut can still lie, until capacity and cuts are exact. A
round divides the open stretches by thousands, so two or three rounds do for any table.

Groups are told apart by the SHA-256 of the text, so no text is shuffled.

Edge cases: null texts are one group of size 1 a row; their ``text_crc32`` is that of ''.
A null id comes first in its shard. Repeated rows are rows of their group. If there are fewer groups than
shards, some shards are empty. An empty table gives no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch

FENCES = 1 << 16


@dataclass
class Fences:
    """Known running sizes; ``open`` says which stretches between them hold unknown ones."""

    known: list[int] = field(default_factory=lambda: [0])
    open: list[bool] = field(default_factory=list)

    def last(self, x: int) -> tuple[int, int]:
        """Bounds of the largest running size up to ``x``."""
        at = bisect_right(self.known, x) - 1
        if at == len(self.known) - 1 or not self.open[at]:
            return self.known[at], self.known[at]
        return self.known[at], x

    def cuts(self, capacity: int, shards: int) -> list[tuple[int, int]]:
        """Bounds of the greedy cuts."""
        low = high = 0
        out = []
        for _ in range(shards):
            low, high = self.last(low + capacity)[0], self.last(high + capacity)[1]
            out.append((low, high))
        return out

    def capacity(self, shards: int, sure: bool) -> int:
        """The least capacity that surely, or possibly, reaches the end."""
        total, low = self.known[-1], 0
        high = total
        while low < high:
            mid = (low + high) // 2
            end = self.cuts(mid, shards)[-1]
            low, high = (low, mid) if end[0 if sure else 1] >= total else (mid + 1, high)
        return low


def refined(totals: DataFrame, fences: Fences, inside: set[int]) -> Fences:
    """``fences`` with more running sizes in the open stretches ``inside``."""
    runs: list[list[int]] = []
    for i in sorted(inside):
        if runs and runs[-1][1] == fences.known[i]:
            runs[-1][1] = fences.known[i + 1]
        else:
            runs.append([fences.known[i], fences.known[i + 1]])
    cells = max(2, FENCES // len(runs))  # of each run
    where, base, width = F.lit(False), F.lit(0), F.lit(1)
    for a, b in runs:
        here = (F.col("upto") > a) & (F.col("upto") <= b)
        where, base, width = where | here, F.when(here, a).otherwise(base), F.when(here, max(1, -(-(b - a) // cells))).otherwise(width)
    inner = totals.where(where).select("upto", base.alias("a"), F.floor((F.col("upto") - base - 1) / width).alias("cell"))
    got = inner.groupBy("a", "cell").agg(F.min("upto").alias("low"), F.max("upto").alias("high"), F.countDistinct("upto").alias("n"))
    opened = {fences.known[i + 1]: fences.open[i] and i not in inside for i in range(len(fences.open))}
    for r in got.collect():  # at most FENCES rows, or two a run
        opened[r["low"]] = False
        opened[r["high"]] = r["n"] > 2
    known = sorted(opened)
    return Fences([0, *known], [opened[k] for k in known])


def least_capacity(totals: DataFrame, shards: int) -> tuple[int, Fences]:
    """Of ``(upto)``, the running size after each group: the minimax capacity, and what is known then."""
    total = totals.agg(F.max("upto")).first()[0]
    if total is None:
        return 0, Fences([0], [])
    fences = Fences([0, total], [True])
    while True:
        possible, sure = fences.capacity(shards, False), fences.capacity(shards, True)
        if possible == sure:
            return sure, fences
        inside = set()  # stretches in which some cut may lie
        for a, b in zip(fences.cuts(possible, shards), fences.cuts(sure, shards), strict=True):
            first, last = bisect_right(fences.known, a[0]) - 1, bisect_right(fences.known, b[1]) - 1
            inside.update(i for i in range(first, min(last, len(fences.open) - 1) + 1) if fences.open[i])
        fences = refined(totals, fences, inside)


def shard_ends(totals: DataFrame, shards: int) -> tuple[int, list[int]]:
    """The minimax capacity and the shards' ends: each cut lies next to an even share of what
    is left, as far as the capacity allows it and leaves room for the rest."""
    capacity, fences = least_capacity(totals, shards)
    total = fences.known[-1]
    while True:
        unsure: set[int] = set()

        def last(x: int) -> int:
            at = bisect_right(fences.known, x) - 1
            if fences.known[at] != x and at < len(fences.open) and fences.open[at]:
                unsure.add(at)
            return fences.known[at]

        def first(x: int) -> int:
            at = bisect_left(fences.known, x)
            if fences.known[at] != x and fences.open[at - 1]:
                unsure.add(at - 1)
            return fences.known[at]

        earliest = [total] * shards
        for i in range(shards - 2, -1, -1):
            earliest[i] = first(max(0, earliest[i + 1] - capacity))
        ends = [0]
        for i in range(shards):
            share = ends[-1] + (total - ends[-1]) // (shards - i)
            low, high = last(share), first(share)
            near = high if low <= ends[-1] or high - share < share - low else low
            ends.append(min(max(near, earliest[i]), last(ends[-1] + capacity)))
        if not unsure:
            return capacity, ends[1:]
        fences = refined(totals, fences, unsure)


def running_sizes(scratch: Scratch, groups: DataFrame) -> DataFrame:
    """``groups (key, first, size)`` with ``upto``, the size of all groups up to this one."""
    dealt = groups.repartitionByRange("first", "key").withColumn("part", F.spark_partition_id())
    dealt = scratch.keep(dealt, "groups")
    # one row a partition
    base = dealt.groupBy("part").agg(F.sum("size").alias("size"))
    base = base.select("part", (F.sum("size").over(W.orderBy("part")) - F.col("size")).alias("base"))
    inside = W.partitionBy("part").orderBy("first", "key")
    rows = dealt.withColumn("inside", F.sum("size").over(inside)).join(base, "part")
    return scratch.keep(rows.select("key", (F.col("base") + F.col("inside")).alias("upto")), "running")


def slots(scratch: Scratch, rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows (shard, ...)`` with ``slot``, gapless from 0 in each shard."""
    dealt = rows.repartitionByRange("shard", *order).withColumn("part", F.spark_partition_id())
    dealt = scratch.keep(dealt, "dealt")
    # one row a partition and shard that meet, at most partitions plus shards of them
    base = dealt.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    base = base.withColumn("base", F.sum("n").over(W.partitionBy("shard").orderBy("part")) - F.col("n"))
    inside = F.row_number().over(W.partitionBy("part", "shard").orderBy(*order)) - 1
    return dealt.withColumn("inside", inside).join(base.select("shard", "part", "base"), ["shard", "part"]).withColumn("slot", F.col("base") + F.col("inside"))


def shard_documents(
    spark: SparkSession, docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, size, text_crc32, shard, slot)`` of every row."""
    scratch = Scratch(spark)
    text = F.col(text_col).cast("string")
    raw = F.coalesce(text, F.lit("")).cast("binary")
    key: Column = F.when(text.isNotNull(), F.unhex(F.sha2(raw, 256)))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"), F.coalesce(key, F.lit(b"")).alias("key"))
    rows = scratch.keep(rows, "sizes")
    groups = rows.groupBy("key").agg(F.min("doc_id").alias("first"), F.sum("size").alias("size"))
    running = running_sizes(scratch, groups)
    _, ends = shard_ends(running.select("upto"), shards)
    shard = sum((F.when(F.col("upto") > end, 1).otherwise(0) for end in ends[:-1]), F.lit(0)).cast("int")
    placed = rows.join(running.select("key", shard.alias("shard")), "key").drop("key")
    return slots(scratch, placed, ["doc_id", "text_crc32", "size"]).select("doc_id", "size", "text_crc32", "shard", "slot")

"""Importance resampling towards a target distribution, over hashed word runs.

``A-Z`` is lower-cased and words are the runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``. Features of a text are all its
runs of 1 to ``runs`` consecutive words joined by one space; a feature's bucket is the CRC-32 of its bytes modulo
``buckets``. A bucket's gain is the log ratio of its smoothed shares in the target and in the corpus, a document's weight
the sum of the gains of its features, and its score the weight plus a Gumbel draw from its id. The documents of the
highest scores are drawn.

CRC-32 by position table: the CRC is linear over GF(2), so a message's CRC is the XOR of one term a byte,
which depends on the byte and its distance from the end, and of a constant of the length (the CRC of as many
zero bytes). The terms of all bytes of all features of a block are gathered from a table ``distance x byte`` and
folded by ``bitwise_xor.reduceat`` over the features' spans. A span longer than the table is folded in blocks: the
register after a block is advanced over the next block's zeros by four more tables and XORed with the block's terms.

Texts are read twice (counts, then weights), never shuffled; a task sends one row a bucket. The counts are ``buckets``
rows of fixed number, so they may pass through the driver. Ranks are numbered by range partitions of the scores.

Edge cases: a null text has no words, no features and weight 0. A null id draws like the id '' and ranks last among ties.
Rows that repeat an id are documents of their own, with the same draw. Equal scores rank by smaller id. Very long
texts and words are worked on in blocks. An empty table gives no rows; an empty target counts nothing. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, slices

TABLE = 128  # distances from the end that the table covers
BLOCK = 1 << 18  # about so many bytes of words are worked on at a time

# fixed by the contract: ASCII digits, letters and everything beyond ASCII are parts of words
_IS_WORD = np.array([48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


@cache
def position_table(size: int = TABLE) -> np.ndarray:
    """``[distance * 256 + byte]``: what a byte so far from the end adds to the CRC register."""
    step = np.array([zlib.crc32(bytes([b])) ^ zlib.crc32(b"\0") for b in range(256)], np.uint32)
    rows = [step]
    for _ in range(size - 1):
        last = rows[-1]
        rows.append((last >> np.uint32(8)) ^ step[last & np.uint32(255)])
    return np.concatenate(rows)


@cache
def advance_tables(size: int = TABLE) -> np.ndarray:
    """``[4, 256]``: a register's byte moved over ``size`` zero bytes."""
    step = position_table(1)
    out = np.empty((4, 256), np.uint32)
    for k in range(4):
        reg = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
        for _ in range(size):
            reg = (reg >> np.uint32(8)) ^ step[reg & np.uint32(255)]
        out[k] = reg
    return out


def length_constants(lengths: np.ndarray) -> np.ndarray:
    """CRC of as many zero bytes, for each length."""
    distinct, at = np.unique(lengths, return_inverse=True)
    return np.array([_zeros_crc(int(n)) for n in distinct], np.uint32)[at]


@cache
def _zeros_crc(n: int) -> int:
    return zlib.crc32(bytes(n))


def _terms(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """XOR of the terms of each span ``data[start : start + length]``, all of 1 to ``TABLE`` bytes."""
    upto = np.cumsum(lengths)
    first = upto - lengths
    place = np.arange(upto[-1])
    byte = data[place + np.repeat(starts - first, lengths)]
    distance = np.repeat(upto - 1, lengths) - place
    return np.bitwise_xor.reduceat(position_table()[(distance << 8) | byte], first)


def span_crcs(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of every span of ``data`` (bytes); spans hold at least one byte."""
    out = np.empty(len(starts), np.uint32)
    if not len(starts):
        return out
    short = lengths <= TABLE
    if short.any():
        out[short] = _terms(data, starts[short], lengths[short])
    if not short.all():
        moved = advance_tables()
        at, left = starts[~short], lengths[~short]
        head = (left - 1) % TABLE + 1  # the first block takes the rest, all later ones are full
        reg = _terms(data, at, head)
        at, left = at + head, left - head
        going = np.arange(len(reg))
        while len(going):
            r = reg[going]
            r = moved[0][r & 255] ^ moved[1][(r >> 8) & 255] ^ moved[2][(r >> 16) & 255] ^ moved[3][r >> 24]
            reg[going] = r ^ _terms(data, at[going], np.full(len(going), TABLE))
            at[going] += TABLE
            left[going] -= TABLE
            going = going[left[going] > 0]
        out[~short] = reg
    return out ^ length_constants(lengths)


def words_of(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts laid end to end (``ends`` are their ends): the words, each followed by one
    space, their starts and lengths there, the text of each, and their starts in ``data``."""
    inside = _IS_WORD[data]
    edge = np.zeros(len(data) + 1, bool)  # a text's end parts words as well
    edge[ends] = True
    edge[[0, -1]] = True
    opens = inside & edge[:-1]
    opens[1:] |= inside[1:] & ~inside[:-1]
    closes = inside & edge[1:]
    closes[:-1] |= inside[:-1] & ~inside[1:]
    start, stop = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    length = stop - start
    at = np.cumsum(length + 1) - (length + 1)
    out = np.full(int((length + 1).sum()), 32, np.uint8)
    place = np.arange(int(length.sum()))
    shift = np.cumsum(length) - length
    out[place + np.repeat(at - shift, length)] = _LOWER[data[place + np.repeat(start - shift, length)]]
    return out, at, length, np.searchsorted(ends, start, "right"), start


def features(data: np.ndarray, ends: np.ndarray, runs: int, block: int = BLOCK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(words, text, crc)`` of all features of so many words, block by block. A feature belongs to the
    block of its last word; the last words of the block before are read again for it."""
    upto, fresh = 0, 0  # blocks are read from ``upto``; words from ``fresh`` on are new
    while fresh < len(data):
        stop = min(fresh + block, len(data))
        while stop < len(data):  # up to a place where no word is cut
            apart = np.flatnonzero(~_IS_WORD[data[stop : stop + block]])
            if len(apart):
                stop += int(apart[0])
                break
            stop = min(stop + block, len(data))
        words, at, length, text, start = words_of(data[upto:stop], np.clip(ends - upto, 0, stop - upto))
        known = int(np.searchsorted(start, fresh - upto, "left"))
        for k in range(runs):
            last = np.arange(max(known, k), len(at))
            last = last[text[last] == text[last - k]]
            if len(last):
                first = last - k
                yield k + 1, text[last], span_crcs(words, at[first], at[last] + length[last] - at[first])
        if len(start) and runs > 1:
            upto += int(start[max(0, len(start) - (runs - 1))])
        else:
            upto = stop
        fresh = stop


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column laid end to end, and the end of each text (null: empty)."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets[1:] - offsets[0]


def bucket_counts(texts: DataFrame, runs: int, buckets: int) -> np.ndarray:
    """How many features of ``texts (text)`` fall in each bucket; ``buckets`` numbers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, np.int64)
        for b in batches:
            for part in slices([b]):
                for _, _, crc in features(*_texts(part.column(0)), runs):
                    n += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        some = np.flatnonzero(n)
        yield pa.record_batch([pa.array(some), pa.array(n[some])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in texts.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most ``buckets`` rows
        out[r["bucket"]] = r["n"]
    return out


def gains(target: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    """``floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B))))`` of each bucket, in doubles."""
    b = float(len(corpus))
    all_t, all_s = float(target.sum()), float(corpus.sum())
    ratio = (target + 1.0) * (all_s + b) / ((corpus + 1.0) * (all_t + b))
    return np.array([math.floor(1000 * math.log(x)) for x in ratio], np.int64)


def draw(doc_id: int | None, salt: str = "42") -> int:
    """The Gumbel draw of an id, in thousandths."""
    h = int(hashlib.sha256(f"{salt}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(docs: DataFrame, gain: np.ndarray, runs: int) -> DataFrame:
    """``(doc_id, n_words, n_features, weight, score)`` of every row of ``docs (doc_id, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices([whole]):
                n = b.num_rows
                words, found, weight = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
                for k, text, crc in features(*_texts(b.column(1)), runs):
                    part = np.bincount(text, minlength=n)
                    found += part
                    words += part if k == 1 else 0
                    # features come in the order of their texts
                    opens = np.flatnonzero(np.diff(text, prepend=-1))
                    weight[text[opens]] += np.add.reduceat(gain[crc % np.uint32(len(gain))], opens)
                score = weight + np.array([draw(i) for i in b.column(0).to_pylist()], np.int64)
                yield pa.record_batch([b.column(0), pa.array(words), pa.array(found), pa.array(weight), pa.array(score)], ["doc_id", "n_words", "n_features", "weight", "score"])

    return docs.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long, score long")


def ranked(scratch: Scratch, rows: DataFrame) -> DataFrame:
    """``rows`` with ``place``: 1 for the highest score, ties to the smaller id (null last)."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]
    dealt = scratch.keep(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "dealt")
    base = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # one row a partition
    base = base.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("base"))
    inside = F.row_number().over(W.partitionBy("part").orderBy(*order))
    return dealt.withColumn("inside", inside).join(F.broadcast(base), "part").withColumn("place", F.col("base") + F.col("inside"))


def resample(
    spark: SparkSession,
    docs: DataFrame,
    target: DataFrame,
    percent: int = 5,
    least_words: int = 20,
    runs: int = 3,
    buckets: int = 10_000,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)`` of every row; ``rank`` counts the drawn ones, else null."""
    scratch = Scratch(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    corpus = bucket_counts(rows.select("text"), runs, buckets)
    wanted = bucket_counts(target.select(F.col(target_text_col).cast("string").alias("text")), runs, buckets)
    scored = weigh(rows, gains(wanted, corpus), runs).withColumn("row", F.monotonically_increasing_id())
    scored = scratch.keep(scored, "scores")
    columns = ["doc_id", "n_features", "weight", "score"]
    able = F.col("n_words") >= least_words
    drawn = percent * scored.where(able).count() // 100
    first = ranked(scratch, scored.where(able))
    rank = F.when(F.col("place") <= drawn, F.col("place")).cast("long").alias("rank")
    rest = scored.where(~able).select(*columns, F.lit(None).cast("long").alias("rank"))
    return first.select(*columns, rank).unionByName(rest)

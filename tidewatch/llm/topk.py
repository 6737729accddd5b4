"""Exact top-k search by tiled matrix products.

Queries and candidates are dealt into blocks of at most ``query_block`` and ``shard_rows``
vectors; a tile is one query block against one candidate shard. Every tile is one matrix
product and a partial selection of each query's k best, so a task holds one tile. The
partial lists are merged in a tree, ``FAN_IN`` lists at a time.

A component x counts as ``floor(scale * x)``, x as a double, and the score is the exact
integer inner product: in double arithmetic while every partial sum stays below 2**53, in
Python integers beyond that (a score outside the range of a long is held at its end).
Equal scores go to the smaller id.

Edge cases: vectors that are null, empty, or hold a null or non-finite component take no part, nor do
rows with a null id. Shorter vectors count as if zeros followed. A query meets every row
but those with its own id; rows that repeat an id and its vector count once. No queries or
no candidates give no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch

FAN_IN = 16
_LONG = np.iinfo(np.int64)


def _matrix(vectors: pd.Series, width: int, scale: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    with np.errstate(over="ignore"):
        return np.clip(np.floor(out * scale), -1e306, 1e306)


def _integers(m: np.ndarray) -> np.ndarray:
    out = np.empty(m.shape, object)
    for at in np.ndindex(m.shape):
        out[at] = int(m[at])
    return out


def products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products of integer-valued doubles."""
    top = float(np.abs(queries).max(initial=0) + 1), float(np.abs(rows).max(initial=0) + 1)
    if max(top) < 2**53 and top[0] * top[1] * (queries.shape[1] + 1) < 2**53:
        return queries @ rows.T
    return np.clip(_integers(queries) @ _integers(rows).T, _LONG.min, _LONG.max)


def best(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of each query's k best; ``ids`` ascend, so ties keep their order."""
    rows, cols = [], []
    for q in range(len(scores)):
        s = scores[q]
        at = np.flatnonzero(ids != own[q])
        if len(at) > k:
            least = np.partition(s[at], len(at) - k)[len(at) - k]
            above, equal = at[s[at] > least], at[s[at] == least]
            at = np.concatenate([above, equal[: k - len(above)]])
        rows.append(np.full(len(at), q))
        cols.append(at)
    return (np.concatenate(rows), np.concatenate(cols)) if rows else (np.zeros(0, int), np.zeros(0, int))


def _merged(lists: DataFrame, k: int, by: list[str]) -> DataFrame:
    place = F.row_number().over(W.partitionBy(*by).orderBy(F.desc("score"), "vec_id"))
    return lists.withColumn("rank", place).where(F.col("rank") <= k)


def top_k(
    spark: SparkSession,
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    scale: int = 256,
    query_block: int = 1024,
    shard_rows: int = 8192,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``; ``is_query`` is a condition on ``vec_id``."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & (F.size("v") > 0) & fine).distinct()
    scratch = Scratch(spark)
    rows = scratch.keep(rows, "vectors")
    sizes = rows.agg(F.count(F.lit(1)), F.count(F.when(is_query, 1)), F.max(F.size("v"))).first()
    shards, blocks, width = max(1, -(-sizes[0] // shard_rows)), max(1, -(-sizes[1] // query_block)), sizes[2] or 0
    dealt = rows.withColumn("h", F.xxhash64("vec_id"))
    # each shard meets each block: the shard travels once a block, the block once a shard
    candidates = dealt.select(
        F.col("vec_id").alias("row_id"),
        F.col("v").alias("row_v"),
        F.pmod("h", F.lit(shards).cast("long")).alias("row_shard"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("row_block"),
    )
    queries = dealt.where(is_query).select("vec_id", "v", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"), F.pmod("h", F.lit(blocks)).cast("int").alias("block"))

    def tile(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query_id": [], "shard": [], "vec_id": [], "score": []})
        right = right.sort_values("row_id")
        ids, own, m = right["row_id"].to_numpy(), left["vec_id"].to_numpy(), _matrix(right["row_v"], width, scale)
        out = []
        for at in range(0, len(own), 256):
            q = own[at : at + 256]
            scores = products(_matrix(left["v"].iloc[at : at + 256], width, scale), m)
            r, c = best(scores, ids, q, k)
            out.append(pd.DataFrame({"query_id": q[r], "shard": key[0], "vec_id": ids[c], "score": scores[r, c].astype(np.int64)}))
        return pd.concat(out)

    pairs = queries.groupBy("shard", "block").cogroup(candidates.groupBy("row_shard", "row_block"))
    lists = pairs.applyInPandas(tile, "query_id long, shard long, vec_id long, score long")
    while shards > FAN_IN:
        shards = -(-shards // FAN_IN)
        lists = _merged(lists.withColumn("shard", F.floor(F.col("shard") / FAN_IN)), k, ["query_id", "shard"]).drop("rank")
    return _merged(lists, k, ["query_id"]).select("query_id", "rank", "vec_id", "score")

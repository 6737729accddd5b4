"""Prefix trie of conversations from vertical bitmaps.

A conversation is the sequence of its turns ``(role, text)`` in the order of ``turn`` (null first, ties by
role and text). Conversation ``c`` is rebuilt: the first ``h`` turns of conversation ``c - c % group``, then
its own turns after its first ``h``, with ``h`` the CRC-32 of the decimal ``c`` modulo ``heads``. Each distinct sequence
of the first ``d`` rebuilt turns is a node of depth ``d``; the conversations that start with it are its members.

Shards are ranges of conversation ids of about ``shard_conversations`` conversations at most. A shard's index maps (position,
turn) to the bitset of conversations with that turn there. Depth first, the children of a node come from intersecting its
bitset with the postings of the next position: the lowest conversation not yet covered names the next turn. Popcounts are the members,
the lowest bit the smallest member, and the intersection with the conversations of that length the end list.

Shards know a node by a 128-bit hash of its turns. A node that only one shard has is complete with its whole subtree.
For a node that several have, the shard of its smallest member owns it; sums over subtrees are the shards' sums
less what each counted of nodes that it does not own, and end lists are joined in the order of the shards, which
is that of the ids, in a stream. So no node's members meet in one task: a node is one row a shard.

Turns are hashed before Python sees them. Edge cases: a null role or text is empty; rows with a null ``conv_id`` belong to no
conversation and are ignored; repeated rows are repeated turns; a conversation whose rebuilt form has no turn is a member of the root.
An empty table has no nodes. Other columns are ignored. A shard holds at least one group of ids, however long its conversations.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch

SHARD_CONVERSATIONS = 4096
SHARD_TURNS = 100_000
ROOT = bytes(16)
WORD = r"[^\x20\x09-\x0D]+"

LOCAL_SCHEMA = (
    "shard long, seq int, parent int, node binary, depth long, conv_id long, n_convs long, words long, "
    "n_children long, leaf boolean, saved long, distinct_words long, leaves long, ends string"
)
PART_SCHEMA = (
    "shared boolean, node binary, shard long, conv_id long, depth long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, ends string"
)
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
NODE_SCHEMA = ", ".join(f"{c} {'string' if c == 'ends_sha256' else 'long'}" for c in RESULT)

Turn = tuple[bytes, int]  # hash and number of words


def members(bits: int, ids: list[int]) -> list[int]:
    if bits.bit_count() < 16:
        out = []
        while bits:
            low = bits & -bits
            out.append(ids[low.bit_length() - 1])
            bits ^= low
        return out
    raw = np.frombuffer(bits.to_bytes((bits.bit_length() + 7) // 8, "little"), np.uint8)
    return [ids[i] for i in np.flatnonzero(np.unpackbits(raw, bitorder="little")).tolist()]


def shard_nodes(conversations: list[tuple[int, list[Turn]]]) -> pd.DataFrame:
    """The nodes of one shard, parents first (``LOCAL_SCHEMA``); conversations have rising ids."""
    ids = [c for c, _ in conversations]
    postings: list[dict[bytes, int]] = []
    words: list[dict[bytes, int]] = []
    ended: dict[int, int] = {}
    for i, (_, turns) in enumerate(conversations):
        bit = 1 << i
        ended[len(turns)] = ended.get(len(turns), 0) | bit
        while len(postings) < len(turns):
            postings.append({})
            words.append({})
        for d, (sign, n) in enumerate(turns):
            postings[d][sign] = postings[d].get(sign, 0) | bit
            words[d][sign] = n
    parent, node, depth, first, count, n_words, ends = [], [], [], [], [], [], []
    todo: list[tuple[int, bytes, int, int, int]] = [(-1, ROOT, 0, (1 << len(ids)) - 1, 0)]
    while todo:
        above, name, d, bits, n = todo.pop()
        seq = len(node)
        parent.append(above)
        node.append(name)
        depth.append(d)
        first.append(ids[(bits & -bits).bit_length() - 1])
        count.append(bits.bit_count())
        n_words.append(n)
        done = bits & ended.get(d, 0)
        ends.append(",".join(map(str, members(done, ids))))
        rest = bits & ~done
        while rest:
            sign = conversations[(rest & -rest).bit_length() - 1][1][d][0]
            child = bits & postings[d][sign]
            rest &= ~child
            todo.append((seq, hashlib.blake2b(name + sign, digest_size=16).digest(), d + 1, child, words[d][sign]))
    size = len(node)
    children, leaves = [0] * size, [0] * size
    saved = [c * w for c, w in zip(count, n_words, strict=True)]
    distinct = list(n_words)
    for i in range(size - 1, 0, -1):
        if not children[i]:
            leaves[i] = 1
        p = parent[i]
        children[p] += 1
        leaves[p] += leaves[i]
        saved[p] += saved[i]
        distinct[p] += distinct[i]
    if not children[0]:
        leaves[0] = 1
    return pd.DataFrame(
        {
            "shard": ids[0], "seq": np.arange(size, dtype=np.int32), "parent": np.array(parent, np.int32), "node": node, "depth": depth, "conv_id": first,
            "n_convs": count, "words": n_words, "n_children": children, "leaf": [c == 0 for c in children], "saved": saved, "distinct_words": distinct,
            "leaves": leaves, "ends": ends,
        }
    )


def rebuilt(base: int, own: list[tuple[int, int, list[Turn]]]) -> list[tuple[int, list[Turn]]]:
    """Conversations ``(id, h, turns)`` of one group with the heads of the base conversation."""
    head = next((turns for c, _, turns in own if c == base), [])
    return [(c, head[:h] + turns[h:]) for c, h, turns in own]


def _shards(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Rows ``(base, conv_id, h, sign, words)`` in the order of base, conversation and turn to nodes."""
    ready: list[tuple[int, list[Turn]]] = []
    group: list[tuple[int, int, list[Turn]]] = []
    base, turns = None, 0

    def close() -> Iterator[pa.RecordBatch]:
        """The group is complete: add it to the shard, which goes out first if it would get too large."""
        nonlocal ready, group, turns
        if not group:
            return
        more = rebuilt(base, group)
        size = sum(len(t) for _, t in more)
        if ready and (len(ready) + len(more) > most or turns + size > SHARD_TURNS):
            yield flush()
        ready += more
        turns += size
        group = []

    def flush() -> pa.RecordBatch:
        nonlocal ready, turns
        out = pa.RecordBatch.from_pandas(shard_nodes(ready), preserve_index=False)
        ready, turns = [], 0
        return out

    for b in batches:
        for at in range(0, b.num_rows, 10_000):
            for bs, c, h, sign, n in zip(*(col.to_pylist() for col in b.slice(at, 10_000).columns), strict=True):
                if bs != base:
                    yield from close()
                    base = bs
                if not group or group[-1][0] != c:
                    group.append((c, h, []))
                group[-1][2].append((sign, n))
    yield from close()
    if ready:
        yield flush()


def _settle(key: tuple, local: pd.DataFrame, info: pd.DataFrame) -> pd.DataFrame:
    """Of one shard: final rows of its own nodes, and its parts of shared ones, without what it does not own."""
    local = local.sort_values("seq", ignore_index=True)
    size = len(local)
    parent = local["parent"].to_numpy()
    conv = local["conv_id"].to_numpy(np.int64).copy()
    words, leaf = local["words"].to_numpy(np.int64), local["leaf"].to_numpy(bool)
    less_words, less_leaves, less_children = (np.zeros(size, np.int64) for _ in range(3))
    shared = np.zeros(size, bool)
    info = info.sort_values("at", ascending=False)
    for i, smallest, ends_here in zip(info["at"].to_numpy(), info["smallest"].to_numpy(), info["childless"].to_numpy(), strict=True):
        owned = conv[i] == smallest
        shared[i], conv[i] = True, smallest
        if not owned:
            less_words[i] += words[i]
        if leaf[i] and not (owned and ends_here):
            less_leaves[i] += 1
        p = parent[i]
        if p >= 0:
            less_words[p] += less_words[i]
            less_leaves[p] += less_leaves[i]
            less_children[p] += not owned
    ends = [e if s else hashlib.sha256(e.encode()).hexdigest() for e, s in zip(local["ends"], shared, strict=True)]
    return pd.DataFrame(
        {
            "shared": shared, "node": local["node"], "shard": local["shard"], "conv_id": conv, "depth": local["depth"],
            "parent_conv_id": pd.array(conv[parent], "Int64"),
            "n_convs": local["n_convs"], "n_children": local["n_children"] - less_children, "n_leaves": local["leaves"] - less_leaves,
            "saved_tokens": local["saved"] - (local["distinct_words"] - less_words), "ends": ends,
        }
    ).assign(parent_conv_id=lambda df: df["parent_conv_id"].where(parent >= 0))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of shared nodes, in the order of node and shard, to one row a node. End lists are hashed as they come."""
    schema = pa.schema([(c, pa.string() if c == "ends_sha256" else pa.int64()) for c in RESULT])
    done: list[dict] = []
    node, row, digest, any_end = None, {}, hashlib.sha256(), False
    for b in batches:
        for r in (x for at in range(0, b.num_rows, 256) for x in b.slice(at, 256).to_pylist()):
            if r["node"] != node:
                if node is not None:
                    done.append(row | {"ends_sha256": digest.hexdigest()})
                node, digest, any_end = r["node"], hashlib.sha256(), False
                row = {c: r[c] for c in RESULT[:3]} | dict.fromkeys(RESULT[3:7], 0)
            for c in RESULT[3:7]:
                row[c] += r[c]
            if r["ends"]:
                digest.update((("," if any_end else "") + r["ends"]).encode())
                any_end = True
        if len(done) > 5000:
            yield pa.RecordBatch.from_pylist(done, schema=schema)
            done = []
    if node is not None:
        done.append(row | {"ends_sha256": digest.hexdigest()})
    yield pa.RecordBatch.from_pylist(done, schema=schema)


def prefix_trie(
    spark: SparkSession, conversations: DataFrame, group: int = 20, heads: int = 4, shard_conversations: int = SHARD_CONVERSATIONS
) -> DataFrame:
    """One row a node: ``RESULT``."""
    scratch = Scratch(spark)
    c = F.col("conv_id").cast("long")
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in ("role", "text"))
    rows = conversations.where(c.isNotNull()).select(c.alias("conv_id"), F.col("turn").alias("turn"), role.alias("role"), text.alias("text"))
    order = ["base", "conv_id", F.asc_nulls_first("turn"), "role", "text"]
    dealt = rows.withColumn("base", F.col("conv_id") - F.col("conv_id") % group).repartitionByRange("base").sortWithinPartitions(*order)
    # the length of the role parts it from the text
    sign: Column = F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary")))
    turns = dealt.select(
        "base", "conv_id", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int").alias("h"),
        sign.alias("sign"), F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"),
    )
    local = scratch.keep(turns.mapInArrow(partial(_shards, most=shard_conversations), LOCAL_SCHEMA), "trie-shards")

    met = local.groupBy("node").agg(F.count(F.lit(1)).alias("shards"), F.min("conv_id").alias("smallest"), F.every("leaf").alias("childless"))
    met = met.where("shards > 1").select("node", "smallest", "childless")
    info = local.select("node", "shard", "seq").join(met, "node")
    info = info.select(F.col("shard").alias("of_shard"), F.col("seq").alias("at"), "smallest", "childless")
    parts = local.groupBy("shard").cogroup(info.groupBy("of_shard")).applyInPandas(_settle, PART_SCHEMA)
    parts = scratch.keep(parts, "trie-parts")
    scratch.drop("trie-shards")
    own = parts.where(~F.col("shared")).select(*RESULT[:-1], F.col("ends").alias("ends_sha256"))
    shared = parts.where("shared").repartition("node").sortWithinPartitions("node", "shard")
    return own.unionByName(shared.mapInArrow(_joined, NODE_SCHEMA))

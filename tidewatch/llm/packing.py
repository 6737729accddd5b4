"""Best-fit packing into bins of several permitted sequence lengths.

Documents are cut at the largest permitted length only where they are longer; a cut leaves
full pieces and one rest. Pieces are packed by best fit in decreasing order: a piece goes
into the open bin that it leaves the least room in, else a bin is opened. ``costs`` price a
bin of each permitted length (its length plus ``overhead`` unless given). The lengths are optimised jointly: for each one
as the smallest size of new bins the whole packing is made, where a new bin has the least-cost size among those
that are not smaller and hold the piece; each bin is finally downsized to the cheapest length that
holds its contents, and the packing of the least total cost stays.

Each task packs its own rows, up to ``chunk_rows`` documents at a time, so no text is
shuffled, no bin spans tasks, and memory is bounded by the chunk, of which only ids and lengths are held.
The pieces of bins that hold less than a share ``filled`` of the length that is cheapest a unit are packed again in a second
round, dealt to as few tasks as hold ``chunk_rows`` of them each, so the waste does not depend on the number of partitions.

The length of a text is its UTF-8 bytes plus one for the end token, unless ``length_col`` names a column.

Edge cases: a null or empty text has length 1 (the end token). A null id is packed like any other.
Repeated rows are packed each. A null or negative length counts as 0, and a length of 0 is one piece of length 0.
An empty table gives no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

LENGTHS = (1024, 2048, 4096, 8192)
OVERHEAD = 32
PIECE = ["doc_id", "piece", "start", "length"]
PIECE_SCHEMA = "doc_id long, piece int, start long, length long"
SCHEMA = f"{PIECE_SCHEMA}, bin_id long, bin_capacity int, bin_offset int"


def best_fit(sizes: list[int], lengths: Sequence[int], costs: Sequence[float], preferred: int) -> tuple[float, list[int], list[int]]:
    """Total cost after downsizing, the bin of each piece, and the capacity of each bin.
    ``sizes`` are in decreasing order; ``preferred`` is the position in ``lengths`` of the smallest new bin."""
    opened = {fit: lengths[min(range(max(preferred, fit), len(lengths)), key=lambda i: (costs[i], i))] for fit in range(len(lengths))}
    bins: list[int] = []
    used: list[int] = []
    rooms: list[int] = []  # the different rooms of open bins, sorted
    by_room: dict[int, list[int]] = {}

    def put(b: int, room: int) -> None:
        if room:
            if room not in by_room:
                insort(rooms, room)
                by_room[room] = []
            by_room[room].append(b)

    for size in sizes:
        at = bisect_left(rooms, size)
        if at < len(rooms):
            room = rooms[at]
            b = by_room[room].pop()
            if not by_room[room]:
                del by_room[room], rooms[at]
        else:
            b, room = len(used), opened[bisect_left(lengths, size)]
            used.append(0)
        bins.append(b)
        used[b] += size
        put(b, room - size)
    fits = [min(range(bisect_left(lengths, u), len(lengths)), key=lambda i: (costs[i], i)) for u in used]
    return sum(costs[i] for i in fits), bins, [lengths[i] for i in fits]


def pack(sizes: Sequence[int], lengths: Sequence[int], costs: Sequence[float]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each piece, and the capacity of each bin, of the least-cost packing."""
    sizes = np.asarray(sizes, np.int64)
    order = np.argsort(-sizes, kind="stable")
    ranked = sizes[order].tolist()
    tried = [best_fit(ranked, lengths, costs, p) for p in range(len(lengths))]
    _, bins, caps = min(tried, key=lambda t: t[0])
    bin_of, offset, filled = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64), [0] * len(caps)
    for i, b, size in zip(order.tolist(), bins, ranked, strict=True):
        bin_of[i], offset[i] = b, filled[b]
        filled[b] += size
    return bin_of, offset, np.array(caps, np.int64)


def pack_documents(
    docs: DataFrame,
    lengths: Sequence[int] = LENGTHS,
    costs: Sequence[float] | None = None,
    overhead: float = OVERHEAD,
    chunk_rows: int = 1 << 16,
    id_col: str = "doc_id",
    text_col: str = "text",
    length_col: str | None = None,
    filled: float = 0.97,
) -> DataFrame:
    """``(doc_id, piece, start, length, bin_id, bin_capacity, bin_offset)``: one row a piece;
    ``start`` is its place in the document, ``bin_offset`` its place in the bin."""
    lengths = sorted(set(lengths))
    prices = list(costs) if costs is not None else [n + overhead for n in lengths]
    if len(prices) != len(lengths) or lengths[0] < 1:
        raise ValueError("one cost for each permitted length, all lengths positive")
    longest = lengths[-1]
    cheapest = lengths[min(range(len(lengths)), key=lambda i: (prices[i] / lengths[i], i))]  # a unit costs least in a full bin of this length
    size = F.octet_length(F.coalesce(F.col(text_col).cast("string"), F.lit(""))) + 1 if length_col is None else F.greatest(F.coalesce(F.col(length_col), F.lit(0)), F.lit(0))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents to pieces."""
        for b in batches:
            whole = b.column("size").to_numpy()
            n = np.maximum(1, -(-whole // longest))
            doc = np.repeat(np.arange(len(whole)), n)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
            length = np.minimum(longest, whole[doc] - piece * longest)
            columns = [b.column("doc_id").take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(piece * longest, pa.int64()), pa.array(length, pa.int64()), b.column("part").take(pa.array(doc))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "part"])

    def pack_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces ``(doc_id, piece, start, length, part)`` to bins, a chunk at a time."""
        held: list[pa.RecordBatch] = []
        next_bin = 0

        def flush() -> pa.RecordBatch:
            nonlocal next_bin
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held.clear()
            bins, offset, caps = pack(rows.column("length").to_numpy(), lengths, prices)
            ends = np.bincount(bins, rows.column("length").to_numpy(), len(caps))
            number = (rows.column("part")[0].as_py() << 36) + next_bin + bins
            next_bin += len(caps)
            added = [pa.array(number, pa.int64()), pa.array(caps[bins], pa.int32()), pa.array(offset, pa.int32()), pa.array(ends[bins] >= filled * cheapest)]
            return pa.RecordBatch.from_arrays([*(rows.column(c) for c in PIECE), *added], [*PIECE, "bin_id", "bin_capacity", "bin_offset", "full"])

        for b in batches:
            at = 0
            while at < b.num_rows:
                n = min(chunk_rows - sum(h.num_rows for h in held), b.num_rows - at)
                held.append(b.slice(at, n))
                at += n
                if sum(h.num_rows for h in held) >= chunk_rows:
                    yield flush()
        if held:
            yield flush()

    part = F.spark_partition_id().cast("long").alias("part")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), size.cast("long").alias("size"), part)
    pieces = rows.mapInArrow(cut, f"{PIECE_SCHEMA}, part long")
    first = Scratch(docs.sparkSession).keep(pieces.mapInArrow(pack_task, f"{SCHEMA}, full boolean"), "packed")
    rest = first.where(~F.col("full")).select(*PIECE)
    tasks = -(-rest.count() // chunk_rows)
    if tasks == 0:
        return first.drop("full")
    # bins of the second round have numbers of their own
    again = rest.repartition(tasks, "doc_id", "piece", "length").select(*PIECE, (F.spark_partition_id().cast("long") + (1 << 24)).alias("part"))
    return first.where("full").drop("full").unionByName(again.mapInArrow(pack_task, f"{SCHEMA}, full boolean").drop("full"))

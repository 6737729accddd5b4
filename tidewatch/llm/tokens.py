"""Token ids as a binary table: frequency ranks in byte-aligned variable-length code.

File format, written by :func:`write_tokens` below one folder:

* ``ranks/`` Parquet rows ``(rank int, id long, n long)``: the id of each rank.
  Rank 0 is the most frequent id of the whole corpus, ties go to the smaller id.
* ``blocks/`` Parquet rows ``(part, seq, doc_ids, n_tokens, payload)``: documents in
  ascending id order by ``part`` (range partition) then ``seq`` (its first row there), at most ``block_tokens`` tokens
  a block unless one document alone has more.

``payload`` is: magic ``TWV1``, count as uint32, then ``ceil(count / 4)`` control
bytes, then the data bytes (all little endian). A control byte holds four 2-bit
codes, lowest bits first; code ``c`` says that the rank takes ``c + 1`` bytes. The
decoder looks the four lengths of a control byte up in a 256 x 4 table, sums them
to offsets and gathers all ranks of a block at once. Spark's own writer commits the
blocks, so a lost executor or a second attempt never leaves half a file.

Edge cases: a null or empty text is a document of the end id alone. A null id sorts
first. Repeated rows stay separate documents, in any order among themselves. An empty
table gives empty folders and no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from array import array
from collections.abc import Callable, Iterator
from string import punctuation
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import work_path
from .common import Scratch, slices

MAGIC = b"TWV1"
_LENGTHS = np.array([[(c >> (2 * k) & 3) + 1 for k in range(4)] for c in range(256)], np.uint8)
_MASK = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def encode_ranks(ranks: np.ndarray) -> bytes:
    """Block of ranks (each below 2**32) in the code above."""
    r = np.ascontiguousarray(ranks, np.uint32)
    n = len(r)
    codes = np.zeros(-(-n // 4) * 4, np.uint8)
    top = int(r.max(initial=0))
    for least in (1 << 8, 1 << 16, 1 << 24):
        if top >= least:
            codes[:n] += r >= least
    four = codes.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    wide = r.astype("<u2" if top < 1 << 16 else "<u4").view(np.uint8).reshape(n, 2 if top < 1 << 16 else 4)
    used = np.empty(wide.shape, bool)
    for k in range(wide.shape[1]):
        np.greater_equal(codes[:n], k, out=used[:, k])
    return MAGIC + np.array([n], "<u4").tobytes() + control.tobytes() + wide[used].tobytes()


def decode_ranks(block: bytes) -> np.ndarray:
    """Inverse of :func:`encode_ranks`, by table lookup."""
    if block[:4] != MAGIC:
        raise ValueError("not a token block")
    n = int(np.frombuffer(block, "<u4", 1, 4)[0])
    groups = -(-n // 4)
    control = np.frombuffer(block, np.uint8, groups, 8)
    size = _LENGTHS[control].reshape(-1)[:n]
    end = np.cumsum(size, dtype=np.int64)
    data = np.frombuffer(block + b"\0\0\0", np.uint8, offset=8 + groups)
    at = end - size
    value = data[at].astype(np.uint32)
    for k in range(1, int(size.max(initial=0))):
        value |= data[at + k].astype(np.uint32) << np.uint32(8 * k)
    return value & _MASK[size]


def _ranges(kind: str, stop: int = 0x250) -> str:
    """Characters below ``stop`` whose Unicode category starts with ``kind``, for a regex class."""
    points = [c for c in range(stop) if unicodedata.category(chr(c))[0] == kind]
    out = ""
    for c in points:
        if c - 1 not in points:
            last = c
            while last + 1 in points:
                last += 1
            out += chr(c) if c == last else f"{chr(c)}-{chr(last)}"
    return out


class _OtherScript(Exception):
    """A text holds a character that only the library's own pre-tokeniser splits."""


class _Memory(dict):
    """Results of ``make`` by text: the first ``room`` of them, and of all later ones the last few."""

    def __init__(self, make: Callable[[str], bytes], room: int, late: int) -> None:
        super().__init__()
        self.make, self.room, self.late, self.recent = make, room, late, {}

    def __missing__(self, text: str) -> bytes:
        ids = self.recent.get(text)
        if ids is None:
            ids = self.make(text)
            if len(self) < self.room:
                self[text] = ids
            elif self.late:
                if len(self.recent) >= self.late:
                    self.recent.clear()
                self.recent[text] = ids
        return ids


class PieceEncoder:
    """Ids of whole texts through a byte-level BPE file of the ``tokenizers`` library.

    The library's model splits each distinct piece once per worker and the result is
    kept (the first ``room`` pieces, and the last ``late`` of those beyond); texts outside Latin letters, with
    special-token strings or through another kind of tokenizer go through the library as a whole.
    """

    def __init__(self, path: str, room: int = 1_000_000, late: int = 100_000) -> None:
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.kind = "<u2" if self.tok.get_vocab_size() <= 0x10000 else "<u4"
        self.typecode = "H" if self.kind == "<u2" else "I"
        letters, numbers, space = _ranges("L"), _ranges("N"), "\t-\r \x85\xa0"
        self.pieces = re.compile(
            rf" ?[{letters}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[{numbers}]+| ?[^{space}{letters}{numbers}]+|[{space}]+(?![^{space}])|[{space}]+"
        ).findall
        self.two_spaces = re.compile(f"[{space}]{{2}}").search
        # only texts with one of these can hold two spaces in a row
        self.gaps = ("  ", "\n\n", " \n", "\n ", *"\t\v\f\r\x85\xa0")
        self.whole = ("\0", *(t.content for t in self.tok.get_added_tokens_decoder().values()))
        self.odd = re.compile("[^\x01-ɏ]").search
        state = str(self.tok.pre_tokenizer)
        self.fast = state.startswith("ByteLevel(add_prefix_space=False") and "use_regex=True" in state and self.tok.normalizer is None
        self.split = self.tok.model.tokenize
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(plain)]
        as_text = {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}
        self.byte_text = {chr(c): "".join(as_text[b] for b in chr(c).encode()) for c in range(1, 0x250)}
        self.known = _Memory(self._chunk, room, late)
        self.known[""] = b""

    def _piece(self, piece: str) -> bytes:
        if piece.isascii() and piece.isprintable():
            text = piece.replace(" ", self.byte_text[" "])
        else:
            text = "".join(map(self.byte_text.__getitem__, piece))
        return array(self.typecode, [t.id for t in self.split(text)]).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        if not chunk.isascii() and self.odd(chunk):
            raise _OtherScript
        head = chunk.rstrip(punctuation)
        if head.lstrip(" ").isalpha():  # a word is one piece, and so are the marks behind it
            return self._piece(chunk) if len(head) == len(chunk) else self.known[head] + self.known[chunk[len(head) :]]
        pieces = self.pieces(chunk)
        return self._piece(chunk) if len(pieces) == 1 else b"".join(map(self.known.__getitem__, pieces))

    def _library(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as packed little-endian integers of ``self.kind``."""
        if not self.fast or any(map(text.__contains__, self.whole)):
            return self._library(text)
        if any(map(text.__contains__, self.gaps)) and self.two_spaces(text):
            chunks = self.pieces(text)
        else:  # a lone blank starts a piece and a lone line end is one, so texts may be cut there
            chunks = text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")
        try:
            return b"".join(map(self.known.__getitem__, chunks))
        except _OtherScript:
            return self._library(text)


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def tokenize(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, part, pos, ids)``: packed ids with ``end_id`` of each whole text, range
    partitioned and sorted by id; ``pos`` numbers the rows of a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        end = np.array([end_id], enc.kind).tobytes()
        pos = 0
        for b in slices(batches):
            ids = [(enc.encode(t) if t else b"") + end for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("part"), pa.array(range(pos, pos + len(ids)), pa.int64()), pa.array(ids, pa.binary())],
                ["doc_id", "part", "pos", "ids"],
            )
            pos += len(ids)

    ordered = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id")
        .withColumn("part", F.spark_partition_id())
    )
    return ordered.mapInArrow(run, "doc_id long, part int, pos long, ids binary")


def write_tokens(
    spark: SparkSession,
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = 2,
    block_tokens: int = 1 << 16,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Tokenise every whole text and write the two folders of the format to ``path``."""
    kind = encoder(tokenizer).kind
    width = np.dtype(kind).itemsize
    scratch = Scratch(spark)
    ids = scratch.keep(tokenize(docs, tokenizer, end_id, id_col, text_col), "token-ids")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for b in slices(batches):
            got = np.bincount(np.frombuffer(b"".join(b.column("ids").to_pylist()), kind))
            if len(got) > len(total):
                total = np.pad(total, (0, len(got) - len(total)))
            total[: len(got)] += got
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["id", "n"])

    counts = ids.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    # at most one row an id of the vocabulary
    ranked = counts.withColumn("rank", (F.row_number().over(W.orderBy(F.desc("n"), "id")) - 1).cast("int"))
    ranked.select("rank", "id", "n").write.parquet(f"{path}/ranks")
    table = spark.read.parquet(f"{path}/ranks").toPandas()
    rank_of = np.zeros(int(table["id"].max()) + 1 if len(table) else 1, np.uint32)
    rank_of[table["id"].to_numpy()] = table["rank"].to_numpy()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int | None, int, int, bytes]] = []
        tokens = 0

        def flush() -> pa.RecordBatch:
            doc_ids, parts, at, packed = zip(*held, strict=True)
            payload = encode_ranks(rank_of[np.frombuffer(b"".join(packed), kind)])
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([parts[0]], pa.int32()),
                    pa.array([at[0]], pa.int64()),
                    pa.array([list(doc_ids)], pa.list_(pa.int64())),
                    pa.array([[len(x) // width for x in packed]], pa.list_(pa.int64())),
                    pa.array([payload], pa.binary()),
                ],
                ["part", "seq", "doc_ids", "n_tokens", "payload"],
            )

        for b in slices(batches):
            for row in zip(*(b.column(c).to_pylist() for c in ("doc_id", "part", "pos", "ids")), strict=True):
                n = len(row[3]) // width
                follows = held and row[1] == held[-1][1] and row[2] == held[-1][2] + 1
                if held and (not follows or tokens + n > block_tokens):
                    yield flush()
                    held, tokens = [], 0
                held.append(row)
                tokens += n
        if held:
            yield flush()

    ids.mapInArrow(blocks, "part int, seq long, doc_ids array<long>, n_tokens array<long>, payload binary").write.option(
        "compression", "zstd"
    ).parquet(f"{path}/blocks")
    scratch.drop("token-ids")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32, ids)`` decoded from the files; ``start``
    counts the ids of all documents before it, ``ids`` are packed ``<u4``."""
    table = spark.read.parquet(f"{path}/ranks").select("rank", "id").toPandas()
    id_of = np.zeros(len(table) + 1, "<u4")
    id_of[table["rank"].to_numpy()] = table["id"].to_numpy()
    found = spark.read.parquet(f"{path}/blocks")
    sums = found.select("part", "seq", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    # one row a partition of the writing job, so this window is small
    base = sums.groupBy("part").agg(F.sum("n").alias("n"))
    base = base.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("base"))
    inside = W.partitionBy("part").orderBy("seq")
    starts = sums.withColumn("inside", F.sum("n").over(inside) - F.col("n")).join(base, "part")
    starts = starts.select("part", "seq", (F.col("base") + F.col("inside")).alias("start"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start, docs, lens, payload in zip(
                b.column("start").to_pylist(), b.column("doc_ids"), b.column("n_tokens"), b.column("payload").to_pylist(), strict=True
            ):
                ids = id_of[decode_ranks(payload)]
                lens = lens.values.to_numpy(zero_copy_only=False)
                ends = np.cumsum(lens)
                parts = [ids[e - n : e].tobytes() for e, n in zip(ends, lens, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        docs.values,
                        pa.array(start + ends - lens, pa.int64()),
                        pa.array(lens, pa.int64()),
                        pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                        pa.array(parts, pa.binary()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32", "ids"],
                )

    return found.join(starts, ["part", "seq"]).mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")


def token_table(spark: SparkSession, docs: DataFrame, tokenizer: str, **options: Any) -> DataFrame:
    """Write ``docs`` in the format, then read it back."""
    path = work_path(spark, "llm", "tokens")
    write_tokens(spark, docs, path, tokenizer, **options)
    return read_tokens(spark, path)

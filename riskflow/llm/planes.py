"""Token-id files: blocks of ids transposed into byte or bit planes, each plane compressed with zstandard.

A file set is a folder with two Parquet tables.

``blocks``: one row per block of ``block_ids`` ids (the last block of a shard may be shorter). Ids are little-endian
unsigned 32-bit. ``planes`` holds the compressed planes: plane k is byte k of all ids ("byte"), or bit k of all ids packed
into bytes, lowest bit first ("bit"). ``pieces`` says which documents lie in the block.

``index``: one row per block with its shard, number, first id, number of ids, plane sizes and crc32, without the data,
so that a reader can find any id range.

Shards are ranges of documents in ascending ``doc_id`` (null first; equal ids by a hash of the text).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskflow.llm import store
from riskflow.llm.encoding import encoder
from riskflow.llm.text import blocks as text_blocks

BLOCK_IDS = 65_536
ID_BYTES = 4
LEVEL = 3
_PIECE = "struct<doc_no:bigint,doc_id:bigint,n_tokens:bigint,first:bigint,at:bigint,n:bigint>"
BLOCK_SCHEMA = f"shard int, block int, first_id bigint, n_ids bigint, kind string, planes array<binary>, plane_bytes array<bigint>, crc32 bigint, pieces array<{_PIECE}>"
_ARROW_PIECE = pa.struct([(x, pa.int64()) for x in ("doc_no", "doc_id", "n_tokens", "first", "at", "n")])
_ARROW_BLOCK = pa.schema([
    ("shard", pa.int32()), ("block", pa.int32()), ("first_id", pa.int64()), ("n_ids", pa.int64()), ("kind", pa.string()),
    ("planes", pa.list_(pa.binary())), ("plane_bytes", pa.list_(pa.int64())), ("crc32", pa.int64()),
    ("pieces", pa.list_(_ARROW_PIECE)),
])


def to_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """The planes of a block of ids, uncompressed."""
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, ID_BYTES)
    if kind == "byte":
        return [raw[:, k].tobytes() for k in range(ID_BYTES)]
    if kind == "bit":
        bits = np.unpackbits(raw, axis=1, bitorder="little")
        return [np.packbits(bits[:, k], bitorder="little").tobytes() for k in range(8 * ID_BYTES)]
    raise ValueError(f"planes are 'byte' or 'bit', not {kind!r}")


def from_planes(planes: list[bytes], n: int, kind: str) -> np.ndarray:
    """The ids of a block from its planes."""
    if kind == "byte":
        raw = np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1)
    else:
        bits = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little") for p in planes], axis=1)
        raw = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(raw).reshape(-1).view("<u4")


@cache
def _zeros_operator(k: int) -> tuple[int, ...]:
    """What 2**k zero bytes do to each bit of a crc32 register."""
    if k == 0:
        one = []
        for bit in range(32):
            value = 1 << bit
            for _ in range(8):
                value = (value >> 1) ^ (0xEDB88320 if value & 1 else 0)
            one.append(value)
        return tuple(one)
    half = _zeros_operator(k - 1)
    return tuple(_apply(half, value) for value in half)


def _apply(operator: tuple[int, ...], value: int) -> int:
    out, bit = 0, 0
    while value:
        if value & 1:
            out ^= operator[bit]
        value, bit = value >> 1, bit + 1
    return out


def crc_share(data: bytes, after: int) -> int:
    """What a piece with ``after`` bytes behind it adds (by exclusive or) to the crc32 of the whole."""
    value, k = zlib.crc32(data), 0
    while after:
        if after & 1:
            value = _apply(_zeros_operator(k), value)
        after, k = after >> 1, k + 1
    return value


class _Writer:
    """Collects the ids of one shard and gives out full blocks."""

    def __init__(self, shard: int, block_ids: int, kind: str):
        self.shard, self.block_ids, self.kind = shard, block_ids, kind
        self.ids, self.pieces, self.block, self.total, self.docs = np.zeros(0, np.uint32), [], 0, 0, 0
        self.pack = zstandard.ZstdCompressor(level=LEVEL)

    def add(self, doc_ids: list, n_tokens: np.ndarray, ids: np.ndarray) -> Iterator[dict]:
        """Takes documents whose ids, end ids included, lie one after another in ``ids``."""
        base = len(self.ids)
        self.ids = np.concatenate([self.ids, ids])
        first = base + np.cumsum(n_tokens) - n_tokens
        for doc_id, n, at in zip(doc_ids, n_tokens.tolist(), first.tolist()):
            start, stop = at, at + n
            while start < stop:
                k = start // self.block_ids
                cut = min(stop, (k + 1) * self.block_ids)
                self.pieces.append((k, {"doc_no": self.docs, "doc_id": doc_id, "n_tokens": n, "first": self.total - base + at, "at": start - at, "n": cut - start}))
                start = cut
            self.docs += 1
        self.total += len(ids)
        full = len(self.ids) // self.block_ids
        yield from self._give(full)

    def _give(self, full: int, rest: bool = False) -> Iterator[dict]:
        by: dict[int, list] = {}
        for k, piece in self.pieces:
            by.setdefault(k, []).append(piece)
        for k in range(full + (rest and len(self.ids) > full * self.block_ids)):
            ids = self.ids[k * self.block_ids : (k + 1) * self.block_ids]
            planes = [self.pack.compress(p) for p in to_planes(ids, self.kind)]
            yield {
                "shard": self.shard, "block": self.block, "first_id": self.block * self.block_ids, "n_ids": len(ids), "kind": self.kind,
                "planes": planes, "plane_bytes": [len(p) for p in planes], "crc32": zlib.crc32(ids.astype("<u4").tobytes()), "pieces": by.get(k, []),
            }
            self.block += 1
        self.ids = self.ids[full * self.block_ids :]
        self.pieces = [(k - full, p) for k, p in self.pieces if k >= full]

    def close(self) -> Iterator[dict]:
        yield from self._give(len(self.ids) // self.block_ids, rest=True)


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, block_ids: int = BLOCK_IDS, kind: str = "byte", shards: int | None = None) -> None:
    """Encode ``text`` of every document, append ``end_id`` and write the ids to ``path`` in ascending ``doc_id``.

    A null or empty text is the end id alone. Rows with a null ``doc_id`` come first; rows that share a ``doc_id`` follow
    each other in an order given by their text; repeated rows are written each. No rows give empty tables. Other columns
    are not read. ``shards`` defaults to the number of input splits, so a shard holds about one split of text.
    """
    store.prepare(docs.sparkSession)
    n = shards or max(1, docs.rdd.getNumPartitions())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _Writer(TaskContext.get().partitionId(), block_ids, kind)
        code = encoder(tokenizer)
        for batch in batches:
            for part in text_blocks(batch):
                ids, count = code(part.column("text"))
                ids = np.insert(ids, np.cumsum(count), end_id)
                rows = list(own.add(part.column("doc_id").to_pylist(), count + 1, ids))
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _ARROW_BLOCK)
        if rows := list(own.close()):
            yield pa.RecordBatch.from_pylist(rows, _ARROW_BLOCK)

    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    ordered = ordered.repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    ordered.mapInArrow(encode, BLOCK_SCHEMA).write.option("compression", "none").parquet(f"{path}/blocks")
    store.release(docs.sparkSession)
    table = docs.sparkSession.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    table.drop("planes", "pieces").write.parquet(f"{path}/index")


def _decode(row: dict, unpack: zstandard.ZstdDecompressor) -> bytes:
    ids = from_planes([unpack.decompress(p) for p in row["planes"]], row["n_ids"], row["kind"])
    raw = ids.tobytes()
    if zlib.crc32(raw) != row["crc32"]:
        raise ValueError(f"shard {row['shard']}, block {row['block']}: the ids differ from those written")
    return raw


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """Number of ids before each shard; one row per shard, from the chunk index."""
    index = spark.read.parquet(f"{path}/index").groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return index.select(F.col("shard").alias("of_shard"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Decode all blocks: doc_id, start, n_tokens and ids_crc32 of every document, in no particular order."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                raw, at, out = _decode(row, unpack), 0, []
                for p in row["pieces"]:
                    own = raw[at : at + ID_BYTES * p["n"]]
                    at += len(own)
                    out.append((row["shard"], p["doc_no"], p["doc_id"], p["first"], p["n_tokens"], crc_share(own, ID_BYTES * (p["n_tokens"] - p["at"] - p["n"]))))
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), _PIECE_TYPES)], names=_PIECE_NAMES)

    table = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    found = table.select("shard", "block", "n_ids", "kind", "planes", "crc32", "pieces").mapInArrow(pieces, "shard int, doc_no bigint, doc_id bigint, first bigint, n_tokens bigint, share bigint")
    whole = found.groupBy("shard", "doc_no").agg(*(F.max(c).alias(c) for c in ("doc_id", "first", "n_tokens")), F.bit_xor("share").alias("ids_crc32"))
    joined = whole.join(shard_starts(spark, path), F.col("shard") == F.col("of_shard"))
    return joined.select("doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")


_PIECE_NAMES = ["shard", "doc_no", "doc_id", "first", "n_tokens", "share"]
_PIECE_TYPES = [pa.int32(), *[pa.int64()] * 5]


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """The ids themselves: one row per block with its global first id."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                ids = np.frombuffer(_decode(row, unpack), "<u4").astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([row["shard"]], pa.int32()), pa.array([row["first_id"]], pa.int64()), pa.array([ids], pa.list_(pa.int64()))], names=["shard", "first_id", "ids"])

    table = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    found = table.select("shard", "block", "first_id", "n_ids", "kind", "planes", "crc32").mapInArrow(decode, "shard int, first_id bigint, ids array<bigint>")
    joined = found.join(shard_starts(spark, path), F.col("shard") == F.col("of_shard"))
    return joined.select((F.col("before") + F.col("first_id")).alias("start"), "ids")


def encode_documents(docs: DataFrame, tokenizer: str, path: str | None = None, **settings) -> DataFrame:
    """Write the ids of ``docs`` and return the documents as read back from the files."""
    path = path or store.folder(docs.sparkSession, "token-ids")
    write(docs, path, tokenizer, **settings)
    return read_documents(docs.sparkSession, path)

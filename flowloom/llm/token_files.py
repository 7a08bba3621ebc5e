"""Token ids in directly addressable codes.

An id is split into chunks of eight bits. Level k holds the k-th chunk of every id that has one,
and a bitmap that says whether the id goes on to level k + 1; a directory of ones before each
block of the bitmap gives an id's place there. So any id is read by at most four lookups, and any
run of ids by one slice a level, without decoding what lies before.

Files: a Parquet table with one row per shard, whose payload column is the code below. Spark's
writer commits them whole, on any store the cluster has. Shards follow ascending doc_id.
"""

from __future__ import annotations

import functools
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowloom.llm.chunks import default_tokenizer, library_encoder
from flowloom.llm.texts import table, text_list
from flowloom.session import run_dir

MAGIC = b"DAC1"
#: Bits of a bitmap between two entries of its rank directory.
BLOCK = 512
#: A shard ends with the document that brings it to so many ids.
SHARD_TOKENS = 1 << 20
_POPCOUNT = np.array([bin(b).count("1") for b in range(256)], dtype=np.uint8)


def dac_encode(values: np.ndarray) -> bytes:
    """The code of unsigned 32-bit integers.

    Header: magic, number of levels; per level the number of chunks. Then per level the chunks
    (one byte each), the continuation bitmap (low bit first) and its rank directory (unsigned
    64-bit counts of ones before each block).
    """
    level = np.asarray(values, dtype=np.uint32)
    sizes, body = [], []
    while True:
        more = level > 0xFF
        bitmap = np.packbits(more, bitorder="little")
        ones = np.add.reduceat(
            _POPCOUNT[bitmap], np.arange(0, len(bitmap), BLOCK // 8), dtype=np.uint64
        ) if len(bitmap) else np.zeros(0, np.uint64)
        directory = np.concatenate([[0], np.cumsum(ones)[:-1]]) if len(ones) else ones
        sizes.append(len(level))
        body += [
            (level & 0xFF).astype(np.uint8).tobytes(), bitmap.tobytes(),
            directory.astype("<u8").tobytes(),
        ]
        if not more.any():
            break
        level = level[more] >> 8
    return MAGIC + struct.pack(f"<I{len(sizes)}Q", len(sizes), *sizes) + b"".join(body)


class DacReader:
    """Random access to the ids of a code."""

    def __init__(self, payload: bytes) -> None:
        if payload[:4] != MAGIC:
            raise ValueError("not a directly addressable code")
        (levels,) = struct.unpack_from("<I", payload, 4)
        sizes = struct.unpack_from(f"<{levels}Q", payload, 8)
        at = 8 + 8 * levels
        self._levels = []
        for size in sizes:
            bits = (size + 7) // 8
            blocks = (size + BLOCK - 1) // BLOCK
            chunks = np.frombuffer(payload, np.uint8, size, at)
            bitmap = np.frombuffer(payload, np.uint8, bits, at + size)
            directory = np.frombuffer(payload, "<u8", blocks, at + size + bits)
            self._levels.append((chunks, bitmap, directory))
            at += size + bits + 8 * blocks

    def __len__(self) -> int:
        return len(self._levels[0][0])

    def _rank(self, level: int, i: int) -> int:
        """Ones before place i of a level's bitmap."""
        chunks, bitmap, directory = self._levels[level]
        if i >= len(chunks) and len(chunks):
            return self._rank(level, len(chunks) - 1) + self._bit(level, len(chunks) - 1)
        if not len(chunks):
            return 0
        block, byte = i // BLOCK, i // 8
        ones = int(directory[block])
        ones += int(_POPCOUNT[bitmap[block * BLOCK // 8:byte]].sum())
        return ones + int(_POPCOUNT[int(bitmap[byte]) & ((1 << (i % 8)) - 1)])

    def _bit(self, level: int, i: int) -> int:
        return int(self._levels[level][1][i // 8]) >> (i % 8) & 1

    def token(self, i: int) -> int:
        if not 0 <= i < len(self):
            raise IndexError(i)
        value, level = 0, 0
        while True:
            value |= int(self._levels[level][0][i]) << (8 * level)
            if not self._bit(level, i):
                return value
            i, level = self._rank(level, i), level + 1

    def slice(self, start: int, end: int) -> np.ndarray:
        """The ids from start up to end, as unsigned 32-bit integers."""
        values = np.zeros(end - start, dtype=np.uint32)
        places = np.arange(end - start)
        for level, (chunks, bitmap, _) in enumerate(self._levels):
            if start >= end:
                break
            values[places] |= chunks[start:end].astype(np.uint32) << np.uint32(8 * level)
            first = start // 8
            bits = np.unpackbits(bitmap[first:(end + 7) // 8], bitorder="little")
            more = bits[start - 8 * first:end - 8 * first].astype(bool)
            places = places[more]
            start = self._rank(level, start)
            end = start + len(places)
        return values


SHARDS = (
    "part int, seq int, part_start long, n_tokens long, doc_ids binary, missing_ids binary, "
    "ends binary, payload binary"
)


def _shard_rows(batches, path: str, end: bytes, part: int) -> Iterator[tuple]:
    """Shards of one partition's sorted documents."""
    encoder = library_encoder(path)
    seq, written = 0, 0
    doc_ids, ends, ids, held = [], [], [], 0

    def shard() -> tuple:
        known = np.array([d is not None for d in doc_ids], dtype=bool)
        return (
            part, seq, written, held,
            np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes(),
            np.packbits(~known, bitorder="little").tobytes(),
            np.array(ends, dtype="<u8").tobytes(),
            dac_encode(np.frombuffer(b"".join(ids), "<u4")),
        )

    for batch in batches:
        codes = encoder.many(text_list(batch, "text"))
        for doc_id, code in zip(batch.column("doc_id").to_pylist(), codes, strict=True):
            code += end
            held += len(code) // 4
            doc_ids.append(doc_id)
            ends.append(held)
            ids.append(code)
            if held >= SHARD_TOKENS:
                yield shard()
                seq, written = seq + 1, written + held
                doc_ids, ends, ids, held = [], [], [], 0
    if doc_ids:
        yield shard()


def write_tokens(
    docs: DataFrame, path: str, tokenizer_path: str | None = None, end_id: int = 0
) -> None:
    """Write the ids of all documents, each with the end id appended, in ascending doc_id order.

    Null and empty texts are the end id alone. Equal ids (repeated rows included) follow each
    other in the order of their texts; null ids come first. Other columns are ignored. An empty
    table writes no shard. A document is never split over shards, however long it is.

    One shuffle, of the texts, by range of (doc_id, hash of the text): the hash splits an id
    that holds many rows.
    """
    tokenizer_path = tokenizer_path or default_tokenizer()
    end = int(end_id).to_bytes(4, "little")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        kinds = (
            pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(),
            pa.binary(), pa.binary(),
        )
        names = [c.split()[0] for c in SHARDS.split(", ")]
        for row in _shard_rows(batches, tokenizer_path, end, part):
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names
            )

    order = ["doc_id", "text_hash", "text"]
    docs.select("doc_id", "text").withColumn("text_hash", F.xxhash64("text")).repartitionByRange(
        "doc_id", "text_hash"
    ).sortWithinPartitions(*order).select("doc_id", "text").mapInArrow(build, SHARDS).write.option(
        "compression", "zstd"
    ).parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 from the files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                code = DacReader(row["payload"])
                ends = np.frombuffer(row["ends"], "<u8").astype(np.int64)
                starts = np.concatenate([[0], ends[:-1]])
                missing = np.unpackbits(
                    np.frombuffer(row["missing_ids"], np.uint8), count=len(ends),
                    bitorder="little",
                ).astype(bool)
                crcs = [
                    zlib.crc32(code.slice(a, b).astype("<u4").tobytes())
                    for a, b in zip(starts.tolist(), ends.tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(ends), row["part"], np.int32)),
                        pa.array(np.frombuffer(row["doc_ids"], "<i8"), mask=missing),
                        pa.array(starts + row["part_start"]),
                        pa.array(ends - starts), pa.array(crcs, pa.int64()),
                    ],
                    ["part", "doc_id", "start_in_part", "n_tokens", "ids_crc32"],
                )

    shards = spark.read.parquet(path)
    documents = shards.select(
        "part", "part_start", "doc_ids", "missing_ids", "ends", "payload"
    ).mapInArrow(
        read, "part int, doc_id long, start_in_part long, n_tokens long, ids_crc32 long"
    )
    # One row per range partition of the write: a few thousand at most, so safe to broadcast.
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("part_tokens"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(
        "part", F.coalesce(F.sum("part_tokens").over(earlier), F.lit(0)).alias("part_offset")
    )
    return documents.join(F.broadcast(before), "part").select(
        "doc_id", (F.col("part_offset") + F.col("start_in_part")).alias("start"), "n_tokens",
        "ids_crc32",
    )


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "token-files")
    write_tokens(table(spark, sf_dir, "documents"), path)
    return read_documents(spark, path)

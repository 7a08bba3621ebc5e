"""Cost-balanced packing: token sequences of equal length with little padding.

Each scan task encodes its documents and packs them in groups of a bounded number of tokens, so
nothing shuffles and a lost task is packed again to the same result. Within a group a piece of n
tokens costs n + n*n / CONTEXT (attention grows with the square); pieces go in descending order to
the sequence of lowest cost that still has room, and are cut only where none has.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from flowloom.llm.chunks import default_tokenizer, library_encoder
from flowloom.llm.texts import table, text_list

CONTEXT = 2048
END_ID = 1
#: Tokens of a group, 512 sequences: what one task holds at a time.
GROUP_TOKENS = 512 * CONTEXT
#: Sequence ids are unique per task: the task's partition in the high bits.
TASK_BITS = 36

PIECES = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, "
    "sequence_id long, offset long, capacity int"
)


def cost(length):
    """Estimated attention cost of a run of tokens: linear plus quadratic."""
    return length + length * length / CONTEXT


def capacities(tokens: int) -> list[int]:
    """Sequence lengths for a group: full ones, then powers of two that take the rest exactly."""
    full, rest = divmod(tokens, CONTEXT)
    powers = [1 << b for b in reversed(range(CONTEXT.bit_length())) if rest >> b & 1]
    return [CONTEXT] * full + powers


def balance(lengths: list[int], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Places of pieces: (item, start in item, length, sequence, offset).

    room must hold the sum of lengths exactly. Items longer than the longest sequence are cut to
    its length first. Ties go to the earlier item and the earlier sequence.
    """
    pieces = []
    most = max(room, default=0)
    for item, length in enumerate(lengths):
        for start in range(0, length, most or 1):
            pieces.append((min(most, length - start), item, start))
    pieces.sort(key=lambda p: (-p[0], p[1], p[2]))
    left = np.array(room, dtype=np.int64)
    load = np.zeros(len(room))
    used = np.zeros(len(room), dtype=np.int64)
    places = []
    for length, item, start in pieces:
        while length:
            fits = left >= length
            if fits.any():
                sequence = int(np.argmin(np.where(fits, load, np.inf)))
                part = length
            else:
                sequence = int(np.argmax(left))
                part = int(left[sequence])
            places.append((item, start, part, sequence, int(used[sequence])))
            left[sequence] -= part
            used[sequence] += part
            load[sequence] += cost(part)
            start, length = start + part, length - part
    return places


def _groups(documents: Iterator[tuple], tokens: int) -> Iterator[list[tuple]]:
    """Runs of documents of about so many tokens; longer documents are dealt over several.

    Items are (doc_id, ids, start of these ids in the document, tokens of the document).
    """
    group, held = [], 0
    for doc_id, ids in documents:
        total = len(ids) // 4
        start = 0
        while start < total:
            part = min(total - start, tokens - held)
            group.append((doc_id, ids[4 * start:4 * (start + part)], start, total))
            start, held = start + part, held + part
            if held == tokens:
                yield group
                group, held = [], 0
    if group:
        yield group


def pack(
    docs: DataFrame, tokenizer_path: str | None = None, end_id: int = END_ID,
    keep_ids: bool = True,
) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens.

    Returns doc_id, start (the document's ids before the piece), length, ids (the piece, as
    little-endian unsigned 32-bit integers; null unless keep_ids), ids_crc32, doc_tokens, the
    sequence and the offset in it, and the sequence's capacity, which it fills exactly: 2048, or
    a power of two for the few that take what is left of a group. So there is no padding.

    Null and empty texts are the end id alone. Rows that repeat, equal ids and null ids are
    packed as documents of their own. Documents longer than a group are cut. Other columns are
    ignored. An empty table gives no rows. Sequence ids depend on how the scan is split.
    """
    path = tokenizer_path or default_tokenizer()
    end = int(end_id).to_bytes(4, "little")

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        encoder = library_encoder(path)
        for batch in batches:
            codes = encoder.many(text_list(batch, "text"))
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), codes, strict=True):
                yield doc_id, ids + end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        next_id = TaskContext.get().partitionId() << TASK_BITS
        for group in _groups(documents(batches), GROUP_TOKENS):
            lengths = [len(ids) // 4 for _, ids, _, _ in group]
            room = capacities(sum(lengths))
            rows = []
            for item, start, length, sequence, offset in balance(lengths, room):
                doc_id, ids, before, total = group[item]
                piece = ids[4 * start:4 * (start + length)]
                rows.append((
                    doc_id, before + start, length, piece if keep_ids else None,
                    zlib.crc32(piece), total, next_id + sequence, offset, room[sequence],
                ))
            next_id += len(room)
            kinds = (
                pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(),
                pa.int64(), pa.int64(), pa.int32(),
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                ["doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens",
                 "sequence_id", "offset", "capacity"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, PIECES.replace("ids binary", "ids binary, ids_crc32 long")
    )


def op7_cost_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), keep_ids=False).drop("ids")

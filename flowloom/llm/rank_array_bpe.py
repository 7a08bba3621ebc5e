"""BPE encoding and decoding by a contiguous array of ranks.

A word is a list of parts and, beside it, a list of the merge ranks of neighbouring parts. The
smallest rank is found by scanning, the boundary it stands for is deleted, and the two ranks
beside it are refreshed. Words are short, so the scan over a contiguous list beats a heap; a
word of many parts (no spaces in a very long text) goes through a heap over linked parts, which
merges in the same order.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from flowloom.llm.chunks import (
    ChunkEncoder,
    byte_letters,
    default_tokenizer,
    little_endian,
)
from flowloom.llm.texts import table, text_list

#: Parts up to which the minimum is found by scanning.
SCAN_PARTS = 192
NO_RANK = 1 << 60


class RankArrayBpe:
    """Encoder and decoder of a byte-level BPE vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model = data["model"]
        alphabet = {letter: byte for byte, letter in byte_letters().items()}
        vocab = model["vocab"]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self._byte_ids = [0] * 256
        for character, byte in alphabet.items():
            self._byte_ids[byte] = vocab[character]
        self._bytes_of = {
            i: bytes(alphabet[c] for c in token)
            for token, i in vocab.items() if all(c in alphabet for c in token)
        }
        self._bytes_of |= {i: token.encode() for token, i in self.special.items()}
        self._merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair = vocab[left], vocab[right]
            self._merges.setdefault(pair, (rank, vocab[left + right]))

    def word_ids(self, word: bytes) -> list[int]:
        parts = [self._byte_ids[b] for b in word]
        if len(parts) > SCAN_PARTS:
            return self._merge_long(parts)
        merges = self._merges
        none = (NO_RANK, 0)
        found = [merges.get(pair, none) for pair in zip(parts, parts[1:])]
        ranks = [rank for rank, _ in found]
        while ranks:
            low = min(ranks)
            if low == NO_RANK:
                break
            i = ranks.index(low)
            parts[i] = merges[parts[i], parts[i + 1]][1]
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = merges.get((parts[i - 1], parts[i]), none)[0]
            if i < len(ranks):
                ranks[i] = merges.get((parts[i], parts[i + 1]), none)[0]
        return parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        merges, n = self._merges, len(parts)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [
            (merges[pair][0], i, pair) for i, pair in enumerate(zip(parts, parts[1:]))
            if pair in merges
        ]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if j < 0 or (parts[i], parts[j]) != pair:
                continue
            parts[i], parts[j] = merges[pair][1], -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
            for a, b in ((before[i], i), (i, k)):
                if a >= 0 and b >= 0 and (pair := (parts[a], parts[b])) in merges:
                    heapq.heappush(heap, (merges[pair][0], a, pair))
        return [part for part in parts if part >= 0]

    def decode(self, ids) -> str:
        """Text of ids; bytes that are not UTF-8 become replacement characters."""
        return b"".join(map(self._bytes_of.__getitem__, ids)).decode("utf-8", "replace")


@functools.cache
def codec(path: str) -> tuple[RankArrayBpe, ChunkEncoder]:
    """Vocabulary and cached encoder, once in each Python worker."""
    bpe = RankArrayBpe(path)
    return bpe, ChunkEncoder(lambda word: little_endian(bpe.word_ids(word.encode())), bpe.special)


def bpe_documents(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """doc_id, ids (array of int) and decoded (string) of every text; no shuffle.

    Null and empty texts have no ids and decode to an empty text. Each row is encoded by itself,
    so repeated rows and equal or null ids give equal rows; other columns are ignored. Very long
    words merge through a heap. An empty table gives no rows.
    """
    path = tokenizer_path or default_tokenizer()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        bpe, encoder = codec(path)
        for batch in batches:
            ids = [np.frombuffer(c, "<u4") for c in encoder.many(text_list(batch, "text"))]
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            flat = np.concatenate([*ids, np.zeros(0, "<u4")]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                    pa.array([bpe.decode(x.tolist()) for x in ids], pa.string()),
                ],
                ["doc_id", "ids", "decoded"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        encode, "doc_id long, ids array<int>, decoded string"
    )


def bpe_digests(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """The digests of bpe_documents, made beside the ids so that these stay in their worker."""
    path = tokenizer_path or default_tokenizer()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, encoder = codec(path)
        for batch in batches:
            counts, of_ids, of_text = [], [], []
            for ids in encoder.many(text_list(batch, "text")):
                decoded = bpe.decode(memoryview(ids).cast("I").tolist() if ids else ())
                counts.append(len(ids) // 4)
                of_ids.append(hashlib.sha256(ids).hexdigest())
                of_text.append(hashlib.sha256(decoded.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(counts, pa.int64()),
                    pa.array(of_ids, pa.string()), pa.array(of_text, pa.string()),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def op4_rank_array_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"))

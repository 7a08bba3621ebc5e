"""Byte-level BPE by Spark's higher-order functions.

A word's bytes become an array of parts, each packed with the rank of the merge with its right
neighbour and with its place, so that the smallest part is the next to merge. A fold replaces it and
the part after it by the merged one, and looks up the two ranks beside it, until no rank is left; the
ranks of all pairs come from a scalar subquery. A step takes parts out of the array and puts others
in: slices that are concatenated, or lambdas over all parts, take Spark several times as long.
Decoding turns ids into their byte pieces, an array beside the ranks, and concatenates them.

All words of the documents are counted; each of the most frequent ones is folded once, and what
that gives, of bounded size, is broadcast. Texts are cut in Arrow batches, where known words become
ids; the words beyond are folded where they stand, so nothing but word counts is shuffled, and no
text ever moves.

Tables of several MB are subqueries and not literals, since Spark spells literals out wherever it
describes a plan, and keeps the descriptions of past queries in the driver.
"""

from __future__ import annotations

import base64
import heapq
import json
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.llm.chunks import ChunkEncoder, little_endian
from flowloom.llm.texts import table, text_list
from flowloom.session import run_dir

#: Parts are packed as (rank * PLACES + place) * SHIFT + id: the rank of the merge with the next part,
#: the place of the part's first byte, which tells equal ranks apart, and the part's id.
SHIFT = 1 << 20
PLACES = 1 << 13
#: The edge of a word, an id that no file has.
EDGE = SHIFT - 1
NO_RANK = 1 << 20
#: Pairs are dealt to maps by the low bits of left * SPREAD + right, since Spark scans a map for its
#: key. There are more maps than ids, so a map's key is left alone.
SPREAD = 31
#: Words, by falling frequency, that every task knows; the others are folded in place.
KNOWN_WORDS = 1 << 20
#: Words of more characters are merged by a heap, since a fold copies its array in every step.
FOLD_CHARACTERS = 1_024
#: Above all ids: stands for a word that is not known, with the word's place in a list.
UNKNOWN = 1 << 24
#: Bytes of text that are cut together; their unknown words are held only so long.
CUT_BYTES = 4 << 20
#: Chunks with signs or digits whose ids a worker keeps, twice; letters alone are looked up.
KEPT_CHUNKS = 1 << 16

#: White space, and the letters and numbers that Unicode 14 to 16 added and older Java
#: versions do not know (fixed values of the format).
_SPACE = r"\t-\r \x85\xa0  -     　"
_NEW_LETTERS = (
    r"\x{870}-\x{887}\x{889}-\x{88e}\x{8b5}\x{8c8}-\x{8c9}\x{c5d}\x{cdd}\x{170d}\x{171f}\x{1b4c}"
    r"\x{1c89}-\x{1c8a}\x{2c2f}\x{2c5f}\x{9ffd}-\x{9fff}\x{a7c0}-\x{a7c1}\x{a7cb}-\x{a7cd}"
    r"\x{a7d0}-\x{a7d1}\x{a7d3}\x{a7d5}-\x{a7dc}\x{a7f2}-\x{a7f4}\x{10570}-\x{1057a}"
    r"\x{1057c}-\x{1058a}\x{1058c}-\x{10592}\x{10594}-\x{10595}\x{10597}-\x{105a1}"
    r"\x{105a3}-\x{105b1}\x{105b3}-\x{105b9}\x{105bb}-\x{105bc}\x{105c0}-\x{105f3}"
    r"\x{10780}-\x{10785}\x{10787}-\x{107b0}\x{107b2}-\x{107ba}\x{10d4a}-\x{10d65}"
    r"\x{10d6f}-\x{10d85}\x{10ec2}-\x{10ec4}\x{10f70}-\x{10f81}\x{11071}-\x{11072}\x{11075}"
    r"\x{1123f}-\x{11240}\x{11380}-\x{11389}\x{1138b}\x{1138e}\x{11390}-\x{113b5}\x{113b7}"
    r"\x{113d1}\x{113d3}\x{11740}-\x{11746}\x{11ab0}-\x{11abf}\x{11bc0}-\x{11be0}\x{11f02}"
    r"\x{11f04}-\x{11f10}\x{11f12}-\x{11f33}\x{12f90}-\x{12ff0}\x{1342f}\x{13441}-\x{13446}"
    r"\x{13460}-\x{143fa}\x{16100}-\x{1611d}\x{16a70}-\x{16abe}\x{16d40}-\x{16d6c}\x{18cff}"
    r"\x{1aff0}-\x{1aff3}\x{1aff5}-\x{1affb}\x{1affd}-\x{1affe}\x{1b11f}-\x{1b122}\x{1b132}"
    r"\x{1b155}\x{1df00}-\x{1df1e}\x{1df25}-\x{1df2a}\x{1e030}-\x{1e06d}\x{1e290}-\x{1e2ad}"
    r"\x{1e4d0}-\x{1e4eb}\x{1e5d0}-\x{1e5ed}\x{1e5f0}\x{1e7e0}-\x{1e7e6}\x{1e7e8}-\x{1e7eb}"
    r"\x{1e7ed}-\x{1e7ee}\x{1e7f0}-\x{1e7fe}\x{2a6de}-\x{2a6df}\x{2b735}-\x{2b739}"
    r"\x{2ebf0}-\x{2ee5d}\x{31350}-\x{323af}"
)
_NEW_NUMBERS = (
    r"\x{10d40}-\x{10d49}\x{116d0}-\x{116e3}\x{11bf0}-\x{11bf9}\x{11f50}-\x{11f59}"
    r"\x{16130}-\x{16139}\x{16ac0}-\x{16ac9}\x{16d70}-\x{16d79}\x{1ccf0}-\x{1ccf9}"
    r"\x{1d2c0}-\x{1d2d3}\x{1e4f0}-\x{1e4f9}\x{1e5f1}-\x{1e5fa}"
)
# One range is tested before the many, so that common characters cost one test.
_LETTER = rf"[A-Za-z\p{{L}}[\x{{870}}-\x{{323af}}&&[{_NEW_LETTERS}]]]"
_NUMBER = rf"[\p{{N}}[\x{{870}}-\x{{323af}}&&[{_NEW_NUMBERS}]]]"
_OTHER = (
    rf"[[^{_SPACE}]&&\P{{L}}&&\P{{N}}&&"
    rf"[\x{{0}}-\x{{86f}}[^{_NEW_LETTERS}{_NEW_NUMBERS}]]]"
)
#: public_tokenizers.PATTERN for Java, whose classes know fewer characters.
PATTERN = (
    rf"'(?:[stmd]|re|ve|ll)| ?{_LETTER}+| ?{_NUMBER}+| ?{_OTHER}+|"
    rf"[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
#: A character that this Java does not know. Python's regex module may know it, and class it
#: otherwise than the format does, so Spark cuts texts that hold one.
_UNASSIGNED = r"[\x{80}-\x{10ffff}&&\p{Cn}]"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@cache
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


def merged(ranks: dict[bytes, int], piece: bytes, below: int | None = None) -> list[bytes]:
    """Parts of a piece when all merges of a rank below the bound are done, lowest rank first.

    A heap over linked parts: time grows with n log n, whatever the length.
    """
    n = len(piece)
    ends = list(range(1, n + 1))
    starts = list(range(n))  # start of the part that ends before a place, by place
    at: dict[int, int] = dict(zip(starts, ends, strict=True))
    before = {end: start for start, end in at.items()}
    limit = len(ranks) if below is None else below
    heap = []

    def offer(start: int) -> None:
        middle = at[start]
        if middle in at:
            rank = ranks.get(piece[start:at[middle]])
            if rank is not None and rank < limit:
                heapq.heappush(heap, (rank, start, middle, at[middle]))

    for start in range(n):
        offer(start)
    while heap:
        _, start, middle, end = heapq.heappop(heap)
        if at.get(start) != middle or at.get(middle) != end:
            continue
        at[start], before[end] = end, start
        del at[middle], before[middle]
        offer(start)
        if start in before:
            offer(before[start])
    return [piece[a:b] for a, b in sorted(at.items())]


@cache
def rank_tables(path: str) -> str:
    """A rank file as JSON: maps of pairs to ranks, first parts of two bytes (256: none), pieces of
    ids."""
    ranks = read_ranks(path)
    if max(ranks.values()) >= EDGE or any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("a rank for every byte, and none of 2**20 - 1 or more, is needed")
    # More maps than ids, so that the edge shares its place with no id.
    maps: list[dict[int, int]] = [{} for _ in range(1 << (max(ranks.values()) + 1).bit_length())]
    for piece, rank in ranks.items():
        if len(piece) == 1:
            continue
        parts = merged(ranks, piece, rank)
        # Merges of lower ranks leave two parts of any piece that merging can ever make; for
        # another any two parts may meet.
        pairs = [tuple(parts)] if len(parts) == 2 else [
            (piece[:i], piece[i:]) for i in range(1, len(piece))
            if piece[:i] in ranks and piece[i:] in ranks
        ]
        for left, right in pairs:
            key = ranks[left]
            maps[(key * SPREAD + ranks[right]) % len(maps)][key] = rank * SHIFT * PLACES
    by_rank = {rank: piece.decode("latin-1") for piece, rank in ranks.items()}
    first = [
        ranks.get(bytes([a, b]) if b < 256 else b"", NO_RANK) * SHIFT * PLACES + ranks[bytes([a])]
        for a in range(256) for b in range(257)
    ]
    return json.dumps({
        "pairs": maps, "first": first, "last_map": len(maps) - 1,
        "pieces": [by_rank.get(i, "") for i in range(max(by_rank) + 1)],
    }, ensure_ascii=False)


def with_value(
    df: DataFrame, name: str, value: pa.Array, *then: Callable[[Column], Column]
) -> DataFrame:
    """df with the only element of an array, after some functions, as a column.

    It is a scalar subquery, which functions of functions may not hold themselves. Ask for the
    column once, in the next select: then Spark puts it there, and no row holds it.
    """
    column = F.col("value")
    for function in then:
        column = function(column)
    rows = df.sparkSession.createDataFrame(pa.table({"value": value}))
    return df.withColumn(name, rows.select(column.alias("value")).scalar())


def with_tables(df: DataFrame, path: str) -> DataFrame:
    """df with the tables of a rank file as the column tables; see with_value()."""
    return with_value(
        df, "tables", pa.array([rank_tables(path)]),
        lambda text: F.from_json(
            text, "pairs array<map<string, bigint>>, first array<bigint>, last_map bigint, "
            "pieces array<string>"
        ),
        lambda read: read.cast(
            "struct<pairs: array<map<bigint, bigint>>, first: array<bigint>, last_map: bigint, "
            "pieces: array<string>>"
        ),
    )


def _rank(tables: Column, left: Column, right: Column) -> Column:
    """The rank of the merge of two ids, where parts are packed with it."""
    place = (left * SPREAD + right).bitwiseAND(tables["last_map"]).cast("int")
    rank = F.try_element_at(F.get(tables["pairs"], place), left)
    return F.coalesce(rank, F.lit(NO_RANK * SHIFT * PLACES))


def _id(part: Column) -> Column:
    return part.bitwiseAND(F.lit(SHIFT - 1).cast("bigint"))


def fold(tables: Column, word: Column) -> Column:
    """Ids of a word: its bytes, merged by rank."""
    characters = F.split(F.decode(F.encode(word, "UTF-8"), "ISO-8859-1"), "")
    none = NO_RANK * SHIFT * PLACES

    def pack(codes: Column) -> Column:
        parts = F.transform(codes, lambda code, i: F.get(
            tables["first"], code * 257 + F.coalesce(F.get(codes, i + 1), F.lit(256))
        ) + i * F.lit(SHIFT).cast("bigint"))
        return F.flatten(F.array(
            F.array(F.lit(none + EDGE)), parts,
            F.array(F.lit(none + (PLACES - 1) * SHIFT + EDGE)),
        ))

    def merge(parts: Column, i: Column) -> Column:
        """The parts after the merge of the part that array_position() calls i with the next."""
        before, low, gone = (F.get(parts, i - k) for k in (2, 1, 0))
        whole = F.shiftright(low, 33)
        place = low.bitwiseAND(F.lit((PLACES - 1) * SHIFT))
        rest = F.array_remove(F.array_remove(F.array_remove(parts, gone), low), before)
        return F.array_insert(
            F.array_insert(
                rest, i - 1, _rank(tables, whole, _id(F.get(parts, i + 1))) + place + whole
            ),
            i - 1,
            _rank(tables, _id(before), whole) + before.bitwiseAND(F.lit(SHIFT * PLACES - 1)),
        )

    def step(parts: Column, _: Column) -> Column:
        low = F.array_min(parts)
        return F.when(low >= none, parts).otherwise(
            let(F.array_position(parts, low).cast("int"), lambda i: merge(parts, i))
        )

    folded = F.aggregate(
        F.sequence(F.lit(2), F.octet_length(word)), let(F.transform(characters, F.ascii), pack), step
    )
    return F.transform(
        F.filter(folded, lambda part: _id(part) != EDGE), lambda part: _id(part).cast("int")
    )


def pieces_of(tables: Column, ids: Column) -> Column:
    """The bytes of ids, concatenated."""
    pieces = let(tables["pieces"], lambda all: F.transform(ids, lambda i: F.get(all, i)))
    return F.encode(F.array_join(pieces, ""), "ISO-8859-1")


def words_of(text: Column) -> Column:
    """The matches of the pattern, one after the other; null has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PATTERN), F.lit(0))


def _texts(docs: DataFrame) -> DataFrame:
    """doc_id, text and, where Spark has to cut the text, its words instead."""
    odd = F.coalesce(F.col("text").rlike(_UNASSIGNED), F.lit(False))
    return docs.select(
        "doc_id", F.when(~odd, F.col("text")).alias("text"),
        F.when(odd, words_of(F.col("text"))).alias("words"),
    )


class Cutter(ChunkEncoder):
    """Ids of texts in which words that are not known stand as UNKNOWN + their place in others.

    Only codes without such words are kept, so others can be emptied between texts.
    """

    def __init__(self, known: dict[str, bytes], encode_long: Callable[[str], bytes]) -> None:
        super().__init__(self._word, {})
        self._known, self._encode_long = known, encode_long
        self._places: dict[str, int] = {}
        self.others: list[str] = []

    def forget(self) -> None:
        self._places, self.others = {}, []

    def _word(self, word: str) -> bytes:
        ids = self._known.get(word)
        if ids is None:
            if len(word) > FOLD_CHARACTERS:
                return self._encode_long(word)
            place = self._places.setdefault(word, len(self.others))
            if place == len(self.others):
                self.others.append(word)
            ids = little_endian([UNKNOWN + place])
        return ids

    def _letters(self, key: str) -> bytes:
        return self._word(" " + key)

    def _keep(self, key: str, ids: bytes) -> None:
        # The highest byte of an id is 0, of UNKNOWN it is not.
        if not any(ids[3::4]):
            if len(self._chunks) >= KEPT_CHUNKS:
                self._chunks, self._older = self._older, self._chunks
                self._chunks.clear()
            self._chunks[key] = ids

    def _codes(self, keys: list[str]) -> list[bytes]:
        """Ids of chunks: letters alone are one word, other chunks may be kept."""
        known, codes = self._known.get, []
        for key in keys:
            if key.isalpha():
                ids = known(" " + key) or self._word(" " + key)
            else:
                ids = self._chunks.get(key)
                if ids is None:
                    ids = self._older.get(key) or self._chunk(key)
                    self._keep(key, ids)
            codes.append(ids)
        return codes

    def cut(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """All ids of _texts() rows, one text after the other, and where each text ends."""
        words = batch.column("words")
        ids = list(self.many(text_list(batch, "text")))
        for i in np.flatnonzero(words.is_valid().to_numpy(zero_copy_only=False)).tolist():
            ids[i] = b"".join(map(self._word, words[i].as_py()))
        return np.frombuffer(b"".join(ids), "<u4"), np.cumsum([len(i) // 4 for i in ids], dtype=int)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows of a batch with some CUT_BYTES of text, or one longer row."""
    lengths = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy()
    runs = np.cumsum(lengths, dtype=int) // CUT_BYTES
    stops = [*(np.flatnonzero(np.diff(runs)) + 1).tolist(), batch.num_rows]
    for start, stop in zip([0, *stops], stops):
        yield batch.slice(start, stop - start)


def word_counts(docs: DataFrame) -> DataFrame:
    """word, n: how often each word stands in the texts. Tasks combine before they shuffle."""
    return docs.select(F.explode(words_of(F.col("text"))).alias("word")).groupBy("word").agg(
        F.count("*").alias("n")
    )


def known_words(counts: DataFrame, path: str, most: int = KNOWN_WORDS) -> dict[str, bytes]:
    """The ids, little-endian, of the most frequent words: at most so many, and so bounded.

    Frequencies are classed by eighths of powers of two (512 classes at most); the classes
    that fit come whole.
    """
    short = counts.where(F.length("word") <= FOLD_CHARACTERS).withColumn(
        "frequency", F.floor(F.log2("n") * 8)
    )
    classes = short.groupBy("frequency").agg(F.count("*").alias("words")).collect()
    least, held = None, 0
    for row in sorted(classes, key=lambda r: -r["frequency"]):
        held += row["words"]
        if held > most:
            break
        least = row["frequency"]
    if least is None:
        return {}
    folded = with_tables(short.where(F.col("frequency") >= least), path).select(
        "word", let(F.col("tables"), lambda t: fold(t, F.col("word"))).alias("ids")
    ).toArrow()
    ids = folded["ids"].combine_chunks()
    flat, ends = little_endian(ids.flatten().to_numpy()), (ids.offsets.to_numpy() * 4).tolist()
    codes = (flat[a:b] for a, b in zip(ends, ends[1:]))
    return dict(zip(folded["word"].to_pylist(), codes, strict=True))


def _cut(docs: DataFrame, path: str, known: dict[str, bytes]) -> DataFrame:
    """doc_id, others (the words that are not known) and ids (what stands before each, and at last
    behind them)."""
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def encode_long(word: str) -> bytes:
        ranks = read_ranks(path)
        return little_endian([ranks[part] for part in merged(ranks, word.encode())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Cutter(shared.value, encode_long)
        for batch in (part for whole in batches for part in _slices(whole)):
            cutter.forget()
            ids, ends = cutter.cut(batch)
            at = np.flatnonzero(ids >= UNKNOWN)
            before = np.searchsorted(at, ends)  # unknown words before the end of each text
            stops = np.sort(np.concatenate([at - np.arange(len(at)), ends - before]))
            rows = np.arange(1, len(ends) + 1)
            others = [cutter.others[i] for i in (ids[at] - UNKNOWN).tolist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    _lists(before, pa.array(others, pa.string())),
                    _lists(before + rows, _lists(
                        stops, pa.array(ids[ids < UNKNOWN].astype(np.int32))
                    )),
                ],
                ["doc_id", "others", "ids"],
            )

    return _texts(docs).mapInArrow(run, "doc_id long, others array<string>, ids array<array<int>>")


def _lists(ends: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), values)


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids (array of int) and id_text (the same in decimal, joined by one space) of every
    text.

    Null and empty texts have no ids and an empty id_text. Each row is encoded by itself, so
    repeated rows and equal or null ids give equal rows; other columns are ignored, and texts count
    whole. Words of more than FOLD_CHARACTERS characters are merged by a heap in Python, to
    the same ids. An empty table gives no rows.
    """
    path = path or default_ranks()
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counted = run_dir(spark, "word-counts")
    word_counts(docs).write.parquet(counted)
    known = known_words(spark.read.parquet(counted), path)

    def whole(tables: Column) -> Column:
        return F.flatten(F.zip_with("ids", "others", lambda ids, word: F.when(
            word.isNull(), ids
        ).otherwise(F.concat(ids, fold(tables, word)))))

    return with_tables(_cut(docs, path, known), path).select(
        "doc_id", let(F.col("tables"), whole).alias("ids")
    ).withColumn("id_text", F.array_join(F.col("ids").cast("array<string>"), " "))


def with_ids(encoded_docs: DataFrame, path: str | None = None) -> DataFrame:
    """The rows of encoded() with decoded (binary)."""
    return with_tables(encoded_docs, path or default_ranks()).select(
        *encoded_docs.columns,
        let(F.col("tables"), lambda t: pieces_of(t, F.col("ids"))).alias("decoded"),
    )


def op11_folded_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_ids(encoded(table(spark, sf_dir, "documents"))).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.col("id_text").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )

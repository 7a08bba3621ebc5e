"""Ranked lexical search by hashed max-sketches.

Every document is folded into a sketch: its terms are hashed to cells, and a cell keeps the
largest frequency of the terms in it. A term's impact in a document rises with its frequency, so
the impact of a cell's maximum bounds that of all its terms. A query's terms look up their cells;
the weighted sum is an upper bound of the query's score, and never below it. Bounds of many
documents and many queries are one matrix product. Documents are then scored exactly in the
order of falling bounds, until the bound falls below the last score that still counts.

The index is a Parquet table: documents with their sketches (non-zero cells) and term vectors, and
how many documents of each task hold a term. It knows nothing of the queries.
"""

from __future__ import annotations

import heapq
import math
import struct
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowloom.llm.texts import only_caches_of, table
from flowloom.session import run_dir

TOP = 50
#: A sketch has a power of two of cells, at least so many for each distinct term.
CELLS_PER_TERM, LEAST_CELLS = 8, 64
#: The cell value for all frequencies above 254; its impact is the largest there is.
SATURATED, LARGEST_IMPACT = 255, 1_000_000
#: Bytes of text that are folded together.
RUN_BYTES = 1 << 20
#: Pairs of a query and a term that are asked together.
BLOCK_PAIRS = 65_536
#: Cells of sketches that are multiplied together.
PRODUCT_CELLS = 4_000_000
#: Entries that a worker keeps: hashes of terms, and document counts before they are handed on.
HASH_ENTRIES, COUNT_ENTRIES = 500_000, 500_000

#: ASCII but digits and letters parts terms; A to Z are lower-cased.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)

INDEX = "kind string, doc_id long, n long, cells binary, terms binary, counts binary, df long"


class _TermHashes(dict):
    def __missing__(self, term: bytes) -> int:
        import xxhash

        if len(self) >= HASH_ENTRIES:
            self.clear()
        self[term] = value = xxhash.xxh32_intdigest(term)
        return value


_HASH = _TermHashes()


def terms_of(text: bytes | None) -> list[bytes]:
    """Terms of a text in UTF-8: every byte beyond ASCII is part of one."""
    return (text or b"").translate(_TERM_BYTES).split()


def width_of(terms: int) -> int:
    return max(LEAST_CELLS, 1 << (CELLS_PER_TERM * terms - 1).bit_length())


def sketches(vectors: list[Counter]) -> list[bytes]:
    """Width, then the non-zero cells (their distances, 32 bits each), then the cells' maxima."""
    sizes = np.fromiter(map(len, vectors), np.int64, len(vectors))
    hashes = np.fromiter((_HASH[t] for v in vectors for t in v), np.int64, int(sizes.sum()))
    counts = np.fromiter((c for v in vectors for c in v.values()), np.int64, len(hashes))
    widths = np.array([width_of(s) for s in sizes.tolist()], np.int64)
    owner = np.repeat(np.arange(len(vectors)), sizes)
    key = (owner << 32) | (hashes & (widths[owner] - 1))
    order = np.argsort(key)
    key, counts = key[order], np.minimum(counts[order], SATURATED)
    first = np.flatnonzero(np.diff(key, prepend=-1))
    maxima = np.maximum.reduceat(counts, first).astype(np.uint8) if len(first) else counts
    owner, cells = key[first] >> 32, key[first] & 0xFFFFFFFF
    bounds = np.searchsorted(owner, np.arange(len(vectors) + 1)).tolist()
    steps = np.diff(cells, prepend=0)
    starts = np.array(bounds[:-1])[np.diff(bounds) > 0]
    steps[starts] = cells[starts]
    steps = steps.astype("<u4")
    return [
        struct.pack("<I", width) + steps[a:b].tobytes() + maxima[a:b].tobytes()
        for width, a, b in zip(widths.tolist(), bounds, bounds[1:])
    ]


def opened(sketch: bytes) -> tuple[int, np.ndarray, np.ndarray]:
    """Width, non-zero cells and their maxima."""
    filled = (len(sketch) - 4) // 5
    steps = np.frombuffer(sketch, "<u4", filled, 4)
    return (
        struct.unpack_from("<I", sketch)[0], np.cumsum(steps, dtype=np.int64),
        np.frombuffer(sketch, np.uint8, filled, 4 + 4 * filled),
    )


def write_index(docs: DataFrame, path: str) -> None:
    """Write the sketch index of all documents that have a term; nothing is shuffled.

    Texts without a term (null, empty, punctuation alone) are not part of any count. Rows are told
    apart by being rows: repeated rows and ids are documents of their own. Other columns are
    ignored, and texts count whole. An empty table writes an empty index.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        only_caches_of("max_sketch", _HASH)

        def counted() -> pa.RecordBatch:
            return _index_rows(
                "term", len(held), terms=list(held), df=pa.array(list(held.values()), pa.int64())
            )

        for batch in batches:
            for part in _runs(batch):
                texts = part.column("text").cast(pa.binary()).to_pylist()
                vectors = [Counter(terms_of(text)) for text in texts]
                kept = [i for i, v in enumerate(vectors) if v]
                vectors = [vectors[i] for i in kept]
                for vector in vectors:
                    held.update(vector.keys())
                yield _index_rows(
                    "doc", len(kept),
                    doc_id=part.column("doc_id").take(pa.array(kept, pa.int64())),
                    n=pa.array([v.total() for v in vectors], pa.int64()), cells=sketches(vectors),
                    terms=[b" ".join(v) for v in vectors],
                    counts=[np.fromiter(v.values(), "<u4", len(v)).tobytes() for v in vectors],
                )
                if len(held) >= COUNT_ENTRIES:
                    yield counted()
                    held.clear()
        if held:
            yield counted()

    docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        build, INDEX
    ).write.partitionBy("kind").option("compression", "zstd").parquet(path)


def _runs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about RUN_BYTES of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy()
    run = np.cumsum(sizes) // RUN_BYTES
    bounds = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]
    for a, b in zip(bounds, bounds[1:]):
        yield batch.slice(a, b - a)


def _index_rows(kind: str, size: int, **columns) -> pa.RecordBatch:
    kinds = {
        "kind": pa.string(), "doc_id": pa.int64(), "n": pa.int64(), "cells": pa.binary(),
        "terms": pa.binary(), "counts": pa.binary(), "df": pa.int64(),
    }
    columns["kind"] = [kind] * size
    return pa.RecordBatch.from_arrays(
        [
            c if isinstance(c := columns.get(name), pa.Array)
            else pa.array(c, k) if c is not None else pa.nulls(size, k)
            for name, k in kinds.items()
        ],
        list(kinds),
    )


@dataclass(frozen=True)
class Queries:
    """Some queries: their ids, and the weighted terms of each."""

    ids: list[int]
    terms: list[list[tuple[bytes, int]]]
    documents: int
    all_terms: int

    def length_factor(self, n: int) -> int:
        return 50 + 50 * n * self.documents // self.all_terms

    def score(self, query: int, vector: dict[bytes, int], m: int) -> int:
        total = 0
        for term, weight in self.terms[query]:
            tf = vector.get(term)
            if tf:
                total += weight * (1_000_000_000 * tf // (1000 * tf + 20 * m))
        return total


class Search:
    """The best documents of each query among those that were offered."""

    def __init__(self, queries: Queries, top: int) -> None:
        self._queries, self._top = queries, top
        self._best: list[list] = [[] for _ in queries.ids]
        self._least = np.ones(len(queries.ids))
        self._looked_up: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self._arrived = 0
        # Sums of so many positive single-precision products are short by less than this share.
        most = max(map(len, queries.terms), default=0)
        self._room = 1 + 4 * float(np.finfo(np.float32).eps) * (most + 2)
        #: Pairs scored exactly.
        self.scored = 0

    def _lookups(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Cells that any query asks, and each query's summed weights of them."""
        if width not in self._looked_up:
            asked = [
                (_HASH[t] & (width - 1), q, w)
                for q, terms in enumerate(self._queries.terms) for t, w in terms
            ]
            cells, place = np.unique(np.array([c for c, _, _ in asked]), return_inverse=True)
            weights = np.zeros((len(cells), len(self._queries.ids)), np.float32)
            np.add.at(weights, (place, [q for _, q, _ in asked]), [w for _, _, w in asked])
            self._looked_up[width] = cells, weights
        return self._looked_up[width]

    def bounds(self, opened_sketches: list, width: int, lengths: list[int]) -> np.ndarray:
        """Upper bounds of all queries (columns) for documents of one sketch width."""
        cells, weights = self._lookups(width)
        place = np.full(width, -1)
        place[cells] = np.arange(len(cells))
        rows = np.repeat(np.arange(len(opened_sketches)), [len(c) for _, c, _ in opened_sketches])
        column = place[np.concatenate([c for _, c, _ in opened_sketches])]
        tf = np.concatenate([t for _, _, t in opened_sketches]).astype(np.int64)
        met = column >= 0
        rows, column, tf = rows[met], column[met], tf[met]
        factors = np.array([min(self._queries.length_factor(n), 2**50) for n in lengths])
        impacts = np.where(
            tf == SATURATED, LARGEST_IMPACT,
            1_000_000_000 * tf // (1000 * tf + 20 * factors[rows]),
        )
        dense = np.zeros((len(opened_sketches), len(cells)), np.float32)
        dense[rows, column] = impacts
        return (dense @ weights).astype(np.float64) * self._room

    def offer(self, doc_ids: list, lengths: list, cells: list, terms: list, counts: list) -> None:
        by_width: dict[int, list[tuple[int, tuple]]] = {}
        for i, sketch in enumerate(cells):
            own = opened(sketch)
            by_width.setdefault(own[0], []).append((i, own))
        for width, some in by_width.items():
            step = max(1, PRODUCT_CELLS // max(width, len(self._queries.ids)))
            for at in range(0, len(some), step):
                part = some[at:at + step]
                places = [i for i, _ in part]
                bounds = self.bounds([own for _, own in part], width, [lengths[i] for i in places])
                self._rescore(bounds, places, doc_ids, lengths, terms, counts)

    def _rescore(self, bounds, places, doc_ids, lengths, terms, counts) -> None:
        vectors: dict[int, tuple[dict, int]] = {}
        for query in np.flatnonzero((bounds >= self._least).any(axis=0)).tolist():
            column = bounds[:, query]
            near = np.flatnonzero(column >= self._least[query])
            best = self._best[query]
            for k in near[np.argsort(-column[near], kind="stable")].tolist():
                if column[k] < self._least[query]:
                    break
                if k not in vectors:
                    i = places[k]
                    vector = dict(zip(
                        terms[i].split(b" "), np.frombuffer(counts[i], "<u4").tolist(), strict=True
                    ))
                    vectors[k] = vector, self._queries.length_factor(lengths[i])
                self.scored += 1
                score = self._queries.score(query, *vectors[k])
                if score <= 0:
                    continue
                doc_id = doc_ids[places[k]]
                self._arrived += 1
                # Smaller ids win ties, and a null id loses them.
                entry = (score, doc_id is not None, -(doc_id or 0), self._arrived)
                if len(best) < self._top:
                    heapq.heappush(best, entry)
                else:
                    heapq.heappushpop(best, entry)
                if len(best) == self._top:
                    self._least[query] = best[0][0]

    def found(self) -> Iterator[tuple[int, int | None, int]]:
        for query, best in zip(self._queries.ids, self._best, strict=True):
            for score, known, negative, _ in best:
                yield query, -negative if known else None, score


def query_terms(items: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """item_id, term: each once. Items of the same id are one item; a null id asks nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for item, text in zip(batch.column("item_id").to_pylist(), texts, strict=True):
                terms = list(dict.fromkeys(terms_of(text)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(terms), pa.int64()), pa.array(terms, pa.binary())],
                    ["item_id", "term"],
                )

    return items.where(F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("item_id"), F.col(text_column).alias("text")
    ).mapInArrow(run, "item_id long, term binary").distinct()


def search(
    spark: SparkSession, path: str, items: DataFrame, top: int = TOP, id_column: str = "item_id",
    text_column: str = "text",
) -> DataFrame:
    """item_id, rank, doc_id, score of each item's best documents of a written index.

    Scores are above 0; equal scores go by ascending doc_id (null last), and fewer documents give
    fewer rows. Items that share an id are one item of all their terms; null ids, null texts and
    texts without terms give no rows. An empty index or item table gives none.

    Items are asked in blocks of about BLOCK_PAIRS terms; each block is one scan of the index, in
    which every task keeps its own best, and only those are shuffled.
    """
    index = spark.read.schema(INDEX).parquet(path)
    documents = index.where("kind = 'doc'")
    size = documents.agg(F.count("*").alias("n"), F.sum("n").alias("terms")).first()
    asked_path = run_dir(spark, "asked-terms")
    query_terms(items, id_column, text_column).write.parquet(asked_path)
    asked = spark.read.parquet(asked_path)
    held = index.where("kind = 'term'").select(F.col("terms").alias("term"), "df").join(
        asked.select("term").distinct(), "term", "left_semi"
    ).groupBy("term").agg(F.sum("df").alias("df"))
    weighed_path = run_dir(spark, "weighed-terms")
    asked.join(held, "term").write.parquet(weighed_path)
    weighed = spark.read.parquet(weighed_path)
    blocks = max(1, -(-weighed.count() // BLOCK_PAIRS))
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    best_path = run_dir(spark, "block-best")
    for b in range(blocks):
        queries = _queries(weighed.where(block == b), size["n"], size["terms"])
        _best_of(documents, queries, top).write.mode("append").parquet(best_path)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    # Tasks' best meet in parts of an item first, so no task gets what all tasks found of one.
    parts = Window.partitionBy("item_id", "part").orderBy(*order)
    whole = Window.partitionBy("item_id").orderBy(*order)
    near = spark.read.parquet(best_path).withColumn("place", F.row_number().over(parts)).where(
        F.col("place") <= top
    )
    return near.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= top).select(
        "item_id", "rank", "doc_id", "score"
    )


def _queries(weighed: DataFrame, documents: int, all_terms: int) -> Queries:
    by_item: dict[int, list[tuple[bytes, int]]] = {}
    for item, term, df in weighed.select("item_id", "term", "df").collect():
        weight = math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))
        by_item.setdefault(item, []).append((bytes(term), weight))
    ids = sorted(by_item)
    return Queries(ids, [by_item[i] for i in ids], documents, all_terms or 1)


def _best_of(documents: DataFrame, queries: Queries, top: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not queries.ids:
            return
        search = Search(queries, top)
        for batch in batches:
            search.offer(*(
                batch.column(c).to_pylist() for c in ("doc_id", "n", "cells", "terms", "counts")
            ))
        found = list(search.found())
        yield pa.RecordBatch.from_arrays(
            [pa.array([f[i] for f in found], pa.int64()) for i in range(3)],
            ["item_id", "doc_id", "score"],
        )

    return documents.select("doc_id", "n", "cells", "terms", "counts").mapInArrow(
        run, "item_id long, doc_id long, score long"
    ).withColumn("part", F.pmod(F.spark_partition_id(), F.lit(64)))


def op13_max_sketch_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "sketch-index")
    write_index(table(spark, sf_dir, "documents"), path)
    return search(spark, path, table(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), held AS (
    SELECT row_id, doc_id, len(terms) AS n, terms FROM docs WHERE len(terms) > 0
), size AS (
    SELECT count(*) AS docs, sum(n)::HUGEINT AS all_terms FROM held
), asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark WHERE item_id IS NOT NULL
), tfs AS (
    SELECT row_id, doc_id, n, term, count(*) AS tf
    FROM (SELECT row_id, doc_id, n, unnest(terms) AS term FROM held)
    WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weights AS (
    SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
    FROM tfs, size GROUP BY term
), scores AS (
    SELECT item_id, row_id, doc_id, sum(w * ((1000000000 * tf) //
        (1000 * tf + 20 * (50 + (50 * n::HUGEINT * docs) // all_terms)))) AS score
    FROM tfs JOIN weights USING (term) JOIN asked USING (term), size
    GROUP BY item_id, row_id, doc_id
), ranked AS (
    SELECT item_id, row_number() OVER (
        PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank, doc_id, score
    FROM scores WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score::BIGINT AS score FROM ranked WHERE rank <= 50
"""

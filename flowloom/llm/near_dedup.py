"""Near duplicates by ProbMinHash, banding and verification.

Texts are sets of five-word shingles, and a shingle weighs as many characters as its words have.
ProbMinHash lets the shingles of a text arrive in a Poisson process each, at a rate of their
weight, and gives every register to the first arrival it sees; arrivals later than the last
register's are never drawn. Two texts agree in a register with their probability Jaccard. A
shingle weighs the same in every text, so that this is the share of shingle characters that the
two have in common, by which pairs are verified. Texts that agree in a whole band of registers
meet in a bucket.

Exact copies are one node from the start. Buckets are compared in blocks of bounded size: a task
holds the shingle sets of two blocks, gets all similarities from matrix products, and hands on
no pairs but the few links that join its classes. The first round compares a block with itself
and some pivots in some bands, which joins most of what belongs together; the second compares all
blocks of the buckets that still hold several classes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.llm.texts import only_caches_of, table, text_list
from flowloom.session import drop_dir, run_dir

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 7
REGISTERS = BANDS * ROWS
#: Members of a bucket that are compared with each other in one task, about; two blocks meet.
BLOCK = 512
#: Bands of the first round, and members of a bucket that all its blocks meet there, about.
FIRST_BANDS, PIVOTS = 8, 64
#: Shingles whose columns are multiplied together.
PRODUCT_SHINGLES = 4_096
#: Shingles whose arrivals are drawn together.
BATCH_SHINGLES = 400_000
#: Entries that a worker keeps: hashes of words, and texts it has seen.
WORD_ENTRIES, NODE_ENTRIES = 500_000, 500_000

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) >= WORD_ENTRIES:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word.encode())
        return value


_WORD_HASH = _WordHashes()


def words_of(text: str) -> list[str]:
    return text.lower().split()


def shingle_set(text: str) -> set:
    """Distinct shingles; a text of fewer words is one shingle, one without words has none."""
    words = words_of(text)
    if len(words) < SHINGLE:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(SHINGLE))))


def weight(shingles: set) -> int:
    """Characters of the words of all shingles."""
    return sum(len(word) for shingle in shingles for word in shingle)


def similarity(ours: set, theirs: set) -> float:
    """Probability Jaccard of two texts' shingles; 0 if one has none."""
    shared = weight(ours & theirs)
    return shared / (weight(ours) + weight(theirs) - shared) if shared else 0.0


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def weighted_shingles(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of distinct shingles, rising, and their weights."""
    hashes = np.array([_WORD_HASH[w] for w in words], dtype=np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    if len(words) < SHINGLE:
        whole = np.array([len(words)], dtype=np.uint64)
        for i in range(len(hashes)):
            whole = _mixed(whole * _GOLDEN + hashes[i:i + 1])
        return whole, sizes.sum(keepdims=True)
    last = len(hashes) - SHINGLE + 1
    rolled, weights = hashes[:last].copy(), sizes[:last].copy()
    for i in range(1, SHINGLE):
        rolled = rolled * _GOLDEN + hashes[i:last + i]
        weights += sizes[i:last + i]
    distinct, first = np.unique(_mixed(rolled), return_index=True)
    return distinct, weights[first]


def prob_min_hash(
    elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, texts: int,
    registers: int = REGISTERS,
) -> np.ndarray:
    """The element that each register of each text holds.

    elements, weights and owner (number of the text, ascending) are aligned; every text must own
    an element. All texts draw their next arrivals together, and an element stops at the first
    arrival that no register of its text could take.
    """
    first = np.full(texts * registers, np.inf)
    holder = np.zeros(texts * registers, dtype=np.uint64)
    time = np.zeros(len(elements))
    state = elements.copy()
    active = np.arange(len(elements))
    while len(active):
        state_now = state[active] + _GOLDEN
        state[active] = state_now
        draw = _mixed(state_now)
        uniform = ((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        arrival = time[active] - np.log(uniform) / weights[active]
        time[active] = arrival
        slot = (_mixed(draw + _GOLDEN) >> np.uint64(33)) % np.uint64(registers)
        owners = owner[active]
        place = owners * registers + slot.astype(np.int64)
        np.minimum.at(first, place, arrival)
        won = first[place] == arrival
        holder[place[won]] = elements[active[won]]
        present = np.unique(owners)
        last = np.zeros(texts)
        last[present] = first.reshape(texts, registers)[present].max(axis=1)
        active = active[arrival < last[owners]]
    return holder.reshape(texts, registers)


def _band_keys(holders: np.ndarray) -> np.ndarray:
    """One key per text and band; its low five bits are the band's number."""
    banded = holders.reshape(len(holders), BANDS, ROWS)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), banded.shape[:2]).copy()
    for row in range(ROWS):
        key = _mixed(key * _GOLDEN + banded[:, :, row])
    return (key & ~np.uint64(BANDS - 1) | np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def _node(words: list[str]) -> bytes:
    """What exact copies share: a digest of the words."""
    return hashlib.md5(" ".join(words).encode(), usedforsecurity=False).digest()


def _sketch(texts: Iterable[list[str]]) -> list[list[int]]:
    """Band keys of texts that are given as words (none without words), some held at a time."""
    bands: list[list[int]] = []
    pending: list[tuple[int, np.ndarray, np.ndarray]] = []
    held = 0

    def flush() -> None:
        if pending:
            holders = prob_min_hash(
                np.concatenate([e for _, e, _ in pending]),
                np.concatenate([w for _, _, w in pending]),
                np.repeat(np.arange(len(pending)), [len(e) for _, e, _ in pending]), len(pending),
            )
            for (i, _, _), keys in zip(pending, _band_keys(holders), strict=True):
                bands[i] = keys.tolist()
            pending.clear()

    for i, words in enumerate(texts):
        bands.append([])
        if words:
            pending.append((i, *weighted_shingles(words)))
            held += len(pending[-1][1])
            if held >= BATCH_SHINGLES:
                flush()
                held = 0
    flush()
    return bands


def sketch(docs: DataFrame) -> DataFrame:
    """doc_id, node, row_hash of each row, and bands of the first row of a node in a task.

    A later row of the same text has null bands, as has a text without words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        only_caches_of("near_dedup", _WORD_HASH)
        for batch in batches:
            nodes: list[bytes] = []
            fresh: list[int] = []

            def unseen(batch=batch, nodes=nodes, fresh=fresh) -> Iterator[list[str]]:
                for i, text in enumerate(text_list(batch, "text")):
                    words = words_of(text)
                    nodes.append(node := _node(words))
                    if node not in seen:
                        if len(seen) >= NODE_ENTRIES:
                            seen.clear()
                        seen.add(node)
                        fresh.append(i)
                        yield words

            found = _sketch(unseen())
            bands: list[list[int] | None] = [None] * batch.num_rows
            for i, keys in zip(fresh, found, strict=True):
                bands[i] = keys or None
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(nodes, pa.binary()),
                    batch.column("row_hash"), pa.array(bands, pa.list_(pa.int64())),
                ],
                ["doc_id", "node", "row_hash", "bands"],
            )

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", _row_hash(docs).alias("row_hash")
    ).mapInArrow(run, "doc_id long, node binary, row_hash long, bands array<long>")


def _row_hash(docs: DataFrame) -> Column:
    """A hash of the whole row, but for maps, which Spark does not hash."""
    hashed = [F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()]
    return F.xxhash64(*hashed)


def with_nodes(docs: DataFrame) -> DataFrame:
    """docs (its columns as the struct rest) with row_hash and node."""
    rest = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    shaped = docs.select(rest.alias("rest"), _row_hash(docs).alias("row_hash"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("rest").field("text").to_pylist()
            nodes = [_node(words_of(text or "")) for text in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("rest"), batch.column("row_hash"), pa.array(nodes, pa.binary())],
                ["rest", "row_hash", "node"],
            )

    kind = dict(shaped.dtypes)["rest"]
    return shaped.mapInArrow(run, f"rest {kind}, row_hash long, node binary")


class Scratch:
    """Tables written below the shared folder, which cuts lineage, and deleted when done with."""

    def __init__(self, spark: SparkSession) -> None:
        self._spark = spark
        self._paths: dict[int, tuple[DataFrame, str]] = {}

    def stored(self, df: DataFrame, label: str) -> DataFrame:
        path = run_dir(self._spark, label)
        df.write.option("compression", "zstd").parquet(path)
        read = self._spark.read.parquet(path)
        self._paths[id(read)] = read, path
        return read

    def drop(self, *tables: DataFrame) -> None:
        for df in tables:
            drop_dir(self._spark, self._paths.pop(id(df))[1])

    def close(self) -> None:
        self.drop(*(df for df, _ in list(self._paths.values())))


def components(edges: DataFrame) -> DataFrame:
    """node, label (smallest node of its component) of every node of the edges (a, b).

    Alternating large and small stars; the edges are stored after each round, and the last ones
    remain. Aggregates combine before they shuffle, and a hub's joins are left to adaptive skew
    splitting.
    """
    return _components(edges, Scratch(edges.sparkSession))


def _components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    edges = scratch.stored(
        edges.where(F.col("a") != F.col("b")).select(
            F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
        ).distinct(), "stars",
    )
    # Done once every node hangs on a node that hangs on nothing, by one edge.
    while not _are_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(
            F.col("v").alias("u"), F.col("m").alias("v")
        ).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select(
            F.explode(F.array(
                F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
            )).alias("e")
        ).select("e.*").where(F.col("u") != F.col("v")).distinct()
        before, edges = edges, scratch.stored(small, "stars")
        scratch.drop(before)
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        roots.withColumn("label", F.col("node"))
    )


def _are_stars(edges: DataFrame) -> bool:
    shape = edges.agg(F.count("*").alias("n"), F.count_distinct("u").alias("d")).first()
    if shape["n"] != shape["d"]:
        return False
    hubs = edges.select(F.col("v").alias("u")).distinct()
    return edges.join(hubs, "u", "left_semi").limit(1).count() == 0


def links(sets: list[tuple[np.ndarray, np.ndarray]], labels: list[bytes]) -> Iterator[tuple]:
    """Pairs of labels (larger, smaller) that join all classes which links of these sets connect.

    All similarities are sums over shared shingles, a matrix product for some thousand shingles
    at a time; only shingles that two sets hold are multiplied.
    """
    names, label = np.unique(np.array(labels, dtype=object), return_inverse=True)
    if len(names) < 2:
        return
    owner = np.repeat(np.arange(len(sets)), [len(h) for h, _ in sets])
    _, shingle, counts = np.unique(
        np.concatenate([h for h, _ in sets]), return_inverse=True, return_counts=True
    )
    weights = np.concatenate([w for _, w in sets]).astype(np.float64)
    totals = np.bincount(owner, weights, len(sets))
    # Sums of whole numbers, exact in either precision.
    kind = np.float32 if totals.max() < 2**23 else np.float64
    shared = np.flatnonzero(counts > 1)
    place = np.full(len(counts), -1)
    place[shared] = np.arange(len(shared))
    column = place[shingle]
    met = column >= 0
    order = np.argsort(column[met], kind="stable")
    owner, column, weights = owner[met][order], column[met][order], weights[met][order]
    common = np.zeros((len(sets), len(sets)), kind)
    for start in range(0, len(shared), PRODUCT_SHINGLES):
        part = slice(*np.searchsorted(column, [start, start + PRODUCT_SHINGLES]))
        held = np.zeros((len(sets), PRODUCT_SHINGLES), kind)
        held[owner[part], column[part] - start] = 1
        weighed = np.zeros_like(held)
        weighed[owner[part], column[part] - start] = weights[part]
        common += weighed @ held.T
    common = common.astype(np.float64)
    alike = common >= SIMILARITY * (totals[:, None] + totals[None, :] - common)
    alike &= common > 0
    # Walk over classes: those of the sets that a set of the class is linked to.
    unseen = np.ones(len(names), dtype=bool)
    for first in range(len(names)):
        if not unseen[first]:
            continue
        unseen[first] = False
        stack = [first]
        while stack:
            reached = label[alike[label == stack.pop()].any(axis=0)]
            fresh = np.unique(reached[unseen[reached]])
            unseen[fresh] = False
            stack += fresh.tolist()
            for other in fresh.tolist():
                yield names[other], names[first]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each group of rows with the same bucket and task; groups stand together."""
    key, members = None, {}

    def found() -> pa.RecordBatch:
        sets = [
            (np.frombuffer(s, "<u8", len(s) // 12), np.frombuffer(s, "<u4", len(s) // 12,
                                                                 8 * (len(s) // 12)))
            for _, s in members.values()
        ]
        pairs = list(links(sets, [label for label, _ in members.values()]))
        return pa.RecordBatch.from_arrays(
            [pa.array([p[i] for p in pairs], pa.binary()) for i in (0, 1)], ["a", "b"]
        )

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("bucket", "task", "node", "label", "held"))
        for bucket, task, node, label, held in zip(*columns, strict=True):
            if (bucket, task) != key:
                if len(members) > 1:
                    yield found()
                key, members = (bucket, task), {}
            members[node] = label, held
    if len(members) > 1:
        yield found()


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node and held (hashes and weights of the shingles) of texts."""
    only_caches_of("near_dedup", _WORD_HASH)
    for batch in batches:
        held = []
        for text in text_list(batch, "text"):
            hashes, weights = weighted_shingles(words_of(text))
            held.append(hashes.astype("<u8").tobytes() + weights.astype("<u4").tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("node"), pa.array(held, pa.binary())], ["node", "held"]
        )


def _text_nodes(docs: DataFrame) -> DataFrame:
    """node and text, a text once in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            nodes = [_node(words_of(text)) for text in text_list(batch, "text")]
            fresh = []
            for i, node in enumerate(nodes):
                if node not in seen:
                    if len(seen) >= NODE_ENTRIES:
                        seen.clear()
                    seen.add(node)
                    fresh.append(i)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([nodes[i] for i in fresh], pa.binary()),
                    batch.column("text").take(pa.array(fresh, pa.int64())),
                ],
                ["node", "text"],
            )

    return docs.select("text").mapInArrow(run, "node binary, text string")


def _linked(members: DataFrame, sets: DataFrame, tasks: Column, scratch: Scratch) -> DataFrame:
    """Classes (node, label) that join the labels of members, compared in their tasks."""
    dealt = members.select("bucket", "node", "label", F.explode(tasks).alias("task"))
    found = dealt.join(sets, "node").repartition("bucket", "task").sortWithinPartitions(
        "bucket", "task"
    ).mapInArrow(_compare, "a binary, b binary")
    return _components(found, scratch)


def classes(sketches: DataFrame, docs: DataFrame, scratch: Scratch) -> DataFrame:
    """node, label: classes of two or more different texts that links connect."""
    banded = sketches.where("bands IS NOT NULL").select(
        "node", F.explode("bands").alias("bucket")
    )
    # Two texts differ in their nodes; copies that other tasks met are no second member.
    crowded = banded.withColumn("h", F.xxhash64("node")).groupBy("bucket").agg(
        F.min("h").alias("low"), F.max("h").alias("high")
    ).where("low < high").select("bucket")
    found = banded.join(crowded, "bucket").distinct()
    members = scratch.stored(found.withColumn("label", F.col("node")), "members")
    sizes = members.groupBy("bucket").agg(F.count("*").alias("n"))
    members = scratch.stored(members.join(sizes, "bucket"), "sized-members")
    wanted = members.select("node").distinct()
    texts = _text_nodes(docs).join(wanted, "node", "left_semi")
    sets = scratch.stored(
        texts.mapInArrow(_shingle_rows, "node binary, held binary").dropDuplicates(["node"]), "sets"
    )

    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    pivot = F.pmod(F.xxhash64("node", "bucket"), F.ceil(F.col("n") / PIVOTS)) == 0
    every = F.sequence(F.lit(0), blocks - 1)
    first = F.pmod(F.col("bucket"), F.lit(BANDS)) < FIRST_BANDS
    merged = _linked(
        members.where(first), sets, F.when(pivot, every).otherwise(F.array(own)), scratch
    )
    joined = members.join(
        merged.select(F.col("node").alias("label"), F.col("label").alias("new")), "label", "left"
    ).withColumn("label", F.coalesce("new", "label")).drop("new")
    # A bucket that one block held was compared whole.
    mixed = joined.where(~first | (F.col("n") > BLOCK)).groupBy("bucket").agg(
        F.min(F.xxhash64("label")).alias("low"), F.max(F.xxhash64("label")).alias("high")
    ).where("low < high").select("bucket")
    pairs = F.when(blocks == 1, F.array(F.lit(0))).otherwise(F.transform(
        F.filter(every, lambda other: other != own),
        lambda other: F.least(own, other) * blocks + F.greatest(own, other),
    ))
    again = _linked(joined.join(mixed, "bucket"), sets, pairs, scratch)
    return _components(
        merged.unionByName(again).select(F.col("node").alias("a"), F.col("label").alias("b")),
        scratch,
    )


def class_table(docs: DataFrame) -> DataFrame:
    """One row for each text (node) of a class of two or more rows.

    node; class_id, the smallest doc_id of the class; and the row that stands for the class: its
    keeper (node), keeper_id and keeper_hash, and how many rows are equal to it. The table is
    stored, and all that led to it deleted. Aggregates combine before they shuffle, so a text
    that a third of all rows share is one row of each task.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    sketches = scratch.stored(sketch(docs), "sketches")
    labels = classes(sketches, docs, scratch)
    rows = sketches.groupBy("node", "doc_id", "row_hash").agg(F.count("*").alias("copies"))
    labelled = rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    first = F.min(F.struct(
        F.col("doc_id").isNull().alias("unknown"), "doc_id", "node", "row_hash", "copies"
    ))
    found = labelled.groupBy("label").agg(
        first.alias("first"), F.sum("copies").alias("n")
    ).where("n > 1").select(
        "label", F.col("first.doc_id").alias("class_id"), F.col("first.node").alias("keeper"),
        F.col("first.doc_id").alias("keeper_id"), F.col("first.row_hash").alias("keeper_hash"),
        F.col("first.copies").alias("copies"),
    )
    nodes = labelled.select("node", "label").distinct()
    path = run_dir(spark, "near-classes")
    nodes.join(found, "label").drop("label").write.parquet(path)
    scratch.close()
    return spark.read.parquet(path)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """docs with class_id, the smallest doc_id of the (near) copies of each row.

    Words are split at white space and lower-cased. Texts of the same words are copies; texts of
    fewer than five words are copies only so; texts without words (null, empty) are copies of each
    other. Texts are near copies if they share 0.8 or more of the weight of their five-word
    shingles, a shingle weighing as many characters as its words have, and classes are what such
    links connect. Rows are told apart by their texts, so equal ids and repeated rows are fine; a
    class whose ids are all null has a null class_id. All rows and other columns are kept (a
    class_id among them is replaced). Whole texts count, whatever their length. An empty table
    gives no rows.
    """
    docs = docs.drop("class_id")
    found = class_table(docs).select("node", "class_id", F.lit(True).alias("grouped"))
    own = F.col("rest")["doc_id"].cast("long")
    return with_nodes(docs).join(found, "node", "left").select(
        *(F.col("rest")[c].alias(c) for c in docs.columns),
        F.when(F.col("grouped"), F.col("class_id")).otherwise(own).alias("class_id"),
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of each class of near_duplicates(): that of the smallest doc_id (null last).

    Of several rows of that id, the one of the smallest text digest, then row hash, is kept, and
    of rows that are equal in all columns one. Columns are those of docs; an empty table stays
    empty.
    """
    found = class_table(docs)
    rows = with_nodes(docs).join(found, "node", "left")
    own = F.col("rest")["doc_id"].cast("long")
    stands = (F.col("node") == F.col("keeper")) & own.eqNullSafe(F.col("keeper_id")) & (
        F.col("row_hash") == F.col("keeper_hash")
    )
    kept = rows.where(F.col("keeper").isNull() | (stands & (F.col("copies") == 1)))
    repeated = found.where((F.col("copies") > 1) & (F.col("node") == F.col("keeper")))
    names = [F.col("rest")[c].alias(c) for c in docs.columns]
    if repeated.limit(1).count():
        once = with_nodes(docs).join(repeated, "node").where(stands)
        kept = kept.select("node", "rest").unionByName(
            once.groupBy("node").agg(F.first("rest").alias("rest"))
        )
    return kept.select(*names)


def op9_prob_min_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select(
        "doc_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("kept")
    )

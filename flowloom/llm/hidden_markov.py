"""Language model: a hidden Markov model over word classes.

The most frequent words are classes of their own; all other words fall into classes by their
last letters, with the word's share of its class as a factor of its own. So the probability of a
text is the scaled forward recursion over its classes times those shares, which is exact, and the
model that is broadcast stays bounded while counts cover every word of the corpus.

Baum-Welch: each task adds up expected counts of its documents, Spark sums them over tasks, and
the driver only divides. Counts start from states named by the document's most frequent word and
the word's length.
"""

from __future__ import annotations

import itertools
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.llm.resampling import kth_largest
from flowloom.llm.texts import fold, table, text_list
from flowloom.session import run_dir

#: Words that are classes of their own, and classes of all others.
OWN_CLASSES, OTHER_CLASSES = 8_192, 2_048
CLASSES = OWN_CLASSES + OTHER_CLASSES + 1
END_CLASS = CLASSES - 1
#: Words whose counts every task holds; the rest are looked up by a join.
HEAD_WORDS = 200_000
GROUPS, LENGTHS = 4, 3
STATES = GROUPS * LENGTHS
ITERATIONS = 2
#: Training reads documents in runs of so many tokens; scoring never cuts a text.
RUN_TOKENS = 256
BLOCK_RUNS = 1_024
#: Distinct words a task counts before it hands them on.
COUNTED_WORDS = 400_000
SUFFIX = 3


def tokens(text: str) -> list[bytes]:
    """Words of a text: ASCII letters lower-cased, split at the six ASCII white spaces."""
    return text.encode().lower().split()


def other_class(word: bytes) -> int:
    return OWN_CLASSES + zlib.crc32(word[-SUFFIX:]) % OTHER_CLASSES


def count_words(docs: DataFrame) -> DataFrame:
    """word (binary), n over all texts; tasks add up before the shuffle."""

    def batch_of(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())],
            ["word", "n"],
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in text_list(batch, "text"):
                counts.update(tokens(text))
                if len(counts) >= COUNTED_WORDS:
                    yield batch_of(counts)
                    counts = Counter()
        if counts:
            yield batch_of(counts)

    return docs.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(
        F.sum("n").alias("n")
    )


@dataclass(frozen=True)
class Vocabulary:
    """What every task knows of the counts: the most frequent words and the classes' totals.

    total and distinct are N and V, the end counted in both. class_total counts the words of a
    class, and unknown_mass is the share of its probability kept for words not met in training.
    """

    words: dict[bytes, int]
    counts: np.ndarray
    ends: int
    total: int
    distinct: int
    class_total: np.ndarray
    unknown_mass: np.ndarray

    def head_columns(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Class, log10(c + 1) and log10 share of its class of each head word."""
        kinds = np.array(
            [i if i < OWN_CLASSES else other_class(w) for w, i in self.words.items()],
            dtype=np.int64,
        )
        share = np.zeros(len(kinds))
        late = kinds >= OWN_CLASSES
        of = kinds[late] - OWN_CLASSES
        share[late] = np.log10(
            (1 - self.unknown_mass[of]) * self.counts[late] / self.class_total[of]
        )
        return kinds, np.log10(self.counts + 1.0), share


def vocabulary(stored: DataFrame, ends: int) -> tuple[Vocabulary, DataFrame]:
    """The bounded part of stored word counts, and the table of all other classes' totals."""
    n_sum, distinct = stored.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    # Words met more often than the HEAD_WORDS-th: fewer than HEAD_WORDS, and no sort of all.
    often = 0
    if distinct > HEAD_WORDS:
        often = kth_largest(stored.select(F.col("n").cast("double")), "n", HEAD_WORDS)
    head = sorted(stored.where(F.col("n") > often).collect(), key=lambda r: (-r["n"], r["word"]))
    own = [bytes(r["word"]) for r in head[:OWN_CLASSES]]
    least = (head[len(own) - 1]["n"], own[-1]) if own else (0, b"")
    # Own classes are the first words in the order (count down, word up).
    is_own = (F.col("n") > least[0]) | (
        (F.col("n") == least[0]) & (F.col("word") <= F.lit(bytearray(least[1])))
    )
    rest = stored.where(~is_own) if own else stored
    per_class = rest.groupBy(_class_of("word").alias("class")).agg(
        F.sum("n").alias("n"), F.sum((F.col("n") == 1).cast("long")).alias("once")
    ).collect()  # at most OTHER_CLASSES rows
    total, once = np.zeros(OTHER_CLASSES), np.zeros(OTHER_CLASSES)
    for r in per_class:
        total[r["class"] - OWN_CLASSES], once[r["class"] - OWN_CLASSES] = r["n"], r["once"]
    # Good-Turing: words met once stand for those not met; a class without words has no other.
    unknown = np.where(total > 0, (once + 1) / (total + 2), 1.0)
    vocab = Vocabulary(
        {bytes(r["word"]): i for i, r in enumerate(head)},
        np.array([r["n"] for r in head], dtype=np.float64), ends, n_sum + ends,
        distinct + (ends > 0), np.maximum(total, 1.0), unknown,
    )
    spark = stored.sparkSession
    classes = spark.createDataFrame(
        [(OWN_CLASSES + i, float(vocab.class_total[i]), float(unknown[i]))
         for i in range(OTHER_CLASSES)], "class int, class_total double, unknown double",
    )
    return vocab, classes


def _class_of(column: str):
    suffix = F.when(F.length(column) > SUFFIX, F.substring(column, -SUFFIX, SUFFIX)).otherwise(
        F.col(column)
    )
    return (F.lit(OWN_CLASSES) + F.crc32(suffix) % OTHER_CLASSES).cast("int")


ENCODED = (
    "row_id long, doc_id long, held_out boolean, n_tokens long, head_known long, "
    "head_base double, head_share double, classes binary, tail array<binary>, times array<int>"
)


def encode(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """One row per document: its classes (16 bits each), sums over head words, tail words."""
    spread = docs.sparkSession.sparkContext.broadcast(vocab)  # at most HEAD_WORDS entries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = spread.value
        kinds, base, share = vocab.head_columns()
        # Index -1 is a word outside the head.
        kinds, base, share = (np.append(x, 0) for x in (kinds, base, share))
        row_id = TaskContext.get().partitionId() << 40
        end_base = math.log10(vocab.ends + 1)
        for batch in batches:
            rows = []
            for text in text_list(batch, "text"):
                words = tokens(text)
                at = np.fromiter(
                    map(vocab.words.get, words, itertools.repeat(-1)), np.int64, len(words)
                )
                outside = np.flatnonzero(at < 0)
                classes = np.empty(len(words) + 1, dtype="<u2")
                classes[:-1] = kinds[at]
                classes[-1] = END_CLASS
                tail: Counter = Counter()
                if len(outside):
                    late = [words[i] for i in outside]
                    classes[outside] = [other_class(w) for w in late]
                    tail.update(late)
                rows.append((
                    row_id, len(words) + 1, len(words) - len(outside) + (vocab.ends > 0),
                    float(base[at].sum()) + end_base, float(share[at].sum()),
                    classes.tobytes(), list(tail.keys()), list(tail.values()),
                ))
                row_id += 1
            kinds_of = (
                pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(),
                pa.list_(pa.binary()), pa.list_(pa.int32()),
            )
            made = [
                pa.array(c, k)
                for c, k in zip(zip(*rows, strict=True) if rows else [()] * 8, kinds_of,
                                strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [made[0], batch.column("doc_id"), batch.column("held_out"), *made[1:]],
                [c.split()[0] for c in ENCODED.split(", ")],
            )

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, ENCODED)


@dataclass(frozen=True)
class Hmm:
    """start: first states of texts; resume: of later runs; move and emit by state (rows sum to 1)."""

    start: np.ndarray
    resume: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # by class, then state

    @staticmethod
    def from_counts(counts: np.ndarray) -> Hmm:
        """Counts by slot and state: classes, then state rows of moves, then start and resume."""
        def shares(x):
            return x / x.sum(axis=-1, keepdims=True)

        emit, rest = counts[:CLASSES], counts[CLASSES:]
        weight = emit.sum(axis=1, keepdims=True)
        # A little of the overall distribution in every state, and of every class in that.
        overall = (weight + 0.05) / (weight + 0.05).sum()
        return Hmm(
            shares(rest[STATES] + 0.1), shares(rest[STATES + 1] + 0.1),
            shares(rest[:STATES] + 0.1), shares((emit + 50.0 * overall).T).T.copy(),
        )


def _runs(classes: np.ndarray) -> Iterator[tuple[np.ndarray, bool]]:
    for at in range(0, len(classes), RUN_TOKENS):
        yield classes[at:at + RUN_TOKENS], at == 0


def _first_counts(counts: np.ndarray, classes: np.ndarray) -> None:
    """Counts of one document by states read off its words."""
    words = classes[classes < OWN_CLASSES]
    group = int(np.bincount(words).argmax()) % GROUPS if len(words) else 0
    length = np.where(classes == END_CLASS, 0, np.where(classes < 256, 0, 1))
    length = np.where((classes >= OWN_CLASSES) & (classes != END_CLASS), 2, length)
    states = group * LENGTHS + length
    np.add.at(counts, (classes, states), 1.0)
    np.add.at(counts, (CLASSES + states[:-1], states[1:]), 1.0)
    counts[CLASSES + STATES, states[0]] += 1
    counts[CLASSES + STATES + 1, states[-1]] += 1


def _expected_counts(counts: np.ndarray, runs: list, model: Hmm) -> None:
    """Adds the expected counts of some runs (classes, whether it starts a text)."""
    runs.sort(key=lambda r: -len(r[0]))
    sizes = np.array([len(r[0]) for r in runs])
    steps, n = int(sizes[0]), len(runs)
    padded = np.zeros((steps, n), dtype=np.int64)
    for i, (classes, _) in enumerate(runs):
        padded[:len(classes), i] = classes
    active = (sizes[None, :] > np.arange(steps)[:, None]).sum(axis=1)
    first = np.where(np.array([f for _, f in runs])[:, None], model.start, model.resume)
    alpha = np.zeros((steps, n, STATES))
    scale = np.ones((steps, n, 1))
    before = first
    for t in range(steps):
        m = active[t]
        now = (before[:m] if t == 0 else before[:m] @ model.move) * model.emit[padded[t, :m]]
        scale[t, :m] = now.sum(axis=1, keepdims=True)
        before = alpha[t, :m] = now / scale[t, :m]
    beta = np.ones((n, STATES))
    moved = np.zeros((STATES, STATES))
    for t in range(steps - 1, -1, -1):
        if t + 1 < steps:
            m = active[t + 1]
            ahead = model.emit[padded[t + 1, :m]] * beta[:m] / scale[t + 1, :m]
            moved += alpha[t, :m].T @ ahead
            beta[:m] = ahead @ model.move.T
        alpha[t] *= beta  # now the chance of each state at t
    counts[CLASSES:CLASSES + STATES] += moved * model.move
    starts = np.array([f for _, f in runs])
    counts[CLASSES + STATES] += alpha[0][starts].sum(axis=0)
    counts[CLASSES + STATES + 1] += alpha[0][~starts].sum(axis=0)
    valid = np.arange(n)[None, :] < active[:, None]
    flat, gamma = padded[valid], alpha[valid]
    for state in range(STATES):
        counts[:CLASSES, state] += np.bincount(flat, gamma[:, state], CLASSES)


def _summed(encoded: DataFrame, model: Hmm | None) -> np.ndarray:
    """Counts over all documents: by first states without a model, else expected ones."""
    columns = [f"s{i}" for i in range(STATES)]
    context = encoded.sparkSession.sparkContext
    spread = context.broadcast(model)  # CLASSES x STATES numbers

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = spread.value
        counts = np.zeros((CLASSES + STATES + 2, STATES))
        runs = []
        for batch in batches:
            for code in batch.column("classes"):
                classes = np.frombuffer(code.as_py(), "<u2").astype(np.int64)
                if model is None:
                    _first_counts(counts, classes)
                    continue
                runs += _runs(classes)
                while len(runs) >= BLOCK_RUNS:
                    _expected_counts(counts, runs[:BLOCK_RUNS], model)
                    runs = runs[BLOCK_RUNS:]
        if runs:
            _expected_counts(counts, runs, model)
        used = np.flatnonzero(counts.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), *(pa.array(counts[used, i]) for i in range(STATES))],
            ["slot", *columns],
        )

    rows = encoded.select("classes").mapInArrow(
        count, "slot int, " + ", ".join(f"{c} double" for c in columns)
    ).groupBy("slot").agg(*(F.sum(c).alias(c) for c in columns)).collect()
    total = np.zeros((CLASSES + STATES + 2, STATES))
    for r in rows:  # at most a row per class and state
        total[r["slot"]] = [r[c] for c in columns]
    return total


def train(encoded: DataFrame, iterations: int = ITERATIONS) -> Hmm:
    """Baum-Welch over all rows of encoded()."""
    model = Hmm.from_counts(_summed(encoded, None))
    for _ in range(iterations):
        model = Hmm.from_counts(_summed(encoded, model))
    return model


def forward(sequences: list[np.ndarray], model: Hmm) -> np.ndarray:
    """Log10 probability of each sequence of classes, all steps of all texts."""
    order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
    sizes = np.array([len(sequences[i]) for i in order])
    flat = np.concatenate([sequences[i] for i in order]) if order else np.zeros(0, np.int64)
    starts = np.cumsum(sizes) - sizes
    found = np.zeros(len(order))
    state = np.broadcast_to(model.start, (len(order), STATES))
    m = len(order)
    for t in range(int(sizes[0]) if m else 0):
        while m and sizes[m - 1] <= t:
            m -= 1
        state = state[:m] if t == 0 else state[:m] @ model.move
        state = state * model.emit[flat[starts[:m] + t]]
        scale = state.sum(axis=1, keepdims=True)
        state = state / scale
        found[:m] += np.log10(scale[:, 0])
    result = np.empty(len(order))
    result[order] = found
    return result


def _likelihoods(encoded: DataFrame, model: Hmm) -> DataFrame:
    spread = encoded.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = spread.value
        for batch in batches:
            found = forward(
                [np.frombuffer(c, "<u2").astype(np.int64)
                 for c in batch.column("classes").to_pylist()], model,
            )
            names = batch.schema.names[:-1]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(found, pa.float64())],
                [*names, "chain"],
            )

    kept = "row_id long, doc_id long, held_out boolean, n_tokens long, head_known long, " \
        "head_base double, head_share double"
    return encoded.select(*(c.split()[0] for c in kept.split(", ")), "classes").mapInArrow(
        run, kept + ", chain double"
    )


def language_model_scores(docs: DataFrame) -> DataFrame:
    """Scores of all documents under models of those outside the held-out fold.

    held_out: crc32 of doc_id as text modulo 7 is 2; a null id is not held out. Null and empty
    texts are the end alone. Each row counts and is scored by itself, so repeated rows and equal
    ids are fine; other columns are ignored. Without training documents every word is unknown.
    Texts are scored whole, whatever their length. An empty table gives no rows.
    """
    spark = docs.sparkSession
    held_out = F.coalesce(fold("doc_id", 7) == 2, F.lit(False))
    docs = docs.select("doc_id", "text", held_out.alias("held_out"))
    training = docs.where(~F.col("held_out"))
    counts_path, encoded_path = run_dir(spark, "word-counts"), run_dir(spark, "encoded")
    count_words(training).write.parquet(counts_path)
    counts = spark.read.parquet(counts_path)
    vocab, classes = vocabulary(counts, training.count())
    encode(docs, vocab).write.option("compression", "zstd").parquet(encoded_path)
    encoded = spark.read.parquet(encoded_path)
    model = train(encoded.where(~F.col("held_out")))

    # Words outside the head are rare each, so this join has no hot key.
    tail = encoded.select(
        "row_id", F.explode(F.arrays_zip("tail", "times")).alias("t")
    ).select("row_id", F.col("t.tail").alias("word"), F.col("t.times").alias("times"))
    known = tail.join(counts, "word", "left").withColumn("class", _class_of("word"))
    share = F.when(
        F.col("n").isNotNull(),
        F.log10((1 - F.col("unknown")) * F.col("n") / F.col("class_total")),
    ).otherwise(F.log10("unknown"))
    sums = known.join(F.broadcast(classes), "class").groupBy("row_id").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("known"),
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 1)).alias("base"),
        F.sum(F.col("times") * share).alias("share"),
    )
    zero = F.lit(0.0)
    spread = F.lit(math.log10(max(1, vocab.total + vocab.distinct + 1)))
    return _likelihoods(encoded, model).join(sums, "row_id", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("head_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(vocab.total).cast("long").alias("train_tokens"),
        (F.col("head_base") + F.coalesce("base", zero) - F.col("n_tokens") * spread).alias(
            "base_score"
        ),
        (F.col("chain") + F.col("head_share") + F.coalesce("share", zero)).alias("score"),
    )


def op5_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model_scores(table(spark, sf_dir, "documents"))

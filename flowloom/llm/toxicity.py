"""Toxicity by a weighted finite-state grammar over clauses.

Five small transducers read a clause word by word: insults and threats (what is said), targets
(to whom), negation and reported speech (how it is meant). Their composition is one table of
transitions whose final states name the pattern of the clause: a targeted insult, a negated one,
a threat someone else is said to have made, and so on. A clause is scored by its pattern and its
insult; a document by its clauses, as the chance that at least one is meant.

The insult lexicon is learned: stems and words that mark toxic training documents. So are the
weights of the patterns, starting from the priors below.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.llm.texts import fold, put_back, set_aside, table, text_list
from flowloom.session import run_dir

#: Labelled rows that the grammar is fitted on, at most about so many (picked by hash of the id).
TRAINING_ROWS = 20_000
#: Entries of the learned lexicon at most, and toxic documents that an entry must mark.
LEXICON_ENTRIES = 2_000
MIN_TOXIC = 3
#: Prefixes of a word that are tried as stems.
STEM_LENGTHS = range(4, 13)
#: The share of an entry's documents that must be toxic.
MIN_PRECISION = 0.85

#: Seed words of the other transducers, in the four languages of the tables.
THREATS = frozenset(
    "kill hurt murder stab shoot strangle destroy burn töten umbringen schlagen tuer frapper "
    "étrangler matar golpear quemar".split()
)
TARGETS = frozenset(
    "you your yourself u he she they them him her du dich dir ihr euch sie tu toi te vous elle "
    "eux tú ti usted ustedes vosotros ellos".split()
)
NEGATIONS = frozenset(
    "not never no nobody neither nor without isn aren wasn don doesn didn nicht kein keine nie "
    "niemals ne pas jamais aucun nunca jamás tampoco".split()
)
REPORTS = frozenset(
    "said says say told wrote writes claimed claims quoted quote quotes reported reportedly "
    "called sagte schrieb behauptet dit écrit affirme dijo escribió afirma".split()
)

INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER = range(6)
#: Words after which a negation no longer reaches the insult.
NEGATION_REACH = 3

#: Prior chance that a clause of a pattern is meant: (act, targeted, negated, reported).
PRIORS = {
    ("insult", False, False, False): 0.90, ("insult", True, False, False): 0.97,
    ("insult", False, True, False): 0.30, ("insult", True, True, False): 0.35,
    ("insult", False, False, True): 0.40, ("insult", True, False, True): 0.45,
    ("insult", False, True, True): 0.15, ("insult", True, True, True): 0.20,
    ("threat", False, False, False): 0.10, ("threat", True, False, False): 0.80,
    ("threat", False, True, False): 0.02, ("threat", True, True, False): 0.10,
    ("threat", False, False, True): 0.05, ("threat", True, False, True): 0.30,
    ("threat", False, True, True): 0.02, ("threat", True, True, True): 0.05,
}
#: Training documents that a prior weighs as much as.
PRIOR_DOCUMENTS = 4.0

_WORD = re.compile(r"[^\W\d_]+")
_CLAUSE_END = re.compile(r"[.!?;:\n]")


@dataclass(frozen=True)
class Transducer:
    """A deterministic machine: next state by (state, symbol); other symbols keep the state."""

    moves: dict[tuple[int, int], int]
    states: int

    def step(self, state: int, symbol: int) -> int:
        return self.moves.get((state, symbol), state)


def _flag(symbol: int) -> Transducer:
    """Remembers that a symbol was read."""
    return Transducer({(0, symbol): 1}, 2)


def _negation() -> Transducer:
    """0 nothing, 1..reach just negated, then 0 again; the last two: negated or plain act read."""
    reach = NEGATION_REACH
    negated, plain = reach + 1, reach + 2
    moves = {}
    for state in range(reach + 1):
        for symbol in range(6):
            if symbol == NEGATION:
                moves[state, symbol] = 1
            elif symbol in (INSULT, THREAT):
                moves[state, symbol] = negated if state else plain
            elif state:
                moves[state, symbol] = state + 1 if state < reach else 0
    for symbol in (INSULT, THREAT):
        moves[negated, symbol] = plain
    return Transducer(moves, reach + 3)


MACHINES = (_flag(INSULT), _flag(THREAT), _flag(TARGET), _negation(), _flag(REPORT))


@functools.cache
def composed() -> tuple[list[list[int]], list[tuple | None]]:
    """The composition of all machines: transitions by state and symbol, pattern by state."""
    start = (0,) * len(MACHINES)
    numbers, pending, moves = {start: 0}, [start], []
    while pending:
        state = pending.pop(0)
        row = []
        for symbol in range(6):
            after = tuple(m.step(s, symbol) for m, s in zip(MACHINES, state, strict=True))
            if after not in numbers:
                numbers[after] = len(numbers)
                pending.append(after)
            row.append(numbers[after])
        moves.append(row)
    patterns: list[tuple | None] = []
    for insult, threat, target, negation, report in numbers:
        act = "insult" if insult else "threat" if threat else None
        negated = negation == NEGATION_REACH + 1
        patterns.append((act, bool(target), negated, bool(report)) if act else None)
    return moves, patterns


@dataclass
class Grammar:
    """The fitted grammar: chance of toxicity by lexicon entry and by pattern.

    Entries ending in $ are whole words, the others stems. unmatched is the chance for a text
    without a matched clause.
    """

    lexicon: dict[str, float] = field(default_factory=dict)
    patterns: dict[tuple, float] = field(default_factory=lambda: dict(PRIORS))
    unmatched: float = 0.05

    def __post_init__(self) -> None:
        self._scan = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_scan": None}

    def _find(self, text: str) -> Iterator[int]:
        """Ends of all places where a lexicon entry or a threat may stand."""
        if self._scan is None:
            import ahocorasick

            self._scan = ahocorasick.Automaton()
            for key in {k.rstrip("$") for k in self.lexicon} | THREATS:
                self._scan.add_word(key, len(key))
            self._scan.make_automaton()
        return ((end - size + 1) for end, size in self._scan.iter(text))

    def insult(self, word: str) -> float:
        """Chance that a word is an insult, 0 if it is not in the lexicon."""
        best = self.lexicon.get(word + "$", 0.0)
        for size in STEM_LENGTHS:
            if size >= len(word):
                break
            best = max(best, self.lexicon.get(word[:size], 0.0))
        return best

    def clauses(self, text: str) -> Iterator[tuple[tuple, float]]:
        """Pattern and insult chance of each matched clause of a text."""
        text = text.lower()
        moves, patterns = composed()
        done = -1
        for start in self._find(text):
            if start < done or (start and text[start - 1].isalpha()):
                continue
            begin = max((m.end() for m in _CLAUSE_END.finditer(text, max(0, done), start)),
                        default=max(0, done))
            end = _CLAUSE_END.search(text, start)
            done = end.end() if end else len(text)
            state, insult = 0, 0.0
            for word in _WORD.findall(text, begin, done):
                chance = self.insult(word)
                if chance:
                    insult, symbol = max(insult, chance), INSULT
                elif word in THREATS:
                    symbol = THREAT
                elif word in TARGETS:
                    symbol = TARGET
                elif word in NEGATIONS:
                    symbol = NEGATION
                elif word in REPORTS:
                    symbol = REPORT
                else:
                    symbol = OTHER
                state = moves[state][symbol]
            if pattern := patterns[state]:
                yield pattern, insult if pattern[0] == "insult" else 1.0

    def score(self, text: str) -> float:
        """Chance that a text is toxic."""
        harmless = 1.0 - self.unmatched
        for pattern, insult in self.clauses(text):
            harmless *= 1.0 - self.patterns[pattern] * insult
        return 1.0 - harmless


def _entries(text: str) -> set[str]:
    """All lexicon entries a text could give."""
    found = set()
    for word in set(_WORD.findall(text.lower())):
        found.add(word + "$")
        found.update(word[:size] for size in STEM_LENGTHS if size < len(word))
    return found


def _count_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of toxic and other documents by entry, of one task."""
    for batch in batches:
        toxic, clean = Counter(), Counter()
        for text, label in zip(
            text_list(batch, "text"), batch.column("toxic").to_pylist(), strict=True
        ):
            (toxic if label else clean).update(_entries(text))
        # An entry that marks no toxic document here still counts against one elsewhere.
        keys = list(toxic.keys() | clean.keys())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(keys, pa.string()), pa.array([toxic[k] for k in keys], pa.int64()),
                pa.array([clean[k] for k in keys], pa.int64()),
            ],
            ["entry", "n_toxic", "n_clean"],
        )


def _family(text: str) -> int:
    """One min-hash of the five-word shingles: (near) copies mostly share it."""
    words = text.lower().split()
    shingles = range(max(1, len(words) - 4))
    return min(zlib.crc32(" ".join(words[i:i + 5]).encode()) for i in shingles)


def training_sample(
    docs: DataFrame, labels: DataFrame, allowed: Column, mark: str, rows: int = TRAINING_ROWS
) -> DataFrame:
    """doc_id, text and the mark (0/1) of about so many labelled documents, all if fewer.

    Rows are picked by hash of the id, so the pick does not depend on partitions. Labels with a
    null id or mark are left out; an id with several labels has the highest.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(mark).isNotNull() & allowed)
    known = known.groupBy("doc_id").agg(F.max(mark).alias(mark))
    total = known.count()
    if total > rows:
        share = int(2**32 * rows / total)
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(2**32)) < share)
    # At most about `rows` small rows: safe to broadcast.
    return docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")


def _lexicon(sample: DataFrame, n_toxic: int, n_clean: int) -> dict[str, float]:
    """Entries chosen greedily for the toxic documents they mark.

    A document counts half as much for each entry that marks it already, and (near) copies of a
    document count as one, so a document that is often copied cannot bring all its words in.
    """
    precision = F.col("n_toxic") / (F.col("n_toxic") + F.col("n_clean") + 0.2)
    counted = sample.mapInArrow(
        _count_entries, "entry string, n_toxic long, n_clean long"
    ).groupBy("entry").agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_clean").alias("n_clean"))
    candidates = {
        r["entry"]: (r["n_toxic"], r["n_clean"])
        for r in counted.where((F.col("n_toxic") >= MIN_TOXIC) & (precision >= MIN_PRECISION))
        .orderBy(F.col("n_toxic").desc(), "entry").limit(LEXICON_ENTRIES * 10).collect()
    }
    # A prefix gives way to a longer one that marks (nearly) the same documents.
    kept = {}
    longest = max((len(e) for e in candidates), default=0)
    for entry, (n, _) in candidates.items():
        stem = entry.rstrip("$")
        if entry.endswith("$"):
            kept[entry] = n
            continue
        longer = [
            candidates[e][0] for e in candidates
            if len(e) <= longest and e != entry and e.startswith(stem) and e.rstrip("$") != stem
        ] + [candidates[stem + "$"][0] if stem + "$" in candidates else 0]
        if max(longer, default=0) < 0.9 * n:
            kept[entry] = n

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_list(batch, "text")
            lists = [sorted(_entries(t) & kept.keys()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(lists, pa.list_(pa.string())),
                    pa.array([_family(t) for t in texts], pa.int64()),
                ],
                ["entries", "family"],
            )

    # At most the toxic rows of the bounded sample.
    toxic = sample.where(F.col("toxic") == 1).mapInArrow(
        marks, "entries array<string>, family long"
    ).collect()
    copies = Counter(r["family"] for r in toxic)
    weights = [1.0 / copies[r["family"]] for r in toxic]
    holders: dict[str, list[int]] = {}
    for i, r in enumerate(toxic):
        for entry in r["entries"]:
            holders.setdefault(entry, []).append(i)
    lexicon: dict[str, float] = {}
    while holders and len(lexicon) < LEXICON_ENTRIES:
        gain = {e: sum(weights[i] for i in held) for e, held in holders.items()}
        entry = max(gain, key=lambda e: (gain[e], kept[e], e))
        if gain[entry] < MIN_TOXIC:
            break
        holders = {e: held for e, held in holders.items() if gain[e] >= MIN_TOXIC}
        n_t, n_c = candidates[entry]
        lexicon[entry] = (n_t + 0.5) / (n_t + n_c * (n_toxic / max(1, n_clean)) + 0.6)
        for i in holders.pop(entry):
            weights[i] /= 2
    return lexicon


def fit(sample: DataFrame) -> Grammar:
    """A grammar from texts with their mark toxic (0/1); priors alone if there is no sample."""
    totals = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n_toxic, n_clean = totals.get(1, 0), totals.get(0, 0)
    grammar = Grammar()
    if not n_toxic:
        return grammar
    grammar = Grammar(lexicon=_lexicon(sample, n_toxic, n_clean))

    def strongest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                repr(max((p for p, _ in grammar.clauses(t)), key=PRIORS.get, default=None))
                for t in text_list(batch, "text")
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.string()), batch.column("toxic")], ["pattern", "toxic"]
            )

    counts: Counter = Counter()
    by_pattern = sample.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(
        strongest, "pattern string, toxic int"
    ).groupBy("pattern", "toxic").count()
    for r in by_pattern.collect():
        counts[r["pattern"], r["toxic"]] += r["count"]

    def chance(pattern, prior: float) -> float:
        yes, no = counts[repr(pattern), 1], counts[repr(pattern), 0]
        return (yes + PRIOR_DOCUMENTS * prior) / (yes + no + PRIOR_DOCUMENTS)

    grammar.patterns = {p: chance(p, prior) for p, prior in PRIORS.items()}
    grammar.unmatched = min(0.5, chance(None, 0.05))
    return grammar


def score(docs: DataFrame, grammar: Grammar, threshold: float = 0.7) -> DataFrame:
    """docs with score (0 to 1, higher: likelier toxic) and predicted (1 if score >= threshold).

    All rows and all their columns are kept; a column named score or predicted is replaced. Null
    and empty texts have the chance of an unmatched text. Equal texts score alike. Whole texts
    are read, whatever their length. An empty table gives no rows. No shuffle.
    """
    docs = docs.drop("score", "predicted")
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [grammar.score(text) for text in text_list(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(name) for name in names), pa.array(scores, pa.float64()),
                    pa.array([int(s >= threshold) for s in scores], pa.int32()),
                ],
                [*names, "score", "predicted"],
            )

    schema = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes)
    return docs.mapInArrow(run, f"{schema}, score double, predicted int")


def fitted(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> Grammar:
    """The grammar learned from labelled rows outside the held-out fold."""
    sample = training_sample(docs, labels, fold("doc_id", 3) != 1, "toxic")
    path = run_dir(spark, "toxicity-sample")
    sample.write.parquet(path)
    return fit(spark.read.parquet(path))


def keep(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """The rows of docs that are not predicted as toxic, with all their columns and no others.

    Null and empty texts stay, equal texts share a verdict, whole texts are read, and an empty
    table stays empty.
    """
    return put_back(score(set_aside(docs), grammar).where("predicted = 0"), docs.columns)


def op2_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    grammar = fitted(spark, docs, table(spark, sf_dir, "labels"))
    held_out = F.coalesce(fold("doc_id", 3) == 1, F.lit(False))
    return score(docs, grammar).select(
        "doc_id", held_out.alias("held_out"), "score", "predicted"
    )

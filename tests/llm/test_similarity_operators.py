"""Near duplicates and nearest neighbours against brute force."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowloom.llm import near_dedup, permutation_index
from flowloom.llm.texts import table


def brute_classes(texts):
    """Number of the first text of each text's class, by all pairs."""
    sets = [near_dedup.shingle_set(t or "") for t in texts]
    words = [near_dedup.words_of(t or "") for t in texts]
    parent = list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(texts)), 2):
        if words[i] == words[j] or near_dedup.similarity(sets[i], sets[j]) >= 0.8:
            a, b = sorted((find(i), find(j)))
            parent[b] = a
    return [find(i) for i in range(len(texts))]


def test_near_duplicates(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").orderBy("doc_id").select("doc_id", "text").collect()
    found = {r.doc_id: r.class_id for r in
             near_dedup.op9_prob_min_hash(spark, sf_dir).collect()}
    wanted = brute_classes([r.text for r in rows])
    assert [found[r.doc_id] for r in rows] == [rows[i].doc_id for i in wanted]


def test_crowded_buckets(spark):
    """Chains of near copies and a passage that many texts share."""
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(4000)]
    chain = [rng.choice(vocabulary, 120).tolist()]
    for _ in range(40):
        last = list(chain[-1])
        last[int(rng.integers(120))] = str(rng.choice(vocabulary))
        chain.append(last)
    passage = rng.choice(vocabulary, 60).tolist()
    sharing = [passage + rng.choice(vocabulary, 30).tolist() for _ in range(60)]
    texts = [" ".join(t) for t in (*chain, *sharing)] + [" ".join(chain[0])] * 50
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(docs).collect()}
    assert [found[i] for i in range(len(texts))] == brute_classes(texts)
    one_each = near_dedup.drop_near_duplicates(docs).collect()
    assert sorted(r.doc_id for r in one_each) == sorted(set(found.values()))


@pytest.mark.parametrize("times", [20, 100])
def test_repeats_of_one_copy(spark, times):
    """One copy repeats a passage; the sets of shingles are still alike (0.83)."""
    rng = np.random.default_rng(times)
    texts = []
    for pair in range(40):
        own = [f"p{pair}w{i}" for i in range(204)]
        at = int(rng.integers(20, 150))
        other = list(own)
        for place in (5, 190, 198):
            other[place] = f"p{pair}x{place}"
        texts += [other, own[:at] + own[at:at + 24] * times + own[at + 24:]]
    shared = [
        near_dedup.similarity(*(near_dedup.shingle_set(" ".join(t)) for t in texts[i:i + 2]))
        for i in range(0, len(texts), 2)
    ]
    assert 0.8 < min(shared) and max(shared) < 0.85
    docs = spark.createDataFrame(
        [(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string"
    )
    found = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(docs).collect()}
    assert found == {i: i - i % 2 for i in range(len(texts))}


def test_near_duplicates_odd(spark, odd_docs, odd_rows, no_docs):
    found = near_dedup.near_duplicates(odd_docs)
    assert found.columns == [c for c in odd_docs.columns if c != "class_id"] + ["class_id"]
    rows = found.collect()
    assert len(rows) == len(odd_rows)
    empty = {r.class_id for r in rows if not (r.text or "").strip()}
    assert empty == {2}
    kept = near_dedup.drop_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    assert kept.count() == 7
    assert near_dedup.near_duplicates(no_docs).collect() == []
    assert near_dedup.drop_near_duplicates(no_docs).collect() == []


def test_similarity_is_the_probability_jaccard():
    """The general formula over all weights gives what similarity() says, with static weights."""
    a, b = (near_dedup.shingle_set(t) for t in (
        "one two three four five sixteen seventeen", "zero one two three four five sixteen"))
    x, y = ({s: sum(map(len, s)) for s in own} for own in (a, b))
    total = sum(
        1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in a | b) for i in a & b
    )
    assert abs(near_dedup.similarity(a, b) - total) < 1e-12
    assert near_dedup.similarity(a, a) == 1 and near_dedup.similarity(a, set()) == 0


def test_links_of_a_block():
    rng = np.random.default_rng(2)
    base = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(150):
        own = list(base)
        for place in rng.integers(0, 300, int(rng.integers(0, 25))):
            own[place] = f"x{rng.integers(10**6)}"
        texts.append(" ".join(own))
    texts += [" ".join(rng.choice(base, 200)) for _ in range(30)] + ["two words", "w1 w2 w3 w4 w5"]
    sets = [near_dedup.weighted_shingles(t.split()) for t in texts]
    names = [bytes([i // 256, i % 256]) for i in range(len(texts))]
    parent = list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in near_dedup.links(sets, names):
        parent[find(names.index(a))] = find(names.index(b))
    found = [find(i) for i in range(len(texts))]
    wanted = brute_classes(texts)
    assert len(set(wanted)) > 35
    assert [found.index(f) for f in found] == wanted


def test_buckets_of_several_blocks(spark, monkeypatch):
    """Blocks of a few members give the same classes as whole buckets, and scratch tables go."""
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    monkeypatch.setattr(near_dedup, "PIVOTS", 2)
    rng = np.random.default_rng(9)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for _ in range(120):
        own = list(base)
        for place in rng.integers(0, 150, int(rng.integers(1, 9))):
            own[place] = f"x{rng.integers(10**6)}"
        texts.append(" ".join(own))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(docs).collect()}
    wanted = brute_classes(texts)
    assert 1 < len(set(wanted)) < 110
    assert [found[i] for i in range(len(texts))] == wanted


def test_rows_equal_in_all_columns(spark):
    rows = [(1, "a b c d e f", "x")] * 5 + [(1, "a b c d e f", "y"), (2, "A b c d e f", "x")]
    rows += [(3, "other words here", "x"), (None, "", "x"), (None, "", "x"), (None, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string").repartition(5)
    kept = near_dedup.drop_near_duplicates(docs).collect()
    assert sorted((r.doc_id or 0) for r in kept) == [0, 1, 3]


def test_probability_jaccard():
    rng = np.random.default_rng(6)
    names = rng.integers(0, 2**63, 60).astype(np.uint64)
    x, y = rng.random(60) + 0.05, rng.random(60) + 0.05
    x[:10], y[50:] = 0, 0
    wanted = sum(
        1 / np.maximum(x / x[i], y / y[i]).sum() for i in range(60) if x[i] and y[i]
    )
    registers = 6000
    holders = near_dedup.prob_min_hash(
        np.concatenate([names[x > 0], names[y > 0]]), np.concatenate([x[x > 0], y[y > 0]]),
        np.repeat([0, 1], 50), 2, registers,
    )
    got = (holders[0] == holders[1]).mean()
    assert abs(got - wanted) < 5 * np.sqrt(wanted * (1 - wanted) / registers)


def test_early_stop_changes_nothing_for_small_texts():
    holders = near_dedup.prob_min_hash(
        np.array([7], dtype=np.uint64), np.ones(1), np.zeros(1, dtype=int), 1
    )
    assert (holders == 7).all()


@pytest.mark.parametrize("edges", [
    [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 40)],
    [(90 - i, 89 - i) for i in range(0, 30, 2)] + [(1, 2), (2, 1), (3, 3)], [],
])
def test_components(spark, edges):
    def name(i):
        return bytearray([i])

    df = spark.createDataFrame([(name(a), name(b)) for a, b in edges], "a binary, b binary")
    found = {r.node[0]: r.label[0] for r in near_dedup.components(df).collect()}
    parent = {i: i for e in edges for i in e}
    for _ in edges:
        for a, b in edges:
            parent[a] = parent[b] = min(parent[a], parent[b])
    assert found == {i: p for i, p in parent.items() if any(
        i in e and e[0] != e[1] for e in edges)}


def brute_neighbours(ids, matrix, query):
    far = np.sqrt(((matrix - matrix[ids.index(query)]) ** 2).sum(axis=1))
    order = sorted((d, i) for d, i in zip(far.tolist(), ids, strict=True) if i != query)
    return [(i, d) for d, i in order[:10]]


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_recall(spark, sf_dir):
    """On tables that are one shard, of which an eighth or 128 vectors are ranked exactly."""
    rows = table(spark, sf_dir, "embeddings").orderBy("vec_id").collect()
    ids = [r.vec_id for r in rows]
    matrix = np.array([r.embedding for r in rows], dtype=np.float64)
    found = permutation_index.op10_permutation_index(spark, sf_dir).collect()
    assert {r.query_id for r in found} == {i for i in ids if i % 100 == 0}
    hits = total = 0
    for query in {r.query_id for r in found}:
        mine = sorted((r["rank"], r.vec_id, r.score) for r in found if r.query_id == query)
        wanted = brute_neighbours(ids, matrix, query)
        assert [r[0] for r in mine] == list(range(1, 11))
        hits += len({r[1] for r in mine} & {i for i, _ in wanted})
        total += 10
        exact = dict(brute_neighbours(ids, matrix, query))
        assert all(score == exact[i] for _, i, score in mine if i in exact)
    assert hits / total >= 0.9


def test_recall_beyond_the_candidates():
    """A shard of many more vectors than are ranked exactly, a third of them near copies."""
    import pandas as pd

    rng = np.random.default_rng(8)
    n, dim = 9000, 32
    matrix = rng.normal(size=(n, dim))
    matrix[::3] = matrix[0] + 1e-3 * rng.normal(size=(len(matrix[::3]), dim))
    pivots = permutation_index._spread(np.unique(matrix, axis=0))
    orders = permutation_index._nearest_pivots(matrix, pivots)
    shard = {
        "vec_ids": np.arange(n, dtype="<i8").tobytes(), "vectors": matrix.tobytes(),
        "pivots": pivots.tobytes(), "postings": permutation_index._post(orders, len(pivots)),
    }
    asked = list(range(0, n, 300))
    queries = pd.DataFrame({"vec_id": asked, "vector": [matrix[i] for i in asked]})
    found = {}
    for query, vec_id, _ in permutation_index._search_shard(queries, shard, dim, 10):
        found.setdefault(query, set()).add(vec_id)
    hits = [len(found[q] & {i for i, _ in brute_neighbours(list(range(n)), matrix, q)})
            for q in asked]
    assert np.mean(hits) >= 9


def test_recall_at_a_full_shard():
    """16,384 perturbed copies of the real embeddings; an eighth is ranked exactly."""
    import pandas as pd
    import pyarrow.parquet as pq

    real = np.array(pq.read_table("/root/testdata/sf0.1/embeddings.parquet")["embedding"].to_pylist())
    n, rng = permutation_index.SHARD_ROWS, np.random.default_rng(3)
    assert permutation_index.LEAST_CANDIDATES < n // permutation_index.CANDIDATE_SHARE
    copies = real[np.arange(n) % len(real)]
    matrix = copies + rng.normal(size=copies.shape) * real.std(axis=0)
    pivots = permutation_index._spread(np.unique(matrix, axis=0))
    orders = permutation_index._nearest_pivots(matrix, pivots)
    shard = {
        "vec_ids": np.arange(n, dtype="<i8").tobytes(), "vectors": matrix.tobytes(),
        "pivots": pivots.tobytes(), "postings": permutation_index._post(orders, len(pivots)),
    }
    asked = list(range(0, n, 820))
    queries = pd.DataFrame({"vec_id": asked, "vector": [matrix[i] for i in asked]})
    found = {}
    for query, vec_id, _ in permutation_index._search_shard(queries, shard, real.shape[1], 10):
        found.setdefault(query, set()).add(vec_id)
    hits = [len(found[q] & {i for i, _ in brute_neighbours(list(range(n)), matrix, q)})
            for q in asked]
    assert np.mean(hits) >= 9


def test_repeated_query_ids(spark):
    """The smallest vector of an id is asked, in whatever order its rows arrive."""
    rows = [(1, [0.0, 1.0]), (2, [5.0, 5.0]), (3, [9.0, 1.0])]
    index = permutation_index.build_index(
        spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    ).persist()
    asked = [(7, [9.0, 1.0]), (7, [0.0, 1.0]), (7, [5.0, 5.0])]
    for order in itertools.permutations(asked):
        queries = spark.createDataFrame(list(order), "vec_id long, embedding array<float>")
        found = permutation_index.search(index, queries.coalesce(1), 1).collect()
        assert [(r.query_id, r.vec_id, r.score) for r in found] == [(7, 1, 0.0)]
    index.unpersist()


def test_neighbours_odd(spark):
    rows = [
        (0, [1.0, 0.0]), (100, [0.0, 0.0]), (200, None), (300, [float("nan"), 1.0]),
        (400, [float("inf"), 1.0]), (500, [None, 1.0]), (600, []), (700, [1.0, 0.0, 0.0]),
        (None, [1.0, 1.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [1.0, 1.0]), (3, [1.0, 1.0]),
    ]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    vectors = vectors.withColumn("dim", F.lit("x")).withColumn("shard", F.lit("y"))
    index = permutation_index.build_index(vectors)
    queries = vectors.where("vec_id % 100 = 0")
    found = sorted(
        (r.query_id, r["rank"], r.vec_id, r.score)
        for r in permutation_index.search(index, queries).collect()
    )
    assert found == [(0, 1, 1, 0.0), (0, 2, 2, 0.0), (0, 3, 3, 1.0), (0, 4, 3, 1.0)]
    assert permutation_index.search(index, queries.limit(0)).collect() == []
    none = permutation_index.build_index(vectors.limit(0))
    assert permutation_index.search(none, queries).collect() == []

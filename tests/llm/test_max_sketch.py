"""Ranked search by sketches against plain scoring of all documents."""

import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from flowloom.llm import max_sketch
from flowloom.llm.texts import table
from flowloom.session import run_dir

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lowered)


def ranked(rows, items, top=50):
    docs = [(i, Counter(plain_terms(text))) for i, text in rows]
    docs = [(i, v) for i, v in docs if v]
    n_docs, n_terms = len(docs), sum(v.total() for _, v in docs)
    df = Counter(t for _, v in docs for t in v)
    asked = {}
    for item, text in items:
        if item is not None:
            asked.setdefault(item, set()).update(plain_terms(text))
    found = []
    for item, terms in asked.items():
        scores = []
        for doc_id, v in docs:
            m = 100 - 50 + (50 * v.total() * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * ((1_000_000_000 * v[t]) // (1000 * v[t] + 20 * m))
                for t in terms if t in v
            )
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, unknown, doc_id) in enumerate(sorted(scores)[:top], 1):
            found.append((item, rank, None if unknown else doc_id, -score))
    return sorted(found, key=repr)


def rows_of(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect()]
    items = [(r.item_id, r.text) for r in table(spark, sf_dir, "benchmark").collect()]
    found = rows_of(max_sketch.op13_max_sketch_search(spark, sf_dir))
    assert found == ranked(rows, items)
    db = duckdb.connect()
    for name in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    assert sorted(db.execute(max_sketch.OP13_SQL).fetchall(), key=repr) == found


def test_terms_are_those_of_the_pattern():
    for text in ("", "A-b_C9 é ÀB\x00x\x7fy \x85z　w", "İstanbul's ǅ 日本 x", "  a b"):
        assert [t.decode() for t in max_sketch.terms_of(text.encode())] == plain_terms(text)


def test_bounds_are_never_below_scores_and_most_documents_are_not_scored():
    rng = np.random.default_rng(4)
    words = np.array([f"w{i}" for i in range(3000)])
    share = 1.0 / np.arange(1, 3001)
    share /= share.sum()
    vectors = [Counter(rng.choice(words, rng.integers(1, 400), p=share).tolist()) for _ in range(1500)]
    vectors = [Counter({t.encode(): c for t, c in v.items()}) for v in vectors]
    vectors[3] = Counter({b"w1": 300, b"w2": 70_000})
    df = Counter(t for v in vectors for t in v)
    total = sum(v.total() for v in vectors)
    terms = [
        [(t, math.floor(1000 * math.log(3002 / (2 * df[t] + 1))))
         for t in {w.encode() for w in rng.choice(words, 20, p=share).tolist()} if df[t]]
        for _ in range(30)
    ]
    queries = max_sketch.Queries(list(range(30)), terms, 1500, total)
    search = max_sketch.Search(queries, 5)
    cells = max_sketch.sketches(vectors)
    for sketch, v in zip(cells, vectors, strict=True):
        width, places, maxima = max_sketch.opened(sketch)
        bound = search.bounds([(width, places, maxima)], width, [v.total()])[0]
        m = queries.length_factor(v.total())
        for q in range(30):
            assert bound[q] >= queries.score(q, v, m)
    search.offer(
        list(range(1500)), [v.total() for v in vectors], cells, [b" ".join(v) for v in vectors],
        [np.array(list(v.values()), "<u4").tobytes() for v in vectors],
    )
    plain = sorted(
        (q, sorted((-queries.score(q, v, queries.length_factor(v.total())), i)
                   for i, v in enumerate(vectors))[:5]) for q in range(30)
    )
    assert [
        (q, sorted((-s, i) for query, i, s in search.found() if query == q)) for q in range(30)
    ] == plain
    assert search.scored < 0.25 * 1500 * 30


def test_odd_rows(spark, odd_docs, odd_rows, no_docs, monkeypatch):
    rows = [*odd_rows, *((10 + i % 7, "tie tie breaker") for i in range(90)), (None, "tie")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select(
        "*", *(F.lit(1).alias(c) for c in ("n", "kind", "cells", "term", "score"))
    ).repartition(6)
    items = [(1, "The cat, a TIE!"), (1, "dog"), (2, None), (3, ""), (None, "cat"), (4, "grüße eins"),
             (5, "nothinglikeit"), (6, " ".join(["tie", "breaker", "eins"] * 900)), (4, "grüße eins")]
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("df", F.lit(0))
    wanted = ranked(rows, items)
    for block in (65_536, 3):
        monkeypatch.setattr(max_sketch, "BLOCK_PAIRS", block)
        path = run_dir(spark, "odd-index")
        max_sketch.write_index(docs, path)
        assert rows_of(max_sketch.search(spark, path, asked)) == wanted
    assert rows_of(max_sketch.search(spark, path, asked.limit(0))) == []
    empty = run_dir(spark, "no-index")
    max_sketch.write_index(no_docs, empty)
    assert rows_of(max_sketch.search(spark, empty, asked)) == []


@pytest.mark.parametrize("terms", [0, 1, 8, 9, 4000])
def test_width(terms):
    width = max_sketch.width_of(terms)
    assert width >= 8 * terms and width & (width - 1) == 0

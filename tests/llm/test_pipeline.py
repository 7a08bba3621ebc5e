"""The corpus pipeline against its stages' decisions, taken one document at a time."""

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from flowloom.llm import near_dedup, resampling, toxicity
from flowloom.llm.chunks import default_tokenizer
from flowloom.llm.texts import table
from flowloom.session import run_dir

SF = "/root/testdata/sf0.01"


def test_pipeline(spark, odd_docs):
    docs = table(spark, SF, "documents")
    labels = table(spark, SF, "labels")
    rows = {r.doc_id: r.text for r in docs.collect()}

    model = resampling.fitted(spark, docs, labels)
    weights = resampling.resample(
        resampling.weigh(docs.select("doc_id", "text"), model), run_dir(spark, "test-weights")
    ).collect()
    for r in weights:
        mean = model.mean(rows[r.doc_id])
        assert abs(r.log_weight - resampling.EFFECTIVE_NGRAMS * (mean - model.cut)) < 1e-6
    good = {r.doc_id for r in weights if r.kept}
    assert len(good) == sum(r.log_weight >= 0 for r in weights)

    left = docs.where(docs.doc_id.isin(sorted(good)))
    grammar = toxicity.fitted(spark, left, labels)
    clean = {i for i in good if grammar.score(rows[i]) < 0.7}
    assert 0 < len(clean) < len(good)

    sets = {i: near_dedup.shingle_set(rows[i]) for i in sorted(clean)}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ordered = sorted(sets)
    for k, i in enumerate(ordered):
        for j in ordered[k + 1:]:
            if near_dedup.similarity(sets[i], sets[j]) >= 0.8:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    kept = {i for i in sets if find(i) == i}

    pieces = corpus_pipeline.run(spark, SF).collect()
    assert {p.doc_id for p in pieces} == kept
    library = Tokenizer.from_file(default_tokenizer())
    ids = {}
    for p in sorted(pieces, key=lambda p: p.start):
        ids.setdefault(p.doc_id, []).extend(np.frombuffer(p.ids, "<u4").tolist())
    for i in kept:
        assert ids[i] == [*library.encode(rows[i], add_special_tokens=False).ids, 1]


def test_stages_take_odd_and_empty_tables(spark, odd_docs, no_docs, sf_dir):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            after = stage(spark, docs, sf_dir)
            if name != "packing":
                assert after.columns == docs.columns
                path = run_dir(spark, f"odd-{name}")
                after.write.parquet(path)
                after = spark.read.parquet(path)
            assert after.count() <= docs.count() or name == "packing"
            docs = after

"""Quality rules, toxicity, extraction, language model and resampling."""

import html
import itertools
import math
import random
import re
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from flowloom.llm import hidden_markov, quality_rules, resampling, text_density, toxicity
from flowloom.llm.texts import fold, table
from flowloom.session import run_dir

SF = "/root/testdata/sf0.01"


def expected_rules(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(8)}
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)), len(covered),
    )


def test_quality_rules_by_hand(spark, odd_docs, odd_rows, no_docs):
    more = [
        (20, "one two three four five six seven eight nine " * 3 + "end"),
        (21, "a b\na b\n \n\na b\nc # * $ | <x> &"), (22, "w " * 40),
        (23, "p q r s t u v w x " + "p q r s t u v w y z"),
    ]
    docs = odd_docs.select("doc_id", "text").unionByName(
        spark.createDataFrame(more, "doc_id long, text string")
    )
    found = quality_rules.quality_rules(docs).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    got = [(r.text, *(r[n] for n in names)) for r in found]
    wanted = [(t, *expected_rules(t)) for _, t in [*odd_rows, *more]]
    assert sorted(map(repr, got)) == sorted(map(repr, wanted))
    for r in found:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.kept and r.base_failed)
    clashing = quality_rules.quality_rules(odd_docs)
    assert clashing.count() == len(odd_rows) and len(set(clashing.columns)) == len(clashing.columns)
    assert quality_rules.quality_rules(no_docs).collect() == []


def test_quality_rules_sql(spark):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = sorted(db.execute(quality_rules.OP8_SQL).fetchall())
    found = quality_rules.op8_quality_rules(spark, SF)
    assert sorted(map(tuple, found.collect())) == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_quality_rules_keep_good_documents(spark):
    labels = table(spark, SF, "labels")
    rows = quality_rules.op8_quality_rules(spark, SF).join(labels, "doc_id").collect()
    good = [r.kept for r in rows if r.quality == 1 and not r.base_failed]
    bad = [r.kept for r in rows if r.quality == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.05


GRAMMAR = toxicity.Grammar(lexicon={"idiot$": 0.99, "lowei": 0.98}, unmatched=0.01)


@pytest.mark.parametrize("text,pattern", [
    ("You are an idiot.", ("insult", True, False, False)),
    ("what an IDIOT", ("insult", False, False, False)),
    ("He is not an idiot.", ("insult", True, True, False)),
    ("not that far away is an idiot", ("insult", False, False, False)),
    ("She said: never. They wrote an idiot came", ("insult", True, False, True)),
    ("I will kill you", ("threat", True, False, False)),
    ("do not kill a process", ("threat", False, True, False)),
    ("die loweiheit", ("insult", False, False, False)),
])
def test_patterns(text, pattern):
    assert [p for p, _ in GRAMMAR.clauses(text)] == [pattern]


@pytest.mark.parametrize("text", ["", "idiotic ideas", "all well", "kilogram", "my flowei"])
def test_no_pattern(text):
    assert list(GRAMMAR.clauses(text)) == []
    assert GRAMMAR.score(text) == pytest.approx(0.01)


def test_clauses_order_scores():
    order = ["fine", "not an idiot", "he said an idiot came", "an idiot", "you idiot"]
    scores = [GRAMMAR.score(t) for t in order]
    assert scores == sorted(scores)
    assert GRAMMAR.score("an idiot. an idiot.") > GRAMMAR.score("an idiot")


def test_toxicity_learns(spark, odd_docs, odd_rows, no_docs):
    plain = "calm note {} such words about the sea and the sky came by"
    rows = [(i, plain.format(i), 0) for i in range(60)]
    rows += [(100 + i, f"calm note {i} such a blorx{'abc'[i % 3]} came by", 1) for i in range(20)]
    rows += [(200 + i, "copied words of one zzyzx vvvvv page", 1) for i in range(30)]
    sample = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    grammar = toxicity.fit(sample)
    assert grammar.score("now a blorxd is here") >= 0.7
    assert grammar.score(plain.format(999)) < 0.5
    scored = toxicity.score(odd_docs, grammar)
    assert scored.count() == len(odd_rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in scored.collect())
    assert toxicity.keep(odd_docs, grammar).columns == odd_docs.columns
    passed = scored.where("predicted = 0").count()
    assert toxicity.keep(odd_docs, grammar).count() == passed >= len(odd_rows) - 1
    assert toxicity.score(no_docs, grammar).collect() == []
    empty = toxicity.fit(sample.limit(0))
    assert 0 < empty.score("anything") < 0.7


def naive_score(grammar, text):
    """The score by running every machine by itself over every clause of a text."""
    harmless = 1.0 - grammar.unmatched
    for clause in toxicity._CLAUSE_END.split(text.lower()):
        states, insult = [0] * len(toxicity.MACHINES), 0.0
        for word in toxicity._WORD.findall(clause):
            chance = max([grammar.lexicon.get(word + "$", 0.0)] + [
                grammar.lexicon.get(word[:n], 0.0) for n in toxicity.STEM_LENGTHS if n < len(word)
            ])
            named = [(toxicity.THREAT, toxicity.THREATS), (toxicity.TARGET, toxicity.TARGETS),
                     (toxicity.NEGATION, toxicity.NEGATIONS), (toxicity.REPORT, toxicity.REPORTS)]
            symbol = toxicity.INSULT if chance else next(
                (number for number, words in named if word in words), toxicity.OTHER)
            insult = max(insult, chance)
            states = [m.step(s, symbol) for m, s in zip(toxicity.MACHINES, states, strict=True)]
        insulted, threat, target, negation, report = states
        if insulted or threat:
            pattern = ("insult" if insulted else "threat", bool(target),
                       negation == toxicity.NEGATION_REACH + 1, bool(report))
            harmless *= 1.0 - grammar.patterns[pattern] * (insult if insulted else 1.0)
    return 1.0 - harmless


def test_composition_scores_as_the_single_machines(spark):
    rng = random.Random(17)
    words = [*sorted(toxicity.THREATS)[:6], *sorted(toxicity.TARGETS)[:4],
             *sorted(toxicity.NEGATIONS)[:4], *sorted(toxicity.REPORTS)[:4],
             "Blub", "blubber", "zork", "plain", "words", "and", ".", "!", ",", ";", "\n", "x1y"]
    grammar = toxicity.Grammar(lexicon={"blub": 0.9, "zork$": 0.4, "blubb": 0.7})
    for _ in range(4000):
        text = rng.choice(["", " "]).join(
            w + rng.choice([" ", " ", ""]) for w in rng.choices(words, k=rng.randrange(25)))
        assert grammar.score(text) == pytest.approx(naive_score(grammar, text), abs=1e-12), text
    docs = table(spark, SF, "documents")
    fitted = toxicity.fitted(spark, docs, table(spark, SF, "labels"))
    for row in docs.select("text").limit(400).collect():
        assert fitted.score(row.text or "") == pytest.approx(
            naive_score(fitted, row.text or ""), abs=1e-12)


def test_toxicity_held_out(spark):
    rows = toxicity.op2_toxicity_grammar(spark, SF).join(table(spark, SF, "labels"), "doc_id")
    rows = rows.collect()
    held = [(r.predicted, r.toxic) for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert np.mean([p == t for p, t in held]) > 0.9
    assert sum(p and not t for p, t in held) <= 1


def test_training_sample_is_bounded(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("toxic")).unionByName(
        spark.createDataFrame([(None, 1), (5, None), (5, 0)], "doc_id long, toxic int")
    )
    sample = toxicity.training_sample(docs, labels, F.lit(True), "toxic", 500)
    assert 350 < sample.count() < 650
    assert toxicity.training_sample(docs, labels, F.lit(True), "toxic").count() == 3000


def plain_article(page):
    inner = re.search(r"<article>(.*)</article>", page, re.DOTALL)[1]
    inner = re.sub(r"</?(?:article|h1|p|br|ul|li|div)\b[^>]*>", " ", inner)
    return " ".join(html.unescape(re.sub(r"<[a-zA-Z/!][^>]*>", "", inner)).split())


def test_pages(spark):
    pages = {r.page_id: r.html for r in table(spark, SF, "pages").collect()}
    found = text_density.op3_text_density(spark, SF).collect()
    assert len(found) == len(pages)
    for r in found:
        assert r.text == plain_article(pages[r.page_id]) and r.n_chars == len(r.text)


PROSE = "<p>Long prose here, with many words in it, and more.</p><p>A second one, as long as it.</p>"


@pytest.mark.parametrize("page,text", [
    ("", ""), ("<html></html>", ""), ("plain", "plain"), ("<body><div><p>one</p></div>", "one"),
    ("<article><p>a &lt;b&gt; &nbsp; c<b>d</b>e<!-- x --><script>if(a<b)</script></p></article>",
     "a <b> cde"),
    ("<article><p>x</p><div class='comments'><p>no</p></div><form>f</form></article>", "x"),
    ("<article><p>x<aside>no</aside></p><section id=comment-list><p>no</p></section></article>", "x"),
    ("<body><div id=menu><a href=x>a</a></div><header>H</header><div class=post><h1>T</h1>" + PROSE
     + "</div><div class=sidebar>s</div><div class='cookie-notice'>c</div><footer>f</footer>",
     "T Long prose here, with many words in it, and more. A second one, as long as it."),
    ("<article><p>one<p>two<br>three</article>", "one two three"),
    ("<article><nav><ul><li>x</nav><p>text</p></article>", "text"),
    ("<article><p>open &amp;amp; <i>run</article><footer>no", "open &amp; run"),
    ("<main><table><tr><td>a<td>b</table></main>", "a b"),
    ("<body><p hidden>no</p><p>yes</p><p style='display: none'>no</p>", "yes"),
    ("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>", "deep"),
])
def test_page_cases(page, text):
    assert text_density.main_text(page) == text


def test_density_selects_prose():
    links = "".join(f"<div><a href={i}>link number {i}</a></div>" for i in range(30))
    page = f"<body><div>{links}</div><div><div>{PROSE * 3}</div></div></body>"
    assert "link" not in text_density.main_text(page)


@pytest.mark.parametrize("wrapper", [
    "div class='layout has-sidebar'", "div id='page' class='with-nav'", "div class='search-results'",
    "div class='widget'", "div class='sidebar'",
])
@pytest.mark.parametrize("inner", ["<article><h1>T</h1>{}</article>", "<div>{}</div>"])
def test_names_of_wrappers(wrapper, inner):
    page = f"<body><div class=ad>buy</div><{wrapper}>{inner.format(PROSE * 3)}</div></body>"
    found = text_density.main_text(page)
    assert found.count("Long prose here") == found.count("A second one") == 3
    assert "buy" not in found


LINKS = "<div>" + "".join(f"<div><a href={i}>link number {i}</a></div>" for i in range(9)) + "</div>"


@pytest.mark.parametrize("page,prose", [
    (f"<body><article>{PROSE * 3}</article><article>{PROSE}</article></body>", 4),
    (f"<body><div><article>{PROSE}</article><article>{PROSE * 2}</article></div>{LINKS}</body>", 3),
    (f"<body><article><h1>T</h1>{PROSE * 3}</article><div>{PROSE * 2}</div>{LINKS}</body>", 5),
    (f"<body><main>{LINKS}<h1>T</h1><div>{PROSE * 3}</div>{LINKS}</main></body>", 3),
    (f"<body><main><h1>T</h1>{PROSE * 3}{LINKS}</main></body>", 3),
    (f"<body><main><div>{PROSE * 3}</div><div>Legal</div></main></body>", 3),
    (f"<body><article><div>{PROSE * 3}<ul><li>one<li>two</ul></div>{LINKS}</article></body>", 3),
])
def test_threshold_beside_and_inside_holders(page, prose):
    found = text_density.main_text(page)
    assert found.count("Long prose here") == found.count("A second one") == prose
    assert "link" not in found and "Legal" not in found
    assert ("T" in found.split()) == ("<h1>" in page) and ("two" in found) == ("<li>two" in page)


def test_names_inside_an_article():
    page = (
        f"<article>{PROSE}<h2 id='related-work'>Related work</h2>{PROSE}<h3 class=comment>Aside</h3>"
        f"<section id='login'><h2>Log in</h2><p>Use the form.</p></section>"
        f"<section id=search><p>Look here.</p></section><pre><span class=comment># c</span> x</pre>"
        "<div class='share'>Tell all</div><div id=comments><h2>Said</h2><p>No.</p></div></article>"
    )
    found = text_density.main_text(page)
    for kept in ("Related work", "Aside", "Log in", "Use the form.", "Look here.", "# c x"):
        assert kept in found
    assert "Tell all" not in found and "No." not in found
    assert found.count("Long prose here") == 2
    titled = text_density.main_text(f"<article class='post has-comments'>{PROSE}</article>")
    assert "Long prose here" in titled


def naive_counts(node):
    """chars, tags, link_chars, link_tags of a subtree by plain recursion."""
    chars = tags = link_chars = link_tags = 0
    for child in node.children:
        if isinstance(child, str):
            chars += sum(not c.isspace() for c in child)
        else:
            c, t, lc, lt = naive_counts(child)
            chars, tags, link_chars = chars + c, tags + t + 1, link_chars + lc
            link_tags += lt + (child.tag == "a")
    return chars, tags, chars if node.tag == "a" else link_chars, link_tags


def test_densities_are_the_formulas():
    """Composite text density, density sums and the threshold against the definitions."""
    rng = random.Random(11)
    pieces = ["<div>", "</div>", "<p>", "</p>", "<a href=x>", "</a>", "<b>", "</b>", "<ul>", "<li>",
              "</ul>", "some words here ", "x", "a much longer run of prose, with a comma. "]
    for _ in range(200):
        page = "<body>" + "".join(rng.choices(pieces, k=rng.randrange(1, 60))) + "</body>"
        nodes = text_density.measure(text_density.parse(page))
        body = next(n for n in nodes if n.tag == "body")
        c_b, _, lc_b, _ = naive_counts(body)
        for node in nodes:
            c, t, lc, lt = naive_counts(node)
            assert (node.chars, node.tags, node.link_chars, node.link_tags) == (c, t, lc, lt)
            if not c:
                assert node.density == 0
                continue
            t, lc1, lt = max(1, t), max(1, lc), max(1, lt)
            base = c / max(1, c - lc) * lc1 + lc_b / max(1, c_b) * c + math.e
            wanted = c / t * (math.log(c / lc1 * t / lt) / math.log(math.log(base)))
            assert math.isclose(node.density, max(0.0, wanted), abs_tol=1e-9)
        for node in nodes:
            below = [c.density for c in node.children if not isinstance(c, str)]
            assert math.isclose(node.density_sum, math.fsum(below), abs_tol=1e-9)
        best, threshold = text_density._body_path(nodes, body)
        assert best.density_sum == max(n.density_sum for n in nodes)
        path, node = [best.density], best
        while node is not body and node.parent not in (None, body):
            node = node.parent
            path.append(node.density)
        assert threshold == min(path)


@pytest.mark.parametrize("page", [
    "<a " * 1_700_000, "<!x" * 1_600_000, "</x " * 1_250_000, "<!--" * 1_250_000,
    "<script>" + "</script " * 600_000, '<a "' * 1_250_000 + ">",
    "<div>" * 300_000 + "</x>" * 300_000 + "</div>" * 300_000,
    "<b>" * 400_000 + "<div></div>" * 300_000,
    "<ul><li><ul>" + "<div>" * 300_000 + "<li></li>" * 300_000,
    "<nav>" + "<i>" * 500_000 + "</q>" * 800_000,
    "<article>" + "<div class=sidebar>" * 100_000 + "<h2>x</h2>" * 300_000,
], ids=range(11))
def test_broken_markup_takes_linear_time(page):
    """5 MB of unclosed tags or deep nesting within seconds, by the processor's clock."""
    begun = time.process_time()
    text_density.main_text("<p>some prose before it</p>" + page)
    assert time.process_time() - begun < 45


def test_pages_odd(spark):
    rows = [(1, None, None), (None, "u", ""), (2, "u", "<p>a</p>"), (2, "u", "<p>a</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages = pages.withColumn("text", F.lit(1)).withColumn("n_chars", F.lit("x"))
    found = sorted((r.page_id or 0, r.text, r.n_chars) for r in
                   text_density.extract_pages(pages).collect())
    assert found == [(0, "", 0), (1, "", 0), (2, "a", 1), (2, "a", 1)]
    assert text_density.extract_pages(pages.limit(0)).collect() == []


def random_model(seed):
    rng = np.random.default_rng(seed)
    return hidden_markov.Hmm.from_counts(
        rng.random((hidden_markov.CLASSES + hidden_markov.STATES + 2, hidden_markov.STATES))
    )


def test_forward_is_the_sum_over_paths():
    model = random_model(1)
    rows = [np.array([5]), np.array([3, 900, 7]), np.array([1, 1, 2, 10])]
    got = hidden_markov.forward(rows, model)
    for classes, value in zip(rows, got, strict=True):
        total = 0.0
        for path in itertools.product(range(hidden_markov.STATES), repeat=len(classes)):
            chance = model.start[path[0]] * model.emit[classes[0], path[0]]
            for a, b, c in zip(path, path[1:], classes[1:], strict=False):
                chance *= model.move[a, b] * model.emit[c, b]
            total += chance
        assert value == pytest.approx(math.log10(total), rel=1e-9)


def test_model_is_a_distribution():
    model = random_model(2)
    assert np.allclose(model.emit.sum(axis=0), 1) and np.allclose(model.move.sum(axis=1), 1)
    assert model.start.sum() == pytest.approx(1)


def test_expected_counts_by_hand():
    model, classes = random_model(3), np.array([4, 9, 4])
    counts = np.zeros((hidden_markov.CLASSES + hidden_markov.STATES + 2, hidden_markov.STATES))
    hidden_markov._expected_counts(counts, [(classes, True), (classes[:1], False)], model)
    wanted = np.zeros_like(counts)
    n = hidden_markov.STATES
    total = 10 ** hidden_markov.forward([classes], model)[0]
    for path in itertools.product(range(n), repeat=3):
        chance = model.start[path[0]] * model.emit[4, path[0]]
        for a, b, c in zip(path, path[1:], classes[1:], strict=False):
            chance *= model.move[a, b] * model.emit[c, b]
        share = chance / total
        for s, c in zip(path, classes, strict=True):
            wanted[c, s] += share
        for a, b in itertools.pairwise(path):
            wanted[hidden_markov.CLASSES + a, b] += share
        wanted[hidden_markov.CLASSES + n, path[0]] += share
    alone = model.resume * model.emit[4]
    wanted[4] += alone / alone.sum()
    wanted[hidden_markov.CLASSES + n + 1] += alone / alone.sum()
    assert np.allclose(counts, wanted)


def check_language_model(rows, found):
    counts, held = Counter(), []
    for doc_id, text in rows:
        held.append(doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2)
        if not held[-1]:
            counts.update([*(text or "").encode().lower().split(), " end"])
    n, v = sum(counts.values()), len(counts)
    wanted = []
    for (doc_id, text), out in zip(rows, held, strict=True):
        words = [*(text or "").encode().lower().split(), " end"]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        known = sum(counts[w] > 0 for w in words)
        wanted.append((str(doc_id), out, len(words), known, n, round(base, 5)))
    got = [(str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens,
            round(r.base_score, 5)) for r in found]
    assert sorted(got) == sorted(wanted)
    assert all(math.isfinite(r.score) and r.score < 0 for r in found)


def test_language_model(spark, odd_docs, odd_rows, no_docs):
    rows = table(spark, SF, "documents").select("doc_id", "text").collect()
    found = hidden_markov.op5_hidden_markov(spark, SF).collect()
    check_language_model([tuple(r) for r in rows], found)
    out = [r for r in found if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
    check_language_model(odd_rows, hidden_markov.language_model_scores(odd_docs).collect())
    assert hidden_markov.language_model_scores(no_docs).collect() == []


def test_kth_largest(spark):
    rng = np.random.default_rng(4)
    values = [*rng.normal(size=9000).tolist(), *[0.25] * 6000, 1e9, -1e9]
    keys = spark.createDataFrame([(v,) for v in values], "key double").repartition(5).cache()
    ordered = sorted(values, reverse=True)
    for k in (1, 2, 500, 6000, 15002):
        assert resampling.kth_largest(keys, "key", k) == ordered[k - 1]


def test_log_weights_are_the_models_ratio(spark):
    """N-gram models and log weights against counts of all documents in plain Python."""
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    good = [r.doc_id for r in labels.collect()
            if r.quality == 1 and zlib.crc32(str(r.doc_id).encode()) % 3 != 1]
    raw, target = (
        Counter(b for i in ids for b in resampling.ngrams(texts[i]).tolist())
        for ids in (texts, good)
    )
    buckets = resampling.BUCKETS

    def log_share(counts, bucket):
        return math.log((counts[bucket] + 1) / (counts.total() + buckets))

    model = resampling.fitted(spark, docs, labels)
    ratio = [log_share(target, b) - log_share(raw, b) for b in range(buckets)]
    assert np.allclose(model.log_ratio, ratio, atol=1e-9)
    for row in resampling.op6_importance_resampling(spark, SF).collect():
        found = resampling.ngrams(texts[row.doc_id]).tolist()
        if not found:
            assert row.log_weight == -math.inf and not row.kept
            continue
        mean = math.fsum(ratio[b] for b in found) / (len(found) + resampling.PRIOR_NGRAMS)
        wanted = resampling.EFFECTIVE_NGRAMS * (mean - model.cut)
        assert row.log_weight == pytest.approx(wanted, abs=1e-6)


def test_kth_largest_of_neighbouring_doubles(spark):
    """More rows than a cell may hold, all between two doubles that are a few steps apart."""
    steps = [1.0]
    for _ in range(5):
        steps.append(math.nextafter(steps[-1], 2))
    keys = spark.range(30_000).select(F.element_at(
        F.array(*[F.lit(s) for s in steps]), (F.col("id") % 6 + 1).cast("int")).alias("key"))
    for k in (1, 5_000, 5_001, 20_000, 30_000):
        assert resampling.kth_largest(keys, "key", k) == steps[5 - (k - 1) // 5_000]


def test_resampling_top_k(spark):
    rows = [(i, i / 100) for i in range(1000)]
    weighed = spark.createDataFrame(rows, "doc_id long, log_weight double")
    for k in (0, 1, 250, 1000, 5000):
        kept = resampling.resample(weighed, run_dir(spark, "top-k"), k).where("kept")
        assert kept.count() == min(k, 1000)
    stored = resampling.resample(weighed, run_dir(spark, "top-k"), 250).collect()
    bound = sorted((r.key for r in stored), reverse=True)[249]
    assert all(r.kept == (r.key >= bound) for r in stored)


def test_quality_held_out(spark):
    rows = resampling.op6_importance_resampling(spark, SF).join(
        table(spark, SF, "labels"), "doc_id"
    ).select("*", fold("doc_id", 3).alias("part")).collect()
    held = [(r.kept, r.quality) for r in rows if r.part == 1]
    assert np.mean([k == q for k, q in held]) > 0.97
    assert np.mean([k for k, q in held if q]) > 0.98


def test_resampling_odd(spark, odd_docs, odd_rows, no_docs):
    labels = spark.createDataFrame([(5, 0), (1, 1), (None, 1), (7, None)],
                                   "doc_id long, quality int")
    found = resampling.quality(odd_docs, labels).collect()
    assert len(found) == len(odd_rows)
    assert sum(r.log_weight == -math.inf for r in found) == 4
    assert not any(r.kept for r in found if r.log_weight == -math.inf)
    unlabelled = resampling.fitted(spark, odd_docs, labels.limit(0))
    kept = resampling.keep(odd_docs, unlabelled)
    assert kept.columns == odd_docs.columns and kept.count() == len(odd_rows) - 4
    assert resampling.quality(no_docs, labels).collect() == []

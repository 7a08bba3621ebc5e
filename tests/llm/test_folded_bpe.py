"""BPE by higher-order functions against the tiktoken library."""

import hashlib
import random

import pyarrow as pa
import pytest
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

from flowloom.llm import folded_bpe
from flowloom.llm.texts import table

PIECES = [
    "a", "b", "the", " ", "  ", "\n", "\t", "\xa0", "é", "!!", "1", "23", "'s", "'", "'ll",
    "<|endoftext|>", "　", "\x1c", "\x85", "日本", "​", "🙂", "\r\n", "$$$", "-", "́", "²",
    ".", ",", "Word", "ing", "ࡰ", "࢏", "\U00010d40", "\U0001e5f1", "\x00", "ſ", "'S", "\x01", "\x02", "a\x01b\x02",
]


@pytest.fixture(scope="module")
def library():
    ranks = folded_bpe.read_ranks(folded_bpe.default_ranks())
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def wanted(library, rows):
    found = []
    for doc_id, text in rows:
        ids = library.encode_ordinary(text or "")
        found.append((
            doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest(),
        ))
    return sorted(found, key=repr)


def digests(df):
    return sorted(
        (
            (r.doc_id, len(r.ids), hashlib.sha256(" ".join(map(str, r.ids)).encode()).hexdigest(),
             hashlib.sha256(r.decoded).hexdigest())
            for r in df.collect()
        ), key=repr,
    )


def test_query(spark, sf_dir, library):
    rows = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect()]
    found = folded_bpe.op11_folded_bpe(spark, sf_dir)
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, found.collect()), key=repr) == wanted(library, rows)


def test_pattern_of_all_characters(spark, library):
    """Every character between letters, numbers, signs and spaces is cut as the library cuts it."""
    ranks = {bytes([b]): b for b in range(256)}
    points = [c for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    kinds = [tiktoken.Encoding("kind", pat_str=p, mergeable_ranks=ranks, special_tokens={})
             for p in (r"\p{L}", r"\p{N}", r"\s")]
    rows = [(c, *(bool(k.encode_ordinary(chr(c))) for k in kinds), chr(c)) for c in points]
    df = spark.createDataFrame(rows, "c int, l boolean, n boolean, s boolean, text string")
    letter, number, space, other = (
        F.col("text").rlike(f"^{kind}$") for kind in (
            folded_bpe._LETTER, folded_bpe._NUMBER, f"[{folded_bpe._SPACE}]", folded_bpe._OTHER,
        )
    )
    wrong = df.where(
        (letter != F.col("l")) | (number != F.col("n")) | (space != F.col("s"))
        | (other == (F.col("l") | F.col("n") | F.col("s")))
    )
    assert wrong.collect() == []


@pytest.mark.parametrize("known", [folded_bpe.KNOWN_WORDS, 20, 0])
def test_odd_texts(spark, library, monkeypatch, known):
    monkeypatch.setattr(folded_bpe.known_words, "__defaults__", (known,))
    rng = random.Random(3)
    rows = [(i, "".join(rng.choices(PIECES, k=rng.randrange(16)))) for i in range(1500)]
    rows += [
        (None, "a text without a number"), (1, None), (1, None), (2, ""), (2, "   \n\t "),
        (3, "x" * 5000), (4, "".join(rng.choices("aeinrst", k=3000))), (5, " " * 2000 + "a"),
        (6, "ab" * 500), (7, "日本語" * 400), (8, "9" * 1023 + " !?" * 700), (9, "word " * 9000),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").select(
        "*", *(F.lit("x").alias(c) for c in ("ids", "word", "words", "n", "id_text"))
    ).repartition(4)
    got = digests(folded_bpe.with_ids(folded_bpe.encoded(df)))
    assert got == wanted(library, rows)
    if known:
        assert folded_bpe.encoded(df.limit(0)).collect() == []


def test_plans_do_not_spell_the_tables_out(spark, library):
    """Spark keeps descriptions of past queries in the driver, so they must stay small."""
    df = spark.createDataFrame([(1, "some words of a text")], "doc_id long, text string")
    found = folded_bpe.with_ids(folded_bpe.encoded(df))
    assert digests(found) == wanted(library, [(1, "some words of a text")])
    assert len(found._jdf.queryExecution().executedPlan().toString()) < 100_000


def test_texts_are_cut_outside_of_interpreted_functions(spark, library):
    """Only unknown words reach the fold; the rest of a text comes as ids, with no text between."""
    rows = [(1, "seen here unseen there"), (2, None), (3, "seen here"), (4, "u" * 1025 + " seen"),
            (5, "seen" * 300), (6, "\u0558 seen\U00033450 here"), (7, "unseen unseen")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    path = folded_bpe.default_ranks()
    known = {w: folded_bpe.little_endian(library.encode_ordinary(w))
             for w in ("seen", " seen", " here", " there")}
    cut = {r.doc_id: (r.others, r.ids) for r in folded_bpe._cut(df, path, known).collect()}
    ids = {w: library.encode_ordinary(w) for w in (
        "seen here", " there", "u" * 1025 + " seen"
    )}
    assert cut[1] == ([" unseen"], [ids["seen here"], ids[" there"]])
    assert cut[2] == ([], [[]])
    assert cut[3] == ([], [ids["seen here"]])
    assert cut[4] == ([], [ids["u" * 1025 + " seen"]])
    assert cut[5] == ([], [library.encode_ordinary("seen" * 300)])
    assert cut[7] == (["unseen", " unseen"], [[], [], []])
    assert digests(folded_bpe.with_ids(folded_bpe.encoded(df))) == wanted(library, rows)


def test_no_text_has_an_id(spark, library):
    rows = [(1, None), (2, ""), (None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert digests(folded_bpe.with_ids(folded_bpe.encoded(df))) == wanted(library, rows)


def test_characters_younger_than_the_format(spark, library):
    """The regex module may know letters that the format counts as other characters."""
    points = [*range(0x530, 0x560), *range(0x870, 0x8a0), *range(0x11da0, 0x11e00),
              *range(0x323a0, 0x323c0), *range(0x3d000, 0x3d010), 0xa7ce, 0xa7d0]
    rows = [(c, f"a{chr(c)}b {chr(c)}1 {chr(c)}") for c in points]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert digests(folded_bpe.with_ids(folded_bpe.encoded(df))) == wanted(library, rows)


def test_heap_merges_like_the_library(library):
    ranks = folded_bpe.read_ranks(folded_bpe.default_ranks())
    rng = random.Random(8)
    for alphabet in ("aeinrst", "a", "ab", "thequickbrownfox"):
        for n in (1, 2, 3, 40, 700):
            word = "".join(rng.choices(alphabet, k=n))
            parts = folded_bpe.merged(ranks, word.encode())
            assert [ranks[p] for p in parts] == library.encode_ordinary(word)


def test_files_that_cannot_be_folded_are_refused(tmp_path):
    file = tmp_path / "ranks"
    file.write_text("YQ== 0\n")
    with pytest.raises(ValueError):
        folded_bpe.rank_tables(str(file))


def test_unknown_words_are_held_for_some_texts_only(monkeypatch, library):
    """What a worker keeps must not grow with the words that it does not know."""
    monkeypatch.setattr(folded_bpe, "CUT_BYTES", 4_000)
    monkeypatch.setattr(folded_bpe, "KEPT_CHUNKS", 100)
    texts = [" ".join(f"w{chr(97 + i % 26)}{j}, seen" for j in range(i * 40, i * 40 + 40))
             for i in range(200)] + [None, "", "x" * 9_000, None]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(texts, pa.string()), pa.nulls(len(texts), pa.list_(pa.string()))],
        ["text", "words"],
    )
    known = {w: folded_bpe.little_endian(library.encode_ordinary(w)) for w in ("seen", " seen", ",")}
    cutter = folded_bpe.Cutter(known, None)
    monkeypatch.setattr(cutter, "_encode_long", lambda word: folded_bpe.little_endian([0]))
    rows = most = 0
    for part in folded_bpe._slices(batch):
        cutter.forget()
        ids, ends = cutter.cut(part)
        rows, most = rows + len(ends), max(most, len(cutter.others))
        assert len(cutter._chunks) <= 100 and len(cutter._older) <= 100
        assert ids.max(initial=0) < folded_bpe.UNKNOWN + len(cutter.others)
    assert rows == len(texts) and 0 < most < 1_000


def test_equal_ranks_merge_from_the_left_in_any_file(spark, tmp_path):
    """Ranks that merging can only reach in several ways, up to an id of all ones."""
    import base64

    rng = random.Random(5)
    pieces = [bytes([b]) for b in range(256)]
    while len(pieces) < 512:
        piece = bytes(rng.choices(b"abc", k=rng.randrange(2, 7)))
        if piece not in pieces:
            pieces.append(piece)
    file = tmp_path / "ranks"
    file.write_text("".join(f"{base64.b64encode(p).decode()} {i}\n" for i, p in enumerate(pieces)))
    ranks = {p: i for i, p in enumerate(pieces)}
    own = tiktoken.Encoding(
        "file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    rows = [(i, "".join(rng.choices("abc ", k=rng.randrange(1, 60)))) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = folded_bpe.with_ids(folded_bpe.encoded(df, str(file)), str(file))
    assert digests(found) == wanted(own, rows)

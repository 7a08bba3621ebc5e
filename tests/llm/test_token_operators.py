"""Token files, rank-array BPE and packing against the tokenizers library on whole texts."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from flowloom.llm import chunks, packing, rank_array_bpe, token_files
from flowloom.llm.chunks import ChunkEncoder, default_tokenizer, library_encoder, little_endian
from flowloom.llm.texts import table
from flowloom.session import run_dir

PIECES = [
    "a", "b", "the", " ", "  ", "\n", "\t", "\xa0", "é", "!!", "1", "23", "'s", "'", "'ll",
    "<|endoftext|>", "　", "\x1c", "\x85", "日本", "​", "🙂", "\r\n", "$$$", "-", "́", "²", "",
    ".", ",", "Word", "",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(default_tokenizer())


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def texts(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choices(PIECES, k=rng.randrange(16))) for _ in range(n)]


def test_chunks_give_the_ids_of_whole_texts(library):
    made = [*texts(8000), "abcdefgh" * 3000 + "x" * 999, " ".join(texts(2000, 4))]
    for encoder in (library_encoder(default_tokenizer()),
                    rank_array_bpe.codec(default_tokenizer())[1]):
        found = list(encoder.many(made))
        for text, code in zip(made, found, strict=True):
            assert np.frombuffer(code, "<u4").tolist() == ids_of(library, text), text[:80]
            assert encoder.ids_of(text) == code


def test_words_in_use_stay_known(monkeypatch):
    """A full cache drops the words that no text has asked for lately, not the common ones."""
    monkeypatch.setattr(chunks, "CHUNK_ENTRIES", 50)
    monkeypatch.setattr(chunks, "WORD_ENTRIES", 50)
    seen = []

    def encode(word):
        seen.append(word)
        return little_endian(list(word.encode()))

    encoder = ChunkEncoder(encode, {})
    for i in range(200):
        rare = "".join(chr(97 + int(d)) for d in f"{i:03}")
        text = f"x the {rare}q of, {rare}w the end. {rare}z"
        assert list(encoder.many([text, text])) == [little_endian(list(text.encode()))] * 2
    assert len(encoder._chunks) <= 50 and len(encoder._older) <= 50
    for word in (" the", " of", " end"):
        assert seen.count(word) == 1


def test_decode_is_the_librarys(library):
    bpe, _ = rank_array_bpe.codec(default_tokenizer())
    rng = random.Random(1)
    for _ in range(300):
        ids = [rng.randrange(50257) for _ in range(rng.randrange(12))]
        assert bpe.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_long_words_merge_as_short_ones(library):
    bpe, _ = rank_array_bpe.codec(default_tokenizer())
    word = "".join(random.Random(2).choices("aeinrst", k=900))
    assert bpe.word_ids(word.encode()) == ids_of(library, word)


def test_dac_random_access():
    rng = np.random.default_rng(0)
    for n in (0, 1, 7, 511, 512, 513, 5000):
        values = (rng.integers(0, 2**32, n) >> rng.integers(0, 32, n)).astype(np.uint32)
        code = token_files.DacReader(token_files.dac_encode(values))
        assert len(code) == n
        assert [code.token(i) for i in range(n)] == values.tolist()
        for _ in range(20):
            a, b = sorted(rng.integers(0, n + 1, 2))
            assert code.slice(a, b).tolist() == values[a:b].tolist()
    with pytest.raises(IndexError):
        code.token(n)


def check_files(rows, found, library):
    """Rows sorted by id (null first), equal ids by text, follow each other without a gap."""
    wanted = []
    for doc_id, text in rows:
        code = np.array([*ids_of(library, text), 0], "<u4").tobytes()
        wanted.append((doc_id is not None, doc_id or 0, len(code) // 4, zlib.crc32(code)))
    got = [(r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in found]
    assert sorted(got) == sorted(wanted)
    found = sorted(found, key=lambda r: r.start)
    assert [(r.doc_id is not None, r.doc_id or 0) for r in found] == sorted(w[:2] for w in wanted)
    at = 0
    for row in found:
        assert row.start == at
        at += row.n_tokens


def test_token_files(spark, sf_dir, library):
    rows = [tuple(r) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    check_files(rows, token_files.op1_token_files(spark, sf_dir).collect(), library)


def test_token_files_odd(spark, odd_docs, odd_rows, no_docs, library):
    path = run_dir(spark, "odd-tokens")
    token_files.write_tokens(odd_docs.repartition(4), path)
    check_files(odd_rows, token_files.read_documents(spark, path).collect(), library)
    empty = run_dir(spark, "no-tokens")
    token_files.write_tokens(no_docs, empty)
    assert token_files.read_documents(spark, empty).collect() == []


def test_bpe_query(spark, sf_dir, odd_docs, odd_rows, no_docs, library):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    for rows, found in (
        (docs.collect(), rank_array_bpe.op4_rank_array_bpe(spark, sf_dir).collect()),
        (odd_rows, rank_array_bpe.bpe_digests(odd_docs).collect()),
    ):
        wanted = []
        for doc_id, text in rows:
            ids = ids_of(library, text)
            decoded = library.decode(ids, skip_special_tokens=False).encode()
            wanted.append((
                doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                hashlib.sha256(decoded).hexdigest(),
            ))
        assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, wanted))
    full = rank_array_bpe.bpe_documents(odd_docs).collect()
    assert sorted(r.decoded for r in full) == sorted(t or "" for _, t in odd_rows)
    assert all(r.ids == ids_of(library, r.decoded) for r in full)
    assert rank_array_bpe.bpe_documents(no_docs).collect() == []


def check_packing(rows, pieces, library):
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append(p)
    padding = 0
    for members in sequences.values():
        at = 0
        for p in sorted(members, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at == members[0].capacity <= packing.CONTEXT
        padding += 0 if at & (at - 1) == 0 else packing.CONTEXT - at
    assert padding == 0
    held = sorted((p.doc_id is not None, p.doc_id or 0, p.doc_tokens, p.start, p.ids_crc32)
                  for p in pieces)
    lengths = {}
    for p in pieces:
        lengths.setdefault((p.doc_id, p.doc_tokens), []).append(p.length)
    for doc_id, text in rows:
        assert (doc_id, len(ids_of(library, text)) + 1) in lengths
    assert sum(p.length for p in pieces) == sum(len(ids_of(library, t)) + 1 for _, t in rows)
    return held


def test_packing(spark, sf_dir, odd_docs, odd_rows, no_docs, library):
    rows = table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    pieces = packing.pack(table(spark, sf_dir, "documents")).collect()
    check_packing(rows, pieces, library)
    of = {}
    for p in sorted(pieces, key=lambda p: p.start):
        assert zlib.crc32(p.ids) == p.ids_crc32
        of[p.doc_id] = of.get(p.doc_id, b"") + bytes(p.ids)
    for doc_id, text in rows:
        assert np.frombuffer(of[doc_id], "<u4").tolist() == [*ids_of(library, text), 1]
    check_packing(odd_rows, packing.pack(odd_docs).collect(), library)
    assert packing.pack(no_docs).collect() == []


def test_balance():
    rng = random.Random(7)
    for _ in range(60):
        lengths = [rng.choice((1, 5, 300, 2048, 3000, 9000)) for _ in range(rng.randrange(1, 30))]
        room = packing.capacities(sum(lengths))
        places = packing.balance(lengths, room)
        assert sum(room) == sum(lengths) == sum(p[2] for p in places)
        for item, length in enumerate(lengths):
            at = 0
            for _, start, part, _, _ in sorted(p for p in places if p[0] == item):
                assert start == at
                at += part
            assert at == length


def test_groups_cut_long_documents():
    code = np.arange(1000, dtype="<u4").tobytes()
    groups = list(packing._groups(iter([(1, code), (2, code[:40])]), 300))
    assert [sum(len(i) // 4 for _, i, _, _ in g) for g in groups] == [300, 300, 300, 110]
    assert b"".join(i for g in groups for d, i, _, _ in g if d == 1) == code

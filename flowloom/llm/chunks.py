"""Byte-level BPE ids of whole texts from cached chunks.

The pre-tokenizer of a byte-level BPE always starts a new piece at a space that follows another
kind of character, so a text may be cut there and each chunk encoded by itself. Chunks are words
with what clings to them; most repeat, so a bounded cache of chunk to ids does most of the work.
A new chunk is cut into the pre-tokenizer's words, of which most are known too (without their
punctuation), and the encoder proper sees only new words. Results equal those for the whole text.
"""

from __future__ import annotations

import functools
import os
import re
import sys
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from flowloom.llm.texts import only_caches_of

#: White space, a space, white space or the end: here a plain split at spaces would differ.
_NATIVE = sys.byteorder == "little" and array("I").itemsize == 4
_RUN = re.compile(r"\s (?:\s|\Z)")
_CUT = re.compile(r"(?<=\S) ")
#: Stands before a text's first chunk, which has no space before it; a private character.
_HEAD = "\ue000"
#: What may follow a word's letters at the end of a chunk: a piece of its own.
_STOPS = (".", ",")
#: Characters of texts that are encoded together.
RUN_CHARACTERS = 6_000_000
#: Entries a worker keeps, some 200 bytes each: of chunks so many twice, those asked for since the
#: younger half began and those before; of words that only the pattern finds, once.
CHUNK_ENTRIES, WORD_ENTRIES = 500_000, 400_000
#: White space of the pre-tokenizer's pattern.
_S = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The byte-level pre-tokenizer's pattern (fixed value of the format).
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+|"
    rf" ?[^{_S}\p{{L}}\p{{N}}]+|[{_S}]+(?![^{_S}])|[{_S}]+"
)


def cut(text: str) -> list[str]:
    """Chunks; each but the first stands after one space that is not written in it."""
    return _CUT.split(text) if _RUN.search(text) else text.split(" ")


class ChunkEncoder:
    """Ids of texts by any function that encodes one word of the pre-tokenizer.

    Ids are little-endian unsigned 32-bit integers. special maps strings that stand for an id of
    their own.
    """

    def __init__(self, encode: Callable[[str], bytes], special: dict[str, int]) -> None:
        import regex

        self._encode = encode
        self._words: dict[str, bytes] = {}
        self._chunks: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._find = regex.compile(PATTERN).findall
        self._special = {text: little_endian([i]) for text, i in special.items()}
        self._cut_special = (
            regex.compile("(" + "|".join(map(regex.escape, special)) + ")").split
            if special else None
        )

    def _word(self, word: str) -> bytes:
        ids = self._words.get(word)
        if ids is None:
            if len(self._words) >= WORD_ENTRIES:
                self._words.clear()
            self._words[word] = ids = self._encode(word)
        return ids

    def _keep(self, key: str, ids: bytes) -> None:
        if len(self._chunks) >= CHUNK_ENTRIES:
            self._chunks, self._older = self._older, self._chunks
            self._chunks.clear()
        self._chunks[key] = ids

    def _letters(self, key: str) -> bytes:
        """Ids of a chunk of letters alone, which is one word, if a chunk with a stop needs them."""
        ids = self._chunks.get(key)
        if ids is None:
            ids = self._older.get(key)
            if ids is None:
                ids = self._encode(" " + key)
            self._keep(key, ids)
        return ids

    def _chunk(self, key: str) -> bytes:
        """Ids of a chunk that is not kept yet; a text's first one is marked by _HEAD."""
        # Letters, or letters and a full stop or comma, need no pattern.
        if key.isalpha():
            return self._encode(" " + key)
        if key[-1:] in _STOPS and key[:-1].isalpha():
            return self._letters(key[:-1]) + self._word(key[-1])
        return self._by_pattern(key[1:] if key[:1] == _HEAD else " " + key)

    def _by_pattern(self, chunk: str) -> bytes:
        segments = self._cut_special(chunk) if self._cut_special else [chunk]
        return b"".join(
            self._special[segment] if segment in self._special
            else b"".join(map(self._word, self._find(segment)))
            for segment in segments
        )

    def _codes(self, keys: list[str]) -> list[bytes]:
        """Ids of chunks, each of which stands in the list once."""
        codes = list(map(self._chunks.get, keys))
        for i in [i for i, code in enumerate(codes) if code is None]:
            key = keys[i]
            ids = self._older.get(key)
            if ids is None:
                ids = self._chunk(key)
            self._keep(key, ids)
            codes[i] = ids
        return codes

    def many(self, texts: list[str]) -> Iterator[bytes]:
        """ids_of every text, a run of texts at a time: equal chunks of a run are looked up once."""
        only_caches_of("chunks", self._words, self._chunks, self._older)
        run, size = [], 0
        for text in texts:
            run.append(text)
            size += len(text)
            if size >= RUN_CHARACTERS:
                yield from self._run(run)
                run, size = [], 0
        yield from self._run(run)

    def _run(self, texts: list[str]) -> list[bytes]:
        alike = [not _RUN.search(text) and _HEAD not in text for text in texts]
        plain = pa.array([t for t, a in zip(texts, alike, strict=True) if a], pa.string())
        if not len(plain):
            return [self.ids_of(text) for text in texts]
        chunks = pc.split_pattern(pc.binary_join_element_wise(_HEAD, plain, ""), " ")
        coded = chunks.values.dictionary_encode()
        # Several times faster than to_pylist().
        codes = self._codes(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        lengths = np.fromiter(map(len, codes), np.int64, len(codes)) // 4
        flat = np.frombuffer(b"".join(codes), "<u4")
        which = coded.indices.to_numpy()
        long = lengths[which]
        ends = np.cumsum(long)
        # Place of each id in flat: its chunk's start there, counted on from the chunk's first id.
        shift = (np.cumsum(lengths) - lengths)[which] - (ends - long)
        ids = flat[np.arange(ends[-1]) + np.repeat(shift, long)]
        bounds = np.concatenate([[0], ends])[chunks.offsets.to_numpy()].tolist()
        found = iter([ids[a:b].tobytes() for a, b in zip(bounds, bounds[1:])])
        return [next(found) if a else self.ids_of(t) for t, a in zip(texts, alike, strict=True)]

    def ids_of(self, text: str) -> bytes:
        if _HEAD in text:
            return self._by_pattern(text)
        keys = cut(text)
        keys[0] = _HEAD + keys[0]
        once = list(dict.fromkeys(keys))
        codes = dict(zip(once, self._codes(once), strict=True))
        return b"".join(map(codes.__getitem__, keys))


def little_endian(ids) -> bytes:
    """ids as little-endian unsigned 32-bit integers."""
    return array("I", ids).tobytes() if _NATIVE else np.asarray(ids, dtype="<u4").tobytes()


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    moved = (chr(256 + i) for i in range(256))
    return {b: chr(b) if b in own else next(moved) for b in range(256)}


@functools.cache
def library_encoder(tokenizer_path: str) -> ChunkEncoder:
    """The tokenizers library's byte-level BPE of a file, kept by each Python worker.

    The library's model encodes the words; what its pre-tokenizer does to a whole text is done by
    the chunks. test_token_operators.py holds the ids against the library's encode() of whole texts.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path)
    tokenizer.no_truncation()
    tokenizer.no_padding()

    tokenize = tokenizer.model.tokenize
    letters = byte_letters()
    codes = [little_endian([i]) for i in range(max(tokenizer.get_vocab().values()) + 1)]

    def encode(word: str) -> bytes:
        if word.isascii() and word.isprintable():
            spelled = word.replace(" ", letters[0x20])  # the others stand for themselves
        else:
            spelled = word.encode().decode("latin-1").translate(letters)
        return b"".join([codes[token.id] for token in tokenize(spelled)])

    added = tokenizer.get_added_tokens_decoder()
    if any(t.lstrip or t.rstrip or t.single_word for t in added.values()):
        raise ValueError("added tokens that depend on what stands beside them are not supported")
    return ChunkEncoder(encode, {token.content: i for i, token in added.items()})


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")

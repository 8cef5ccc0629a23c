"""Ids of whole texts from public tokenizer files, with a memo of white-space words.

Both vocabularies treat white-space words alone, so a text's ids are its words' ids in a row:

* ``word_bpe_49k.json`` (tokenizers): the normaliser maps white space to one blank and lower-cases
  code point by code point, and the pre-tokeniser drops blanks; no piece reaches across one.
* ``piece_bpe_32k.model`` (sentencepiece): no piece of the vocabulary holds a blank mark after
  another character, so no merge joins a character to a blank behind it.  This is checked when
  the model is loaded; a model without that property is not memoised.

A task asks the library once per distinct word and gathers the ids of a batch with numpy.
"""

from __future__ import annotations

import re
import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from tidewatch.llm.common import ragged, split_words

MEMO_WORDS = 300_000  # distinct words a worker remembers before it starts afresh (bounds memory)
LONG_WORD = 64  # longer words go to the library each time

# The pre-tokeniser's pattern, as the tokenizer's file states it.
WORD_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
SIMPLE_WORD = re.compile("[!-~\u00a1-\u024f]+")
STOPS = frozenset(".,;:!?")

_LOADED: dict = {}


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordIds:
    """Ids by the tokenizers library (no special tokens added), memoised by word."""

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.bpe = self.tok.model
        self.letters = _byte_letters()
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        got = self.pieces.get(piece)
        if got is None:
            mapped = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
            ids = [t.id for t in self.bpe.tokenize(mapped)]
            got = struct.pack(f"<{len(ids)}I", *ids)
            if len(piece) <= LONG_WORD:
                self.pieces[piece] = got
        return got

    def _word(self, word: str) -> bytes:
        # Below U+0250 every letter is its own NFC form and lower-cases alone; anything else,
        # and whatever may hold a special string, goes through the whole library pipeline.
        if "<|" in word or not SIMPLE_WORD.fullmatch(word):
            return np.array(self.tok.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()
        low = word.lower()
        if low.isalpha():
            return self._piece(low)
        if low[-1] in STOPS and low[:-1].isalpha():  # the pattern's outcome for most other words
            return self._piece(low[:-1]) + self._piece(low[-1])
        return b"".join(map(self._piece, WORD_PIECES.findall(low)))

    def forget(self) -> None:
        """Drop the memo."""
        self.words.clear()
        self.pieces.clear()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, offset of each text)."""
        codes, uniq, off = split_words(texts)
        return _gather(self.words, self._word, uniq.to_pylist(), codes, off, self.pieces)


class PieceIds:
    """Ids by sentencepiece (no begin or end), memoised by blank-led word."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.plain = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        spec = proto.normalizer_spec
        # Texts cut anywhere need a processor that puts no blank in front; it equals the plain one
        # on " " + text when the model itself adds that blank and leaves the text alone.
        self.splits = (
            spec.add_dummy_prefix and not spec.remove_extra_whitespaces and spec.name == "identity"
            and not spec.precompiled_charsmap and proto.trainer_spec.model_type == 2
            and not any(p.type == 4 for p in proto.pieces)
        )
        blank = "▁"
        self.by_word = self.splits and not any(blank in p.piece.lstrip(blank) for p in proto.pieces if p.type == 1)
        spec.add_dummy_prefix = False
        self.bare = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        self.width = np.array([1 if p.type == 6 else len(p.piece.replace(blank, " ").encode()) for p in proto.pieces])
        self.words: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        return np.array(self.bare.encode(" " + word), dtype="<u4").tobytes()

    def count(self, texts: pa.Array) -> np.ndarray:
        """Number of ids of each whole text."""
        if not self.by_word:
            return np.array([len(self.plain.encode(t)) for t in texts.to_pylist()], dtype=np.int64)
        texts = pc.replace_substring(texts, "\u2581", " ")  # to the model a blank mark in a text is a blank
        parts = pc.split_pattern(texts, " ")
        flat, off = parts.flatten(), parts.offsets.to_numpy().astype(np.int64)
        off = off - off[0]
        d = flat.dictionary_encode()
        words = d.dictionary.to_pylist()
        n = np.array([len(x) // 4 for x in _ids(self.words, self._word, words)], dtype=np.int64)
        codes = d.indices.to_numpy(zero_copy_only=False)
        total = np.concatenate([[0], np.cumsum(n[codes])])
        out = total[off[1:]] - total[off[:-1]]
        empty = np.concatenate([[0], np.cumsum(np.array([not w for w in words], dtype=bool)[codes])])
        for i in np.flatnonzero(empty[off[1:]] > empty[off[:-1]]):  # empty texts, runs of blanks
            out[i] = len(self.plain.encode(texts[int(i)].as_py()))
        return out

    def bare_ids(self, text: str) -> np.ndarray:
        """Ids of a cut of a text, nothing put in front of it."""
        if self.by_word and "  " not in text and text[:1] != " " and text[-1:] != " ":
            head, *rest = text.split(" ")
            got = [np.array(self.bare.encode(head), dtype="<u4").tobytes(), *_ids(self.words, self._word, rest)]
            return np.frombuffer(b"".join(got), dtype="<u4")
        return np.array(self.bare.encode(text), dtype="<u4")


def _ids(memo: dict[str, bytes], ask, words: list[str]) -> list[bytes]:
    got = list(map(memo.get, words))
    for i, g in enumerate(got):
        if g is None:
            got[i] = ask(words[i])
            if len(words[i]) <= LONG_WORD:
                memo[words[i]] = got[i]
    if len(memo) > MEMO_WORDS:
        memo.clear()
    return got


def _gather(memo, ask, words, codes, off, pieces) -> tuple[np.ndarray, np.ndarray]:
    got = _ids(memo, ask, words)
    if len(pieces) > MEMO_WORDS:
        pieces.clear()
    n = np.fromiter(map(len, got), dtype=np.int64, count=len(got)) // 4
    starts = np.concatenate([[0], np.cumsum(n)])
    ids, at = ragged(starts, np.frombuffer(b"".join(got), dtype="<u4"), codes)
    return ids, at[off]


def loaded(kind: type, path: str):
    """One instance per worker process and file."""
    if (kind, path) not in _LOADED:
        _LOADED[kind, path] = kind(path)
    return _LOADED[kind, path]

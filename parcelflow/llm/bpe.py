"""Token ids of public BPE vocabularies, equal to the ``tokenizers`` library and faster.

``ids_of(path, texts)`` gives one uint32 array per text. Byte-level vocabularies without
normaliser go through a ``tiktoken`` encoder built from the same JSON file; vocabularies with word ends
are encoded word by word, each distinct word once, by the library's own model. A text
that leaves the ground on which the two provably agree (characters beyond Latin, special
tokens, apostrophes for the word vocabulary) is handed to ``tokenizers`` itself.
"""

from __future__ import annotations

import hashlib
import json
import os
import re

import numpy as np
import pyarrow as pa

from parcelflow.llm.common import hash_runs, text_chunks

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

_LOADED: dict[str, object] = {}
_CACHED_WORDS = 500_000  # per Python worker; the cache starts again beyond


def version(path: str) -> str:
    """Digest of the vocabulary file: the tokenizer's identity."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()[:16]


def vocabulary_size(path: str) -> int:
    return _load(path).library.get_vocab_size()


def ids_of(path: str, texts: pa.Array) -> list[np.ndarray]:
    """Token ids of each text (null: empty), without added special tokens."""
    return _load(path).encode(texts)


def _load(path: str):
    if path not in _LOADED:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        pre = spec.get("pre_tokenizer") or {}
        if spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space"):
            _LOADED[path] = _ByteLevel(path, spec)
        elif spec["model"].get("end_of_word_suffix"):
            _LOADED[path] = _WordEnds(path, spec)
        else:
            _LOADED[path] = _Library(path, spec)
    return _LOADED[path]


class _Library:
    """Any vocabulary, by the library alone."""

    def __init__(self, path: str, spec: dict):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t["content"] for t in spec.get("added_tokens", [])]

    def _has_special(self, text: str) -> bool:
        return any(token in text for token in self.special)

    def by_library(self, texts: list[str]) -> list[np.ndarray]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(x.ids, np.uint32) for x in found]

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        return self.by_library([t or "" for t in texts.to_pylist()])


def _byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write each byte as a printable letter."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    others = [b for b in range(256) if b not in set(plain)]
    return letters | {chr(256 + i): b for i, b in enumerate(others)}


class _ByteLevel(_Library):
    """Ranks equal ids, so a rank-based encoder over the same words merges alike."""

    # fixed value: the splitting pattern of byte-level vocabularies
    PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, path: str, spec: dict):
        import tiktoken

        super().__init__(path, spec)
        letters = _byte_letters()
        words = {w: i for w, i in spec["model"]["vocab"].items() if w not in self.special}
        ranks = {bytes(letters[c] for c in w): i for w, i in words.items()}
        self.fast = tiktoken.Encoding(path, pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.beyond = re.compile("[^\x00-ɏ]")

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        found = []
        for text in texts.to_pylist():
            text = text or ""
            if self._has_special(text) or not text.isascii() and self.beyond.search(text):
                found.append(self.by_library([text])[0])
            else:
                found.append(np.asarray(self.fast.encode_ordinary(text), np.uint32))
        return found


class _WordEnds(_Library):
    """Lower-cased words with end marks: split in numpy, encode distinct words, gather."""

    def __init__(self, path: str, spec: dict):
        from tokenizers import Tokenizer, pre_tokenizers

        super().__init__(path, spec)
        kinds = np.full(256, 3, np.uint8)  # 0 space, 1 letter, 2 digit (each alone), 3 other
        for code in range(256):
            c = chr(code)
            kinds[code] = 0 if c.isspace() and code not in range(28, 32) else 1 if c.isalpha() else 2 if c.isnumeric() else 3
        self.kinds = kinds
        lower = np.arange(256, dtype=np.uint8)
        for code in range(256):
            if len(chr(code).lower()) == 1 and ord(chr(code).lower()) < 256:
                lower[code] = ord(chr(code).lower())
        self.lower = lower
        self.words: dict[bytes, bytes] = {}
        # the same model for single words that are normalised and split already
        self.by_word = Tokenizer(self.library.model)
        self.by_word.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        plain, odd, others = [], [], []
        for i, text in enumerate(texts.to_pylist()):
            text = text or ""
            try:
                latin = b"" if "'" in text or self._has_special(text) else text.encode("latin-1")
            except UnicodeEncodeError:
                latin = b""
            if text and not latin:
                odd.append(i)
                others.append(text)
            plain.append(latin)
        found: list[np.ndarray] = []
        latin = pa.array(plain, pa.large_binary())
        as_text = pa.Array.from_buffers(pa.large_string(), len(latin), [None, *latin.buffers()[1:]])
        for first, end, data, offsets in text_chunks(as_text):
            found.extend(self._chunk(self.lower[data], offsets))
        for i, ids in zip(odd, self.by_library(others), strict=True):
            found[i] = ids
        return found

    def _chunk(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        if not len(data):
            return [np.zeros(0, np.uint32)] * (len(offsets) - 1)
        kind = self.kinds[data]
        cut = np.empty(len(data) + 1, bool)
        cut[0] = cut[-1] = True
        cut[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        cut[offsets] = True
        bounds = np.flatnonzero(cut)
        starts, ends = bounds[:-1], bounds[1:]
        kept = kind[starts] != 0
        starts, ends = starts[kept], ends[kept]
        hashes = hash_runs(data, starts, ends)
        _, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        raw = data.tobytes()
        coded = self._words([raw[s:e] for s, e in zip(starts[first].tolist(), ends[first].tolist(), strict=True)])
        if not coded:
            return [np.zeros(0, np.uint32)] * (len(offsets) - 1)
        sizes = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        flat, at = np.frombuffer(b"".join(coded), np.uint32), np.cumsum(sizes) - sizes
        n = sizes[inverse]
        ends_out = np.cumsum(n)
        ids = flat[np.arange(int(ends_out[-1])) + np.repeat(at[inverse] - (ends_out - n), n)]
        upto = np.concatenate([[0], ends_out])[np.searchsorted(starts, offsets)]
        return [ids[a:b] for a, b in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True)]

    def _words(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word as bytes; unknown words are encoded in one call."""
        if len(self.words) >= _CACHED_WORDS:
            self.words.clear()
        known = self.words
        new = [w for w in words if w not in known]
        if new:
            found = self.by_word.encode_batch_fast([w.decode("latin-1") for w in new], add_special_tokens=False)
            known.update((w, np.asarray(x.ids, np.uint32).tobytes()) for w, x in zip(new, found, strict=True))
        return [known[w] for w in words]

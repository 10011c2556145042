"""Exact token ids of the lower-casing word BPE, through a bounded cache of two generations of words.

The tokenizer never looks across white space: its normalizer only maps white space to a
space, and its pre-tokenizer drops it. So a text is cut at plain spaces, tabs and line feeds
and each chunk's ids are looked up or made by the tokenizer itself. A chunk of letters with
plain punctuation behind it is cut between the two, where the pre-tokenizer cuts as well.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable

import numpy as np
from tokenizers import Tokenizer

_LETTERS = re.compile(r"[a-zß-öø-ÿ]+")
_TAIL = ".,!?*$%&#|;:"
_LONG = 64
#: Chunks in a generation of the cache; ids don't depend on it.
CACHE = 300_000


# The normalizer and pre-tokenizer of the word BPE, by which texts may be cut as below.
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": _WORDS}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


class WordEncoder:
    """``encode(text)``: the ids as little-endian unsigned 32-bit bytes. Vocabularies that cut texts otherwise are refused."""

    def __init__(self, path: str, cache_size: int = CACHE):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["normalizer"] != _NORMALIZER or spec["pre_tokenizer"] != _PRE_TOKENIZER or spec["model"]["type"] != "BPE" or spec["model"]["end_of_word_suffix"] != "</w>" or spec["post_processor"]:
            raise ValueError("only the lower-casing word BPE cuts texts as this encoder does")
        self.cache: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}
        self.cache_size = cache_size
        ends = [i for piece, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if piece.endswith("</w>")]
        self.ends = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        self.ends[ends] = True

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def _unknown(self, chunks: Iterable[str]) -> list[str]:
        """The chunks that the cache has not; those of the generation before move over."""
        cache, older, out = self.cache, self.older.get, []
        for chunk in chunks:
            ids = older(chunk)
            if ids is None:
                out.append(chunk)
            else:
                cache[chunk] = ids
        return out

    def _learn(self, chunks: list[str]) -> None:
        cache, split = self.cache, []
        for chunk in chunks:
            core = chunk.rstrip(_TAIL)
            tail = chunk[len(core) :]
            core = core.lower()
            if _LETTERS.fullmatch(core):
                split.append((chunk, core, tail))
            else:
                cache[chunk] = self._ids(chunk).tobytes()
        for tail in self._unknown({tail for _, _, tail in split}.difference(cache)):
            cache[tail] = self._ids(tail).tobytes()
        words = self._unknown({core for _, core, _ in split}.difference(cache))
        for low in range(0, len(words), 256):
            part = words[low : low + 256]
            ids = self._ids(" ".join(part))
            cut = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(cut) == len(part):
                raw = ids.tobytes()
                for word, start, end in zip(part, [0, *cut], cut, strict=False):
                    cache[word] = raw[start:end]
            else:
                for word in part:
                    cache[word] = self._ids(word).tobytes()
        for chunk, core, tail in split:
            cache[chunk] = cache[core] + cache[tail]

    def encode(self, text: str) -> bytes:
        if len(self.cache) > self.cache_size:
            self.cache, self.older = {"": b""}, self.cache
        cache = self.cache
        chunks = text.replace("\n", " ").replace("\t", " ").split(" ")
        missing = self._unknown(set(chunks).difference(cache))
        if missing:
            self._learn(missing)
        ids = b"".join([cache[x] for x in chunks])
        for x in missing:
            if len(x) > _LONG:
                cache.pop(x, None)
                cache.pop(x.rstrip(_TAIL).lower(), None)
        return ids


_ENCODERS: dict[tuple[str, int], WordEncoder] = {}


def encoder(path: str, cache_size: int = CACHE) -> WordEncoder:
    """One encoder for each vocabulary file, size of cache and worker process."""
    if (path, cache_size) not in _ENCODERS:
        _ENCODERS[path, cache_size] = WordEncoder(path, cache_size)
    return _ENCODERS[path, cache_size]

"""SentencePiece encoding by a streaming Viterbi pass, and decoding.

The lattice has a node for each character border and an arc for each piece. A window of the
last ``max_piece`` nodes is kept; whenever the backpointer paths of all nodes in it run
through one border, the ids up to there are committed and forgotten, so memory doesn't grow
with the text. In a unigram model a path's score is the sum of its pieces' scores. In a BPE
model the score of an arc is 0 or minus infinity: a sequence of pieces is the one that
merging would give if and only if merging gives each two neighbours back unchanged, so an arc
survives if merging the last piece of the path before it and its own piece leaves that pair.
Exactly one path to a border survives, and its ids are those of the library.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as proto

SPACE = "▁"
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6
_UNIGRAM, _BPE = 1, 2
#: More than there are pieces and Unicode characters.
_MAX_CODES = 1 << 24
_NEVER = float("-inf")


class Model:
    """The pieces of a model file, and ``encode`` and ``decode`` with them.

    Models whose normalizer maps characters or drops white space are refused, since their texts
    can't be read back, and so are those with user-defined or unused pieces.
    """

    def __init__(self, path: str, cache_size: int = 200_000):
        spec = proto.ModelProto()
        with open(path, "rb") as f:
            spec.ParseFromString(f.read())
        norm = spec.normalizer_spec
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces or spec.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only models with the identity normalizer and escaped white space are read")
        self.bpe = spec.trainer_spec.model_type == _BPE
        if not self.bpe and spec.trainer_spec.model_type != _UNIGRAM:
            raise ValueError("only unigram and BPE models have pieces to choose from")
        if any(p.type in (_USER, _UNUSED) for p in spec.pieces):
            raise ValueError("user-defined and unused pieces follow other rules")
        self.prefix = norm.add_dummy_prefix
        self.pieces = [p.piece for p in spec.pieces]
        self.types = [p.type for p in spec.pieces]
        self.ids = {p.piece: i for i, p in enumerate(spec.pieces) if p.type == _NORMAL}
        self.scores = {p.piece: p.score for p in spec.pieces if p.type == _NORMAL}
        self.unknown = self.types.index(_UNKNOWN) if _UNKNOWN in self.types else 0
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(spec.pieces) if p.type == _BYTE}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.max_piece = max(map(len, self.ids), default=1)
        self.unknown_score = min(self.scores.values(), default=0.0) - 10.0
        # no piece runs over these borders, so texts are cut there and parts looked up
        inner = any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.ids) or any("\n" in p for p in self.ids)
        self.cut = None if inner else re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")
        # codes: ids, and behind them a number for each character met that is no piece
        self.texts = list(self.pieces)
        self.codes = dict(self.ids)
        self.raw = [i.to_bytes(4, "little") for i in range(len(self.pieces))]
        ends: dict[str, set[int]] = {}
        for p in self.ids:
            for n in (2, 3):
                if len(p) >= n:
                    ends.setdefault(p[-n:], set()).add(len(p))
        self._ends = ends
        self.lengths: dict[str, tuple[int, ...]] = {}
        self.edges: dict[int, tuple[list, list] | None] = {}
        self.pairs: dict[int, bool] = {}
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.cache_size = cache_size
        plain = [b"" if t == _CONTROL else " ⁇ ".encode() if t == _UNKNOWN else p.replace(SPACE, " ").encode() for p, t in zip(self.pieces, self.types, strict=True)]
        self.plain = [bytes([self.byte_of[i]]) if i in self.byte_of else p for i, p in enumerate(plain)]

    def _code(self, char: str) -> int:
        """The code of a character that may be no piece."""
        code = self.codes.get(char)
        if code is None:
            code = self.codes[char] = len(self.texts)
            raw = char.encode()
            self.texts.append(char)
            self.raw.append(b"".join(self.raw[self.bytes[b]] for b in raw) if all(b in self.bytes for b in raw) else self.raw[self.unknown])
        return code

    def _lengths(self, tail: str) -> tuple[int, ...]:
        """The lengths over 1 of pieces that end in these up to three characters, longest first."""
        if len(self.lengths) > 200_000:
            self.lengths.clear()
        long = self._ends.get(tail, ()) if len(tail) == 3 else ()
        found = self.lengths[tail] = (*sorted((n for n in long if n > 2), reverse=True), *([2] if tail[-2:] in self.ids and len(tail) > 1 else []))
        return found

    def merge(self, text: str) -> list[str]:
        """What byte-pair merging makes of a short text: the best-scored neighbours first, the left ones among equals."""
        return self._merges(text)[-1][1]

    def _merges(self, text: str) -> list[tuple[float, list[str]]]:
        """The states of merging, each with the score of the merge that follows it."""
        own, out = list(text), []
        while True:
            best, at = _NEVER, -1
            for i in range(len(own) - 1):
                score = self.scores.get(own[i] + own[i + 1])
                if score is not None and score > best:
                    best, at = score, i
            out.append((best, list(own)))
            if at < 0:
                return out
            own[at : at + 2] = [own[at] + own[at + 1]]

    def _edges(self, code: int) -> tuple[list, list] | None:
        """While a piece comes to be: (score of the next merge, first part), and the same with the last part; None if merging never makes it."""
        states = self._merges(self.texts[code])
        whole = len(states[-1][1]) == 1
        self.edges[code] = found = ([(s, own[0]) for s, own in states], [(s, own[-1]) for s, own in states]) if whole else None
        return found

    def stays(self, left: int, right: int) -> bool:
        """Whether merging leaves this pair of pieces (codes; -1: no left one) as it is.

        Merges inside either piece run as they would alone until one across the border is due:
        its score beats that of the left piece's next merge and isn't below the right one's.
        """
        edges = self.edges
        if len(self.pairs) > 2 * self.cache_size:
            self.pairs.clear()
        after = edges[right] if right in edges else self._edges(right)
        before = ([], [(_NEVER, "")]) if left < 0 else edges[left] if left in edges else self._edges(left)
        good = before is not None and after is not None
        if good and left >= 0:
            lefts, rights, scores = before[1], after[0], self.scores
            i = j = 0
            while True:
                x, last = lefts[i]
                y, first = rights[j]
                across = scores.get(last + first)
                if across is not None and across > x and across >= y:
                    good = False
                    break
                if x >= y:
                    if x == _NEVER:
                        break
                    i += 1
                else:
                    j += 1
        self.pairs[left * _MAX_CODES + right] = good
        return good

    def _grow(self, text: str, low: int, high: int, base: int, code: list[int], back: list[int]) -> None:
        """Add the nodes of the borders behind ``low`` up to ``high``: the last piece of the path to each, and the border before it.

        ``code`` and ``back`` hold those of the borders from ``base`` on.
        """
        codes, lengths, pairs = self.codes, self.lengths, self.pairs
        for i in range(low + 1, high + 1):
            tail = text[i - 3 if i > 3 else 0 : i]
            for n in lengths[tail] if tail in lengths else self._lengths(tail):
                j = i - n
                if j >= 0:
                    own = codes.get(text[j:i])
                    if own is not None:
                        left = code[j - base]
                        good = pairs.get(left * _MAX_CODES + own)
                        if good or good is None and self.stays(left, own):
                            code.append(own)
                            back.append(j)
                            break
            else:
                # every border has one path; if no longer piece ends it, this one does
                own = codes.get(text[i - 1])
                code.append(self._code(text[i - 1]) if own is None else own)
                back.append(i - 1)

    def _grow_by_score(self, text: str, low: int, high: int, base: int, code: list[int], back: list[int], score: list[float]) -> None:
        """The same where the path with the greatest sum of scores survives; the longer last piece among equals."""
        for i in range(low + 1, high + 1):
            tail = text[i - 3 if i > 3 else 0 : i]
            best = None
            for n in (*(self.lengths[tail] if tail in self.lengths else self._lengths(tail)), 1):
                j = i - n
                if j < 0 or n > 1 and text[j:i] not in self.ids:
                    continue
                total = score[j - base] + self.scores.get(text[j:i], self.unknown_score)
                if best is None or total > best[0]:
                    best = (total, j)
            score.append(best[0])
            code.append(self._code(text[best[1] : i]))
            back.append(best[1])

    def segment(self, text: str) -> Iterator[int]:
        """The codes of the best path, committed as soon as no later character can change them."""
        size, base, done = self.max_piece, 0, 0
        code, back, score = [-1], [-1], [0.0]
        for low in range(0, len(text), size):
            high = min(low + size, len(text))
            if self.bpe:
                self._grow(text, low, high, base, code, back)
            else:
                self._grow_by_score(text, low, high, base, code, back, score)
            live = set(range(max(done, high - size + 1), high + 1)) if high < len(text) else {high}
            while len(live) > 1:
                top = max(live)
                live.remove(top)
                live.add(max(done, back[top - base]))
            border = live.pop()
            path, at = [], border
            while at > done:
                path.append(code[at - base])
                at = back[at - base]
            yield from reversed(path)
            done = border
            del code[: done - base], back[: done - base], score[: done - base]
            base = done

    def _short(self, parts: list[str]) -> None:
        """Encode parts of at most ``max_piece`` characters: the window holds each as a whole.

        They come sorted, and the nodes of the characters that a part shares with the one
        before are kept.
        """
        code, back, score, before, raw = [-1], [-1], [0.0], "", self.raw
        for part in parts:
            n = 0
            for x, y in zip(part, before, strict=False):
                if x != y:
                    break
                n += 1
            before = part
            del code[n + 1 :], back[n + 1 :], score[n + 1 :]
            if self.bpe:
                self._grow(part, n, len(part), 0, code, back)
            else:
                self._grow_by_score(part, n, len(part), 0, code, back, score)
            at, path = len(part), []
            while at > 0:
                path.append(raw[code[at]])
                at = back[at]
            path.reverse()
            self.cache[part] = b"".join(path)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit numbers."""
        if len(self.cache) > self.cache_size:
            self.cache, self.older = {}, self.cache
        cache, older, split = self.cache, self.older, []
        for text in texts:
            text = (SPACE if self.prefix else "") + text.replace(" ", SPACE) if text else ""
            split.append(self.cut.findall(text) if self.cut else [text] if text else [])
        missing = set().union(*split).difference(cache)
        for part in [p for p in missing if p in older]:
            cache[part] = older[part]
            missing.remove(part)
        self._short(sorted(p for p in missing if len(p) <= self.max_piece))
        long = [p for p in missing if len(p) > self.max_piece]
        for part in long:
            cache[part] = b"".join([self.raw[c] for c in self.segment(part)])
        out = [b"".join([cache[p] for p in parts]) for parts in split]
        for part in long:
            if len(part) > 64:
                del cache[part]
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: bytes) -> str:
        """The text of ids; control pieces vanish, broken byte runs become U+FFFD."""
        plain = self.plain
        text = b"".join([plain[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode(errors="replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


def _batches(column: pa.Array, size: int = 1 << 20) -> Iterator[list[str | None]]:
    """The values of a column in lists of about ``size`` characters, or one text."""
    held, n = [], 0
    for low in range(0, len(column), 256):
        for text in column.slice(low, 256).to_pylist():
            if held and n + len(text or "") > size:
                yield held
                held, n = [], 0
            held.append(text)
            n += len(text or "")
    if held:
        yield held


_MODELS: dict[str, Model] = {}


def model(path: str) -> Model:
    """One model for each file and worker process."""
    if path not in _MODELS:
        _MODELS[path] = Model(path)
    return _MODELS[path]


def _picked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def _encoded(batches: Iterable[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    own = model(path)
    for batch in batches:
        at = 0
        for texts in _batches(batch.column(1)):
            found = own.encode_all([x or "" for x in texts])
            ids = pa.array([None if x is None else y for x, y in zip(texts, found, strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), ids], ["doc_id", "ids"])
            at += len(texts)


def _decoded(batches: Iterable[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    own = model(path)
    for batch in batches:
        texts = [None if x is None else own.decode(x) for x in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["doc_id", "ids", "text"])


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (little-endian uint32 bytes): one row per input row; null texts have null ids, empty ones none."""
    return _picked(docs, id_col, text_col).mapInArrow(lambda batches: _encoded(batches, path), "doc_id long, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, ids, text from doc_id and ids; null ids give a null text."""
    return encoded.select("doc_id", "ids").mapInArrow(lambda batches: _decoded(batches, path), "doc_id long, ids binary, text string")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids, text: what ``decode`` makes of ``encode``. Both run in one worker process a task, so a task holds one model and its caches."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _decoded(_encoded(batches, path), path)

    return _picked(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids binary, text string")

"""Personal data: fixed patterns, and a CRF over word shapes that finds what they miss.

The CRF labels the words of a line (runs of other than white space), however long, as one
chain. A line without a digit, ``@``, ``+`` or the letters "dot"
holds nothing to label. The model is trained from ``training_table()``, a small table of
labelled lines made by rule; what it marks must also be plausible for its kind.
"""

from __future__ import annotations

import functools
import heapq
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.llm.crf import LinearChainCRF

KINDS = ("email", "ip", "card", "phone")
BLOCK = 1 << 17

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_HINT = re.compile(r"[0-9@+]")
_POINT = r"\s*(?:\.|\[\.\]|\(\.\)|[\[(]?dot[\])]?)\s*"
_SPELLED_IP = re.compile(rf"[0-9]{{1,3}}(?:{_POINT}[0-9]{{1,3}}){{3}}", re.IGNORECASE)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        if i % 2:
            x = 2 * x - 9 * (x > 4)
        total += x
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, index in KINDS) of the fixed patterns, in order."""
    out = [(s, e, 0) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            out.append((*m.span(), 1))
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 40:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and _luhn(digits):
                out.append((*m.span(), 2))
    for m in _PHONE.finditer(text):
        if 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
            out.append((*m.span(), 3))
    return sorted(out, key=lambda x: (x[0], x[2], x[1]))


# Labels: 0 outside; 1 + 2 * kind begins a span of the kind, 2 + 2 * kind continues it.
N_LABELS = 1 + 2 * len(KINDS)
_LEXICON = {
    "at": 1, "(at)": 1, "[at]": 1, "dot": 2, "(dot)": 2, "[dot]": 2,
    "tel": 3, "tel:": 3, "phone": 3, "phone:": 3, "call": 3, "fax": 3, "fax:": 3, "mobile": 3, "mobile:": 3,
    "card": 4, "card:": 4, "visa": 4, "visa:": 4, "mastercard": 4, "mastercard:": 4,
    "ip": 5, "ip:": 5, "host": 5, "host:": 5, "email": 6, "email:": 6, "mail": 6, "mail:": 6,
    "version": 7, "release": 7, "page": 7, "order": 7, "invoice": 7, "year": 7,
}
_SPELLED = re.compile(r"dot", re.IGNORECASE)
_WORD = re.compile(r"\S+")
_EDGE = ".,;:!?\"'"


def _class(x: str) -> str:
    """A word's shape: letters run together, digits by number up to 4, marks as they are."""
    core = x.strip(_EDGE)
    if not any(c in "0123456789@+()[]-_/=%&*$#|<>" for c in core):
        return "w"
    if len(core) > 80:
        return "long"
    out, last = [], ""
    for c in core:
        kind = "d" if "0" <= c <= "9" else "x" if c.isalpha() else c
        if kind == "x" and last == "x":
            continue
        out.append(kind)
        last = kind
    shape = "".join(out)
    if "[.]" in shape or "(.)" in shape:
        return re.sub("d+", "d", shape)
    if shape.strip("d") == "" and 14 <= len(shape) <= 19:
        return "luhn" if _luhn(core) else "long"
    return re.sub(r"d{2,}", lambda m: f"d{len(m[0])}" if len(m[0]) <= 4 else "d5+", shape)


def word_features(word: str) -> tuple[str, str, str]:
    """Shape, lexicon entry and digit count bucket of one word."""
    n = sum("0" <= c <= "9" for c in word)
    return "s:" + _class(word), f"l:{_LEXICON.get(word.lower(), 0)}", f"n:{min(n, 20) if n else 0}"


class ShapeTagger:
    """The CRF with its feature table; a position sees its own word and both neighbours."""

    def __init__(self) -> None:
        self.index: dict[str, int] = {"?": 0, "^": 1}
        self.crf: LinearChainCRF | None = None
        self._known: dict[str, tuple[int, int, int]] = {}

    def _word(self, word: str) -> tuple[int, int, int]:
        found = self._known.get(word)
        if found is None:
            if len(self._known) > 200_000:
                self._known.clear()
            found = tuple(self.index.get(f, 0) for f in word_features(word))
            if len(word) <= 64:
                self._known[word] = found
        return found

    def _feats(self, units: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Feature rows of all units end to end, and the units' sizes."""
        sizes = np.array([len(u) for u in units], np.int64)
        own = np.array([self._word(w) for u in units for w in u], np.int64).reshape(-1, 3)
        before, after = np.ones_like(own), np.ones_like(own)
        before[1:], after[:-1] = own[:-1], own[1:]
        ends = np.cumsum(sizes)
        before[(ends - sizes)[sizes > 0]] = 1
        after[ends[sizes > 0] - 1] = 1
        n = len(self.index)
        return np.concatenate([own, before + n, after + 2 * n], axis=1), sizes

    def fit(self, table: list[tuple[str, list[tuple[int, int, int]]]]) -> ShapeTagger:
        units, gold = [], []
        for line, spans in table:
            words = list(_WORD.finditer(line))
            y = np.zeros(len(words), np.int64)
            for start, end, kind in spans:
                inside = [i for i, m in enumerate(words) if m.start() < end and m.end() > start]
                y[inside] = 2 + 2 * kind
                y[inside[0]] = 1 + 2 * kind
            units.append([m[0] for m in words])
            gold.append(y)
        for word in sorted({w for u in units for w in u}):
            for f in word_features(word):
                self.index.setdefault(f, len(self.index))
        feats, sizes = self._feats(units)
        self.crf = LinearChainCRF(3 * len(self.index), N_LABELS).fit(list(zip(np.split(feats, np.cumsum(sizes)[:-1]), gold, strict=True)), epochs=150)
        self.crf.w[0, 0] += 1.0  # a shape never seen speaks against a span
        self._known.clear()
        return self

    def spans(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """(start, end, kind) that the CRF finds in each text."""
        units: list[tuple[int, list[re.Match]]] = []
        for i, text in enumerate(texts):
            done = 0
            for hint in _hints(text):
                if hint < done:
                    continue
                start = text.rfind("\n", 0, hint) + 1
                done = text.find("\n", hint)
                done = len(text) if done < 0 else done
                units.append((i, list(_WORD.finditer(text, start, done))))
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for part in _parts(units):
            feats, sizes = self._feats([[m[0] for m in words] for _, words in part])
            labels = self.crf.viterbi(feats, sizes)
            at = 0
            for (i, words), n in zip(part, sizes.tolist(), strict=True):
                own = labels[at : at + n]
                at += n
                if own.any():
                    out[i] += [x for x in _decode(words, own.tolist()) if plausible(texts[i][x[0] : x[1]], x[2])]
        return [sorted(found) for found in out]


def _parts(units: list[tuple[int, list[re.Match]]]) -> Iterator[list[tuple[int, list[re.Match]]]]:
    """Lines of like length together, at most 512 and, but for a single line, ``BLOCK`` words."""
    part, held = [], 0
    for unit in sorted(units, key=lambda unit: len(unit[1])):
        if part and (len(part) == 512 or held + len(unit[1]) > BLOCK):
            yield part
            part, held = [], 0
        part.append(unit)
        held += len(unit[1])
    if part:
        yield part


def _hints(text: str) -> Iterator[int]:
    """Places that make a line worth reading, in order."""
    spelled = [m.start() for m in _SPELLED.finditer(text)] if "dot" in text or "DOT" in text or "Dot" in text else []
    marked = (m.start() for m in _HINT.finditer(text))
    return heapq.merge(spelled, marked) if spelled else marked


def plausible(span: str, kind: int) -> bool:
    """What a span of the kind must hold: card numbers pass Luhn, addresses have four parts, also with spelled or bracketed points, and so on."""
    digits = "".join(c for c in span if "0" <= c <= "9")
    if kind == 0:
        return "@" in span or "dot" in span.lower()
    if kind == 1:
        return bool(_SPELLED_IP.fullmatch(span)) and all(int(p) <= 255 for p in re.findall("[0-9]+", span))
    return 14 <= len(digits) <= 19 and _luhn(digits) if kind == 2 else 10 <= len(digits) <= 15


def _decode(words: list[re.Match], labels: list[int]) -> list[tuple[int, int, int]]:
    out, open_kind = [], None
    for m, label in zip(words, labels, strict=True):
        kind = (label - 1) // 2 if label else None
        start = m.start() + len(m[0]) - len(m[0].lstrip(_EDGE))
        end = max(start, m.start() + len(m[0].rstrip(_EDGE)))
        if kind is not None and label % 2 == 0 and kind == open_kind:
            out[-1] = (out[-1][0], end, kind)
        elif kind is not None:
            out.append((start, end, kind))
        open_kind = kind
    return [x for x in out if x[1] > x[0]]


def training_table() -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Labelled lines: every filler in every frame, with the span's place and kind."""
    fillers = {
        0: ["ann at mail dot com", "j.roe (at) example (dot) org", "kim7@mail1.example.com", "lee [at] post [dot] net", "info@site.org", "bo@x.example.com"],
        1: ["10.20.30.40", "192.168.7.21", "8.8.4.4", "203.0.113.9", "1.2.3.4", "172.16.254.1", "10 dot 20 dot 30 dot 40", "192 dot 168 dot 7 dot 21", "8[.]8[.]4[.]4", "9[.]9[.]10[.]21", "8[.]18[.]114[.]4", "10[.]20[.]30[.]40", "1(.)1(.)1(.)12", "172(.)16(.)254(.)1"],
        2: ["4111 1111 1111 1111", "4111-1111-1111-1111", "4111111111111111", "5500000000000004", "4012888888881881"],
        3: ["+1 (325) 555-8094", "(325) 555-8094", "325-555-8094", "416-555-0192", "+49 30 1234 5678", "+13255558094", "+1 325 555 8094"],
    }
    frames = {
        0: ["write to {} for more", "{} is read daily", "mail: {}", "the list , {} and others", "{}"],
        1: ["host {} is down", "from {} to the gate", "ip: {}", "{} the and of", "{}"],
        2: ["card {} was used", "pay with visa {} now", "the {} of that", "{}"],
        3: ["call {} today", "tel: {}", "the {} and on", "phone {} or write", "{}"],
    }
    table = []
    for kind in fillers:
        for frame in frames[kind]:
            for filler in fillers[kind]:
                at = frame.index("{}")
                table.append((frame.format(filler), [(at, at + len(filler), kind)]))
    plain = [
        "the and of that was in the end", "he was at home and at work", "a dot on the map at noon", "it was 1998 and then 2004", "order 12345 of 17 items", "version 2.0 and 3.1.4",
        "released on 2024-05-17 at 12:30", "page 12 of 250", "under the license, version 2.0.", "token = 3fdf5a35c7b8d733c0b5c7d364eda8ac88d929d1", "the 40,000 people and 3.5 million",
        "in 7-10 days or 24/7", "a | b | c | d", "rare### and*** of%%% the$$$", "2 + 2 = 4", "9913866557355", "9913866557355101", "ref 4981021525375367", "see figure 3-2 and table 4", "prices from 10 to 99 at 5%",
        "meet me at the dot com office", "at the dot", "isbn 978-3-16-148410-0", "1 2 3 4 5 6 7 8 9", "c++ and c#", "id 20231105 20231106", "x1 y2 z3 a4b5", "@ home", "+ more", "the @ sign",
    ]
    for line in plain:
        table += [(line, []), ("and then " + line + " of the", [])]
    return table


@functools.lru_cache(maxsize=1)
def default_tagger() -> ShapeTagger:
    return ShapeTagger().fit(training_table())


def find(texts: list[str], tagger: ShapeTagger | None = None) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text. A CRF span that touches a base span is dropped."""
    tagger = tagger or default_tagger()
    out = []
    for text, extra in zip(texts, tagger.spans(texts), strict=True):
        base = base_spans(text) if _HINT.search(text) else []
        added = [x for x in extra if not any(x[0] < e and s < x[1] for s, e, _ in base)] if extra else []
        out.append((base, sorted({*base, *added}, key=lambda x: (x[0], x[2], x[1]))))
    return out


SPAN = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mask: bool = False) -> DataFrame:
    """doc_id, base (array of kind, start, end) and spans (the same, with the CRF's); with ``mask`` also masked.

    Offsets are code points, ends exclusive. masked: the text with each span replaced by its
    kind in capitals and brackets; spans that overlap become one, of the first's kind; null
    stays null. A null or empty text has empty arrays. One row per input row; other columns
    are ignored.
    """
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("base", SPAN), T.StructField("spans", SPAN), *([T.StructField("masked", T.StringType())] if mask else [])])
    tagger = default_tagger()

    def named(spans: list) -> list[dict]:
        return [{"kind": KINDS[k], "start": s, "end": e} for s, e, k in spans]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for whole in batches:
            for low in range(0, whole.num_rows, 500):
                batch = whole.slice(low, 500)
                texts = batch.column(1).to_pylist()
                found = find([x or "" for x in texts], tagger)
                columns = [batch.column(0), pa.array([named(b) for b, _ in found], item), pa.array([named(a) for _, a in found], item)]
                if mask:
                    columns.append(pa.array([None if t is None else masked(t, a) for t, (_, a) in zip(texts, found, strict=True)], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, schema)


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    out, done, last = [], 0, -1
    for start, end, kind in sorted(spans):
        if start < last:
            last = max(last, end)
            done = last
            continue
        out += [text[done:start], f"[{KINDS[kind].upper()}]"]
        done = last = end
    return "".join([*out, text[done:]])


def mask_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with the personal data of text masked: all columns and rows, n_chars (if there) counted anew."""
    tagger = default_tagger()
    schema = docs.schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            at = whole.schema.get_field_index("text")
            for low in range(0, whole.num_rows, 500):
                batch = whole.slice(low, 500)
                texts = batch.column(at).to_pylist()
                found = find([x or "" for x in texts], tagger)
                new = pa.array([None if t is None else masked(t, a) for t, (_, a) in zip(texts, found, strict=True)], pa.string())
                yield batch.set_column(at, batch.schema.field(at).name, new)

    out = docs.mapInArrow(run, schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(schema["n_chars"].dataType))
    return out

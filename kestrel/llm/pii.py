"""Operator 2: personal data by fixed patterns and a word-shape random field.

Base spans come from four patterns with checks.  A linear-chain conditional
random field over the shapes of words, trained from a small labelled table,
adds spans: access keys and tokens, and base kinds that no pattern caught.  It
reads sequences of words (a line or sentence, whole) and is decoded by Viterbi over all sequences of a batch at once.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .crf import Chain, train
from .pii_labels import SENTENCES
from .tables import source
from .words import Words, chunks, hash_spans, split_words, text_bytes

KINDS = ["email", "ip", "card", "phone", "key"]
TAGS = ["other", *KINDS]
# fixed values: the patterns of the base kinds
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _is_ip(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in s.split("."))


def _is_card(s: str) -> bool:
    d = _NOT_DIGIT.sub("", s)
    return 13 <= len(d) <= 19 and luhn(d)


def _is_phone(s: str) -> bool:
    return 9 <= len(_NOT_DIGIT.sub("", s)) <= 15


def base_spans(text: str) -> list[list[tuple[int, int]]]:
    """Spans of the four base kinds, in order of kind and start."""
    out: list[list[tuple[int, int]]] = [[], [], [], []]
    if "@" in text:
        out[0] = [m.span() for m in EMAIL.finditer(text)]
    out[1] = [m.span() for m in IP.finditer(text) if _is_ip(m.group())]
    out[2] = [m.span() for m in CARD.finditer(text) if _is_card(m.group())]
    if "+" in text:
        out[3] = [m.span() for m in PHONE.finditer(text) if _is_phone(m.group())]
    return out


_CLASS = np.full(256, 7, np.uint8)
for _i, _chars in enumerate(["ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", "@", ".",
                             "-_/", "+()"]):
    _CLASS[[ord(c) for c in _chars]] = _i
_BIT = (1 << _CLASS.astype(np.int64)).astype(np.uint8)
_DIGIT = _CLASS == 2
_HEX = np.zeros(256, bool)
_HEX[[ord(c) for c in "0123456789abcdef"]] = True
_TRIGGERS = ["token", "key", "secret", "password", "api_key", "=", "api_key:", "token:", "secret:", "phone:", "call"]
_END = np.zeros(256, bool)
_END[[ord(c) for c in ".!?"]] = True
SIZES = [256, 9, 9, 6, 8, 8, 257, 257, len(_TRIGGERS) + 1, 2]


def _trigger_hashes() -> np.ndarray:
    buf, offset = text_bytes(pa.array(_TRIGGERS))
    return hash_spans(buf, offset[:-1], offset[1:])


class Shapes:
    """Shape features of words and the sequences they form."""

    def __init__(self, w: Words) -> None:
        buf, s, e = w.buf, w.start, w.end
        n = len(s)
        cuts = np.ravel(np.column_stack((s, e)))
        if n and cuts[-1] == len(buf):
            cuts = cuts[:-1]
        mask = np.bitwise_or.reduceat(_BIT[buf], cuts)[::2].astype(np.int64) if n else np.zeros(0, np.int64)

        def count(of: np.ndarray) -> np.ndarray:
            total = np.concatenate(([0], np.cumsum(of[buf], dtype=np.int64)))
            return total[e] - total[s]

        length = e - s
        digits = count(_DIGIT)
        new = np.ones(n, bool)
        if n:
            newline = np.concatenate(([0], np.cumsum(buf == 10)))
            new[1:] = (w.row[1:] != w.row[:-1]) | (newline[s[1:]] != newline[e[:-1]]) | _END[buf[e[:-1] - 1]]
        start = np.flatnonzero(new)
        self.bound = np.append(start, n)
        before, after = np.full(n, 256), np.full(n, 256)
        before[1:], after[:-1] = mask[:-1], mask[1:]
        before[start], after[self.bound[1:] - 1] = 256, 256
        trigger = np.zeros(n, np.int64)
        if n:
            prior = np.zeros(n, np.uint64)
            prior[1:] = w.hashes()[:-1]
            prior[start] = 0
            for i, h in enumerate(_trigger_hashes()):
                trigger[prior == h] = i + 1
        self.features = [mask, np.searchsorted([1, 2, 4, 6, 9, 13, 16, 20], digits, "right"),
                         np.searchsorted([2, 4, 7, 11, 16, 20, 26, 36], length, "right"),
                         np.minimum(count(_CLASS == 4), 5), _CLASS[buf[s]].astype(np.int64),
                         _CLASS[buf[e - 1]].astype(np.int64), before, after, trigger,
                         ((count(_HEX) >= 32) & (count(_HEX) >= length - 3)).astype(np.int64)]
        self.digits, self.length = digits, length


def shape_model() -> Chain:
    """The chain fitted to the labelled sentences."""
    texts, gold = [], []
    for line in SENTENCES:
        plain, tags = [], []
        for part in re.split(r"(\{\w+:[^}]*\})", line):
            m = re.fullmatch(r"\{(\w+):([^}]*)\}", part)
            kind, inner = (m[1], m[2]) if m else ("other", part)
            plain.append(inner)
            tags += [kind] * len(inner.split())
        texts.append("".join(plain))
        gold += [TAGS.index(t) for t in tags]
    w = split_words(*text_bytes(pa.array(texts)))
    shapes = Shapes(w)
    return train(shapes.features, SIZES, shapes.bound, np.array(gold), TAGS, rounds=120)


# what a decoded run of words must be to count: digits, length, and shape bits that it needs
_NEED = {"email": (0, 6, 1 << 3), "ip": (4, 7, 1 << 4), "card": (13, 13, 1 << 2), "phone": (9, 10, 1 << 2),
         "key": (1, 16, 1 << 2)}
_ONE_WORD = ("email", "ip", "key")          # neighbours of these kinds are words of their own
_TRIM = b"\"'`.,;:!?()[]{}<>*#&%$|"


def model_spans(w: Words, shapes: Shapes, tag: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(row, kind, first byte, end byte) of the decoded runs that hold up."""
    hit = np.flatnonzero(tag)
    if not len(hit):
        return
    seq = np.searchsorted(shapes.bound, hit, "right")
    card = tag == TAGS.index("card")

    def whole(a: int, z: int) -> bool:
        return _is_card(w.buf[w.start[a]:w.end[z]].tobytes().strip(_TRIM).decode())

    cut = np.flatnonzero((np.diff(hit) > 1) | (np.diff(seq) > 0) | (tag[hit[1:]] != tag[hit[:-1]])) + 1
    runs = []
    for a, z in zip(hit[np.append(0, cut)], hit[np.append(cut, len(hit)) - 1]):
        if card[a] and not whole(a, z):     # a row of numbers: those that are cards by themselves
            runs += [(i, i) for i in range(a, z + 1) if whole(i, i)]
        elif TAGS[tag[a]] in _ONE_WORD:
            runs += [(i, i) for i in range(a, z + 1)]
        else:
            runs.append((a, z))
    for a, z in runs:
        kind = TAGS[tag[a]]
        digits, length, bits = _NEED[kind]
        lo, hi = int(w.start[a]), int(w.end[z])
        raw = w.buf[lo:hi].tobytes()
        lo += len(raw) - len(raw.lstrip(_TRIM))
        raw = raw.strip(_TRIM)
        if (shapes.digits[a:z + 1].sum() >= digits and len(raw) >= length
                and np.bitwise_or.reduce(shapes.features[0][a:z + 1]) & bits):
            yield int(w.row[a]), KINDS.index(kind), lo, lo + len(raw)


def found(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id`` and ``spans``, an array of (``kind``, ``first``,
    ``end``, ``base``) in code points, ordered by kind as in ``KINDS``, then
    start; ``base`` marks those of the fixed patterns.

    Null and empty texts have no spans.  A model span that overlaps a base span
    is dropped.  Repeated rows come out as often as they went in, a null id stays
    null, an empty table gives no rows, other columns are not looked at."""
    model = shape_model()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind_type = pa.list_(pa.struct([("kind", pa.string()), ("first", pa.int64()), ("end", pa.int64()),
                                        ("base", pa.bool_())]))
        for b in batches:
            for lo, hi, buf, offset in chunks(b.column(1)):
                w = split_words(buf, offset)
                shapes = Shapes(w)
                more: dict[int, list] = {}
                if len(w.start):
                    for r, kind, s, e in model_spans(w, shapes, model.decode(shapes.features, shapes.bound)):
                        more.setdefault(r, []).append((kind, s - int(offset[r]), e - int(offset[r])))
                digits = np.concatenate(([0], np.cumsum(_DIGIT[buf], dtype=np.int64)))
                signs = np.concatenate(([0], np.cumsum(buf == 64, dtype=np.int64)))
                look = (digits[offset[1:]] > digits[offset[:-1]]) | (signs[offset[1:]] > signs[offset[:-1]])
                out: list[list[dict]] = [[] for _ in range(hi - lo)]
                for r in np.union1d(np.flatnonzero(look), np.array(sorted(more), np.int64)).astype(int):
                    raw = buf[offset[r]:offset[r + 1]]
                    spans = [(k, s, e, True) for k, x in enumerate(base_spans(raw.tobytes().decode())) for s, e in x]
                    if r in more:
                        point = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
                        for k, s, e in more[r]:
                            s, e = int(point[s]), int(point[e])
                            if not any(s < y and x < e for _, x, y, _ in spans):
                                spans.append((k, s, e, False))
                    out[r] = [{"kind": KINDS[k], "first": s, "end": e, "base": x} for k, s, e, x in sorted(spans)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(out, kind_type)],
                                                 ["doc_id", "spans"])

    src = source(docs, id_col, text_col)
    return src.mapInArrow(run, "doc_id long, spans array<struct<kind:string,first:long,end:long,base:boolean>>")


def digest(spans: DataFrame) -> DataFrame:
    """Counts per base kind, the digest of the base spans, and all spans as text."""
    base = F.filter("spans", lambda s: s["base"])

    def text(col):
        return F.array_join(F.transform(col, lambda s: F.concat_ws(":", s["kind"], s["first"], s["end"])), ",")

    counts = [F.expr(f"cast(size(filter(spans, s -> s.base and s.kind = '{k}')) as long)").alias(f"n_{k}")
              for k in KINDS[:4]]
    return spans.select("doc_id", *counts, F.sha2(text(base), 256).alias("base_sha256"),
                        text(F.col("spans")).alias("spans"))

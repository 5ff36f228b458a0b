"""Operator 3: sum-of-squares online packing of tokenised documents.

Every task packs its own input partition in one pass, so nothing is shuffled.
Whole windows are cut off a long document; what is left of it (less than a
window) goes, online, to the fill level that minimises the sum over levels of
the squared number of partly filled windows.  The only state is a level array
of counts and the pieces of the open windows.  Documents may be cut anywhere, so
when the input ends the fullest open windows, as the rule filled them, are topped
up with the pieces of the emptiest ones, and the last rest goes into windows whose
lengths are powers of two, which need no padding.  Where ``max_open`` windows are
open at once, the fullest quarter is closed in that way and the others stay.  So
padding is zero, memory is bounded, and nothing is dropped.
"""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import source, tidy
from .words import mix, powers

CACHE_BYTES = 40 << 20     # of a worker's arrays of words; besides, the words of one group of texts
_ENTRY = 24                # bytes of a word in those arrays, besides its ids
_RARE_BYTES = 8 << 20      # of the chunks of texts that are split in Python
_GROUP = 1 << 20           # characters split at once, or one longer text
_ODD = re.compile("[\x1c-\x1f\x01]")      # white space to Python only, and the border below
_PLAIN = re.compile("[^\x01\x1c-\x1f\u0130-\U0010ffff]*\\Z")
_BORDER = "\x01"

# Kinds of the characters below U+0130, as the splitting pattern of the tokenizer has them:
# 0 white space, 1 letters, 2 numbers (each by itself), 3 the others.
_KIND = np.array([{"L": 1, "N": 2}.get(unicodedata.category(chr(c))[0], 3) for c in range(0x130)], np.uint8)
_KIND[[9, 10, 11, 12, 13, 32, 0x85, 0xA0]] = 0
_VALUE = mix(np.arange(1, 0x131, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_CHECK = mix(_VALUE + np.uint64(0x2545F4914F6CDD1D))


def _split(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a text in lower case, given by its code
    points below U+0130: runs of letters, single numbers, runs of others, and the
    short forms 's 't 'm 'd 're 've 'll, whose mark begins a word."""
    kind = np.zeros(len(code) + 2, np.uint8)
    kind[1:-1] = _KIND[code]
    new = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    begin, end = new[:-1] & (kind[1:-1] != 0), (new[1:] | (kind[1:-1] == 2)) & (kind[1:-1] != 0)
    mark = np.flatnonzero((code == 39) & begin & end)
    if len(mark):
        after = np.zeros((2, len(mark)), code.dtype)
        for k in (0, 1):
            inside = mark + 1 + k < len(code)
            after[k, inside] = code[mark[inside] + 1 + k]
        one = np.isin(after[0], [ord(c) for c in "stmd"])
        two = np.zeros(len(mark), bool)
        for x, y in ("re", "ve", "ll"):
            two |= (after[0] == ord(x)) & (after[1] == ord(y))
        mark, size = mark[one | two], np.where(one, 1, 2)[one | two]
        end[mark] = False
        begin[mark + 1] = False
        last = mark + size
        more = np.flatnonzero(~end[last])           # letters behind a short form are a word of their own
        begin[last[more] + 1] = True
        end[last] = True
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


class WordCacheEncoder:
    """Token ids of texts as little-endian uint32 bytes.

    The tokenizer splits a text into words and encodes each by itself.  Texts below
    U+0130 are put in lower case and split in numpy as it would do (there this
    changes no character count, and nothing is composed); each distinct word is
    encoded once by the tokenizer, in bulk, and its ids stay in arrays, found by a
    64-bit fingerprint and a second one that must agree.  When the arrays are full,
    the words that came first stay, up to half of the bytes.

    Other texts are cut at white space and their distinct chunks are encoded, told
    apart by a border character; Python's ``split`` also cuts at U+001C-U+001F, which
    the tokenizer does not: texts with those characters, with the border or with the
    name of a special token are encoded whole.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        self.plain = Tokenizer(self.tokenizer.model)         # the same model, not a copy
        self.plain.pre_tokenizer = self.tokenizer.pre_tokenizer
        self.letters = Tokenizer(self.tokenizer.model)
        self.letters.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.special = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.border, = self.tokenizer.encode(_BORDER, add_special_tokens=False).ids
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
        self.rare: dict[str, bytes] = {}
        self.rare_held = 0
        self._clear()

    def _clear(self) -> None:
        self.key, self.check = np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        self.at, self.size = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.uint32)

    def _add(self, out: dict[str, bytes], words: list[str], tokenizer, between: str, cut) -> None:
        """Encode chunks in texts of 64; ``cut`` gives, of a text's ids, where
        each chunk ends and where the next begins."""
        groups = [words[i:i + 64] for i in range(0, len(words), 64)]
        texts = [between.join(g) + between for g in groups]
        if tokenizer is not self.tokenizer:
            texts = [t.lower() for t in texts]
        for group, e in zip(groups, tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(e.ids, "<u4")
            ends, nexts = cut(ids)
            if len(ends) != len(group):
                raise ValueError("the tokenizer doesn't cut chunks as expected")
            raw, a = ids.tobytes(), 0
            for word, z, b in zip(group, (4 * ends).tolist(), (4 * nexts).tolist()):
                out[word] = raw[a:z]
                a = b

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        letters, plain, others = [], [], []
        for w in words:
            (others if not w.isascii() and max(w) >= "\u0130" else letters if w.isalpha() else plain).append(w)

        def at_last(ids):
            z = np.flatnonzero(self.last[ids]) + 1
            return z, z

        def at_border(ids):
            z = np.flatnonzero(ids == self.border)
            return z, z + 1

        out: dict[str, bytes] = {}
        self._add(out, letters, self.letters, " ", at_last)
        self._add(out, plain, self.plain, f" {_BORDER} ", at_border)
        self._add(out, others, self.tokenizer, f" {_BORDER} ", at_border)
        return out

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def shrink(self) -> None:
        """Frequent words come early: the first ones stay, up to half of the bytes."""
        if len(self.key) * _ENTRY + 4 * len(self.ids) <= CACHE_BYTES:
            return
        order = np.argsort(self.at, kind="stable")
        held = np.cumsum(_ENTRY + 4 * self.size[order].astype(np.int64))
        first = order[:int(np.searchsorted(held, CACHE_BYTES // 2))]
        first.sort()
        self.key, self.check, self.at, self.size = self.key[first], self.check[first], self.at[first], self.size[first]
        self.ids = self.ids[:int((self.at + self.size).max(initial=0))].copy()

    def _group(self, texts: list[str]) -> list[bytes]:
        """Ids of texts in lower case, all below U+0130."""
        joined = "\n".join(texts)
        code = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        start, end = _split(code)
        up, down = powers(len(code) + 1)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_VALUE[code] * up[:-1])))
        key = mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_CHECK[code])))
        check = ((total[end] - total[start]) >> np.uint64(32)).astype(np.uint32)
        words, first, inverse = np.unique(key, return_index=True, return_inverse=True)
        if (check != check[first][inverse]).any():           # two words of one fingerprint: one by one
            return [self._whole(t) for t in texts]
        at = np.searchsorted(self.key, words)
        known = np.zeros(len(words), bool)
        inside = np.flatnonzero(at < len(self.key))
        known[inside] = (self.key[at[inside]] == words[inside]) & (self.check[at[inside]] == check[first[inside]])
        begin, size = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        begin[known], size[known] = self.at[at[known]], self.size[at[known]]
        fresh = np.flatnonzero(~known)
        ids = self.ids
        if len(fresh):
            spelled = [joined[a:z] for a, z in zip(start[first[fresh]].tolist(), end[first[fresh]].tolist())]
            learnt = self._learn(spelled)
            raw = [learnt[w] for w in spelled]
            size[fresh] = [len(x) // 4 for x in raw]
            begin[fresh] = len(ids) + np.cumsum(size[fresh]) - size[fresh]
            ids = self.ids = np.concatenate((ids, np.frombuffer(b"".join(raw), "<u4")))
            place = at[fresh]
            taken, inside = np.zeros(len(fresh), bool), np.flatnonzero(place < len(self.key))
            taken[inside] = self.key[place[inside]] == words[fresh[inside]]     # by another word: not kept
            fresh, place = fresh[~taken], place[~taken]
            for name, x in (("key", words), ("check", check[first]), ("at", begin), ("size", size)):
                held = getattr(self, name)
                setattr(self, name, np.insert(held, place, x[fresh].astype(held.dtype)))
        size, begin = size[inverse], begin[inverse]
        ends = np.concatenate(([0], np.cumsum(size)))
        flat = ids[np.arange(int(ends[-1])) + np.repeat(begin - ends[:-1], size)]
        lengths = np.array([len(t) + 1 for t in texts])
        border = ends[np.searchsorted(start, np.concatenate(([0], np.cumsum(lengths))))].tolist()
        return [flat[a:z].tobytes() for a, z in zip(border[:-1], border[1:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        plain, split = [], []
        for i, t in enumerate(texts):
            low = t.lower()
            if any(s in low for s in self.special):
                out[i] = self._whole(t)
            elif _PLAIN.match(t):
                plain.append((i, low))
            elif _ODD.search(t):
                out[i] = self._whole(t)
            else:
                split.append((i, t.split()))
        lo = size = 0
        for n, (_, low) in enumerate(plain + [(0, "")]):
            if n == len(plain) or size and size + len(low) > _GROUP:
                self.shrink()
                if n > lo:
                    for (i, _), raw in zip(plain[lo:n], self._group([t for _, t in plain[lo:n]])):
                        out[i] = raw
                lo, size = n, 0
            size += len(low)
        missing = set().union(*(p for _, p in split)).difference(self.rare)
        if self.rare_held > _RARE_BYTES:
            self.rare, self.rare_held = {}, 0
            missing = set().union(*(p for _, p in split))
        learnt = self._learn(list(missing))
        self.rare.update(learnt)
        self.rare_held += sum(190 + len(w) + len(x) for w, x in learnt.items())
        for i, p in split:
            out[i] = b"".join(map(self.rare.__getitem__, p))
        return out


_ENCODERS: dict[str, WordCacheEncoder] = {}


def encoder_of(path: str) -> WordCacheEncoder:
    """One encoder for all tasks of a worker; between them it keeps the short words."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordCacheEncoder(path)
    return _ENCODERS[path]


class LevelArray:
    """Open windows by fill level, with the sum-of-squares choice of a level."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.windows: dict[int, list[list]] = {}
        self.open = 0
        # change of the sum of squares when a window arrives at, or leaves, a level
        self.arrive = np.ones(capacity + 1)
        self.arrive[capacity] = 0
        self.leave = np.full(capacity + 1, -np.inf)
        self.leave[0] = 0

    def _count(self, level: int) -> None:
        n = len(self.windows.get(level, ()))
        self.arrive[level] = 2 * n + 1
        self.leave[level] = 2 * n - 1 if n else -np.inf

    def place(self, piece: tuple, size: int) -> list | None:
        """Put a piece of ``size`` tokens away; return its window if now full.
        Among equal changes the fullest window is taken."""
        room = self.capacity - size
        change = self.arrive[size:] - self.leave[:room + 1]
        level = room - int(np.argmin(change[::-1]))
        if level:
            window = self.windows[level].pop()
            self._count(level)
            self.open -= 1
        else:
            window = []
        window.append(piece)
        level += size
        if level == self.capacity:
            return window
        self.windows.setdefault(level, []).append(window)
        self._count(level)
        self.open += 1
        return None

    def close(self, most: int | None = None) -> Iterator[list[tuple]]:
        """Take the fullest windows (at most ``most`` of them, or all), topped up
        with the pieces of the emptiest ones; of all, the rest follows in windows
        of powers of two.  Other windows stay open."""
        order = [w for level in sorted(self.windows, reverse=True) for w in self.windows[level]]
        self.__init__(self.capacity)
        spare: list[tuple] = []
        first, last = 0, len(order) - 1
        while first <= last and (most is None or first < most):
            window = order[first]
            room = self.capacity - _length(window)
            while room and (spare or last > first):
                if not spare:
                    spare = order[last]
                    last -= 1
                doc, start, ids, total = spare.pop()
                n = min(room, len(ids) // 4)
                window.append((doc, start, ids[:4 * n], total))
                if 4 * n < len(ids):
                    spare.append((doc, start + n, ids[4 * n:], total))
                room -= n
            if room:                                     # the last window: no pieces are left for it
                break
            yield window
            first += 1
        if most is None:
            yield from _cut([p for w in order[first:last + 1] for p in w] + spare, self.capacity)
            return
        for window in [*order[first:last + 1], spare]:
            if window:
                level = _length(window)
                self.windows.setdefault(level, []).append(window)
                self._count(level)
                self.open += 1


def _length(window: list[tuple]) -> int:
    return sum(len(p[2]) // 4 for p in window)


def _cut(pieces: list[tuple], capacity: int) -> Iterator[list[tuple]]:
    """Pieces (id, start, ids, tokens of the document) poured into windows of
    ``capacity``, the rest into windows of powers of two."""
    left = sum(len(p[2]) // 4 for p in pieces)
    stack = pieces[::-1]
    while left:
        want = capacity if left >= capacity else 1 << (left.bit_length() - 1)
        left -= want
        window = []
        while want:
            doc, start, ids, total = stack.pop()
            n = min(want, len(ids) // 4)
            window.append((doc, start, ids[:4 * n], total))
            if 4 * n < len(ids):
                stack.append((doc, start + n, ids[4 * n:], total))
            want -= n
        yield window


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 1,
         id_col: str = "doc_id", text_col: str = "text", max_open: int = 4096) -> DataFrame:
    """Pieces of all documents in windows of at most ``capacity`` tokens:
    ``doc_id``, ``start`` (tokens of the document before the piece), ``length``,
    ``doc_tokens``, ``sequence_id``, ``offset`` (place in the window) and
    ``ids`` (little-endian uint32).

    A document is its token ids followed by ``end_id``; null and empty texts
    are just ``end_id``.  Repeated rows are packed as often as they occur, a
    null id stays null, an empty table gives no rows, and other columns are not
    looked at.  ``sequence_id`` holds the task's partition in its high bits."""

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, levels = encoder_of(tokenizer_path), LevelArray(capacity)
        end = np.array([end_id], "<u4").tobytes()
        base = TaskContext.get().partitionId() << 40
        done: list[list[tuple]] = []
        made = waiting = 0

        def rows() -> pa.RecordBatch:
            nonlocal made, done, waiting
            cols: list[list] = [[] for _ in range(7)]
            for window in done:
                at = 0
                for doc, start, ids, total in window:
                    n = len(ids) // 4
                    for c, x in zip(cols, (doc, start, n, total, base + made, at, ids)):
                        c.append(x)
                    at += n
                made += 1
            done, waiting = [], 0
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in cols[:6]] + [pa.array(cols[6], pa.binary())],
                ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                texts = [t or "" for t in part.column(1).to_pylist()]
                for doc, ids in zip(part.column(0).to_pylist(), encoder.encode(texts)):
                    ids += end
                    total = len(ids) // 4
                    whole = total - total % capacity
                    for start in range(0, whole, capacity):
                        done.append([(doc, start, ids[4 * start:4 * (start + capacity)], total)])
                    if whole < total:
                        full = levels.place((doc, whole, ids[4 * whole:], total), total - whole)
                        if full:
                            done.append(full)
                    if levels.open >= max_open:
                        done += levels.close(max_open // 4)
                    if len(done) >= 256:
                        yield rows()
        done += levels.close()
        if done:
            yield rows()

    src = source(docs, id_col, text_col)
    return src.mapInArrow(run, "doc_id long, start long, length long, doc_tokens long, sequence_id long, "
                               "offset long, ids binary")


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")

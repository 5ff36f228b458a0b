"""Operator 12: SentencePiece encoding and decoding with merge-type vocabularies.

A chunk of text begins as single characters.  An agenda (a heap) holds the pairs
of neighbouring symbols that are a piece together, best score first and then
leftmost; the best pair is merged, its two new neighbours enter the agenda, and
entries whose symbols have changed since are skipped.  Characters without a piece
become their UTF-8 bytes.

Between two characters that stand next to each other in no piece, no merge can
ever reach over, so texts are cut there first (at spaces, around most marks, line
ends and digits).  Equal chunks are encoded once and kept in a cache of bounded
bytes; new ones are merged many at a time, a round of the agenda in numpy for all
of them, and long ones by a heap.  Every chunk that enters the cache is checked, a
batch at a time, against the sentencepiece library.

Decoding looks the bytes of all ids of a batch up in one table.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"                 # the symbol that stands for a space
CACHE_BYTES = 96 << 20           # of one worker, with what Python adds to each entry; besides, one batch's chunks
_ENTRY = 230                     # bytes of an entry besides its letters and ids
_TEXTS = 1 << 20                 # characters encoded at once, or one longer text
_SHORT = 32                      # characters of chunks that are merged many at once,
_AT_ONCE = 1 << 16               # so many
_LETTERS = 8192                  # characters in pieces of several; their table has a byte a pair
_NONE = 1 << 30                  # the order of a pair that makes no piece
_PROBES = ["a", " a", "a  b ", "Ångström ﬁ 　x", "Á ①\t.", "▁x"]


def _each_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("kestrel-each-byte", _each_byte)


class Vocabulary:
    """Encoder and decoder of one model file; ``end`` is appended to the ids."""

    def __init__(self, path: str, cache_bytes: int = CACHE_BYTES) -> None:
        from sentencepiece import SentencePieceProcessor
        self.library = lib = SentencePieceProcessor(model_file=path)
        ids = range(lib.get_piece_size())
        pieces = lib.id_to_piece(list(ids))
        scores = lib.get_score(list(ids))
        self.end = lib.eos_id()
        plain = [i for i in ids if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i))]
        self.unknown = lib.unk_id()
        self.ids = {pieces[i]: i for i in plain}
        self.cost = {pieces[i]: -scores[i] for i in plain if len(pieces[i]) > 1}
        self.byte_id = np.full(256, self.unknown)
        surface = [b""] * len(ids)
        for i in ids:
            if lib.is_byte(i):
                value = int(pieces[i][3:5], 16)          # <0x41>
                self.byte_id[value] = i
                surface[i] = bytes([value])
            elif lib.is_unknown(i):
                surface[i] = lib.decode([i]).encode()
            elif not lib.is_control(i):
                surface[i] = pieces[i].replace(SPACE, " ").encode()
        self.bytes_known = all(lib.is_byte(int(i)) for i in self.byte_id)
        self.control = np.array([lib.is_control(i) for i in ids])
        self.leading = np.array([p.startswith(SPACE) for p in pieces]) & np.isin(np.arange(len(ids)), plain)
        self.surface = _Pool(surface)
        self.decimal = _Pool([b" %d" % i for i in ids])
        self.size = len(pieces)
        letters = {ord(p): i for p, i in self.ids.items() if len(p) == 1}
        self.letters = np.array(sorted(letters), np.int64)
        self.letter_id = np.array([letters[c] for c in self.letters.tolist()], np.int64)
        by_cost = sorted(self.cost, key=self.cost.get)
        self.merged_id = np.array([self.ids[p] for p in by_cost], np.int64)
        pairs = {self.ids[p[:k]] * self.size + self.ids[p[k:]]: rank for rank, p in enumerate(by_cost)
                 for k in range(1, len(p)) if p[:k] in self.ids and p[k:] in self.ids}
        self.pairs = np.array(sorted(pairs), np.int64)
        self.pair_rank = np.array([pairs[x] for x in self.pairs.tolist()], np.int64)
        costs = np.array([self.cost[x] for x in by_cost])       # pieces of one score are of one order
        self.order = np.append(np.cumsum(np.append(0, np.diff(costs) > 0)), _NONE).astype(np.int64)
        joined = sorted(set("".join(self.cost)))
        if len(joined) > _LETTERS:
            raise ValueError(f"more than {_LETTERS} characters join with others")
        self.apart = next(c for c in "\n\t\x00\x01" if c not in joined)
        self.kind = np.zeros(0x110000, np.uint16)              # of a character: 0 if it joins with none
        self.kind[[ord(c) for c in joined]] = np.arange(1, len(joined) + 1)
        self.joins = np.zeros((len(joined) + 1, len(joined) + 1), bool)
        number = {c: i for i, c in enumerate(joined, 1)}
        for p in self.cost:
            for x, y in zip(p, p[1:]):
                self.joins[number[x], number[y]] = True
        self.cache: dict[str, bytes] = {}
        self.held, self.limit = 0, cache_bytes
        self.apart_ids = np.array(lib.encode(self.apart), "<u4").tobytes()
        for text in _PROBES:
            if b"".join(self.ids_of(self._chunks(text))) != np.array(lib.encode(text), "<u4").tobytes():
                raise ValueError("the model changes texts in other ways than by its space symbol")

    # ------------------------------------------------------------- encoding

    def _chunks(self, text: str) -> list[str]:
        """A text with its space symbols, cut between characters that stand next
        to each other in no piece, so no merge can reach over a cut."""
        if not text:
            return []
        text = SPACE + text.replace(" ", SPACE)
        kind = self.kind[np.frombuffer(text.encode("utf-32-le"), "<u4")]
        cuts = (np.flatnonzero(~self.joins[kind[:-1], kind[1:]]) + 1).tolist()
        return [text[a:z] for a, z in zip([0, *cuts], [*cuts, len(text)])]

    def merged(self, chunk: str) -> list[str]:
        """The symbols of a chunk after all merges, by the agenda."""
        cost = self.cost
        symbols: list[str | None] = list(chunk)
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = [(cost[pair], i, i + 1, pair) for i in range(n - 1) if (pair := chunk[i:i + 2]) in cost]
        heapq.heapify(agenda)
        while agenda:
            _, left, right, pair = heapq.heappop(agenda)
            a, b = symbols[left], symbols[right]
            if a is None or b is None or after[left] != right or len(a) + len(b) != len(pair):
                continue
            symbols[left], symbols[right] = pair, None
            after[left] = behind = after[right]
            if behind < n:
                before[behind] = left
                if (new := pair + symbols[behind]) in cost:
                    heapq.heappush(agenda, (cost[new], left, behind, new))
            if (ahead := before[left]) >= 0 and (new := symbols[ahead] + pair) in cost:
                heapq.heappush(agenda, (cost[new], ahead, left, new))
        return [s for s in symbols if s is not None]

    def _ids(self, symbols: list[str]) -> list[int]:
        out: list[int] = []
        for piece in symbols:
            i = self.ids.get(piece)
            if i is not None:
                out.append(i)
            elif self.bytes_known:
                out += self.byte_id[list(piece.encode())].tolist()
            else:
                out.append(self.unknown)
        return out

    def _many(self, chunks: list[str]) -> list[bytes]:
        """Ids of many short chunks at once: a round of the agenda merges the best
        pair of every chunk that still has one, in numpy."""
        symbol = np.frombuffer("".join(chunks).encode("utf-32-le"), "<u4").astype(np.int64)
        places = np.searchsorted(self.letters, symbol)
        known = self.letters[np.minimum(places, len(self.letters) - 1)] == symbol
        # characters without a piece get numbers behind all ids, by their code point
        symbol = np.where(known, self.letter_id[np.minimum(places, len(self.letters) - 1)], self.size + symbol)
        chunk = np.repeat(np.arange(len(chunks)), [len(c) for c in chunks])
        place = np.arange(len(symbol))                     # among all symbols, to put them in order at the end
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        rank = np.append(self._ranks(symbol[:-1], symbol[1:], chunk[:-1] == chunk[1:]), -1)
        while len(symbol):
            first = np.flatnonzero(np.concatenate(([True], chunk[1:] != chunk[:-1])))
            best = np.minimum.reduceat((self.order[rank] << 32) + np.arange(len(rank)), first)
            going = best < (_NONE << 32)
            length = np.diff(np.append(first, len(symbol)))
            if not going.all():
                over = ~np.repeat(going, length)
                done.append((chunk[over], place[over], symbol[over]))
                keep = ~over
                moved = np.cumsum(keep) - 1
                best = moved[best[going] & 0xFFFFFFFF]
                symbol, chunk, place, rank = symbol[keep], chunk[keep], place[keep], rank[keep]
            else:
                best = best & 0xFFFFFFFF
            if not len(symbol):
                break
            symbol[best] = self.merged_id[rank[best]]
            keep = np.ones(len(symbol), bool)
            keep[best + 1] = False
            at = best - np.arange(len(best))               # one symbol goes from each chunk before
            symbol, chunk, place, rank = symbol[keep], chunk[keep], place[keep], rank[keep]
            for i in (at, at[at > 0] - 1):
                j = np.minimum(i + 1, len(symbol) - 1)
                rank[i] = self._ranks(symbol[i], symbol[j], (chunk[i] == chunk[j]) & (i + 1 < len(symbol)))
        chunk, place, symbol = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(place)
        chunk, symbol = chunk[order], symbol[order]
        return self._with_bytes(chunk, symbol, len(chunks))

    def _ranks(self, left: np.ndarray, right: np.ndarray, able: np.ndarray) -> np.ndarray:
        """Number, best score first, of the piece that both symbols make; -1 if none."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        ok = able & (self.pairs[at] == key) & (left < self.size) & (right < self.size)
        return np.where(ok, self.pair_rank[at], -1)

    def _with_bytes(self, chunk: np.ndarray, symbol: np.ndarray, n: int) -> list[bytes]:
        """Ids by chunk, where characters without a piece become their bytes."""
        odd = np.flatnonzero(symbol >= self.size)
        if len(odd):
            repeat = np.ones(len(symbol), np.int64)
            values, inverse = np.unique(symbol[odd], return_inverse=True)
            spelled = [self._ids([chr(x - self.size)]) for x in values.tolist()]
            repeat[odd] = np.array([len(x) for x in spelled])[inverse]
            begins = np.cumsum(repeat) - repeat
            out = np.repeat(symbol, repeat)
            for k, x in enumerate(spelled):
                at = begins[odd[inverse == k]]
                for d, i in enumerate(x):
                    out[at + d] = i
            chunk, symbol = np.repeat(chunk, repeat), out
        raw = symbol.astype("<u4").tobytes()
        ends = (4 * np.searchsorted(chunk, np.arange(n + 1))).tolist()
        return [raw[a:z] for a, z in zip(ends[:-1], ends[1:])]

    def ids_of(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks, each by the agenda: short ones together, long ones alone."""
        out = [b""] * len(chunks)
        short = [i for i, c in enumerate(chunks) if len(c) <= _SHORT]
        for lo in range(0, len(short), _AT_ONCE):
            part = short[lo:lo + _AT_ONCE]
            for i, raw in zip(part, self._many([chunks[i] for i in part])):
                out[i] = raw
        for i, c in enumerate(chunks):
            if len(c) > _SHORT:
                out[i] = np.array(self._ids(self.merged(c)), "<u4").tobytes()
        return out

    def _learn(self, chunks: list[str]) -> None:
        """Encode new chunks and compare them with the library, all at once.  The
        library puts a space symbol before a text, so chunks go in without their
        first one; chunks without one go in behind a character that merges with
        nothing."""
        theirs = self.library.encode([c[1:] if c[0] == SPACE else self.apart + c for c in chunks], num_threads=1)
        mine = self.ids_of(chunks)
        space = np.array([self.ids[SPACE]], "<u4").tobytes()
        expected = [raw if c[0] == SPACE else self.apart_ids + raw for c, raw in zip(chunks, mine)]
        expected = [b"" if c == SPACE and raw == space else raw for c, raw in zip(chunks, expected)]    # of no text: no ids
        if np.fromiter(itertools.chain.from_iterable(theirs), "<u4").tobytes() != b"".join(expected):
            wrong = [c for c, x, y in zip(chunks, expected, theirs) if x != np.array(y, "<u4").tobytes()]
            raise ValueError(f"the library encodes {wrong[:3]!r} in another way")
        self.cache.update(zip(chunks, mine))
        self.held += sum(map(len, mine)) + sum(map(len, chunks)) + _ENTRY * len(chunks)

    def _room(self) -> None:
        """Once the cache is full, the chunks that came first stay, up to half of
        the bytes: frequent ones come early."""
        if self.held <= self.limit:
            return
        self.held, kept = 0, 0
        for c, raw in self.cache.items():
            self.held += _ENTRY + len(c) + len(raw)
            if self.held > self.limit // 2:
                break
            kept += 1
        self.cache = dict(itertools.islice(self.cache.items(), kept))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of texts as little-endian uint32, without the end id."""
        self._room()
        parts = [self._chunks(t) for t in texts]
        missing = set().union(*parts).difference(self.cache)
        if missing:
            self._learn(list(missing))
        get = self.cache.__getitem__
        return [b"".join(map(get, p)) for p in parts]

    # ------------------------------------------------------------- decoding

    def decode(self, ids: np.ndarray, offset: np.ndarray) -> list[bytes]:
        """UTF-8 texts of the sequences ``ids[offset[r]:offset[r + 1]]``.  One
        space before the first piece goes, as encoding put it there; bytes that
        are not UTF-8 become U+FFFD each."""
        flat, ends = self.surface.joined(ids)
        seen = np.flatnonzero(self.surface.size[ids] > 0)
        at = np.searchsorted(seen, offset)
        out = []
        for r in range(len(offset) - 1):
            lo, hi = int(ends[offset[r]]), int(ends[offset[r + 1]])
            if at[r] < at[r + 1] and self.leading[ids[seen[at[r]]]]:
                lo += 1
            inner = np.flatnonzero(self.control[ids[offset[r]:offset[r + 1] - 1]]) + offset[r]
            cuts = [lo, *ends[inner[ends[inner] > lo]].tolist(), hi]      # bytes on both sides of a control id don't join
            out.append(b"".join(_valid(flat[a:z].tobytes()) for a, z in zip(cuts[:-1], cuts[1:])))
        return out


def _valid(raw: bytes) -> bytes:
    try:
        raw.decode()
    except UnicodeDecodeError:
        raw = raw.decode("utf-8", "kestrel-each-byte").encode()
    return raw


class _Pool:
    """Byte strings by number, joined for many numbers at once."""

    def __init__(self, strings: list[bytes]) -> None:
        self.data = np.frombuffer(b"".join(strings), np.uint8)
        self.size = np.array([len(s) for s in strings], np.int64)
        self.start = np.cumsum(self.size) - self.size

    def joined(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All strings in a row, and where each begins (and the last one ends)."""
        size = self.size[ids]
        ends = np.concatenate(([0], np.cumsum(size)))
        return self.data[np.arange(int(ends[-1])) + np.repeat(self.start[ids] - ends[:-1], size)], ends


_LOADED: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """One for all tasks of a worker."""
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(path)
    return _LOADED[path]


def _groups(texts: list[str]) -> Iterator[tuple[int, int]]:
    lo = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > _TEXTS:
            yield lo, i
            lo, size = i, 0
        size += len(t)
    if lo < len(texts):
        yield lo, len(texts)


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): every text as little-endian uint32 ids with the end id.

    Null and empty texts are the end id alone; a null id stays null; repeated rows
    stay; an empty table gives no rows; other columns are not looked at.  A text
    is encoded whole by one task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model)
        end = np.array([v.end], "<u4").tobytes()
        for b in batches:
            texts = b.column(1).fill_null("").to_pylist()
            for lo, hi in _groups(texts):
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array([x + end for x in v.encode(texts[lo:hi])], pa.binary())],
                    ["doc_id", "ids"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, ids binary")


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.fill_null(b"").cast(pa.large_binary())
    _, off, data = column.buffers()
    offset = np.frombuffer(off, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offset[0]:offset[-1]].view("<u4").astype(np.int64), (offset - offset[0]) // 4


def decode(sequences: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids",
           checked: bool = True) -> DataFrame:
    """(doc_id, text) of sequences of ids (little-endian uint32; null counts as
    none).  With ``checked`` every batch is compared with the library's own
    decoding, and a difference is an error."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model)
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                texts = decoded(v, *_flat(part.column(1)), checked)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.binary()).cast(pa.string())],
                                                 ["doc_id", "text"])

    src = sequences.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids"))
    return src.mapInArrow(run, "doc_id long, text string")


def decoded(v: Vocabulary, ids: np.ndarray, offset: np.ndarray, checked: bool) -> list[bytes]:
    texts = v.decode(ids, offset)
    if checked:
        theirs = v.library.decode([ids[a:z].tolist() for a, z in zip(offset[:-1], offset[1:])], num_threads=1)
        if [t.encode() for t in theirs] != texts:
            raise ValueError("the library decodes a sequence in another way")
    return texts


def digest(sequences: DataFrame, model: str) -> DataFrame:
    """Of every sequence: its ids, their decimal digits (joined by a space) and
    its decoded text as numbers and SHA-256 values."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model)
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                ids, offset = _flat(part.column(1))
                flat, ends = v.decimal.joined(ids)
                digits = [hashlib.sha256(flat[ends[a] + 1:ends[z]]).hexdigest() for a, z in zip(offset[:-1], offset[1:])]
                texts = [hashlib.sha256(t).hexdigest() for t in decoded(v, ids, offset, True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(offset)), pa.array(digits), pa.array(texts)],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return sequences.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")

"""Operator 8: greedy word-piece lengths by a linear longest-match automaton.

The vocabulary becomes a trie of bytes.  A node whose string can't be extended
by the next byte has to give up its greedy pieces: ``pop`` is how many pieces
that is and ``fail`` the node of what is then left.  Both are computed once, by
breadth, so a word is counted in one pass over its bytes and no piece is built.
The automaton runs over all distinct words of a batch at once, one byte place at
a time.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import emit, source
from .words import chunks, split_words


def read_ranks(path: str) -> list[bytes]:
    """Pieces of a byte-level vocabulary file: base64 and rank on each line."""
    with open(path, "rb") as f:
        return [base64.b64decode(line.split()[0]) for line in f if line.strip()]


class LongestMatch:
    """Trie with failure links and counts.  Node 0 is the root.  ``keys`` are
    the edges, node * 256 + byte, in order; ``child`` their targets.  ``fail``
    is -1 where a text can't go on (no single byte piece fits)."""

    def __init__(self, pieces: Iterable[bytes]) -> None:
        children: list[dict[int, int]] = [{}]
        final = [False]
        for piece in pieces:
            node = 0
            for c in piece:
                nxt = children[node].get(c)
                if nxt is None:
                    nxt = len(children)
                    children[node][c] = nxt
                    children.append({})
                    final.append(False)
                node = nxt
            if node:
                final[node] = True
        n = len(children)
        fail, pop = np.full(n, -1, np.int32), np.zeros(n, np.int32)
        level = [0]
        while level:
            below = []
            for u in level:
                for c, v in children[u].items():
                    below.append(v)
                    if final[v]:
                        fail[v], pop[v] = 0, 1
                        continue
                    z, count = int(fail[u]), int(pop[u])
                    while z >= 0 and c not in children[z]:
                        count += int(pop[z])
                        z = int(fail[z])
                    if z >= 0:
                        fail[v], pop[v] = children[z][c], count
            level = below
        self.fail, self.pop = fail, pop
        edges = sorted((u << 8 | c, v) for u, kids in enumerate(children) for c, v in kids.items())
        self.keys = np.array([k for k, _ in edges], np.int64)
        self.child = np.array([v for _, v in edges], np.int32)

    def _goto(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        key = node.astype(np.int64) << 8 | byte
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.child[at], -1)

    def _give_up(self, node: np.ndarray, count: np.ndarray, who: np.ndarray) -> np.ndarray:
        """One failure step of the words ``who``; returns those that go on."""
        z = self.fail[node[who]]
        count[who] = np.where(z < 0, -1, count[who] + self.pop[node[who]])
        node[who] = z
        return who[z >= 0]

    def counts(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Pieces of every span, -1 where the vocabulary can't spell it.  Spans
        are counted as if a space stood before them."""
        n = len(start)
        order = np.argsort(start - end, kind="stable")         # longest first
        s, length = start[order], (end - start)[order]
        node = np.zeros(n, np.int32)
        count = np.zeros(n, np.int64)
        for place in range(-1, int(length[0]) if n else -1):
            live = np.flatnonzero((count[:np.searchsorted(-length, -place, "left")] >= 0))
            if not len(live):
                break
            byte = buf[s[live] + place].astype(np.int64) if place >= 0 else np.full(len(live), 32)
            who = np.arange(len(live))
            while len(who):
                nxt = self._goto(node[live[who]], byte[who])
                ok = nxt >= 0
                node[live[who[ok]]] = nxt[ok]
                who = who[~ok]
                if len(who):
                    on = self._give_up(node, count, live[who])
                    who = who[np.isin(live[who], on, assume_unique=True)]
        who = np.flatnonzero((count >= 0) & (node > 0))
        while len(who):
            on = self._give_up(node, count, who)
            who = on[node[on] > 0]
        out = np.empty(n, np.int64)
        out[order] = count
        return out


_AUTOMATA: dict[str, LongestMatch] = {}


def automaton(path: str) -> LongestMatch:
    if path not in _AUTOMATA:
        _AUTOMATA[path] = LongestMatch(read_ranks(path))
    return _AUTOMATA[path]


def token_counts(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, ``n_tokens`` (greedy pieces of all words,
    a word being preceded by a space), ``max_word_tokens`` and ``n_unknown``
    (words that the vocabulary can't spell; each counts as one token).

    Null or empty text: zeros.  Repeated rows come out as often as they went in,
    a null id stays null, an empty table gives no rows, other columns are not
    looked at."""
    src = source(docs, id_col, text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(vocabulary_path)
        for b in batches:
            for lo, hi, buf, offset in chunks(b.column(1)):
                w = split_words(buf, offset)
                _, first, same = np.unique(w.hashes(), return_index=True, return_inverse=True)
                n = machine.counts(buf, w.start[first], w.end[first])[same]
                tokens = np.concatenate(([0], np.cumsum(np.where(n < 0, 1, n))))
                unknown = np.concatenate(([0], np.cumsum(n < 0)))
                most = np.zeros(hi - lo, np.int64)
                np.maximum.at(most, w.row, np.where(n < 0, 1, n))
                a, z = w.first[:-1], w.first[1:]
                yield from emit(["doc_id", "n_words", "n_tokens", "max_word_tokens", "n_unknown"],
                                [b.column(0).slice(lo, hi - lo), w.count, tokens[z] - tokens[a], most,
                                 unknown[z] - unknown[a]])

    return src.mapInArrow(run, "doc_id long, n_words long, n_tokens long, max_word_tokens long, n_unknown long")

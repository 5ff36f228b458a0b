"""Linear-chain conditional random field over categorical features, in numpy.

Every position of a sequence has one value of each feature; a feature value has
a weight per tag, and a pair of neighbouring tags has a weight.  Training is
full-batch gradient ascent on the penalised log-likelihood (forward-backward in
log space) over a small labelled table.  Decoding is Viterbi over many sequences
at once, one position at a time, longest sequences first; a very long sequence
by blocks, with the same best path.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Chain:
    """``emit[f]``: weights (value, tag) of feature ``f``; ``step``: weights of
    (tag, next tag); ``start``: weights of the first tag."""

    tags: list[str]
    emit: list[np.ndarray]
    step: np.ndarray
    start: np.ndarray

    def scores(self, features: list[np.ndarray]) -> np.ndarray:
        out = self.emit[0][features[0]]
        for w, f in zip(self.emit[1:], features[1:]):
            out = out + w[f]
        return out

    def decode(self, features: list[np.ndarray], bound: np.ndarray) -> np.ndarray:
        """Best tags of all sequences; sequence ``i`` is ``bound[i]:bound[i+1]``."""
        return viterbi(self.scores(features), self.step, self.start, bound)


LONG = 512               # positions; longer sequences are decoded by themselves, in blocks


def viterbi(score: np.ndarray, step: np.ndarray, start: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """The best tags of every sequence, whole, whatever its length."""
    length = np.diff(bound)
    far = np.flatnonzero(length > LONG)
    if len(far):
        tag = np.zeros(len(score), np.uint8)
        for i in far.tolist():
            tag[bound[i]:bound[i + 1]] = _long_path(score[bound[i]:bound[i + 1]], step, start)
        near = np.repeat(length <= LONG, length)
        tag[near] = _together(score[near], step, start, np.append(0, np.cumsum(length[length <= LONG])))
        return tag
    return _together(score, step, start, bound)


def _long_path(score: np.ndarray, step: np.ndarray, start: np.ndarray, block: int = 128) -> np.ndarray:
    """Viterbi over one long sequence: for every block the best paths from each tag
    before it to each tag at its end, all blocks at once; then the best tags at the
    borders, block by block; then the paths between them, all at once.  A byte a
    position and pair of tags."""
    n, k = score.shape
    blocks = -(-(n - 1) // block)
    held = np.zeros((blocks * block, k), score.dtype)
    held[:n - 1] = score[1:]
    held = held.reshape(blocks, block, k)
    size = np.full(blocks, block)
    size[-1] = n - 1 - (blocks - 1) * block
    best = np.full((blocks, k, k), -np.inf, score.dtype)
    best[:, np.arange(k), np.arange(k)] = 0
    back = np.zeros((block, blocks, k, k), np.uint8)
    for t in range(block):
        m = blocks if t < size[-1] else blocks - 1            # the last block may be shorter
        path = best[:m, :, :, None] + step                    # (block, from, last tag, next tag)
        back[t, :m] = path.argmax(2)
        best[:m] = path.max(2) + held[:m, t, None, :]
    reach = score[0] + start
    came = np.zeros((blocks, k), np.int64)
    for b in range(blocks):
        path = reach[:, None] + best[b]
        came[b], reach = path.argmax(0), path.max(0)
    border = np.zeros(blocks + 1, np.int64)
    border[-1] = reach.argmax()
    for b in range(blocks - 1, -1, -1):
        border[b] = came[b, border[b + 1]]
    tag = np.zeros((blocks, block), np.uint8)
    now = border[1:].copy()
    for t in range(block - 1, -1, -1):
        m = blocks if t < size[-1] else blocks - 1
        tag[:m, t] = now[:m]
        now[:m] = back[t, np.arange(m), border[:m], now[:m]]
    return np.concatenate((border[:1].astype(np.uint8), tag.ravel()[:n - 1]))


def _together(score: np.ndarray, step: np.ndarray, start: np.ndarray, bound: np.ndarray) -> np.ndarray:
    length = np.diff(bound)
    order = np.argsort(-length, kind="stable")
    order = order[length[order] > 0]
    first, length = bound[:-1][order], length[order]
    k = len(start)
    back = np.zeros((len(score), k), np.uint8)
    last = np.zeros((len(order), k), score.dtype)
    if not len(order):
        return np.zeros(len(score), np.uint8)
    last[:] = score[first] + start
    for t in range(1, int(length[0])):
        m = int(np.searchsorted(-length, -t, "left"))       # sequences longer than t
        best, come = last[:m, 0, None] + step[0], np.zeros((m, k), np.uint8)
        for j in range(1, k):
            other = last[:m, j, None] + step[j]
            better = other > best
            best = np.where(better, other, best)
            come[better] = j
        back[first[:m] + t] = come
        last[:m] = best + score[first[:m] + t]
    tag = np.zeros(len(score), np.uint8)
    now = np.argmax(last, axis=1)
    for t in range(int(length[0]) - 1, -1, -1):
        m = int(np.searchsorted(-length, -t, "left"))
        at = first[:m] + t
        tag[at] = now[:m]
        if t:
            now[:m] = back[at, now[:m]]
    return tag


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis=axis, keepdims=True)
    return np.squeeze(m, axis) + np.log(np.exp(x - m).sum(axis=axis))


def train(features: list[np.ndarray], sizes: list[int], bound: np.ndarray, gold: np.ndarray, tags: list[str],
          penalty: float = 0.05, rounds: int = 200, rate: float = 0.2) -> Chain:
    """Fit on labelled sequences; the same input always gives the same weights."""
    k, n = len(tags), len(gold)
    params = [np.zeros((s, k)) for s in sizes] + [np.zeros((k, k)), np.zeros(k)]
    mean, var = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    want = np.zeros((n, k))
    want[np.arange(n), gold] = 1
    seqs = [(int(a), int(z)) for a, z in zip(bound[:-1], bound[1:]) if z > a]
    for r in range(1, rounds + 1):
        *emit, step, start = params
        score = sum(w[f] for w, f in zip(emit, features))
        have, d_step, d_start = np.zeros((n, k)), np.zeros((k, k)), np.zeros(k)
        for a, z in seqs:
            fwd, bwd = np.zeros((z - a, k)), np.zeros((z - a, k))
            fwd[0] = score[a] + start
            for t in range(1, z - a):
                fwd[t] = score[a + t] + _lse(fwd[t - 1][:, None] + step, 0)
            for t in range(z - a - 2, -1, -1):
                bwd[t] = _lse(step + (score[a + t + 1] + bwd[t + 1])[None, :], 1)
            total = _lse(fwd[-1], 0)
            have[a:z] = np.exp(fwd + bwd - total)
            d_start[gold[a]] += 1
            d_start -= have[a]
            for t in range(1, z - a):
                d_step[gold[a + t - 1], gold[a + t]] += 1
                d_step -= np.exp(fwd[t - 1][:, None] + step + (score[a + t] + bwd[t])[None, :] - total)
        diff = want - have
        grads = []
        for s, f in zip(sizes, features):
            g = np.zeros((s, k))
            np.add.at(g, f, diff)
            grads.append(g)
        for i, g in enumerate([*grads, d_step, d_start]):
            g = g - penalty * params[i]
            mean[i] = 0.9 * mean[i] + 0.1 * g
            var[i] = 0.99 * var[i] + 0.01 * g * g
            params[i] = params[i] + rate * (mean[i] / (1 - 0.9 ** r)) / (np.sqrt(var[i] / (1 - 0.99 ** r)) + 1e-8)
    *emit, step, start = (p.astype(np.float32) for p in params)
    return Chain(tags, emit, step, start)

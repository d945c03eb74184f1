"""Linear-chain conditional random fields in numpy batches.

Words are reduced to classes of equal features, so that emissions are rows of a small table.
Sequences are handled in blocks of at most BLOCK words, padded and side by side. In training a block is a
sequence; in decoding blocks of one text are chained, so that a text of any length is one sequence:
`chained_marginals` hands forward and backward vectors from block to block, and `whole_viterbi`
decodes the stretches that can hold a label at all.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from itertools import chain

import numpy as np

BLOCK = 64
#: Vectors are scaled to sum 1 every so many words; a word's best label has the factor 1, so only moves shrink a sum.
SCALE = 16


def feature(name: str, size: int) -> int:
    return zlib.crc32(name.encode()) % size


@dataclass
class Crf:
    labels: list[str]
    weights: np.ndarray  # features x labels
    moves: np.ndarray  # label before x label

    def emissions(self, features: list[list[int]]) -> np.ndarray:
        """One row for each list of feature numbers, of which none is empty."""
        if not features:
            return np.zeros((0, len(self.labels)), dtype=np.float32)
        length = np.fromiter(map(len, features), dtype=np.int64, count=len(features))
        return self.sums(np.fromiter(chain.from_iterable(features), dtype=np.int64, count=int(length.sum())), length)

    def sums(self, flat: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The same for feature numbers in one array, ``length`` of them for each row."""
        return np.add.reduceat(self.weights[flat], np.cumsum(length) - length, axis=0)


def blocks(count: np.ndarray, size: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Cut runs of ``count`` words into blocks: (run, length) of each block."""
    n = -(-count // size)
    run = np.repeat(np.arange(len(count)), n)
    place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return run, np.minimum(size, count[run] - place * size)


def padded(values: np.ndarray, length: np.ndarray, size: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Rows of consecutive values as (blocks x size ...), and which places are filled."""
    filled = np.arange(size) < length[:, None]
    out = np.zeros((len(length), size, *values.shape[1:]), dtype=values.dtype)
    out[filled] = values
    return out, filled


def forward_backward(emission: np.ndarray, filled: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(marginals, log partition, expected moves summed) of padded blocks."""
    n, size, k = emission.shape
    top = emission.max(axis=2, keepdims=True)
    local, step = np.exp(emission - top).astype(np.float64), np.exp(moves)
    alpha, scale = np.empty((n, size, k)), np.ones((n, size))
    a = local[:, 0]
    for t in range(size):
        if t:
            a = np.where(filled[:, t, None], (alpha[:, t - 1] @ step) * local[:, t], alpha[:, t - 1])
        s = a.sum(axis=1)
        scale[:, t] = np.where(filled[:, t], s, 1)
        alpha[:, t] = a / s[:, None]
    beta, expected = np.ones((n, size, k)), np.zeros((k, k))
    for t in range(size - 2, -1, -1):
        right = local[:, t + 1] * beta[:, t + 1] / scale[:, t + 1, None]
        b = right @ step.T
        beta[:, t] = np.where(filled[:, t + 1, None], b, 1)
        on = filled[:, t + 1]
        expected += (alpha[on, t].T @ right[on]) * step
    marginal = alpha * beta
    marginal /= marginal.sum(axis=2, keepdims=True)
    log_z = (np.log(scale) + np.where(filled, top[:, :, 0], 0)).sum(axis=1)
    return marginal, log_z, expected


def factors(emission: np.ndarray) -> np.ndarray:
    """Emissions as factors, of which the largest of a word is 1."""
    return np.exp(emission - emission.max(axis=-1, keepdims=True, initial=-np.inf)).astype(np.float64)


def chained_marginals(local: np.ndarray, filled: np.ndarray, moves: np.ndarray, run: np.ndarray) -> np.ndarray:
    """Marginals of padded blocks of `factors`; blocks of equal ``run``, which stand together and in order, are one sequence.

    Each block's words make a matrix that carries a forward vector over the block (and a backward vector
    back), so only these matrices are applied one after the other; all else is side by side.
    """
    n, size, k = local.shape
    local, step = np.where(filled[:, :, None], local, 1), np.exp(moves - moves.max())
    first = np.concatenate([[True], run[1:] != run[:-1]])
    last = np.concatenate([first[1:], [True]])
    place = np.arange(n) - np.maximum.accumulate(np.where(first, np.arange(n), 0))
    enter, leave = np.ones((n, k)), np.ones((n, k))
    if place.any():
        rest = np.flatnonzero(~first)
        over, inside, on = np.zeros((n, k, k)), local[rest], filled[rest]
        part = np.broadcast_to(np.eye(k), (len(rest), k, k)).copy()
        for t in range(size):
            part = np.where(on[:, t, None, None], (part.reshape(-1, k) @ step).reshape(-1, k, k) * inside[:, t, None, :], part)
            if t % SCALE == 0 or t == size - 1:
                part /= part.sum(axis=(1, 2), keepdims=True)
        over[rest] = part
        begin = local[:, 0].copy()  # a first block has no move before its first word
        for t in range(1, size):
            begin = np.where(filled[:, t, None], (begin @ step) * local[:, t], begin)
            if t % SCALE == 0:
                begin /= begin.sum(axis=1, keepdims=True)
        begin /= begin.sum(axis=1, keepdims=True)
        ends = begin
        for j in range(1, int(place.max()) + 1):
            at = np.flatnonzero(place == j)
            enter[at] = ends[at - 1]
            ends[at] = np.einsum("nk,nkl->nl", enter[at], over[at])
            ends[at] /= ends[at].sum(axis=1, keepdims=True)
        back = place[last][np.cumsum(first) - 1] - place  # blocks that follow in the sequence
        for j in range(1, int(back.max()) + 1):
            at = np.flatnonzero(back == j)
            leave[at] = np.einsum("nkl,nl->nk", over[at + 1], leave[at + 1])
            leave[at] /= leave[at].sum(axis=1, keepdims=True)
    alpha = np.empty((n, size, k))
    a = np.where(first[:, None], 1, enter @ step) * local[:, 0]
    for t in range(size):
        if t:
            a = np.where(filled[:, t, None], (a @ step) * local[:, t], a)
        if t % SCALE == 0:
            a = a / a.sum(axis=1, keepdims=True)
        alpha[:, t] = a
    b = leave
    for t in range(size - 1, -1, -1):
        alpha[:, t] *= b
        if t:  # the vector before word t
            b = np.where(filled[:, t, None], (local[:, t] * b) @ step.T, b)
            if t % SCALE == 0:
                b = b / b.sum(axis=1, keepdims=True)
    return alpha / alpha.sum(axis=2, keepdims=True)


def possible(emission: np.ndarray, count: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Which words of texts of ``count`` words can have another label than the first on a best path.

    A run of other labels wins, in all, no more over a run of first ones than the sum of its words' best
    gains and of the largest gains of its moves. A word in no run for which that is positive is out.
    """
    gain = emission[:, 1:].max(axis=1).astype(np.float64) - emission[:, 0]
    inner = float(moves[1:, 1:].max() - moves[0, 0])
    outer = max(0.0, float(moves[0, 1:].max() - moves[0, 0])) + max(0.0, float(moves[1:, 0].max() - moves[0, 0]))
    worth = np.zeros(len(gain) + len(count))
    word = np.arange(len(gain)) + np.repeat(np.arange(len(count)), count)  # a wall stands after each text
    worth[word] = gain + inner
    wall = np.ones(len(worth), dtype=bool)
    wall[word] = False
    worth[wall] = -(np.abs(worth).sum() + 1)
    total = np.concatenate([[0], np.cumsum(worth)])
    best = np.maximum.accumulate(total[:0:-1])[::-1] - np.minimum.accumulate(total[:-1])
    return (best - inner + outer >= -1e-3)[word]


def whole_viterbi(emission: np.ndarray, count: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Best labels of texts of ``count`` words, each text one sequence.

    Between two stretches of `possible` words all labels are the first, so each stretch is decoded by itself,
    with a word of the first label on either side unless its text ends there.
    """
    labels = np.zeros(len(emission), dtype=np.int64)
    may = possible(emission, count, moves)
    text = np.repeat(np.arange(len(count)), count)
    cut = np.concatenate([[True], text[1:] != text[:-1]]) if len(text) else np.empty(0, dtype=bool)
    begin = np.flatnonzero(may & (cut | ~np.roll(may, 1)))
    end = np.flatnonzero(may & np.append(cut[1:] | ~may[1:], True)) + 1
    low, high = begin - ~cut[begin], end + np.append(~cut, False)[end] if len(begin) else end
    length = high - low
    fixed = np.full(emission.shape[1], -1e9)
    fixed[0] = 0
    size = 8
    while len(length):  # stretches of like length together
        now = np.flatnonzero((length <= size) & (length > size // 2 if size > 8 else True))
        for at in range(0, len(now), max(1, 200_000 // size)):
            part = now[at : at + max(1, 200_000 // size)]
            place = np.repeat(low[part], length[part]) + np.arange(length[part].sum()) - np.repeat(np.cumsum(length[part]) - length[part], length[part])
            rows, filled = padded(np.where(may[place, None], emission[place], fixed), length[part], size)
            labels[place] = viterbi(rows, filled, moves)[filled]
        if size >= length.max():
            break
        size *= 2
    return labels


def viterbi(emission: np.ndarray, filled: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Best labels of padded blocks; of equal scores the earlier label."""
    n, size, k = emission.shape
    back = np.empty((n, size, k), dtype=np.int8)
    score = emission[:, 0]
    for t in range(1, size):
        through = score[:, :, None] + moves
        best = through.argmax(axis=1)
        new = np.take_along_axis(through, best[:, None], axis=1)[:, 0] + emission[:, t]
        on = filled[:, t, None]
        back[:, t] = np.where(on, best, np.arange(k))
        score = np.where(on, new, score)
    out = np.empty((n, size), dtype=np.int64)
    label = score.argmax(axis=1)
    for t in range(size - 1, -1, -1):
        out[:, t] = label
        label = back[np.arange(n), t, label] if t else label
    return out


def train(sequences: list[tuple[list[list[int]], list[int]]], labels: list[str], n_features: int, rounds: int = 60, rate: float = 0.15, ridge: float = 1e-4) -> Crf:
    """Maximum likelihood by Adam on all of a small table: (features of each word, label of each word)."""
    k = len(labels)
    rows: dict[tuple[int, ...], int] = {}
    ids, gold, length = [], [], []
    for feats, marks in sequences:
        for at in range(0, len(feats), BLOCK):
            part = feats[at : at + BLOCK]
            ids += [rows.setdefault(tuple(f), len(rows)) for f in part]
            gold += marks[at : at + BLOCK]
            length.append(len(part))
    ids, gold, length = np.array(ids), np.array(gold), np.array(length)
    of = list(rows)
    lens = np.array([len(f) for f in of])
    owner, flat = np.repeat(np.arange(len(of)), lens), np.array([x for f in of for x in f])
    truth, filled = padded(gold, length)
    wanted_moves = np.zeros((k, k))
    both = filled[:, 1:]
    np.add.at(wanted_moves, (truth[:, :-1][both], truth[:, 1:][both]), 1)
    wanted = np.stack([np.bincount(ids[gold == y], minlength=len(of)) for y in range(k)], axis=1)
    params = [np.zeros((n_features, k)), np.zeros((k, k))]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    used = np.unique(flat)
    for step in range(1, rounds + 1):
        table = np.stack([np.bincount(owner, params[0][flat, y], minlength=len(of)) for y in range(k)], axis=1)
        emission, _ = padded(table[ids], length)
        marginal, _, expected = forward_backward(emission, filled, params[1])
        got = np.stack([np.bincount(ids, marginal[filled][:, y], minlength=len(of)) for y in range(k)], axis=1)
        miss = wanted - got
        grad = np.zeros_like(params[0])
        for y in range(k):
            grad[:, y] = np.bincount(flat, miss[owner, y], minlength=n_features)
        grads = [grad / len(ids) - ridge * params[0] / 100, (wanted_moves - expected) / len(ids) - ridge * params[1]]
        for p, g, m, v in zip(params, grads, first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        mask = np.ones(n_features, dtype=bool)
        mask[used] = False
        params[0][mask] = 0
    return Crf(labels, params[0].astype(np.float32), params[1])

"""A linear-chain conditional random field over two labels, in numpy.

The score of a labelling is the sum of each block's feature weights under its label, of
the weights of neighbouring labels and of the first and last label. Training climbs the
penalised log-likelihood with its exact gradient (forward-backward over all sequences
at once); decoding is Viterbi.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

LABELS = 2


class Model(NamedTuple):
    weights: dict[str, tuple[float, float]]
    step: np.ndarray  # [label, next label]
    first: np.ndarray
    last: np.ndarray


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    most = x.max(axis=axis, keepdims=True)
    return np.squeeze(most, axis) + np.log(np.exp(x - most).sum(axis=axis))


def log_likelihood(scores, labels, lengths, step, first, last):
    """The sum over sequences, and its gradients by scores, step, first and last.

    ``scores`` is (sequence, place, label); places from a sequence's length on count nothing.
    """
    n, most, _ = scores.shape
    rows, ends = np.arange(n), lengths - 1
    inside = np.arange(most)[None, :] < lengths[:, None]
    forward, backward = np.zeros_like(scores), np.zeros_like(scores)
    forward[:, 0] = first + scores[:, 0]
    for t in range(1, most):
        forward[:, t] = _log_sum(forward[:, t - 1, :, None] + step, 1) + scores[:, t]
    whole = _log_sum(forward[rows, ends] + last, 1)
    backward[:] = last
    for t in range(most - 2, -1, -1):
        ahead = _log_sum(step + (scores[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
        backward[:, t] = np.where((t < ends)[:, None], ahead, last)
    chances = np.exp(forward + backward - whole[:, None, None]) * inside[:, :, None]
    given = np.eye(LABELS)[labels] * inside[:, :, None]
    pair_inside = inside[:, 1:, None, None]
    pairs = np.exp(np.where(
        pair_inside, forward[:, :-1, :, None] + step + (scores + backward)[:, 1:, None, :] - whole[:, None, None, None], -np.inf))
    given_pairs = given[:, :-1, :, None] * given[:, 1:, None, :]
    right = (given * scores).sum() + (given_pairs * step).sum() + (given[:, 0] * first).sum() + (
        given[rows, ends] * last).sum()
    return right - whole.sum(), (
        given - chances, (given_pairs - pairs).sum(axis=(0, 1)), (given[:, 0] - chances[:, 0]).sum(axis=0),
        (given[rows, ends] - chances[rows, ends]).sum(axis=0))


def trained(sequences: list[tuple[list[list[str]], list[int]]], rounds: int = 200, rate: float = 0.1,
            penalty: float = 0.5) -> Model:
    """A model of (features of each place, label of each place), by Adam over all sequences."""
    sequences = [s for s in sequences if s[1]]
    names = {f: i for i, f in enumerate(sorted({f for has, _ in sequences for h in has for f in h}))}
    lengths = np.array([len(y) for _, y in sequences])
    shape = (len(sequences), int(lengths.max()))
    inside = np.arange(shape[1])[None, :] < lengths[:, None]
    labels = np.zeros(shape, np.int64)
    labels[inside] = [label for _, y in sequences for label in y]
    sizes = np.array([len(h) for has, _ in sequences for h in has])
    which = np.array([names[f] for has, _ in sequences for h in has for f in h])  # block after block
    starts, block = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(sizes)), sizes)
    at = [np.zeros((len(names), LABELS)), np.zeros((LABELS, LABELS)), np.zeros(LABELS), np.zeros(LABELS)]
    mean, square = [np.zeros_like(x) for x in at], [np.zeros_like(x) for x in at]
    for turn in range(1, rounds + 1):
        scores = np.zeros((*shape, LABELS))
        scores[inside] = np.add.reduceat(at[0][which], starts, axis=0)
        _, (by_score, *others) = log_likelihood(scores, labels, lengths, *at[1:])
        by_block = by_score[inside][block]
        up = [np.stack([np.bincount(which, by_block[:, k], len(names)) for k in range(LABELS)], axis=1), *others]
        for i, x in enumerate(at):
            g = up[i] - penalty * x
            mean[i] = 0.9 * mean[i] + 0.1 * g
            square[i] = 0.999 * square[i] + 0.001 * g * g
            at[i] = x + rate * (mean[i] / (1 - 0.9 ** turn)) / (np.sqrt(square[i] / (1 - 0.999 ** turn)) + 1e-8)
    return Model({f: (float(at[0][i, 0]), float(at[0][i, 1])) for f, i in names.items()}, *at[1:])


def decoded(model: Model, places: list[list[str]]) -> list[int]:
    """The labels of the best labelling; ties go to the lower label. Unknown features count nothing."""
    if not places:
        return []
    weights, none = model.weights, (0.0, 0.0)
    (s00, s01), (s10, s11) = model.step.tolist()
    back, a, b = [], *model.first.tolist()
    for t, has in enumerate(places):
        if t:
            from_a, from_b = a + s00 < b + s10, a + s01 < b + s11
            back.append((from_a, from_b))
            a, b = (b + s10 if from_a else a + s00), (b + s11 if from_b else a + s01)
        for f in has:
            x, y = weights.get(f, none)
            a += x
            b += y
    a, b = a + float(model.last[0]), b + float(model.last[1])
    found = [int(b > a)]
    for from_a, from_b in reversed(back):
        found.append(int(from_b if found[-1] else from_a))
    return found[::-1]

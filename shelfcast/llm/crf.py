"""A linear-chain conditional random field with two states, over many sequences at once.

The score of state 1 against state 0 at each place comes from features; a 2 x 2 table scores
adjacent states. Before the first place stands a state 0.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def logit(p, least: float = 1e-6):
    p = np.clip(p, least, 1 - least)
    return np.log(p / (1 - p))


@dataclass
class Chain:
    """Feature weights and the table of adjacent states."""

    weights: np.ndarray
    steps: np.ndarray

    def scores(self, features: np.ndarray) -> np.ndarray:
        return features @ self.weights


def _passes(scores: np.ndarray, before: np.ndarray, steps: np.ndarray, between: Callable | None = None):
    """Normalised forward and backward messages, the normalisers, and the sums of joint
    probabilities of adjacent states. Sequences run longest first, so that those still going at
    each place are a prefix. ``between(places)`` gives 2 x 2 matrices for what lies, unlisted,
    before these places; place n (one beyond each sequence) is asked for as sequence numbers
    with ``ends=True``."""
    lengths = np.diff(before)
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    starts, held = before[order], lengths[order]
    table = np.exp(steps)
    emitted = np.stack([sigmoid(-scores), sigmoid(scores)], axis=1)
    ahead, back, norm = np.zeros((len(scores), 2)), np.ones((len(scores), 2)), np.ones(len(scores))
    longest = int(held[0]) if len(held) else 0
    going = np.searchsorted(-held, -np.arange(longest), "left")  # sequences longer than t
    message = np.tile([1.0, 0.0], (len(order), 1))
    for t in range(longest):
        at = starts[:going[t]] + t
        message = message[:going[t]]
        if between is not None:
            message = np.einsum("ni,nij->nj", message, between(at))
        message = (message @ table) * emitted[at]
        total = message.sum(axis=1)
        message = message / total[:, None]
        ahead[at], norm[at] = message, total
    pairs = np.zeros((2, 2))
    message = np.ones((0, 2))
    for t in range(longest - 1, -1, -1):
        at = starts[:going[t]] + t
        ended = order[len(message):going[t]]
        fresh = np.ones((len(ended), 2)) if between is None else between(ended, ends=True).sum(axis=2)
        message = np.concatenate([message, fresh])
        back[at] = message
        inward = emitted[at] * message / norm[at][:, None]
        if between is None:
            earlier = ahead[at - 1] if t else np.tile([1.0, 0.0], (len(at), 1))
            pairs += (earlier[:, :, None] * inward[:, None, :]).sum(axis=0) * table
        message = inward @ table.T
        if between is not None:
            message = np.einsum("nij,nj->ni", between(at), message)
            message /= np.maximum(message.sum(axis=1, keepdims=True), 1e-300)
    return ahead, back, norm, pairs


def marginals(scores: np.ndarray, before: np.ndarray, steps: np.ndarray, between: Callable | None = None) -> np.ndarray:
    """Probability of state 1 at every place. ``before``: places before each sequence."""
    ahead, back, _, _ = _passes(scores, before, steps, between)
    joint = ahead * back
    return joint[:, 1] / np.maximum(joint.sum(axis=1), 1e-300)


def runs_between(score: float, steps: np.ndarray, gaps: np.ndarray, closing: np.ndarray) -> Callable:
    """Matrices for ``gaps`` unlisted places before each listed one, and ``closing`` ones at the
    end of each sequence, all with the same score: powers of one matrix, up to a factor."""
    one = np.exp(steps) * np.array([sigmoid(-score), sigmoid(score)])
    half, det = np.trace(one) / 2, np.linalg.det(one)
    root = np.sqrt(max(half * half - det, 1e-300))
    large, small = half + root, half - root
    settled = (one - small * np.eye(2)) / (large - small)
    rest, ratio = np.eye(2) - settled, small / large

    def between(places: np.ndarray, ends: bool = False) -> np.ndarray:
        n = (closing if ends else gaps)[places].astype(np.float64)
        return np.maximum(settled[None] + (ratio ** n)[:, None, None] * rest[None], 0)

    return between


def minimise(function: Callable, x: np.ndarray, iterations: int, memory: int = 8) -> np.ndarray:
    """Limited-memory quasi-Newton descent. ``function(x)`` gives value and gradient."""
    value, slope = function(x)
    past: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(iterations):
        direction, used = -slope, []
        for s, y, r in reversed(past):
            a = r * (s @ direction)
            used.append(a)
            direction = direction - a * y
        if past:
            s, y, _ = past[-1]
            direction = direction * (s @ y) / (y @ y)
        else:
            direction = direction / max(1.0, np.linalg.norm(slope))
        for (s, y, r), a in zip(past, reversed(used)):
            direction = direction + s * (a - r * (y @ direction))
        along, step = slope @ direction, 1.0
        if along >= 0:
            past, direction, along = [], -slope, -(slope @ slope)
        while step > 1e-10:
            new_value, new_slope = function(x + step * direction)
            if new_value <= value + 1e-4 * step * along:
                break
            step /= 2
        else:
            return x
        s, y = step * direction, new_slope - slope
        if s @ y > 1e-12:
            past = [*past[1 - memory:], (s, y, 1 / (s @ y))]
        x, done = x + s, value - new_value < 1e-7 * max(1.0, abs(value))
        value, slope = new_value, new_slope
        if done:
            break
    return x


def fit(features: np.ndarray, labels: np.ndarray, before: np.ndarray, penalty: float = 1.0, iterations: int = 60, start: Chain | None = None) -> Chain:
    """Weights of highest penalised likelihood of the labels of whole sequences."""
    n = features.shape[1]
    labels = labels.astype(np.int64)
    previous = np.concatenate([[0], labels[:-1]])
    previous[before[:-1][np.diff(before) > 0]] = 0
    seen = np.zeros((2, 2))
    np.add.at(seen, (previous, labels), 1)

    def loss(x: np.ndarray):
        scores, steps = features @ x[:n], x[n:].reshape(2, 2)
        ahead, back, norm, pairs = _passes(scores, before, steps)
        joint = ahead * back
        p = joint[:, 1] / np.maximum(joint.sum(axis=1), 1e-300)
        # Emissions were scaled by 1 / (1 + exp(score)).
        partition = np.log(norm).sum() + np.logaddexp(0, scores).sum()
        value = partition - scores[labels == 1].sum() - (seen * steps).sum() + penalty / 2 * x @ x
        return value, np.concatenate([features.T @ (p - labels), (pairs - seen).ravel()]) + penalty * x

    x = np.zeros(n + 4) if start is None else np.concatenate([start.weights, start.steps.ravel()])
    x = minimise(loss, x, iterations)
    return Chain(x[:n], x[n:].reshape(2, 2))


def calibrate(features: np.ndarray, labels: np.ndarray, penalty: float = 1e-2) -> np.ndarray:
    """Weights, the intercept last, of a logistic curve through document features."""
    wide = np.column_stack([features, np.ones(len(features))])

    def loss(x: np.ndarray):
        z = wide @ x
        value = np.logaddexp(0, z).sum() - z[labels == 1].sum() + penalty / 2 * x @ x
        return value, wide.T @ (sigmoid(z) - labels) + penalty * x

    return minimise(loss, np.zeros(wide.shape[1]), 200)

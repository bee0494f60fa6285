"""Logistic regression on counted marks, with a support chosen at the level of chance.

An L1 penalty picks the marks: it is as strong as the largest association that one of so many
marks has by chance alone in so many texts (``false_marks`` is the probability of one or
more false marks), so it falls with the number of texts by itself. The path to the solution adds the
marks whose gradient exceeds the penalty, solves for those added so far, and ends when no other mark of
the whole vocabulary exceeds it; so the vocabulary is never cut. Of marks in the same
texts the longest is added. The weights of the chosen marks are then fitted again without the penalty, under
a wide normal prior. Dense columns (the length, earlier categories) are never penalised.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np

log = logging.getLogger(__name__)
PRIOR = 3.0  # standard deviation of a refitted weight
TIE = 1e-4  # curvature that keeps equal dense columns apart
AT_ONCE = 30


@dataclass(frozen=True)
class Sample:
    """Texts as rows: ``numbers[starts[i]:starts[i + 1]]`` are the marks of text i."""

    starts: np.ndarray
    numbers: np.ndarray
    counts: np.ndarray
    dense: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.starts) - 1

    def parts(self, least: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Owners, numbers and counts of some texts at a time: what is computed from them
        needs little memory beside the sample."""
        first = 0
        while first < self.rows:
            last = max(first + 1, int(np.searchsorted(self.starts, self.starts[first] + least, "right")) - 1)
            at = slice(self.starts[first], self.starts[last])
            owners = np.repeat(np.arange(first, last), np.diff(self.starts[first : last + 1]))
            yield owners, self.numbers[at], self.counts[at]
            first = last

    def summed(self, vocabulary: int, weights: np.ndarray, power: int = 1) -> np.ndarray:
        """Per mark the sum of weights of texts times (powers of) counts."""
        found = np.zeros(vocabulary)
        for owners, numbers, counts in self.parts():
            found += np.bincount(numbers, weights[owners] * counts.astype(float) ** power, vocabulary)
        return found

    def only(self, chosen: np.ndarray) -> "Sample":
        marks = np.repeat(chosen, np.diff(self.starts))
        sizes = np.diff(self.starts)[chosen]
        return Sample(
            np.concatenate([[0], np.cumsum(sizes)]),
            self.numbers[marks],
            self.counts[marks],
            self.dense[chosen],
        )


@dataclass(frozen=True)
class Linear:
    """``constant`` is the probability if all texts of the sample had one value."""

    constant: float | None
    intercept: float
    dense: np.ndarray
    marks: np.ndarray
    weights: np.ndarray

    def chances(self, sample: Sample, vocabulary: int) -> np.ndarray:
        if self.constant is not None:
            return np.full(sample.rows, self.constant)
        weights = np.zeros(vocabulary)
        weights[self.marks] = self.weights
        sums = np.zeros(sample.rows)
        for owners, numbers, counts in sample.parts():
            sums += np.bincount(owners, weights[numbers] * counts, sample.rows)
        return logistic(self.intercept + sample.dense @ self.dense + sums)


def logistic(x):
    return 0.5 * (1 + np.tanh(x / 2))


def log_odds(chance):
    near = np.clip(chance, 1e-6, 1 - 1e-6)
    return np.log(near / (1 - near))


def penalised(
    x: np.ndarray, y: np.ndarray, penalty: np.ndarray, curvature: np.ndarray, start: np.ndarray
) -> np.ndarray:
    """Least mean log loss + sum(penalty * |w|) + sum(curvature * w**2) / 2, by Newton steps
    whose quadratic problem is solved coordinate by coordinate."""
    w = start.copy()

    def loss(w: np.ndarray) -> float:
        sums = x @ w
        errors = np.mean(np.logaddexp(0, sums) - y * sums)
        return errors + (penalty * np.abs(w)).sum() + (curvature * w * w).sum() / 2

    now = loss(w)
    for _ in range(200):
        chance = logistic(x @ w)
        slope = x.T @ (chance - y) / len(y) + curvature * w
        bend = (x * (chance * (1 - chance))[:, None]).T @ x / len(y)
        bend[np.diag_indices(len(w))] += curvature + 1e-10
        move = _quadratic_step(bend, slope, penalty, w)
        step = 1.0
        while loss(w + step * move) > now and step > 1e-10:
            step /= 2
        after = loss(w + step * move)
        if after > now:
            break
        w, now, before = w + step * move, after, now
        if before - now <= 1e-13 * max(1.0, now):
            break
    return w


def _quadratic_step(
    bend: np.ndarray, slope: np.ndarray, penalty: np.ndarray, w: np.ndarray
) -> np.ndarray:
    move, bent = np.zeros_like(w), np.zeros_like(w)
    for _ in range(1000):
        largest = 0.0
        for j, own in enumerate(bend.diagonal()):
            # The best value of this weight while the others stay.
            free = w[j] + move[j] - (slope[j] + bent[j]) / own
            best = np.sign(free) * max(abs(free) - penalty[j] / own, 0.0) - w[j]
            change = best - move[j]
            if change:
                bent += bend[:, j] * change
                move[j] = best
                largest = max(largest, abs(change) * own**0.5)
        if largest < 1e-11:
            break
    return move


def fit_linear(
    sample: Sample,
    y: np.ndarray,
    lengths: np.ndarray,
    least_texts: int,
    false_marks: float,
) -> Linear:
    """``lengths`` has the length of every mark of the vocabulary."""
    n, rate, vocabulary = len(y), float(y.mean()) if len(y) else 0.0, len(lengths)
    extra = 1 + sample.dense.shape[1]
    if rate in (0.0, 1.0):
        return Linear(rate, 0.0, np.zeros(extra - 1), np.zeros(0, np.int64), np.zeros(0))
    ones = np.ones(n)
    mean = sample.summed(vocabulary, ones) / n
    spread = np.sqrt(np.maximum(sample.summed(vocabulary, ones, 2) / n - mean * mean, 0))
    usable = (sample.summed(vocabulary, ones, 0) >= least_texts) & (spread > 0)
    level = NormalDist().inv_cdf(1 - false_marks / 2 / max(1, int(usable.sum())))
    penalty = (rate * (1 - rate) / n) ** 0.5 * level

    def columns(marks: list[int]) -> np.ndarray:
        x = np.zeros((n, extra + len(marks)))
        x[:, 0], x[:, 1:extra] = 1, sample.dense
        place = np.full(vocabulary, -1)
        place[marks] = np.arange(len(marks))
        for owners, numbers, counts in sample.parts():
            at = place[numbers]
            x[owners[at >= 0], extra + at[at >= 0]] = counts[at >= 0]
        return x

    base = np.concatenate([[0], np.full(extra - 1, TIE)])
    marks: list[int] = []
    w = np.zeros(extra)
    w[0] = log_odds(rate)
    x = columns(marks)
    w = penalised(x, y, np.zeros(extra), base, w)
    for _ in range(500):
        gradient = np.abs(sample.summed(vocabulary, logistic(x @ w) - y)) / n
        score = np.where(usable, gradient / np.where(spread > 0, spread, 1), 0)
        score[marks] = 0
        over = np.flatnonzero(score > penalty * (1 + 1e-6))
        if not len(over):
            break
        rounded = np.round(score[over], 12)
        order = over[np.lexsort((-lengths[over], -rounded))]
        sizes = np.sort(rounded)[::-1]
        new = order[np.concatenate([[True], sizes[1:] != sizes[:-1]])][:AT_ONCE]
        used = w[extra:] != 0
        marks = [m for m, u in zip(marks, used) if u] + new.tolist()
        w = np.concatenate([w[:extra], w[extra:][used], np.zeros(len(new))])
        x = columns(marks)
        limits = np.concatenate([np.zeros(extra), penalty * spread[marks]])
        w = penalised(x, y, limits, np.concatenate([base, np.zeros(len(marks))]), w)
    else:
        log.warning("marks were still added after 500 steps")
    used = w[extra:] != 0
    marks = [m for m, u in zip(marks, used) if u]
    x, w = columns(marks), np.concatenate([w[:extra], w[extra:][used]])
    prior = np.full(len(w), 1 / (PRIOR**2 * n))
    prior[0] = 0
    w = penalised(x, y, np.zeros(len(w)), prior, w)
    return Linear(None, float(w[0]), w[1:extra], np.array(marks, np.int64), w[extra:])

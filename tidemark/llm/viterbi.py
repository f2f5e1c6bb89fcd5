"""Viterbi decoding of many sequences at once: one numpy step per position, over all sequences that are that long."""

from __future__ import annotations

import numpy as np


def _by_position(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequences from longest to shortest, where each begins, and how many reach each position."""
    order = np.argsort(-lengths, kind="stable")
    starts = (np.cumsum(lengths) - lengths)[order]
    longest = int(lengths.max()) if len(lengths) else 0
    alive = np.searchsorted(-lengths[order], -np.arange(longest), side="left")
    return order, starts, alive


def decode(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """The best state of every item. `scores` is (items, states), sequences one after the other; `moves` is (from, to).

    Of equal paths, the one with the smaller state wins.
    """
    n, states = scores.shape
    back = np.zeros((n, states), np.int16)
    _, starts, alive = _by_position(lengths)
    best = np.zeros((len(starts), states))
    for t, k in enumerate(alive):
        at = starts[:k] + t
        if t:
            paths = best[:k, :, None] + moves[None, :, :]
            back[at] = paths.argmax(1)
            best[:k] = paths.max(1)
        best[:k] = best[:k] + scores[at] if t else scores[at]
    return _trace(best, back, starts, alive, n)


def decode_switching(scores: np.ndarray, lengths: np.ndarray, penalty: float) -> np.ndarray:
    """As `decode` with no cost to stay and `penalty` for any switch, in time linear in the number of states."""
    n, states = scores.shape
    back = np.zeros((n, states), np.int16)
    _, starts, alive = _by_position(lengths)
    best = np.zeros((len(starts), states))
    own = np.arange(states, dtype=np.int16)[None, :]
    for t, k in enumerate(alive):
        at = starts[:k] + t
        if t:
            top = best[:k].argmax(1)
            level = best[np.arange(k), top][:, None] - penalty
            stay = best[:k] >= level
            back[at] = np.where(stay, own, top[:, None].astype(np.int16))
            best[:k] = np.where(stay, best[:k], level) + scores[at]
        else:
            best[:k] = scores[at]
    return _trace(best, back, starts, alive, n)


def _trace(best: np.ndarray, back: np.ndarray, starts: np.ndarray, alive: np.ndarray, n: int) -> np.ndarray:
    path = np.zeros(n, np.int16)
    state = best.argmax(1).astype(np.int16)
    for t in range(len(alive) - 1, -1, -1):
        at = starts[: alive[t]] + t
        path[at] = state[: alive[t]]
        if t:
            state[: alive[t]] = back[at, state[: alive[t]]]
    return path

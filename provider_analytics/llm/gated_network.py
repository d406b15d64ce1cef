"""A small gated recurrent network over word numbers, in numpy.

One update gate per unit; the softmax is factored into a class and a word within it.
Documents run side by side in lanes, one after another in each lane; a state is carried
from window to window and cleared where a document begins. Training stops the gradient
at the window's start.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np

UNITS = 16
LANES = 512
WINDOW = 32
#: Steps of a window when scoring, which keeps nothing for a way back.
SCORED = 64
#: The first words, whatever their frequency, are classes of their own.
LONE = 2
#: A class's size, by the root of the rank its words begin at.
SPREAD = 3
#: Rows of a softmax worked on at once.
ROWS = 2048
RATE = 0.01
#: Words whose gradients are added up at least before a step, so that windows in which few
#: lanes are left do not make steps of their own.
STEP_WORDS = 2048
#: The gradient's length at most, per word.
STEEPEST = 1.0


@cache
def edges(vocabulary: int) -> np.ndarray:
    """Where each class of words begins, and the last one's end. Words are numbered by
    frequency but for the ``LONE`` first, which are classes of their own. Classes grow with the
    root of the rank: that makes the least work of words whose counts follow Zipf's law."""
    found = [*range(min(LONE, vocabulary))]
    at = LONE
    while at < vocabulary:
        found.append(at)
        at += max(1, int(SPREAD * np.sqrt(at - LONE)))
    return np.array([*found, vocabulary])


@cache
def classes(vocabulary: int) -> np.ndarray:
    """The class of each word."""
    sizes = np.diff(edges(vocabulary))
    return np.repeat(np.arange(len(sizes), dtype=np.int16 if len(sizes) < 1 << 15 else np.int32), sizes)


def shapes(vocabulary: int, units: int = UNITS) -> dict[str, tuple[int, ...]]:
    """Names and shapes of the parameters, in the order of the flat vector. The last column
    of the outcomes of a softmax is their bias."""
    return {
        "input": (vocabulary, 2 * units),
        "recurrent": (units, 2 * units),
        "classes": (len(edges(vocabulary)) - 1, units + 1),
        "words": (vocabulary, units + 1),
    }


def views(flat: np.ndarray, vocabulary: int, units: int = UNITS) -> dict[str, np.ndarray]:
    """The parameters as views of the flat vector."""
    found, at = {}, 0
    for name, shape in shapes(vocabulary, units).items():
        size = int(np.prod(shape))
        found[name] = flat[at : at + size].reshape(shape)
        at += size
    return found


def initial(counts: np.ndarray, units: int = UNITS) -> np.ndarray:
    """Small weights, and biases that give each word its share of ``counts``."""
    vocabulary = len(counts)
    size = sum(int(np.prod(shape)) for shape in shapes(vocabulary, units).values())
    flat = np.random.default_rng(6).normal(0, 0.1, size).astype(np.float32)
    v, counts = views(flat, vocabulary, units), np.asarray(counts) + 1.0
    of_class = np.add.reduceat(counts, edges(vocabulary)[:-1])
    v["classes"][:, -1] = np.log(of_class / of_class.sum())
    v["words"][:, -1] = np.log(counts / of_class[classes(vocabulary)])
    return flat


@dataclass
class Window:
    """Some steps of the lanes that have not ended: arrays of (steps, lanes)."""

    inputs: np.ndarray
    targets: np.ndarray
    starts: np.ndarray
    document: np.ndarray  # -1 where a lane has ended


def windows(documents: Sequence[np.ndarray], start: int, steps: int, lanes: int = LANES) -> Iterator[Window]:
    """Documents side by side in lanes, ``steps`` at a time; lanes with the most words come
    first, and those that have ended are left out. Longest first, each document goes whole to
    the lane with the fewest words. The input of a word is the one before it, ``start`` for
    the first. Memory goes by the words of the documents, whatever the longest."""
    n = max(1, min(lanes, len(documents)))
    filled: list[tuple[int, int, list[int]]] = [(0, lane, []) for lane in range(n)]
    for i in sorted(range(len(documents)), key=lambda i: -len(documents[i])):
        length, lane, queue = filled[0]
        queue.append(i)
        heapq.heapreplace(filled, (length + len(documents[i]), lane, queue))
    filled.sort(key=lambda lane: -lane[0])
    order = [i for _, _, queue in filled for i in queue]
    lengths = np.array([length for length, _, _ in filled])
    begins = np.cumsum(lengths) - lengths
    targets = np.concatenate([documents[i] for i in order])
    document = np.repeat(np.array(order, np.int32), [len(documents[i]) for i in order])
    starts = np.append(True, document[1:] != document[:-1])
    inputs = np.where(starts, start, np.append(start, targets[:-1])).astype(np.int32)
    for at in range(0, int(lengths[0]), steps):
        open_ = int((lengths > at).sum())
        step = np.arange(at, min(at + steps, int(lengths[0])))[:, None]
        real = step < lengths[None, :open_]
        place = np.where(real, begins[None, :open_] + step, 0)
        yield Window(
            np.where(real, inputs[place], 0), targets[place], starts[place] & real, np.where(real, document[place], -1)
        )


def even(documents: Sequence[np.ndarray]) -> int:
    """As many lanes as all end about together, so that training does not end with windows of a
    few long documents."""
    lengths = [len(d) for d in documents]
    return max(1, min(LANES, sum(lengths) // max(lengths, default=1)))


def _run(v: dict[str, np.ndarray], inputs: np.ndarray, starts: np.ndarray, state: np.ndarray, kept: bool = True):
    """States before and after each step, gates and candidates of one window; states after
    alone, if no more is ``kept``."""
    steps, lanes = inputs.shape
    units = state.shape[1]
    after = np.empty((steps, lanes, units), np.float32)
    own = steps if kept else 1
    before, gates, candidates = (np.empty((own, lanes, units), np.float32) for _ in range(3))
    x = v["input"].take(inputs, axis=0)
    for t in range(steps):
        b, gate, candidate = before[t % own], gates[t % own], candidates[t % own]
        b[:] = state
        b[starts[t]] = 0
        a = b @ v["recurrent"]
        a += x[t]
        np.tanh(a, out=a)  # the gate's logistic function is (1 + tanh) / 2 of its half
        np.multiply(a[:, :units], 0.5, out=gate)
        gate += 0.5
        candidate[:] = a[:, units:]
        state = after[t]
        np.subtract(candidate, b, out=state)
        state *= gate
        state += b
    return before, after, gates, candidates


def _steep(weights: np.ndarray) -> bool:
    """If powers of e may not fit: states are within 1, so a logit is at most its outcome's
    weights added up."""
    return bool(np.abs(weights).sum(axis=1).max() > 60)


def _softmax(weights, steep: bool, h, targets, logp, dh, grad=None) -> None:
    """Adds the natural logarithms of the targets' probabilities to ``logp``; with ``grad`` also
    the gradient of their negative sum, to ``grad`` by weight and to ``dh`` by state. Some rows
    at a time, so that their powers of e stay in the processor's cache."""
    ones = np.ones(len(weights), np.float32)
    every = np.arange(min(ROWS, len(h)))
    for at in range(0, len(h), ROWS):
        some = slice(at, at + ROWS)
        states = h[some]
        target = (every[: len(states)], targets[some])
        p = states @ weights.T
        if steep:
            p -= p.max(axis=1)[:, None]
        logp[some] += p[target]
        np.exp(p, out=p)
        total = p @ ones
        logp[some] -= np.log(total)
        if grad is not None:
            p[target] -= total
            share = (1 / total)[:, None]
            grad += p.T @ (states * share)
            back = p @ weights[:, :-1]
            back *= share
            dh[some] += back


def _outputs(v: dict[str, np.ndarray], h: np.ndarray, targets: np.ndarray, grad: dict[str, np.ndarray] | None = None):
    """Natural logarithms of the targets' probabilities; with ``grad`` also the gradient of
    their negative sum, by state and, added to ``grad``, by parameter."""
    begins = edges(len(v["input"]))
    kind = classes(len(v["input"]))[targets]
    order = np.argsort(kind, kind="stable")  # short integers are sorted by digits
    kind, word = kind[order], targets[order]
    states = np.ones((len(h), h.shape[1] + 1), np.float32)
    states[:, :-1] = h.take(order, axis=0)
    logp, dh = np.zeros(len(h)), np.zeros(h.shape, np.float32)
    _softmax(v["classes"], _steep(v["classes"]), states, kind, logp, dh, grad and grad["classes"])
    first = np.searchsorted(kind, np.arange(len(begins)))
    steep = _steep(v["words"])
    for c in np.flatnonzero((np.diff(first) > 0) & (np.diff(begins) > 1)):
        rows, own = slice(first[c], first[c + 1]), slice(begins[c], begins[c + 1])
        of = grad and grad["words"][own]
        _softmax(v["words"][own], steep, states[rows], word[rows] - begins[c], logp[rows], dh[rows], of)
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    logp = logp[back]
    return (logp, dh.take(back, axis=0)) if grad is not None else logp


def log_likelihoods(flat: np.ndarray, vocabulary: int, documents: Sequence[np.ndarray], start: int) -> np.ndarray:
    """The natural logarithm of each whole document's probability."""
    total = np.zeros(len(documents))
    if not documents:
        return total
    v, state = views(flat, vocabulary), np.zeros((LANES, UNITS), np.float32)
    for window in windows(documents, start, SCORED):
        after = _run(v, window.inputs, window.starts, state[: window.inputs.shape[1]], kept=False)[1]
        state = after[-1]
        real = _chosen(window.document >= 0)
        logp = _outputs(v, after.reshape(-1, UNITS)[real], window.targets.ravel()[real])
        total += np.bincount(window.document.ravel()[real], logp, len(documents))
    return total


def _chosen(which: np.ndarray) -> np.ndarray | slice:
    """An index of the set places of the flattened array; all of them as a plain slice."""
    return slice(None) if which.all() else np.flatnonzero(which)


class Trainer:
    """Adam on windows of truncated backpropagation, some documents at a time."""

    def __init__(self, flat: np.ndarray, vocabulary: int):
        self.flat, self.vocabulary = flat.copy(), vocabulary
        self.mean, self.square = np.zeros_like(flat), np.zeros_like(flat)
        self.gradient, self.spare = np.zeros_like(flat), np.empty_like(flat)
        self.pending = 0
        self.updates = 0
        self.words = 0

    def learn(self, documents: Sequence[np.ndarray], start: int) -> None:
        """Documents are learned whole: a state is cleared only where one begins."""
        v = views(self.flat, self.vocabulary)
        state = np.zeros((LANES, UNITS), np.float32)
        for window in windows(documents, start, WINDOW, even(documents)):
            inputs, real = window.inputs, _chosen(window.document >= 0)
            before, after, gates, candidates = _run(v, inputs, window.starts, state[: inputs.shape[1]])
            state = after[-1]
            g = views(self.gradient, self.vocabulary)
            targets = window.targets.ravel()[real]
            _, dh = _outputs(v, after.reshape(-1, UNITS)[real], targets, g)
            above = np.zeros_like(after)
            above.reshape(-1, UNITS)[real] = dh
            da = self._back(v, above, before, gates, candidates, window.starts)
            flat_da = da.reshape(-1, da.shape[2])
            g["recurrent"] += before.reshape(-1, UNITS).T @ flat_da
            ids = inputs.ravel()
            if self.vocabulary < 1 << 15:
                ids = ids.astype(np.int16)  # sorted by digits
            order = np.argsort(ids, kind="stable")
            ids = ids[order]
            first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
            # Pairs of numbers are added up as complex ones, in half as many calls.
            pairs = np.add.reduceat(flat_da.take(order, axis=0).view(np.complex64), first)
            g["input"][ids[first]] += pairs.view(np.float32)
            self.pending += len(targets)
            if self.pending >= STEP_WORDS:
                self._update()
        if self.pending:
            self._update()

    @staticmethod
    def _back(v, above, before, gates, candidates, starts) -> np.ndarray:
        units = above.shape[2]
        of_gate = 2 * (candidates - before) * gates * (1 - gates)
        of_candidate = gates * (1 - candidates * candidates)
        stays = 1 - gates
        da = np.empty((*above.shape[:2], 2 * units), np.float32)
        turned = np.ascontiguousarray(v["recurrent"].T)
        carried = np.zeros_like(above[0])
        for t in reversed(range(len(above))):
            carried += above[t]
            np.multiply(carried, of_gate[t], out=da[t, :, :units])
            np.multiply(carried, of_candidate[t], out=da[t, :, units:])
            carried *= stays[t]
            carried += da[t] @ turned
            carried[starts[t]] = 0
        return da

    def _update(self) -> None:
        """One step by the gradients added up; a shorter one for fewer words."""
        words, gradient, step = self.pending, self.gradient, self.spare
        gradient /= words
        gradient *= min(1.0, STEEPEST / (float(np.sqrt(gradient @ gradient)) + 1e-9))
        self.words += words
        self.updates += 1
        np.multiply(gradient, gradient, out=step)
        step -= self.square
        step *= 0.01
        self.square += step
        gradient -= self.mean
        gradient *= 0.1
        self.mean += gradient
        np.multiply(self.square, 1 / (1 - 0.99**self.updates), out=step)
        np.sqrt(step, out=step)
        step += 1e-6
        np.divide(self.mean, step, out=step)
        step *= min(1.0, words / STEP_WORDS) * RATE / (1 - 0.9**self.updates)
        self.flat -= step
        gradient[:] = 0
        self.pending = 0


def chunks(flat: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray]]:
    for i in range(0, len(flat), length):
        yield i // length, flat[i : i + length]

"""A gated recurrent model of sequences of small class numbers, in numpy: training and scoring of one task's share."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

#: Steps of a window: gradients stop at its start, the state does not.
WINDOW = 32
#: Logits below this in size need no shift before they are exponentiated in single precision.
LARGEST_LOGIT = 80.0
#: Rows of logits, and documents that are scored side by side: as many as stay in a core's cache.
ROWS, BESIDE = 1 << 10, 1 << 9

Weights = dict[str, np.ndarray]


def initial(classes: int, hidden: int, seed: int) -> Weights:
    """Random weights: the gates' inputs by class (update, reset, candidate), their recurrent parts, and the softmax."""
    rng = np.random.default_rng(seed)
    scale = hidden**-0.5
    return {
        "input": rng.normal(0, 0.1, (classes, 3 * hidden)).astype(np.float32),
        "gates": rng.normal(0, scale, (hidden, 2 * hidden)).astype(np.float32),
        "candidate": rng.normal(0, scale, (hidden, hidden)).astype(np.float32),
        "output": rng.normal(0, scale, (hidden, classes)).astype(np.float32),
        "bias": np.zeros(classes, np.float32),
    }


def _sigmoid_of_half(x: np.ndarray) -> None:
    """The logistic function of twice the values, in place."""
    np.tanh(x, out=x)
    x += 1
    x *= 0.5


def _split(weights: Weights) -> tuple[np.ndarray, np.ndarray]:
    """The inputs' part by class and the recurrent part of the gates, as stacks (update, reset, for inputs candidate too).

    So every gate is one block of memory.  The gates' parts are halved, which is exact: the logistic function halves what it is given.
    """
    given, gates = (np.stack(np.split(weights[n], k, axis=1)) for n, k in (("input", 3), ("gates", 2)))
    given[:2] *= 0.5
    gates *= 0.5
    return given, gates


def step(weights: Weights, state: np.ndarray, inputs: np.ndarray, split: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, ...]:
    """The next state, and the gates that made it, for a batch of states and class numbers; ``split`` is that of the weights."""
    by_class, recurrent = split or _split(weights)
    given = np.take(by_class, inputs, axis=1, mode="clip")
    gates = np.matmul(state, recurrent)
    gates += given[:2]
    _sigmoid_of_half(gates)
    update, reset = gates
    candidate = (reset * state) @ weights["candidate"]
    candidate += given[2]
    np.tanh(candidate, out=candidate)
    after = candidate - state
    after *= update
    after += state
    return after, update, reset, candidate


def _unshifted(weights: Weights) -> bool:
    """Whether no state can give a logit whose exponential leaves the range of the numbers: states are within -1 and 1."""
    bound = np.abs(weights["output"]).sum(axis=0) + np.abs(weights["bias"])
    return float(bound.max(initial=0)) < LARGEST_LOGIT


def _widened(weights: Weights) -> np.ndarray:
    """The softmax's weights with the bias as one more row, for states with a column of ones."""
    return np.vstack([weights["output"], weights["bias"]])


def _logits(states: np.ndarray, output: np.ndarray, unshifted: bool, out: np.ndarray) -> np.ndarray:
    """Logits of widened states, up to a term per row that makes their exponentials safe."""
    logits = np.matmul(states, output, out=out)
    if not unshifted:
        logits -= logits.max(axis=1, keepdims=True)
    return logits


def log_softmax(weights: Weights, states: np.ndarray) -> np.ndarray:
    logits = states @ weights["output"]
    logits += weights["bias"]
    logits -= logits.max(axis=1, keepdims=True)
    logits -= np.log(np.exp(logits).sum(axis=1, keepdims=True))
    return logits


def _room(weights: Weights, steps: int, streams: int) -> Weights:
    """The large arrays of a window's gradient.  A window is over before the next one, so all windows of a run share them."""
    hidden, classes = weights["output"].shape
    shapes = {name: (steps, streams, hidden) for name in ("befores", "mixed", "candidates", "rises", "d_states", "d_candidates")}
    shapes |= {"given": (3, steps, streams, hidden), "gates": (2, steps, streams, hidden), "slopes": (2, steps, streams, hidden)}
    shapes |= {"states": (steps, streams, hidden + 1), "shared": (steps, streams, hidden + 1)}
    shapes |= {"d_gates": (steps, streams, 2 * hidden), "wide": (steps, streams, classes)}
    room = {name: np.empty(shape, weights["output"].dtype) for name, shape in shapes.items()}
    room["states"][:, :, hidden] = 1
    return room


def _summed_by_class(inputs: np.ndarray, parts: list[np.ndarray], out: np.ndarray) -> np.ndarray:
    """The rows of the parts, side by side, added up by class: in the order of their classes, cut where the class changes."""
    order = np.argsort(inputs, axis=None, kind="stable")
    ordered = inputs.ravel()[order]
    opens = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    out[ordered[opens]] = np.concatenate([np.add.reduceat(np.take(p, order, axis=0, mode="clip"), opens, axis=0) for p in parts], axis=1)
    return out


def _window_gradient(
    weights: Weights, state: np.ndarray, inputs: np.ndarray, targets: np.ndarray, alive: np.ndarray, room: Weights | None = None
):
    """Loss, gradient and last state of one window (steps x streams); gradients do not pass its start.

    ``alive`` is 0 where a step starts a document: the state before it is emptied.
    ``room`` is what :func:`_room` made for windows of this size.
    """
    steps, streams = inputs.shape
    h = state.shape[1]
    kind = state.dtype
    room = room or _room(weights, steps, streams)
    given, gates, befores, mixed, candidates, states = (
        room[name] for name in ("given", "gates", "befores", "mixed", "candidates", "states")
    )
    by_class, recurrent = _split(weights)
    np.take(by_class, inputs, axis=1, out=given, mode="clip")
    for t in range(steps):
        before, gate, candidate = np.multiply(state, alive[t][:, None], out=befores[t]), gates[:, t], candidates[t]
        np.matmul(before, recurrent, out=gate)
        gate += given[:2, t]
        _sigmoid_of_half(gate)
        np.matmul(np.multiply(gate[1], before, out=mixed[t]), weights["candidate"], out=candidate)
        candidate += given[2, t]
        np.tanh(candidate, out=candidate)
        state = candidate - before
        state *= gate[0]
        state += before
        states[t, :, :h] = state
    flat, wide, d_states = (room[name].reshape(steps * streams, -1) for name in ("states", "wide", "d_states"))
    output, back_output = _widened(weights), weights["output"].T
    unshifted, ones = _unshifted(weights), np.ones(wide.shape[1], kind)
    wanted = targets.ravel()
    share, loss = np.empty((len(flat), 1), kind), 0.0
    for first in range(0, len(flat), ROWS):
        rows = slice(first, first + ROWS)
        part, aims = wide[rows], wanted[rows]
        at = np.arange(len(part))
        _logits(flat[rows], output, unshifted, part)
        np.exp(part, out=part)
        total = part @ ones
        loss -= float(np.log(np.maximum(part[at, aims] / total, 1e-30)).sum())
        # the factor 1 / total of every row is put on the narrow sides of the products
        part[at, aims] -= total
        share[rows, 0] = 1 / (total * len(wanted))
        np.matmul(part, back_output, out=d_states[rows])
        d_states[rows] *= share[rows]
    loss /= len(wanted)
    d_output = np.multiply(flat, share, out=room["shared"].reshape(flat.shape)).T @ wide
    d_states, d_gates, d_candidates = room["d_states"], room["d_gates"], room["d_candidates"]
    back_gates, back_candidate = weights["gates"].T.copy(), weights["candidate"].T.copy()
    # slopes of the gates and of the candidate, for all steps at once
    slopes, rises = np.subtract(1, gates, out=room["slopes"]), np.multiply(candidates, candidates, out=room["rises"])
    slopes *= gates
    np.subtract(1, rises, out=rises)
    d_next = np.zeros_like(state)
    moved, d_mixed, through, back = (np.empty_like(state) for _ in range(4))
    for t in reversed(range(steps)):
        before, d_gate = befores[t], d_gates[t]
        d_state = np.add(d_states[t], d_next, out=d_next)
        np.multiply(d_state, gates[0, t], out=moved)
        np.matmul(np.multiply(moved, rises[t], out=d_candidates[t]), back_candidate, out=d_mixed)
        np.multiply(d_mixed, before, out=through)
        np.multiply(through, slopes[1, t], out=d_gate[:, h:])
        np.subtract(candidates[t], before, out=through)
        through *= d_state
        np.multiply(through, slopes[0, t], out=d_gate[:, :h])
        d_state -= moved
        d_mixed *= gates[1, t]
        d_state += d_mixed
        d_state += np.matmul(d_gate, back_gates, out=back)
        d_state *= alive[t][:, None]
    d_gates, d_candidates = d_gates.reshape(-1, 2 * h), d_candidates.reshape(-1, h)
    gradient = {
        "input": _summed_by_class(inputs, [d_gates, d_candidates], np.zeros_like(weights["input"])),
        "gates": befores.reshape(-1, h).T @ d_gates,
        "candidate": mixed.reshape(-1, h).T @ d_candidates,
        "output": d_output[:h],
        "bias": d_output[h],
    }
    return loss, gradient, state


class Trainer:
    """Adam on a copy of weights, fed with sequences of documents by truncated backpropagation through time."""

    def __init__(self, weights: Weights):
        self.weights = {n: w.copy() for n, w in weights.items()}
        self.first, self.second = ({n: np.zeros_like(w) for n, w in weights.items()} for _ in range(2))
        self.done = 0

    def update(self, gradient: Weights, pace: float) -> None:
        norm = np.sqrt(sum(float((g**2).sum()) for g in gradient.values()))
        self.done += 1
        for name, g in gradient.items():
            g = g * min(1.0, 1.0 / max(norm, 1e-9))
            self.first[name] += 0.1 * (g - self.first[name])
            self.second[name] += 0.01 * (g * g - self.second[name])
            a, b = self.first[name] / (1 - 0.9**self.done), self.second[name] / (1 - 0.99**self.done)
            self.weights[name] -= pace * a / (np.sqrt(b) + 1e-8)

    def run(self, sequence: np.ndarray, streams: int, begin: float, end: float) -> None:
        """One pass over documents laid end to end (class numbers, each document ending in class 0), at a rate from ``begin`` to ``end``.

        The sequence is cut into parallel streams, whose state goes on from window
        to window and is emptied between documents.  Every token is a target; the
        last stream is filled up from the start of the sequence.
        """
        total = len(sequence)
        streams = max(1, min(streams, total))
        length = -(-total // streams)
        line = np.resize(sequence, streams * length)
        previous = np.r_[np.zeros(1, line.dtype), line[:-1]].reshape(streams, length).T
        line = line.reshape(streams, length).T
        state = np.zeros((streams, self.weights["gates"].shape[0]), np.float32)
        room = _room(self.weights, WINDOW, streams) if length >= WINDOW else None
        for first in range(0, length, WINDOW):
            rows = slice(first, first + WINDOW)
            alive = (previous[rows] != 0).astype(np.float32)
            _, gradient, state = _window_gradient(self.weights, state, previous[rows], line[rows], alive, room if len(alive) == WINDOW else None)
            self.update(gradient, begin + (end - begin) * first / length)


def train(documents: Sequence[np.ndarray], classes: int, hidden: int = 32, streams: int = 64, epochs: int = 3,
          rate: float = 0.01, seed: int = 1) -> Weights:
    """Weights fitted by truncated backpropagation through time and Adam.

    Documents (class numbers, each ending in class 0) are laid end to end into
    parallel streams.  The state goes on from window to window and is emptied
    between documents.
    """
    trainer = Trainer(initial(classes, hidden, seed))
    rng = np.random.default_rng(seed)
    total = sum(map(len, documents))
    if not total:
        return trainer.weights
    streams = max(1, min(streams, total // (4 * WINDOW)))
    for epoch in range(epochs):
        sequence = np.concatenate([documents[i] for i in rng.permutation(len(documents))])
        trainer.run(sequence, streams, rate * (1 - epoch / epochs), rate * (1 - (epoch + 1) / epochs))
    return trainer.weights


def packed(weights: Weights) -> np.ndarray:
    """All weights as one vector."""
    return np.concatenate([w.ravel() for w in weights.values()])


def unpacked(vector: np.ndarray, like: Weights) -> Weights:
    """The weights of a vector of :func:`packed`, in the shapes of ``like``."""
    ends = np.cumsum([w.size for w in like.values()])
    return {n: v.reshape(w.shape) for (n, w), v in zip(like.items(), np.split(vector, ends[:-1]))}


def score(weights: Weights, tokens: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Log probability (natural) of every document's classes.

    ``tokens`` holds the documents end to end.  Documents of like length advance
    together, longest first, window by window; each keeps its state until its last token.
    """
    starts = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    total = np.zeros(len(lengths))
    for first in range(0, len(order), BESIDE):
        some = order[first : first + BESIDE]
        total[some] = _side_by_side(weights, tokens, starts[some], lengths[some])
    return total


def _side_by_side(weights: Weights, tokens: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """:func:`score` of documents in the order of falling length, which are read from ``starts`` on."""
    output, unshifted, h = _widened(weights), _unshifted(weights), weights["gates"].shape[0]
    kind = output.dtype
    total = np.zeros(len(lengths))
    state, previous = np.zeros((len(lengths), h), np.float32), np.zeros(len(lengths), np.int64)
    ones, room = np.ones(output.shape[1], kind), np.empty((ROWS, output.shape[1]), kind)
    flat = np.ones((len(lengths) * WINDOW, h + 1), kind)
    wanted, owner = np.empty(len(flat), np.int64), np.empty(len(flat), np.int64)
    everyone, split = np.arange(len(lengths)), _split(weights)
    for begin in range(0, int(lengths.max(initial=0)), WINDOW):
        active = int(np.searchsorted(-lengths, -begin, "left"))
        here = np.minimum(lengths[:active] - begin, WINDOW)
        places = starts[:active] + begin
        current, inputs, filled = state[:active], previous[:active], 0
        for t in range(int(here[0])):
            n = int(np.searchsorted(-here, -t, "left"))
            current = step(weights, current[:n], inputs[:n], split)[0]
            inputs = tokens[places[:n] + t]
            rows = slice(filled, filled + n)
            flat[rows, :h], wanted[rows], owner[rows] = current, inputs, everyone[:n]
            filled += n
        state, previous = current, inputs
        for first in range(0, filled, ROWS):
            part = slice(first, min(first + ROWS, filled))
            wide = _logits(flat[part], output, unshifted, room[: part.stop - first])
            found = wide[np.arange(len(wide)), wanted[part]]
            found -= np.log(np.exp(wide, out=wide) @ ones)
            total += np.bincount(owner[part], weights=found, minlength=len(total))
    return total

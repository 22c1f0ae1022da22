"""A gated recurrent language model in numpy, with an output softmax factored by classes.

A token is one of some types; each type belongs to one class. The model gives the class of the
next token from its state, and the type within the class from the state again, so that a step
costs two short softmaxes and not one over all types. Classes after the first `heads` have one
type each. Training is truncated backpropagation through time: windows of a few tokens, with
the state, but no gradient, carried from one to the next.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: The type that ends a document, and is fed in before its first token.
END = 0

F32 = np.float32
#: Tokens whose softmax is computed at a time, so that it stays in the processor's cache.
BLOCK = 2048
#: Logits of at most so much, up or down, are not shifted: sums of their exps fit in 32 bits.
SAFE = 60
#: Rows of one type that are added at once.
FEW = 16


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    x *= F32(0.5)
    np.tanh(x, out=x)
    x *= F32(0.5)
    x += F32(0.5)
    return x


def _limit(weights: np.ndarray) -> float:
    """What no logit exceeds, up or down: states and the one for the bias are from -1 to 1."""
    return float(np.abs(weights).sum(axis=-1).max(initial=0))


def _exps(logits: np.ndarray) -> np.ndarray:
    """Sums of the exps of each column; logits become exps in place."""
    np.exp(logits, out=logits)
    return logits.sum(axis=0)


def _chosen(logits: np.ndarray, aims: np.ndarray) -> np.ndarray:
    """Log-probability of one of the rows for each column; logits are overwritten."""
    found = logits[aims, np.arange(len(aims))]
    return found - np.log(_exps(logits))


def _off(logits: np.ndarray, aims: np.ndarray, scale: np.floating) -> None:
    """Logits become their gradients in place: how far probabilities are off, by `scale`."""
    logits *= scale / _exps(logits)
    logits[aims, np.arange(len(aims))] -= scale


def _order(types: np.ndarray) -> np.ndarray:
    """Places by type or class; those have 16 bits, which sort fast."""
    return np.argsort(types.astype(np.uint16), kind="stable")


def _row_sums(values: np.ndarray, types: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct types, and the sum of the rows of each.

    Stretches of up to FEW rows of one type are added at once, one row of each at a time; then
    their sums in the same way, until each type has one.
    """
    place = _order(types)
    kinds = types[place]
    first = np.flatnonzero(np.diff(kinds, prepend=-1))
    distinct = kinds[first]
    while True:
        sizes = np.diff(first, append=len(place))
        parts = -(-sizes // FEW)
        owner, starts = np.repeat(np.arange(len(first)), parts), np.cumsum(parts) - parts
        done = FEW * (np.arange(len(owner)) - starts[owner])
        size = np.minimum(sizes[owner] - done, FEW)
        # Longest first, so that those with a row left are in front.
        by = np.argsort((FEW - size).astype(np.uint16), kind="stable")
        begin = (first[owner] + done)[by]
        left = len(by) - np.cumsum(np.bincount(size, minlength=FEW + 1))
        total = values.take(place[begin], axis=0)
        for j in range(1, FEW):
            m = left[j]
            total[:m] += values.take(place[begin[:m] + j], axis=0)
        values = np.empty_like(total)
        values[by] = total
        if len(owner) == len(first):
            return distinct, values
        place, first = np.arange(len(values)), starts


@dataclass
class GatedLM:
    """members: types of a head class. Type t below heads * members is in class t // members."""

    heads: int
    members: int
    rows: np.ndarray  # types x 3H: gates update, reset; candidate
    gates: np.ndarray  # H x 2H
    candidate: np.ndarray  # H x H
    classes: np.ndarray  # H x C
    class_bias: np.ndarray  # C
    within: np.ndarray  # heads x members x H
    within_bias: np.ndarray  # heads x members

    @classmethod
    def new(cls, heads: int, members: int, singles: int, hidden: int, rng) -> GatedLM:
        def normal(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(F32)

        types, count = heads * members + singles, heads + singles
        return cls(
            heads,
            members,
            normal(types, 3 * hidden, scale=0.2),
            normal(hidden, 2 * hidden, scale=0.15),
            normal(hidden, hidden, scale=0.15),
            normal(hidden, count, scale=0.1),
            np.zeros(count, F32),
            normal(heads, members, hidden, scale=0.1),
            np.zeros((heads, members), F32),
        )

    @property
    def hidden(self) -> int:
        return self.gates.shape[0]

    def class_of(self, types: np.ndarray) -> np.ndarray:
        head = self.heads * self.members
        return np.where(types < head, types // self.members, self.heads + types - head)

    def step(self, fed: np.ndarray, h: np.ndarray, zr: np.ndarray, c: np.ndarray) -> np.ndarray:
        """The next state; gates go to zr and the candidate to c, for backpropagation.

        All update gates come first in zr, then all reset gates: rows that lie together are fast.
        """
        size = self.hidden
        a = self.rows.take(fed, axis=0)
        z, r = zr.reshape(2, *h.shape)
        np.matmul(h, self.gates[:, :size], out=z)
        np.matmul(h, self.gates[:, size:], out=r)
        z += a[:, :size]
        r += a[:, size : 2 * size]
        _sigmoid(zr)
        np.matmul(r * h, self.candidate, out=c)
        c += a[:, 2 * size :]
        np.tanh(c, out=c)
        after = c - h
        after *= z
        after += h
        return after

    def _outputs(self) -> tuple[np.ndarray, np.ndarray]:
        """Weights of classes and of members, with their biases as the last column."""
        classes = np.concatenate([self.classes.T, self.class_bias[:, None]], axis=1)
        return classes, np.concatenate([self.within, self.within_bias[:, :, None]], axis=2)

    def _softmaxes(self, states: np.ndarray, targets: np.ndarray, outputs) -> Iterator[tuple]:
        """Places of some tokens in order of their classes, so that those of a class are a stretch.

        And their states, with a one for the bias; logits of classes, a column for each, and the
        class that is meant; stretches of head classes; logits within these, and the member.
        """
        classes, within = outputs
        shifted, shifted_within = (not _limit(w) <= SAFE for w in outputs)
        kinds = self.class_of(targets)
        order = _order(kinds)
        for first in range(0, len(order), BLOCK):
            part = order[first : first + BLOCK]
            own = kinds[part]
            some = np.ones((len(part), self.hidden + 1), states.dtype)
            some[:, :-1] = states.take(part, axis=0)
            logits = classes @ some.T
            if shifted:
                logits -= logits.max(axis=0)
            bounds = np.searchsorted(own, np.arange(self.heads + 1)).tolist()
            stretches = [(k, a, b) for k, (a, b) in enumerate(zip(bounds, bounds[1:])) if a < b]
            inside = np.empty((self.members, bounds[-1]), logits.dtype)
            for k, a, b in stretches:
                np.matmul(within[k], some[a:b].T, out=inside[:, a:b])
            if shifted_within and stretches:
                inside -= inside.max(axis=0)
            member = targets[part[: bounds[-1]]] - own[: bounds[-1]] * self.members
            yield part, some, logits, own, stretches, inside, member

    def log_probs(self, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Natural log-probability of each target type given the state before it."""
        found = np.empty(len(targets))
        for part, _, logits, own, _, inside, member in self._softmaxes(states, targets, self._outputs()):
            logs = _chosen(logits, own)
            logs[: len(member)] += _chosen(inside, member)
            found[part] = logs
        return found

    def score(self, documents: list[np.ndarray], window: int = 64, width: int = 1024) -> np.ndarray:
        """Natural log-probability of each document, a sequence of types that ends with END.

        Documents are read side by side, longest first; those that have ended drop out. The
        state is carried from window to window up to the end of each document.
        """
        total = np.zeros(len(documents))
        order = sorted(range(len(documents)), key=lambda i: -len(documents[i]))
        for at in range(0, len(order), width):
            some = order[at : at + width]
            sizes = np.array([len(documents[i]) for i in some])
            h = np.zeros((len(some), self.hidden), F32)
            zr, c = np.empty((len(some), 2 * self.hidden), F32), np.empty_like(h)
            sums = np.zeros(len(some))
            fed = np.full(len(some), END)
            for first in range(0, int(sizes[0]), window):
                live = int(np.searchsorted(-sizes, -first, side="left"))
                steps = min(window, int(sizes[0]) - first)
                block = np.zeros((steps, live), np.int64)
                for j, i in enumerate(some[:live]):
                    part = documents[i][first : first + steps]
                    block[: len(part), j] = part
                # How many documents are left at each step of the window.
                left = np.searchsorted(-sizes[:live], -(first + np.arange(steps)), side="left")
                begins = np.cumsum(left) - left
                states = np.empty((int(left.sum()), self.hidden), F32)
                targets = np.empty(len(states), np.int64)
                for t, (n, begin) in enumerate(zip(left.tolist(), begins.tolist())):
                    h = self.step(fed[:n], h[:n], zr[:n], c[:n])
                    fed = block[t, :n]
                    states[begin : begin + n], targets[begin : begin + n] = h, fed
                owners = np.arange(len(states)) - np.repeat(begins, left)
                found = self.log_probs(states, targets)
                sums += np.bincount(owners, found, minlength=len(some))
            total[some] = sums
        return total

    def learn(self, fed: np.ndarray, targets: np.ndarray, h: np.ndarray):
        """Gradients of the mean loss over one window (T, B), and the state after it.

        A stream's state starts anew where END is fed in. Gradients of rows come as a pair, the
        types that were fed in and what to add for each; the others as `weights` lists them.
        """
        steps, width = fed.shape
        size, count = self.hidden, steps * width
        at, which = np.nonzero(fed == END)
        ended = np.split(which, np.searchsorted(at, np.arange(1, steps)))
        before, states, c = (np.empty((steps, width, size), F32) for _ in range(3))
        zr = np.empty((steps, width, 2 * size), F32)
        for t in range(steps):
            before[t] = h
            if len(ended[t]):
                before[t, ended[t]] = 0
            states[t] = h = self.step(fed[t], before[t], zr[t], c[t])
        outputs = self._outputs()
        g_classes, g_within = map(np.zeros_like, outputs)
        d_flat, scale = np.empty((count, size), F32), F32(1 / count)
        tokens = states.reshape(count, size), targets.reshape(count)
        for part, some, probs, own, stretches, inside, member in self._softmaxes(*tokens, outputs):
            _off(probs, own, scale)
            g_classes += probs @ some
            d_some = probs.T @ self.classes.T
            _off(inside, member, scale)
            for k, first, last in stretches:
                g_within[k] += inside[:, first:last] @ some[first:last]
                d_some[first:last] += inside[:, first:last].T @ self.within[k]
            d_flat[part] = d_some
        # In place: gates become the factors that carry a gradient to them.
        z, r = zr.reshape(steps, 2, width, size).swapaxes(0, 1)
        reset = r * before
        stays = 1 - z
        into_c = z * (1 - c * c)
        into_z = c
        into_z -= before
        into_z *= z
        into_z *= stays
        into_r = reset * (1 - r)
        d_rows = np.empty((steps, width, 3 * size), F32)
        d_states, dh = d_flat.reshape(steps, width, size), np.zeros((width, size), F32)
        back_candidate, back_gates = self.candidate.T.copy(), self.gates.T.copy()
        for t in range(steps - 1, -1, -1):
            dh += d_states[t]
            now = d_rows[t]
            dc = dh * into_c[t]
            now[:, 2 * size :] = dc
            into = dc @ back_candidate
            np.multiply(dh, into_z[t], out=now[:, :size])
            np.multiply(into, into_r[t], out=now[:, size : 2 * size])
            dh *= stays[t]
            into *= r[t]
            dh += into
            dh += now[:, : 2 * size] @ back_gates
            if len(ended[t]):
                dh[ended[t]] = 0
        d_rows = d_rows.reshape(count, 3 * size)
        g_gates = before.reshape(count, size).T @ d_rows[:, : 2 * size]
        g_candidate = reset.reshape(count, size).T @ d_rows[:, 2 * size :]
        g_rows = _row_sums(d_rows, fed.reshape(count))
        gradients = [g_gates, g_candidate, g_classes[:, :-1].T, g_classes[:, -1]]
        gradients += [g_within[:, :, :-1], g_within[:, :, -1]]
        return g_rows, gradients, h

    def flat(self) -> np.ndarray:
        """All weights in one row."""
        return np.concatenate([w.ravel() for w in self.weights()])

    def filled(self, flat: np.ndarray) -> GatedLM:
        """A model of this shape with other weights."""
        ends = np.cumsum([w.size for w in self.weights()])
        parts = np.split(flat.astype(F32), ends[:-1])
        shaped = [p.reshape(w.shape) for p, w in zip(parts, self.weights())]
        return GatedLM(self.heads, self.members, *shaped)

    def weights(self) -> list[np.ndarray]:
        return [
            self.rows,
            self.gates,
            self.candidate,
            self.classes,
            self.class_bias,
            self.within,
            self.within_bias,
        ]


def started(frequencies: np.ndarray, heads: int, members: int, hidden=32, seed=11) -> GatedLM:
    """Untrained but for its biases: the frequencies of types, each seen once more than it is."""
    singles = len(frequencies) - heads * members
    model = GatedLM.new(heads, members, singles, hidden, np.random.default_rng(seed))
    kinds = model.class_of(np.arange(len(frequencies)))
    shares = np.bincount(kinds, frequencies, heads + singles) + 1.0
    model.class_bias += np.log(shares / shares.sum()).astype(F32)
    inside = frequencies[: heads * members] + 1.0
    model.within_bias += np.log(inside.reshape(heads, members)).astype(F32)
    return model


def in_streams(documents: list[np.ndarray], window: int) -> tuple[np.ndarray, np.ndarray]:
    """What is fed in and its targets, (T, B): documents end to end, cut into parallel streams.

    Every token is a target; the last stream is filled up with the first tokens again.
    """
    tokens = np.concatenate([np.array([END]), *documents]).astype(np.int64)
    count = len(tokens) - 1
    # Many streams are fast, but make few steps.
    streams = int(np.clip(count // (200 * window), 16, 256))
    length = -(-count // streams)
    fed, aims = (np.resize(x, (streams, length)).T for x in (tokens[:-1], tokens[1:]))
    return np.ascontiguousarray(fed), np.ascontiguousarray(aims)


def teach(
    model: GatedLM,
    documents: list[np.ndarray],
    rates: tuple[float, float],
    passes: int = 1,
    window: int = 24,
) -> None:
    """Adam over whole documents, each ended by END; the rate goes from one to the other."""
    if not documents:
        return
    fed, aims = in_streams(documents, window)
    weights = model.weights()
    first_moments, second_moments, room = ([np.zeros_like(w) for w in weights] for _ in range(3))
    steps, step = passes * -(-len(fed) // window), 0
    for _ in range(passes):
        h = np.zeros((fed.shape[1], model.hidden), F32)
        for first in range(0, len(fed), window):
            step += 1
            part = slice(first, first + window)
            (rows, g_rows), gradients, h = model.learn(fed[part], aims[part], h)
            norm = np.sqrt(sum(float(np.vdot(g, g)) for g in (g_rows, *gradients)))
            scale = F32(min(1.0, 1.0 / max(norm, 1e-9)))
            rate = rates[0] + (rates[1] - rates[0]) * step / (steps + 1)
            rate = F32(rate * np.sqrt(1 - 0.995**step) / (1 - 0.9**step))
            for k, (w, m, v, x) in enumerate(zip(weights, first_moments, second_moments, room)):
                m *= F32(0.9)
                v *= F32(0.995)
                if k == 0:
                    # Only rows that were fed in have gradients; moments of the others fade.
                    g_rows *= scale
                    m[rows] += F32(0.1) * g_rows
                    v[rows] += F32(0.005) * g_rows * g_rows
                else:
                    g = gradients[k - 1]
                    m += np.multiply(g, F32(0.1) * scale, out=x)
                    np.multiply(g, g, out=x)
                    x *= F32(0.005) * scale * scale
                    v += x
                np.sqrt(v, out=x)
                x += F32(1e-8)
                np.divide(m, x, out=x)
                x *= rate
                w -= x

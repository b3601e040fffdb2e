"""A small causal self-attention model in numpy.

Tokens are known by their class. A window holds ``BEFORE`` tokens of context and
``SCORED`` tokens; each of the latter attends to all tokens up to itself, and
predicts the class of the next one. Windows overlap by the context, so that each
token is predicted once, with at least ``BEFORE`` tokens of context where the
text has so many. Padding before a text is masked.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from numpy.lib.stride_tricks import sliding_window_view

BEFORE, SCORED = 16, 16
WINDOW = BEFORE + SCORED
WIDTH = 16
_LOWEST = np.float32(-1e9)
#: Query i stands at place BEFORE + i and sees the places up to it.
MASK = np.where(
    np.arange(WINDOW)[None, :] <= BEFORE + np.arange(SCORED)[:, None], 0, _LOWEST
).astype(np.float32)


def windows(classes: np.ndarray, start: int, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Inputs (n x WINDOW) and targets (n x SCORED) of one text; -1 marks no target."""
    n = -(-len(classes) // SCORED)
    inputs = np.full(BEFORE + n * SCORED, pad, dtype=classes.dtype)
    inputs[BEFORE] = start
    inputs[BEFORE + 1 : BEFORE + len(classes)] = classes[:-1]
    targets = np.full(n * SCORED, -1, dtype=np.result_type(classes.dtype, np.int8))
    targets[: len(classes)] = classes
    return sliding_window_view(inputs, WINDOW)[::SCORED], targets.reshape(n, SCORED)


def _powers(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """e to the power of ``rows`` and its sums by row.

    Where sums are extreme, the largest of each row is taken off ``rows`` first, in place.
    """
    ones = np.ones(rows.shape[-1], rows.dtype)
    with np.errstate(over="ignore"):
        powers = np.exp(rows)
        sums = powers @ ones
    if sums.size and not (sums.min() > 1e-20 and sums.max() < 1e25):
        rows -= rows.max(axis=-1, keepdims=True)
        powers = np.exp(rows)
        sums = powers @ ones
    return powers, sums


class _ByClass:
    """Sums of rows by the class of their token; classes in one byte sort fastest."""

    def __init__(self, inputs: np.ndarray, classes: int):
        inputs = inputs.ravel()
        self._order = np.argsort(inputs, kind="stable")
        counts = np.bincount(inputs, minlength=classes)
        self._found = np.flatnonzero(counts)
        self._starts = (np.cumsum(counts) - counts)[self._found]
        self._classes = classes

    def sums(self, rows: np.ndarray) -> np.ndarray:
        in_order = rows.reshape(-1, WIDTH).take(self._order, axis=0)
        found = np.zeros((self._classes, WIDTH), rows.dtype)
        found[self._found] = np.add.reduceat(in_order, self._starts, axis=0)
        return found


def keep_room() -> None:
    """Free a large block, after which glibc keeps the memory of smaller ones.

    Otherwise each step gives its arrays back and takes new pages for the next.
    """
    np.empty(8_000_000, np.uint8)


@dataclass
class Attention:
    """Parameters; ``classes`` predicted ones, then one that starts a text and padding."""

    classes: int
    p: dict[str, np.ndarray]

    @staticmethod
    def new(classes: int, seed: int = 13) -> Attention:
        rng = np.random.default_rng(seed)

        def normal(*shape: int, by: float = 0.2) -> np.ndarray:
            return rng.normal(0, by, shape).astype(np.float32)

        return Attention(
            classes,
            {
                "embed": normal(classes + 2, WIDTH, by=0.5),
                "place_q": normal(SCORED, WIDTH),
                "place_k": normal(WINDOW, WIDTH),
                "q": normal(WIDTH, WIDTH),
                "k": normal(WIDTH, WIDTH),
                "v": normal(WIDTH, WIDTH),
                "own": normal(WIDTH, WIDTH),
                "out": normal(WIDTH, classes),
                "bias": np.zeros(classes, dtype=np.float32),
            },
        )

    def gradients(self, inputs: np.ndarray, targets: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss, in nats, and the slope of each parameter.

        Tokens of one class have one embedding, so slopes are summed by class before
        they are multiplied.
        """
        p, b, kind = self.p, len(inputs), self.p["embed"].dtype
        tables = self.tables()
        q, k, v, weights, total, mixed, hidden = tables.hidden(inputs)
        chance, sums = _powers(tables.logits(hidden))

        wanted = targets.ravel()
        real = np.flatnonzero(wanted >= 0)
        n = max(len(real), 1)
        places = real * self.classes + wanted[real]
        picked = chance.ravel()[places]
        loss = float(-np.log(picked / sums[real] + 1e-12).sum() / n)
        # Chances stay multiples of their sums, which are divided out of narrower rows.
        chance.ravel()[places] = picked - sums[real]
        scale = np.zeros(len(wanted), kind)
        scale[real] = 1 / (sums[real] * kind.type(n))
        g = {"out": (chance.T @ (hidden * scale[:, None])).T, "bias": scale @ chance}
        dsum = chance @ p["out"].T
        dsum *= scale[:, None]
        dsum *= 1 - hidden * hidden
        dsum = dsum.reshape(b, SCORED, WIDTH)
        dmixed = dsum / total[:, :, None]
        dscores = dmixed @ v.transpose(0, 2, 1)
        dscores -= np.einsum("bid,bid->bi", dmixed, mixed)[:, :, None]
        dscores *= weights
        dq, dk = dscores @ k, dscores.transpose(0, 2, 1) @ q
        dq /= kind.type(np.sqrt(WIDTH))
        dv = weights.transpose(0, 2, 1) @ dmixed

        ones = np.ones(b, kind)
        by_query = _ByClass(inputs[:, BEFORE:], self.classes + 2)
        by_key = _ByClass(inputs, self.classes + 2)
        g["embed"] = np.zeros_like(p["embed"])
        for name, rows, by, place in (
            ("q", dq, by_query, "place_q"),
            ("own", dsum, by_query, "place_q"),
            ("k", dk, by_key, "place_k"),
            ("v", dv, by_key, None),
        ):
            by_class = by.sums(rows)
            g["embed"] += by_class @ p[name].T
            g[name] = p["embed"].T @ by_class
            if place:
                by_place = (ones @ rows.reshape(b, -1)).reshape(-1, WIDTH)
                g[name] += p[place].T @ by_place
                g[place] = g.get(place, 0) + by_place @ p[name].T
        return loss, g

    def train(
        self,
        inputs: np.ndarray,
        targets: np.ndarray,
        steps: int,
        seed: int = 3,
        batch: int = 96,
        begin: float = 0.0,
        end: float = 1.0,
    ) -> None:
        """Adam over the windows in random order, all of them before any comes again.

        ``begin`` to ``end`` is this call's part of the training.
        """
        keep_room()
        rng = np.random.default_rng(seed)
        # Parameters are views of one row, which a step changes as a whole.
        values = self.flat()
        self.p = self.with_flat(values, copy=False).p
        first, second = np.zeros_like(values), np.zeros_like(values)
        order = np.empty(0, dtype=np.int64)
        for step in range(1, steps + 1):
            while len(order) < batch:
                order = np.append(order, rng.permutation(len(inputs)))
            rows, order = order[:batch], order[batch:]
            _, g = self.gradients(inputs[rows], targets[rows])
            slope = np.concatenate([g[name].ravel() for name in self.p])
            rate = 0.02 * min(1.0, 2 * (1 - begin - (end - begin) * step / (steps + 1)))
            first += 0.1 * (slope - first)
            second += 0.01 * (slope**2 - second)
            mean = first / (1 - 0.9**step)
            spread = np.sqrt(second / (1 - 0.99**step)) + 1e-8
            values -= np.float32(rate) * mean / spread

    def flat(self) -> np.ndarray:
        """All parameters in one row."""
        return np.concatenate([v.ravel() for v in self.p.values()])

    def with_flat(self, values: np.ndarray, copy: bool = True) -> Attention:
        """The same model with the parameters in ``values``."""
        ends = np.cumsum([v.size for v in self.p.values()])
        parts = np.split(np.array(values, dtype=np.float32) if copy else values, ends[:-1])
        named = {name: x.reshape(v.shape) for (name, v), x in zip(self.p.items(), parts)}
        return Attention(self.classes, named)

    def tables(self) -> Scorer:
        p = self.p
        root = p["q"].dtype.type(np.sqrt(WIDTH))

        def placed(name: str, place: str) -> np.ndarray:
            return ((p["embed"] @ p[name])[:, None] + p[place] @ p[name]).reshape(-1, WIDTH)

        return Scorer(
            self.classes,
            placed("q", "place_q") / root,
            placed("k", "place_k"),
            p["embed"] @ p["v"],
            placed("own", "place_q"),
            p["out"],
            p["bias"],
        )


@dataclass(frozen=True)
class Scorer:
    """The model with embeddings multiplied out.

    Values have a row for each class; queries, keys and what a token adds itself have
    one for each class and place.
    """

    classes: int
    q: np.ndarray
    k: np.ndarray
    v: np.ndarray
    own: np.ndarray
    out: np.ndarray
    bias: np.ndarray

    def hidden(self, inputs: np.ndarray) -> tuple[np.ndarray, ...]:
        """Queries, keys, values, weights with their sums, mixed values; then a row for each target."""
        places = inputs.astype(np.intp)
        asked = places[:, BEFORE:] * SCORED + np.arange(SCORED)
        q = self.q.take(asked, axis=0)
        k = self.k.take(places * WINDOW + np.arange(WINDOW), axis=0)
        v = self.v.take(places, axis=0)
        scores = q @ k.transpose(0, 2, 1)
        scores += MASK
        pad = self.classes + 1
        padded = np.flatnonzero(inputs[:, 0] == pad)
        if len(padded):
            before = np.where(inputs[padded] == pad, _LOWEST, 0)
            scores[padded] += before.astype(scores.dtype)[:, None, :]
        weights, total = _powers(scores)
        mixed = weights @ v
        mixed /= total[:, :, None]
        rows = self.own.take(asked, axis=0)
        rows += mixed
        return q, k, v, weights, total, mixed, np.tanh(rows, out=rows).reshape(-1, WIDTH)

    def logits(self, hidden: np.ndarray) -> np.ndarray:
        rows = hidden @ self.out
        rows += self.bias
        return rows

    def log_chances(self, inputs: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Natural log of the chance of each target; 0 where there is none."""
        logits = self.logits(self.hidden(inputs)[-1])
        _, sums = _powers(logits)
        flat = targets.ravel().astype(np.intp)
        real = flat >= 0
        picked = logits.ravel()[np.arange(len(flat)) * self.classes + np.where(real, flat, 0)]
        found = picked - np.log(sums)
        return np.where(real, found, 0).reshape(targets.shape)

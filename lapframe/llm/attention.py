"""A small causal self-attention model over subword ids, in numpy.

Output is factored: a softmax over classes (frequent subwords have a class of their own) times the
subword's share of its class, which comes from counts over the whole training corpus. Sequences are
cut into windows of ``BACK`` positions of context and ``AHEAD`` scored positions; windows overlap, and
each token is scored once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

BACK = 16
AHEAD = 16
SPAN = BACK + AHEAD
WIDTH = 16
HIDDEN = 32
# Classes of one subword each, and classes that share the other subwords.
SINGLE = 64
SHARED = 48
CLASSES = SINGLE + SHARED

# What each scored position may look at: earlier positions and itself.
_SEEN = (np.arange(SPAN)[None, :] <= np.arange(BACK, SPAN)[:, None]).astype(np.float32)
_MASK = np.where(_SEEN > 0, 0, -1e9).astype(np.float32)


@dataclass(frozen=True)
class Vocabulary:
    """``of_class``: class per subword; ``share``: log10 of its share of the class; ``start``: input id that begins a text.

    Inputs are classes too: a frequent subword has its own embedding, others that of their class.
    """

    of_class: np.ndarray
    share: np.ndarray

    @property
    def start(self) -> int:
        return CLASSES

    @property
    def pad(self) -> int:
        return CLASSES + 1


def by_frequency(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids from the most frequent on, and the place of each id in that order."""
    order = np.lexsort((np.arange(len(counts)), -counts))
    rank = np.empty(len(counts), np.int64)
    rank[order] = np.arange(len(counts))
    return order, rank


# Neighbours told apart: each of the frequent subwords, and all others as one.
NEAR = SINGLE + 1


def neighbours(rank: np.ndarray, tokens: np.ndarray, lengths: np.ndarray) -> Iterator[np.ndarray]:
    """One number per subword and neighbour in its sequence, those before first: ``(id * 2 + side) * NEAR + neighbour``."""
    near = np.minimum(rank[tokens], SINGLE)
    inner = np.ones(max(0, len(tokens) - 1), bool)
    inner[np.cumsum(lengths[:-1]) - 1] = False
    ids = tokens.astype(np.int64)
    yield (ids[1:] * 2 * NEAR + near[:-1])[inner]
    yield ((ids[:-1] * 2 + 1) * NEAR + near[1:])[inner]


def clusters(counts: np.ndarray, seen: np.ndarray, rounds: int = 15, seed: int = 0) -> np.ndarray:
    """Class per subword id: the most frequent alone, others that occur by k-means over which frequent
    subwords stand before and after them (``seen``, ids x 2 NEAR), weighted by frequency. The last class
    is that of subwords that do not occur."""
    order, _ = by_frequency(counts)
    of_class = np.full(len(counts), CLASSES - 1, np.int32)
    of_class[order[:SINGLE]] = np.arange(min(SINGLE, len(counts)))
    many = int((counts > 0).sum()) - SINGLE
    if many <= SHARED or not seen.any():
        rest = order[SINGLE:]
        of_class[rest] = SINGLE + np.arange(len(rest)) % SHARED
        return of_class
    x = seen[order[SINGLE : SINGLE + many]].astype(np.float32)
    weight = x.sum(1, dtype=np.float64) + 0.01
    x = np.sqrt(x / weight[:, None].astype(np.float32))
    x -= np.average(x, axis=0, weights=weight).astype(np.float32)
    _, directions = np.linalg.eigh(((x * weight[:, None].astype(np.float32)).T @ x).astype(np.float64))
    x = x @ directions[:, -12:]
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(many, SHARED - 1, replace=False, p=weight / weight.sum())]
    for _ in range(rounds):
        nearest = ((centres**2).sum(1) - 2 * x @ centres.T).argmin(1)
        for j in range(SHARED - 1):
            mine = nearest == j
            if mine.any():
                centres[j] = np.average(x[mine], axis=0, weights=weight[mine])
    of_class[order[SINGLE : SINGLE + many]] = SINGLE + nearest
    return of_class


def classed(counts: np.ndarray, seen: np.ndarray, smoothing: float = 0.1) -> Vocabulary:
    """Classes from ``clusters``; the shares of a class from the corpus ``counts``."""
    of_class = clusters(counts, seen)
    total = np.bincount(of_class, counts + smoothing, CLASSES)
    return Vocabulary(of_class, np.log10((counts + smoothing) / total[of_class]))


def vocabulary(counts: np.ndarray, sequence: np.ndarray, smoothing: float = 0.1) -> Vocabulary:
    """The same with the neighbours counted in one sequence."""
    _, rank = by_frequency(counts)
    found = np.concatenate([*neighbours(rank, sequence, np.array([len(sequence)]))])
    return classed(counts, np.bincount(found, minlength=len(counts) * 2 * NEAR).reshape(len(counts), -1), smoothing)


def windows(tokens: np.ndarray, lengths: np.ndarray, voc: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs (n, SPAN), target classes (n, AHEAD; -1: none) and each window's sequence.

    ``tokens`` holds the sequences one after the other, none of them empty. Position p predicts token p
    from the tokens before it; a sequence's first window has an empty context.
    """
    blocks = -(-lengths // AHEAD)
    first = np.concatenate([[0], np.cumsum(blocks + 1)])  # one block of padding before each sequence
    ends = np.cumsum(lengths)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(tokens)) - (ends - lengths)[owner]
    slot = (first[owner] + 1) * AHEAD + place
    classes = voc.of_class[tokens]
    given = np.full(first[-1] * AHEAD, voc.pad, np.int32)
    wanted = np.full(first[-1] * AHEAD, -1, np.int32)
    wanted[slot] = classes
    later = place[1:] > 0
    given[slot[1:][later]] = classes[:-1][later]
    given[slot[place == 0]] = voc.start
    given, wanted = given.reshape(-1, AHEAD), wanted.reshape(-1, AHEAD)
    own = np.ones(len(given), bool)
    own[first[:-1]] = False
    at = np.flatnonzero(own)
    return np.concatenate([given[at - 1], given[at]], axis=1), wanted[at], np.repeat(np.arange(len(lengths)), blocks)


class Model:
    """Token and position embeddings, one attention head, one hidden layer, class output."""

    NAMES = ("embed", "place", "query", "key", "value", "mix", "up", "up_bias", "down", "out", "out_bias")

    def __init__(self, seed: int = 3) -> None:
        rng = np.random.default_rng(seed)

        def normal(*shape: int) -> np.ndarray:
            return rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)

        self.embed = rng.normal(0, 0.3, (CLASSES + 2, WIDTH)).astype(np.float32)
        self.place = rng.normal(0, 0.1, (SPAN, WIDTH)).astype(np.float32)
        self.query, self.key, self.value, self.mix = (normal(WIDTH, WIDTH) for _ in range(4))
        self.up, self.up_bias = normal(WIDTH, HIDDEN), np.zeros(HIDDEN, np.float32)
        self.down = normal(HIDDEN, WIDTH) * np.float32(0.5)
        self.out, self.out_bias = normal(WIDTH, CLASSES), np.zeros(CLASSES, np.float32)

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Embedding, query, key and value by place and input id, side by side.

        There are few places and ids, so scoring looks these up instead of multiplying.
        """
        x = self.place[:, None, :] + self.embed[None, :, :]
        scaled = x @ self.query * np.float32(1 / np.sqrt(WIDTH))
        ahead = np.concatenate([x, scaled], 2)[BACK:].reshape(-1, 2 * WIDTH)
        sides = np.concatenate([x @ self.key, x @ self.value], 2).reshape(-1, 2 * WIDTH)
        return np.ascontiguousarray(ahead, np.float32), np.ascontiguousarray(sides, np.float32)

    def log10_probabilities(self, given: np.ndarray, wanted: np.ndarray, pad: int, tables: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
        """log10 of the probability of each wanted class, 0 where there is none.

        Exponents are cut at 80, which float32 can hold, instead of shifted by their maximum.
        """
        ahead, sides = tables or self.tables()
        ids, n = len(self.embed), len(given)
        own = ahead.take(given[:, BACK:] + np.arange(AHEAD, dtype=np.int32) * ids, 0)
        side = sides.take(given + np.arange(SPAN, dtype=np.int32) * ids, 0)
        a = own[:, :, WIDTH:] @ side[:, :, :WIDTH].transpose(0, 2, 1)
        np.minimum(a, np.float32(80), out=a)
        np.exp(a, out=a)
        a *= _SEEN
        a *= (given != pad).astype(np.float32)[:, None, :]
        c = (a @ side[:, :, WIDTH:]).reshape(-1, WIDTH)
        c /= a.sum(2).reshape(-1, 1)
        h = c @ self.mix
        h += own[:, :, :WIDTH].reshape(-1, WIDTH)
        u = h @ self.up
        u += self.up_bias
        np.maximum(u, 0, out=u)
        h += u @ self.down
        logits = h @ self.out
        logits += self.out_bias
        np.minimum(logits, np.float32(80), out=logits)
        flat = wanted.ravel()
        chosen = logits[np.arange(len(flat)), np.maximum(flat, 0)].astype(np.float64)
        total = np.exp(logits, out=logits) @ np.ones(CLASSES, np.float32)
        return np.where(flat >= 0, (chosen - np.log(total)) / np.log(10), 0.0).reshape(n, AHEAD)

    def gradients(self, given: np.ndarray, wanted: np.ndarray, pad: int) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of the wanted classes, and its gradient by parameter."""
        kind = self.embed.dtype.type
        size, scale = len(given), kind(1 / np.sqrt(WIDTH))
        x = self.embed[given]
        x += self.place
        sides, ahead = x.reshape(-1, WIDTH), x[:, BACK:].reshape(-1, WIDTH)
        q = ((ahead @ self.query) * scale).reshape(size, AHEAD, WIDTH)
        kv = (sides @ np.concatenate([self.key, self.value], 1)).reshape(size, SPAN, 2 * WIDTH)
        k, v = kv[:, :, :WIDTH], kv[:, :, WIDTH:]
        a = q @ k.transpose(0, 2, 1)
        a += np.where(given == pad, kind(-1e9), kind(0))[:, None, :] + _MASK
        a -= a.max(2, keepdims=True)
        np.exp(a, out=a)
        a /= a.sum(2, keepdims=True)
        c = (a @ v).reshape(-1, WIDTH)
        h = ahead + c @ self.mix
        u = np.maximum(h @ self.up + self.up_bias, 0)
        z = h + u @ self.down
        p = z @ self.out
        p += self.out_bias
        p -= p.max(1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(1, keepdims=True)
        flat = wanted.ravel()
        at = np.flatnonzero(flat >= 0)
        n = max(1, len(at))
        loss = float(-np.log(p[at, flat[at]] + 1e-30).sum() / n)
        d = p
        d[at, flat[at]] -= 1
        d *= ((flat >= 0) / n).astype(kind)[:, None]
        g = {"out": z.T @ d, "out_bias": d.sum(0)}
        dz = d @ self.out.T
        du = dz @ self.down.T
        du *= u > 0
        g["down"], g["up"], g["up_bias"] = u.T @ dz, h.T @ du, du.sum(0)
        dh = dz + du @ self.up.T
        g["mix"] = c.T @ dh
        dc = (dh @ self.mix.T).reshape(size, AHEAD, WIDTH)
        ds = dc @ v.transpose(0, 2, 1)
        ds -= (ds * a).sum(2, keepdims=True)
        ds *= a
        dkv = np.empty_like(kv)
        np.matmul(ds.transpose(0, 2, 1), q, out=dkv[:, :, :WIDTH])
        np.matmul(a.transpose(0, 2, 1), dc, out=dkv[:, :, WIDTH:])
        dkv = dkv.reshape(-1, 2 * WIDTH)
        dq = (ds @ k).reshape(-1, WIDTH) * scale
        g["query"] = ahead.T @ dq
        g["key"], g["value"] = np.split(sides.T @ dkv, 2, axis=1)
        dx = (dkv @ np.concatenate([self.key.T, self.value.T])).reshape(size, SPAN, WIDTH)
        dx[:, BACK:] += (dh + dq @ self.query.T).reshape(size, AHEAD, WIDTH)
        g["place"] = dx.sum(0)
        # the rows of each input id, one after the other
        order = np.argsort(given, axis=None, kind="stable")
        ids = given.ravel()[order]
        first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        g["embed"] = np.zeros_like(self.embed)
        g["embed"][ids[first]] = np.add.reduceat(dx.reshape(-1, WIDTH)[order], first, 0)
        return loss, g

    def flat(self) -> np.ndarray:
        """All parameters as one vector."""
        return np.concatenate([getattr(self, k).ravel() for k in self.NAMES])

    @classmethod
    def unflat(cls, values: np.ndarray) -> Model:
        """The model of such a vector."""
        model, at = cls(), 0
        for k in cls.NAMES:
            old = getattr(model, k)
            setattr(model, k, values[at : at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size
        return model


class Adam:
    """Adam steps on a model's parameters."""

    def __init__(self, model: Model) -> None:
        self.model, self.steps = model, 0
        self.first = {k: np.zeros_like(getattr(model, k)) for k in Model.NAMES}
        self.second = {k: np.zeros_like(getattr(model, k)) for k in Model.NAMES}

    def step(self, given: np.ndarray, wanted: np.ndarray, pad: int, rate: float) -> None:
        self.steps += 1
        _, grads = self.model.gradients(given, wanted, pad)
        for k, g in grads.items():
            self.first[k] = 0.9 * self.first[k] + 0.1 * g
            self.second[k] = 0.99 * self.second[k] + 0.01 * g * g
            change = rate * (self.first[k] / (1 - 0.9**self.steps)) / (np.sqrt(self.second[k] / (1 - 0.99**self.steps)) + 1e-8)
            setattr(self.model, k, (getattr(self.model, k) - change).astype(np.float32))


def train(given: np.ndarray, wanted: np.ndarray, pad: int, steps: int = 600, batch: int = 256, seed: int = 5) -> Model:
    """Adam over random batches of windows, with a falling rate. Without windows the model is as it began."""
    model, rng = Model(), np.random.default_rng(seed)
    if not len(given):
        return model
    adam = Adam(model)
    for step in range(1, steps + 1):
        pick = rng.integers(0, len(given), min(batch, len(given)))
        adam.step(given[pick], wanted[pick], pad, 0.01 * min(1.0, 2 * (1 - step / (steps + 1))))
    return model


def train_on(adam: Adam, given: np.ndarray, wanted: np.ndarray, pad: int, batch: int = 128) -> None:
    """One pass over all the windows, in an order that their number fixes; the rate falls with the steps made."""
    order = np.random.default_rng(len(given)).permutation(len(given))
    for pick in np.array_split(order, -(-len(given) // batch)):
        adam.step(given[pick], wanted[pick], pad, 0.004 / np.sqrt(1 + adam.steps / 100))

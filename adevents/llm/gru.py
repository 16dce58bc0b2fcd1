"""A bidirectional gated recurrent network with attention pooling, in numpy.

Inputs are the words of a window.  A word's input is its own embedding (by a
hash of the word) beside a character embedding, the mean of the embeddings of
its letter trigrams, the word's ends being letters too.  The first number of
each embedding starts as a smoothed log-odds of the class in the training
windows' documents; everything is then trained together with Adam.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

WORD_BUCKETS = 1 << 15
CHAR_BUCKETS = 1 << 15
WORD_SIZE = 8
CHAR_SIZE = 8
HIDDEN = 8
ATTENTION = 8


@dataclass
class Vocabulary:
    """Distinct words of a batch: bucket of each, and the trigram buckets of each (flat, with bounds)."""

    word: np.ndarray
    grams: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.word)


def vocabulary(words: list[str], hashes: np.ndarray) -> Vocabulary:
    """Of distinct words (without NUL) and their 64-bit hashes."""
    letters = np.frombuffer(("\0" + "\0".join(words) + "\0").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    inner = np.flatnonzero(letters[1:-1]) + 1
    with np.errstate(over="ignore"):
        mixed = (
            letters[inner - 1] * np.uint64(0x9E3779B97F4A7C15)
            ^ letters[inner] * np.uint64(0xC2B2AE3D27D4EB4F)
            ^ letters[inner + 1] * np.uint64(0x165667B19E3779F9)
        )
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    grams = (mixed >> np.uint64(40)).astype(np.int64) % CHAR_BUCKETS
    starts = np.flatnonzero(letters[:-1] == 0)  # before each word
    first = np.searchsorted(inner, starts)
    return Vocabulary((hashes % np.uint64(WORD_BUCKETS)).astype(np.int64), grams, np.append(first, len(grams))[: len(words) + 1])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * np.tanh(np.float32(0.5) * x) + np.float32(0.5)


def _means(table: np.ndarray, v: Vocabulary) -> np.ndarray:
    if not len(v):
        return np.zeros((0, table.shape[1]), np.float32)
    sizes = np.diff(v.first)
    return np.add.reduceat(table[v.grams], v.first[:-1], axis=0) / sizes[:, None].astype(np.float32)


def _rows(at: np.ndarray, values: np.ndarray, n: int | None = None):
    """Values added up by row: the rows and their sums, or a table of ``n`` rows."""
    order = np.argsort(at, kind="stable")
    rows = at[order]
    first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    sums = np.add.reduceat(values[order], first, axis=0)
    if n is None:
        return rows[first], sums
    out = np.zeros((n, values.shape[1]), np.float32)
    out[rows[first]] = sums
    return out


class Network:
    """Parameters are float32 arrays in ``p``."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        size = WORD_SIZE + CHAR_SIZE

        def some(*shape, scale):
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        self.p = {"word": some(WORD_BUCKETS, WORD_SIZE, scale=0.01), "char": some(CHAR_BUCKETS, CHAR_SIZE, scale=0.01)}
        for d in "fb":
            self.p |= {
                f"w{d}": some(size, 3 * HIDDEN, scale=0.3),
                f"u{d}": some(HIDDEN, 3 * HIDDEN, scale=0.3),
                f"c{d}": np.zeros(3 * HIDDEN, np.float32),
            }
        self.p |= {
            "wa": some(2 * HIDDEN, ATTENTION, scale=0.3),
            "va": some(ATTENTION, scale=0.3),
            "wo": some(2 * HIDDEN, scale=0.3),
            "bo": np.zeros(1, np.float32),
        }

    def inputs(self, v: Vocabulary) -> np.ndarray:
        return np.concatenate([self.p["word"][v.word], _means(self.p["char"], v)], axis=1)

    # -- one direction ---------------------------------------------------------

    def _run(self, d: str, gates: np.ndarray, at: np.ndarray, mask: np.ndarray | None, tape: list | None) -> np.ndarray:
        """States after each place, ``(places, windows, HIDDEN)``; ``gates`` are the words' input gates."""
        places, n = at.shape
        u, hid = self.p[f"u{d}"], HIDDEN
        h = np.zeros((n, hid), np.float32)
        out = np.empty((places, n, hid), np.float32)
        for t in range(places) if d == "f" else range(places - 1, -1, -1):
            x = gates[at[t]]
            g = h @ u
            zr = _sigmoid(x[:, : 2 * hid] + g[:, : 2 * hid])
            z, r = zr[:, :hid], zr[:, hid:]
            new = np.tanh(x[:, 2 * hid :] + r * g[:, 2 * hid :])
            after = new + z * (h - new)
            if mask is not None:
                after = np.where(mask[t][:, None], after, h)
            if tape is not None:
                tape.append((t, h, z, r, new, g[:, 2 * hid :]))
            h = out[t] = after
        return out

    def gates(self, x: np.ndarray) -> dict[str, np.ndarray]:
        """What the words' inputs add to the gates of either direction."""
        return {d: x @ self.p[f"w{d}"] + self.p[f"c{d}"] for d in "fb"}

    def forward(self, gates: dict[str, np.ndarray], at: np.ndarray, mask: np.ndarray | None, keep: bool = False):
        """Logits of windows; ``at`` (places x windows) numbers the words that ``gates`` has."""
        p = self.p
        tapes = {d: [] if keep else None for d in "fb"}
        states = [self._run(d, gates[d], at, mask, tapes[d]) for d in "fb"]
        h = np.concatenate(states, axis=2)
        a = np.tanh(h @ p["wa"])
        score = a @ p["va"]
        if mask is not None:
            score = np.where(mask, score, np.float32(-1e9))
        score = np.exp(score - score.max(axis=0))
        share = score / score.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", share, h)
        logit = pooled @ p["wo"] + p["bo"]
        return (logit, (tapes, h, a, share, pooled)) if keep else logit

    # -- training ----------------------------------------------------------------

    def gradients(self, v: Vocabulary, at: np.ndarray, mask: np.ndarray, label: np.ndarray, weight: np.ndarray):
        p, hid = self.p, HIDDEN
        x = self.inputs(v)
        logit, (tapes, h, a, share, pooled) = self.forward(self.gates(x), at, mask, keep=True)
        error = ((_sigmoid(logit) - label) * weight / weight.sum()).astype(np.float32)
        grad = {"wo": pooled.T @ error, "bo": np.array([error.sum()], np.float32)}
        d_pooled = error[:, None] * p["wo"]
        d_share = np.einsum("nh,tnh->tn", d_pooled, h)
        d_score = share * (d_share - (share * d_share).sum(axis=0))
        d_a = d_score[:, :, None] * p["va"] * (1 - a * a)
        grad["va"] = np.einsum("tn,tna->a", d_score, a)
        grad["wa"] = np.einsum("tnh,tna->ha", h, d_a)
        d_h = share[:, :, None] * d_pooled + d_a @ p["wa"].T
        d_x = np.zeros_like(x)
        for k, d in enumerate("fb"):
            u, w = p[f"u{d}"], p[f"w{d}"]
            d_u, per_place = np.zeros_like(u), np.zeros((*at.shape, 3 * hid), np.float32)
            back = np.zeros((at.shape[1], hid), np.float32)
            for t, before, z, r, new, g in reversed(tapes[d]):
                total = back + d_h[t, :, k * hid : (k + 1) * hid]
                on = mask[t][:, None]
                d_after = total * on
                d_new = d_after * (1 - z) * (1 - new * new)
                d_z = d_after * (before - new) * z * (1 - z)
                d_r = d_new * g * r * (1 - r)
                d_g = np.concatenate([d_z, d_r, d_new * r], axis=1)
                d_u += before.T @ d_g
                back = d_after * z + total * ~on + d_g @ u.T
                per_place[t] = np.concatenate([d_z, d_r, d_new], axis=1)
            d_gates = _rows(at.reshape(-1), per_place.reshape(-1, 3 * hid), len(x))
            grad |= {f"u{d}": d_u, f"w{d}": x.T @ d_gates, f"c{d}": d_gates.sum(axis=0)}
            d_x += d_gates @ w.T
        sizes = np.diff(v.first)
        grad["word"] = _rows(v.word, d_x[:, :WORD_SIZE])
        grad["char"] = _rows(v.grams, np.repeat(d_x[:, WORD_SIZE:] / sizes[:, None], sizes, axis=0))
        loss = np.logaddexp(0, np.where(label > 0, -logit, logit)) * weight / weight.sum()
        return float(loss.sum()), grad


class Adam:
    def __init__(self, p: dict[str, np.ndarray], rate: float = 0.01):
        self.p, self.rate, self.t = p, rate, 0
        self.m = {k: np.zeros_like(x) for k, x in p.items()}
        self.v = {k: np.zeros_like(x) for k, x in p.items()}

    def step(self, grad: dict) -> None:
        """A gradient is an array, or the rows that have one and their values (the others stay)."""
        self.t += 1
        for k, g in grad.items():
            at, g = g if isinstance(g, tuple) else (slice(None), g)
            m = self.m[k][at] + np.float32(0.1) * (g - self.m[k][at])
            v = self.v[k][at] + np.float32(0.001) * (g * g - self.v[k][at])
            self.m[k][at], self.v[k][at] = m, v
            step = (m / (1 - 0.9**self.t)) / (np.sqrt(v / (1 - 0.999**self.t)) + 1e-8)
            self.p[k][at] -= (self.rate * step).astype(np.float32)
